"""Files listed, read by an engine, written and read back."""

import pytest
from pyspark.sql import functions as F

from paperloom.sinks import files as W
from paperloom.sources import files as S


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name, text in (("a.pdf", "one two\fthree"), ("B.PDF", "x"), ("c.txt", "y"), ("d.pdf", "!"), ("sub/e.pdf", "deep")):
        (tmp_path / "in" / name).write_text(text)
    return str(tmp_path / "in")


def names(df):
    return [r.path.rsplit("/", 1)[1] for r in df.collect()]


def test_listing(spark, folder):
    assert names(S.list_files(spark, folder)) == ["a.pdf", "d.pdf"] and names(S.list_files(spark, folder, recursive=True)) == ["a.pdf", "d.pdf", "e.pdf"]
    assert names(S.list_files(spark, f"{folder}/a.pdf")) == ["a.pdf"] and names(S.resolve(spark, folder)) == ["B.PDF", "a.pdf", "d.pdf"]
    with pytest.raises(FileNotFoundError):
        S.resolve(spark, f"{folder}/c.txt")


def test_reading_by_an_engine(spark, folder):
    engines = ("no.such.engine", "tests.plain_engine")
    texts = S.page_texts(spark, f"{folder}/*.pdf", engines)
    assert sorted((r.path[-5:], r.page or 0, r.pages, r.text or "", bool(r.error)) for r in texts.collect()) == [("a.pdf", 1, 2, "one two", False), ("a.pdf", 2, 2, "three", False), ("d.pdf", 0, 0, "", True)]
    assert sorted((r.path[-5:], r.pages) for r in S.page_counts(texts).collect()) == [("a.pdf", 2), ("d.pdf", 0)]
    words = S.page_words(spark, f"{folder}/*.pdf", engines)
    assert sorted((r.page, r.ord, r.x0, r.text) for r in words.collect()) == [(1, 0, 0.0, "one"), (1, 1, 10.0, "two"), (2, 2, 0.0, "three")]
    with pytest.raises(ImportError):
        S.engine(("no.such.engine",))


def test_recognition(spark):
    w = spark.createDataFrame([(1, 300.0, 600.0, 330.0, 612.0, "ok", 90.0), (2, 0.0, 0.0, 1.0, 1.0, " ", 50.0), (3, 0.0, 0.0, 1.0, 1.0, "low", -1.0), (4, 150.0, 0.0, 1.0, 1.0, "none", None)], "ord int, x0 double, y0 double, x1 double, y1 double, text string, conf double")
    assert sorted((r.ord, r.x0, r.y0) for r in S.recognised(w).collect()) == [(1, 72.0, 144.0), (4, 36.0, 0.0)]
    t = spark.createDataFrame([(1, "n", "p", "o"), (2, " ", "p", "o"), (3, "", None, "o"), (4, None, "", "")], "doc_id int, native string, pdfium string, ocr string")
    got = {m: [(r.text, r.method) for r in S.chosen_text(t, m).orderBy("doc_id").collect()] for m in ("never", "auto", "always")}
    assert got == {"never": [("n", "native"), ("p", "pdfium"), ("", "pdfium"), ("", "pdfium")], "auto": [("n", "native"), ("p", "pdfium"), ("o", "ocr"), ("", "ocr")], "always": [("o", "ocr"), ("o", "ocr"), ("o", "ocr"), ("", "ocr")]}
    pages = spark.createDataFrame([(1, 1, "short"), (1, 2, "x" * 30), (2, 1, ""), (3, 1, None), (3, 2, "")], "doc_id int, page int, text string")
    done = spark.createDataFrame([(2, 1), (3, 1)], "doc_id int, pages long")
    assert sorted(tuple(r) for r in S.to_recognise(pages, done).collect()) == [(1, 1), (3, 1), (3, 2)]
    rows = spark.createDataFrame([(1, ["DOC-ID", "Last  Name", None]), (2, ["x", "y", "z"])], "row int, cells array<string>")
    assert sorted(tuple(r) for r in S.template_columns(rows).collect()) == [("doc id", 1), ("last name", 2)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a.pdf", 1, "=1+1", None), ("a.pdf", 2, 'say "hi", ok', "line\nbreak"), ("b.x.pdf", 1, "é", "")], "doc_id string, ord int, v string, w string")
    plain = sorted(tuple(r) for r in df.fillna("").collect())
    own = W.per_document(df, f"{tmp_path}/own")
    assert sorted({r.file for r in own.collect()}) == ["a_extracted", "b.x_extracted"]
    assert all(x.name.startswith(("bucket=", "_", ".")) for x in (tmp_path / "own").iterdir()) and len(list((tmp_path / "own").glob("bucket=*"))) <= W.BUCKETS
    assert {(r.file, r.rows, r.parts) for r in W.manifest(spark, f"{tmp_path}/own").collect()} == {("a_extracted", 2, 1), ("b.x_extracted", 1, 1)}
    assert sorted(r.ord for r in W.output(spark, f"{tmp_path}/own", "a_extracted").collect()) == [1, 2]
    both = W.combined(df, f"{tmp_path}/all")
    assert both.columns == ["Document ID", "ord", "v", "w"] and both.count() == 3
    back = W.csv(df, f"{tmp_path}/csv", mark=True)
    assert sorted((r.doc_id, int(r.ord), r.v, r.w) for r in back.collect()) == [(a, b, "'=1+1" if c == "=1+1" else c, d) for a, b, c, d in plain]
    assert set(W.file_bytes(f"{tmp_path}/csv")) == {b"\xef\xbb\xbf"} and b"\xef\xbb\xbf" not in W.file_bytes(str(W.csv(df, f"{tmp_path}/csv2") and f"{tmp_path}/csv2"))
    seen = W.views({"all": df, "first": df.filter("ord = 1")}, f"{tmp_path}/views")
    assert {n: v.count() for n, v in seen.items()} == {"all": 3, "first": 2}
    W.increment(df, f"{tmp_path}/inc")
    again = W.increment(df.filter("doc_id = 'a.pdf' and ord = 1").withColumn("v", F.lit("new")), f"{tmp_path}/inc")
    assert sorted((r.doc_id, r.ord, r.v) for r in again.collect()) == [("a.pdf", 1, "new"), ("b.x.pdf", 1, "é")]
    sheet = W.template(df, ("c1", "c2", "c3"), {"c1": F.col("v"), "c3": F.col("ord")}, (("One", "Two"), ("h1", "h2", "h3")))
    assert sorted((r.doc_id, r.row, r.cells) for r in sheet.filter("doc_id = 'a.pdf'").collect()) == [("a.pdf", 1, ["One", "Two", ""]), ("a.pdf", 2, ["h1", "h2", "h3"]), ("a.pdf", 3, ["=1+1", "", "1"]), ("a.pdf", 4, ['say "hi", ok', "", "2"])]
    assert {r.column: r.width for r in W.widths(df, 10).collect()} == {"doc_id": 9, "ord": 5, "v": 10, "w": 10}
    assert W.replace(spark, f"{tmp_path}/csv", f"{tmp_path}/csv2") and not (tmp_path / "csv").exists() and not W.replace(spark, f"{tmp_path}/none", f"{tmp_path}/x", tries=2, wait=0)


def test_ranges_of_pages(spark, tmp_path):
    """A file's pages are read by ranges in tasks of their own; a broken file is one row with its error."""
    (tmp_path / "long.txt").write_bytes("\f".join(f"page {n}\n x" for n in range(1, 61)).encode())
    (tmp_path / "bad.txt").write_bytes(b"\xff\xfe\xff")
    ranges = S.page_ranges(spark, str(tmp_path), ("paperloom.sources.engine_plain",), "*.txt", per=25)
    assert sorted((r.first, r.last, r.pages, bool(r.error)) for r in ranges.collect()) == [(0, 0, 0, True), (1, 25, 60, False), (26, 50, 60, False), (51, 60, 60, False)]
    texts = S.range_texts(ranges, ("paperloom.sources.engine_plain",)).collect()
    assert sorted((r.page or 0, r.text or "") for r in texts) == [(0, "")] + [(n, f"page {n}\n x") for n in range(1, 61)]
    words = S.range_words(ranges, ("paperloom.sources.engine_plain",)).filter("page = 51").orderBy("ord").collect()
    assert [(r.ord, r.x0, r.y0, r.text) for r in words] == [(0, 0.0, 0.0, "page"), (1, 40.0, 0.0, "51"), (2, 8.0, 20.0, "x")]


def test_ranges_travel_with_their_own_pages(spark, tmp_path):
    """Where the engine cuts, a range holds its pages alone, empty ones at its end included; else the whole file, read by the same places."""
    texts = [f"page {n}" if n % 5 else "" for n in range(1, 61)]
    (tmp_path / "long.txt").write_bytes("".join(t + "\f" for t in texts).encode())
    for engines, begins in ((("paperloom.sources.engine_plain",), [1, 26, 51]), (("tests.whole_engine",), [1, 1, 1])):
        ranges = S.page_ranges(spark, str(tmp_path), engines, "*.txt", per=25)
        got = ranges.orderBy("first").collect()
        assert [(r.first, r.last, r.begin) for r in got] == list(zip([1, 26, 51], [25, 50, 60], begins))
    ranges = S.page_ranges(spark, str(tmp_path), ("paperloom.sources.engine_plain",), "*.txt", per=25)
    assert b"".join(r.content for r in ranges.orderBy("first").collect()) == (tmp_path / "long.txt").read_bytes()
    assert [(r.page, r.text) for r in S.range_texts(ranges, ("paperloom.sources.engine_plain",)).orderBy("page").collect()] == list(enumerate(texts, 1))
    words = S.range_words(ranges, ("paperloom.sources.engine_plain",)).orderBy("page", "ord").collect()
    assert [(r.page, r.ord, r.text) for r in words] == [(n, i, w) for n, t in enumerate(texts, 1) for i, w in enumerate(t.split())]


def test_tables_written_in_parts_are_one_file_each(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(10).write.parquet(f"{tmp_path}/old/part.parquet")
    (tmp_path / "nation.parquet").write_bytes(b"1234")
    from paperloom.plans import catalog

    for name in ("src_01", "src_02"):
        assert sorted(r.name for r in catalog.queries()[name](spark, str(tmp_path)).collect()) == ["nation.parquet", "orders.parquet"]
    parts = sum(p.stat().st_size for p in (tmp_path / "orders.parquet").glob("*.parquet"))
    assert [r.length for r in S.list_files(spark, str(tmp_path), "*.parquet").collect()] == [4, parts]
