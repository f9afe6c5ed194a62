import pytest

from paperloom import __main__ as main
from paperloom.operators import progress
from paperloom.sources import lines


def test_command_line(spark, tmp_path):
    pages = spark.createDataFrame([("a", 1, "Wage and Tax Statement 2020\n1 Wages, tips $12.00"), ("b", 1, "nothing much to see in this letter, which is long enough")], "doc_id string, page int, text string")
    words = spark.createDataFrame([("a", 1, 0, 10.0, 10.0, 20.0, 20.0, "Wage")], "doc_id string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string")
    for name, df in (("pages", pages), ("words", words)):
        df.write.parquet(f"{tmp_path}/in/{name}")
    assert main.main(["w2", f"{tmp_path}/in", f"{tmp_path}/out"]) == 0
    assert {r.doc_id: r.box_1_wages for r in spark.read.parquet(f"{tmp_path}/out/rows").collect()} == {"a": "$12.00", "b": ""}
    assert main.main(["bucket11", f"{tmp_path}/in", f"{tmp_path}/log"]) == 0
    assert [r["Records Found"] for r in spark.read.parquet(f"{tmp_path}/log/report").collect()] == ["No"]
    with pytest.raises(SystemExit):
        main.main(["no-such-format", "x", "y"])


def test_progress(spark):
    assert [progress.time_left(x) for x in (None, -1, 5, 65, 3723.9)] == ["calculating...", "calculating...", "5s", "1m 05s", "1h 02m 03s"]
    assert progress.estimate(0, 9, 1.0) is None and progress.estimate(3, 9, 6.0) == 12.0 and progress.tasks(spark) == (0, 0)


def test_auto_reads_what_else_there_is(spark, tmp_path):
    """Tables that lie beside pages and words go to the extractor that names them; a document without anything is a reject."""
    pages = spark.createDataFrame([("a", 1, "SECTION\na letter with a sufficient amount of text"), ("b", 1, "a letter without sections, of a sufficient length")], "doc_id string, page int, text string")
    rows = spark.createDataFrame([("a", 1, 1, 0, ["Name", "Total"], None, None, None, None), ("a", 1, 1, 1, ["Ann", "7"], None, None, None, None)], "doc_id string, page int, tbl int, row int, cells array<string>, x0 double, y0 double, x1 double, y1 double")
    for name, df in (("pages", pages), ("words", lines.laid_out_words(pages)), ("tables", rows)):
        df.write.parquet(f"{tmp_path}/in/{name}")
    assert main.main(["auto", f"{tmp_path}/in", f"{tmp_path}/out"]) == 0
    got = spark.read.parquet(f"{tmp_path}/out/rows").collect()
    assert sorted((r.doc_id, r.format, r.fields["category"], r.fields["name"], r.fields.get("value")) for r in got) == [("a", "generic", "Section", "SECTION", "a letter with a sufficient amount of text"), ("a", "generic", "Table", "Row 1 (Table 1)", "Name: Ann | Total: 7")]
    assert [(r.doc_id, r.why) for r in spark.read.parquet(f"{tmp_path}/out/rejects").collect()] == [("b", "nothing found")]
