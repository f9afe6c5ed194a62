"""Relational operators on fixtures that show each order and tie rule."""

from pyspark.sql import functions as F

from paperloom.operators import layout, neighbourhood, records
from paperloom.plans.forms import FORMS, route
from paperloom.streaming import landing


def words(spark, rows):
    return spark.createDataFrame([(1, 1, i, float(x), float(y), float(x + 20), float(y + 10), t) for i, (x, y, t) in enumerate(rows)], "doc_id long, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string")


def texts(df, order):
    return [r.text for r in df.orderBy(order).collect()]


def test_half_even_line_buckets(spark):
    got = layout.lines_fixed(words(spark, [(0, 4.5, "a"), (30, 6, "b"), (60, 7.5, "c")]), 3.0)
    assert texts(got, "y") == ["a b c"]  # 1.5 and 2.5 both round to 2


def test_chain_joins_what_anchor_splits(spark):
    assert texts(layout.lines_chain(words(spark, [(0, 0, "a"), (30, 5, "b"), (60, 10, "c")]), 5.0), "line") == ["a b c"]
    assert texts(layout.lines_anchor(words(spark, [(0, 0, "a"), (30, 3, "b"), (60, 6, "c")]), 3.0), "line") == ["a b", "c"]


def test_three_columns(spark):
    df = words(spark, [(10, 0, "Deduction"), (83, 0, "Code"), (123, 0, "(W)"), (240, 0, "Active"), (450, 0, "Inactive")])
    got = df.groupBy("doc_id").agg(*layout.three_columns(F.lit(230), F.lit(440))).collect()[0]
    assert (got.c1, got.c2, got.c3) == ("Deduction Code (W)", "Active", "Inactive")


def test_prefix_merge_is_ordered(spark):
    rows = [(1, 1, "900-01-0001", "Jo", "", "Roe", ""), (1, 2, "900-01-0001", "Jonathan", "Q", "ROE", "Jr"), (1, 3, "900-01-0001", "Jon", "Z", "Roe", ""), (1, 4, "900-01-0001", "Ann", "", "Roe", ""), (1, 5, "", "Jo", "", "Roe", "")]
    got = records.merge_prefixes(spark.createDataFrame(rows, "doc_id long, ord long, ssn string, first string, middle string, last string, suffix string")).orderBy("ord").collect()
    assert [(r.ord, r.first, r.middle, r.suffix) for r in got] == [(1, "Jonathan", "Q", "Jr"), (4, "Ann", "", ""), (5, "Jo", "", "")]


def test_partial_numbers_go_beside_full_ones(spark):
    df = spark.createDataFrame([(1, "900-01-0001"), (1, "900-01-XXXX"), (1, "900-02-XXXX"), (1, "")], "doc_id long, ssn string")
    assert sorted(r.ssn for r in records.drop_partial(df, "ssn", ["doc_id"]).collect()) == ["", "900-01-0001", "900-02-XXXX"]


def test_substring_aware_append(spark):
    df = spark.createDataFrame([(["15", "5", "6"],)], "v array<string>")
    assert df.select(records.appended(F.col("v"), "; ")).collect()[0][0] == "15; 6"


def test_greedy_groups_compare_with_founders(spark):
    grid = "0" * 20
    df = spark.createDataFrame([("a", "p", grid, ["w1", "w2"]), ("b", "p", "1" * 20, ["x1"]), ("c", "p", "0" * 19 + "1", ["y"]), ("d", "l", grid, ["w1"]), ("e", "p", "01" * 10, ["w1", "w2", "w3"])], "file string, orientation string, grid string, tokens array<string>")
    got = {r.file: r.group for r in records.greedy_groups(df).collect()}
    assert got == {"a": "p_1", "b": "p_2", "c": "p_1", "d": "l_1", "e": "p_1"}


def test_nearest_label_ties_and_fallback(spark):
    fields = spark.createDataFrame([(1, 1, 1, 100.0, 100.0, 180.0, 112.0, "alt"), (1, 1, 2, 500.0, 700.0, 580.0, 712.0, "alt2")], "doc_id long, page int, field int, fx0 double, ftop double, fx1 double, fbottom double, fallback string")
    lines = spark.createDataFrame([(1, 1, 1, 20.0, 101.0, 90.0, 111.0, "First:"), (1, 1, 2, 20.0, 101.0, 90.0, 111.0, "Second:")], "doc_id long, page int, line_no int, x0 double, top double, x1 double, bottom double, text string")
    got = {r.field: r.label for r in neighbourhood.nearest_label(fields, lines).collect()}
    assert got[1] == "First" and got[2] in ("First", "alt2")


def test_label_value_reach(spark):
    df = spark.createDataFrame([("Pay Date" + "." * 130 + "1/2/2024",), ("Pay Date: 1/2/2024",), ("nothing",)], "t string")
    assert [r[0] for r in df.select(neighbourhood.label_value(F.col("t"), ["Pay Date"], r"\d{1,2}/\d{1,2}/\d{2,4}")).collect()] == ["", "1/2/2024", ""]


def test_order_does_not_depend_on_partitions(spark):
    rows = [(1, i, "v" + str(i % 3)) for i in range(50)]
    out = []
    for n in (1, 7):
        df = spark.createDataFrame(rows, "k int, ord int, v string").repartition(n)
        out.append(df.groupBy("k").agg(records.ordered_distinct("v", ["ord"], ";").alias("x")).collect())
    assert out[0] == out[1] and out[0][0].x == "v0;v1;v2"


def test_routing_priority(spark):
    df = spark.createDataFrame([(1, "form 1095-c with the employee's social security number", True), (2, "health plan id", True), (3, "", False)], "doc_id int, text string, has_text boolean")
    assert [r.format for r in route(df).orderBy("doc_id").collect()] == ["w2", "claims", "patient-info"]
    assert [r.format for r in route(df, ["1095c"]).orderBy("doc_id").collect()] == ["1095c", None, None]


def test_w2_form(spark):
    page = "Form W-2 2023\na Employee's social security number\n900-12-3456\n1 Wages, tips, other comp.\n1863.84"
    got = FORMS["w2"].extract(spark.createDataFrame([(1, 1, page)], "doc_id long, page int, text string")).collect()[0]
    assert (got.tax_year, got.employee_ssn, got.box_1_wages, got.box_2_federal_tax) == ("2023", "900-12-3456", "1863.84", "")


def test_landing_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, 1, 2, "b"), (1, 1, 1, "a"), (2, 1, 1, "c")], landing.LINES).write.parquet(source)
    from paperloom.sources.lines import pages_of_lines

    landing.watch(spark, source, pages_of_lines, sink, str(tmp_path / "state")).awaitTermination(60)
    assert {(r.doc_id, r.text) for r in spark.read.parquet(sink).collect()} == {(1, "a\nb"), (2, "c")}


def test_line_csv(spark, tmp_path):
    from paperloom.sources.lines import open_pages

    path = tmp_path / "x.csv"
    path.write_text('File Name,Page Number,Extracted Text\nf,1,001\nf,1,\nf,2,"a, b"\n')
    assert {(r.doc_id, r.page, r.text) for r in open_pages(spark, str(path)).collect()} == {("f", 1, "001\n"), ("f", 2, "a, b")}


def test_greedy_groups_against_one_pass(spark):
    import random

    r = random.Random(5)
    base = ["".join(r.choice("01") for _ in range(192)) for _ in range(4)]
    vocabulary = [f"word{i}" for i in range(14)]
    rows = []
    for i in range(140):
        grid = list(r.choice(base))
        for _ in range(r.randrange(0, 24)):
            grid[r.randrange(192)] = r.choice("01")
        rows.append((f"f{i:03}", r.choice(["p", "l"]), "".join(grid) if i % 9 else "", r.sample(vocabulary, r.randrange(0, 9)) if i % 4 else ["same", "words"]))
    rows += [("f900", "p", rows[0][2], rows[0][3]), ("g", "p", "", [])]
    founders, want = {}, {}
    for name, side, grid, words in sorted(rows):
        own, words = founders.setdefault(side, []), set(words)
        for n, (g, w) in enumerate(own):
            if g and sum(a == b for a, b in zip(g, grid)) >= 0.92 * len(g) or w and words and len(w & words) >= 0.6 * len(w | words):
                break
        else:
            n = len(own)
            own.append((grid, words))
        want[name] = f"{side}_{n + 1}"
    got = {x.file: x.group for x in records.greedy_groups(spark.createDataFrame(rows, "file string, orientation string, grid string, tokens array<string>")).collect()}
    assert got == want and len(set(want.values())) > 20


def test_greedy_groups_compare_with_founders_alone(spark, monkeypatch):
    """Of 400 layouts that are all alike one founder, the blocks after the first make no pairs among themselves."""
    made = []
    kept = records._kept

    def counted(df):
        out = kept(df)
        made.append((df.columns, out.count()))
        return out

    monkeypatch.setattr(records, "_kept", counted)
    rows = [(f"f{i:03}", "p", "0" * (180 - i % 10) + "1" * (12 + i % 10), [f"w{i}"]) for i in range(400)] + [(f"g{i}", "p", "01" * 48 + f"{1 << i:096b}", [f"v{i}"]) for i in range(40)]
    got = {x.file: x.group for x in records.greedy_groups(spark.createDataFrame(rows, "file string, orientation string, grid string, tokens array<string>"), first=20, block=20).collect()}
    assert got == {f: "p_1" if f[0] == "f" else "p_2" for f, *_ in rows}
    assert max(n for columns, n in made if columns == ["orientation", "a", "b"]) <= 20 * 19 // 2


def test_alike_links_against_all_pairs(spark):
    import random

    r = random.Random(7)
    base = ["".join(r.choice("01") for _ in range(192)) for _ in range(3)]
    rows = []
    for i in range(120):
        grid = list(r.choice(base))
        for _ in range(r.choice([0, 0, 8, 14, 22])):
            grid[r.randrange(192)] = r.choice("01")
        rows.append((f"f{i:03}", r.choice(["p", "l"]), "".join(grid) if i % 7 else "", r.sample([f"word{k}" for k in range(9)], r.randrange(0, 7)) if i % 5 else ["same", "words", "same"]))
    rows += [(f"g{i}", *rows[i][1:3], rows[i][3][::-1]) for i in range(9)] + [("h", "p", "", []), ("i", "p", "", [])]
    equal, want = {}, {}
    for f, side, grid, words in rows:
        first = equal.setdefault((side, grid, frozenset(words)) if grid or words else f, f)
        alike = lambda g, w: grid and g and sum(a == b for a, b in zip(g, grid)) >= 0.92 * 192 or w and words and 10 * len(w & set(words)) >= 6 * len(w | set(words))  # noqa: B023, E731
        want[f] = side, first, sum(bool(alike(g, set(w))) for e, o, g, w in rows if o == side and e != f)
    got = records.alike_links(spark.createDataFrame(rows, "file string, orientation string, grid string, tokens array<string>")).collect()
    assert {x.file: (x.orientation, x["class"], x.links) for x in got} == want and len(got) == len(rows)
