"""Field trees, signatures and generic documents, with the rows spelled out."""

import pytest

from paperloom.plans import fields, generic
from paperloom.sources import fields as S


def node(doc, n, parent=None, at=0, listed=True, page=None, box=None, subtype=None, **more):
    names = ("T", "TU", "FT", "V", "flags", "signed", "sig_name", "sig_date", "sig_reason", "sig_location", "sig_contact")
    return (doc, n, parent, at, listed, subtype, page, *(float(x) for x in box or ()), *([None] * (4 if box is None else 0)), *[more.get(c) for c in names])


@pytest.fixture(scope="module")
def nodes(spark):
    rows = [
        node(1, 1, at=0, T="person", FT="/Tx", TU="Person"), node(1, 2, 1, 0, page=1, box=(100, 700, 200, 712), T="first", V=" Jane "), node(1, 3, 1, 1, page=1, box=(100, 650, 200, 662), V="/Off", FT="/Btn"),
        node(1, 4, at=1, T="lead", V="x", page=1, box=(100, 600, 200, 612), FT="/Ch", flags=1), node(1, 5, at=2, T="sig", FT="/Sig", signed=True, sig_name="Ann Lee", sig_date="D:20240102030405-06'00'", sig_reason="ok"), node(1, 6, 5, 0, page=2, box=(10, 10, 50, 20)),
        node(1, 7, at=3, T="sig2", FT="/Sig", page=2, box=(60, 10, 90, 20), signed=False), node(2, 1, None, 0, False, 1, (10, 10, 60, 20), "/Widget", T="loose", FT="/Tx", V="/abc  d"), node(2, 2, None, 1, False, 1, (10, 30, 60, 40), "/Link", T="link"), node(3, 1, T="nowhere", V="v"),
    ]
    return spark.createDataFrame(rows, S.NODE)


def test_leaf_values(nodes):
    assert sorted((r.doc_id, r.ord, r.name, r.value) for r in S.leaf_values(nodes).collect()) == [(1, "000000/000000", "first", "Jane"), (1, "000001", "lead", "x"), (3, "000000", "nowhere", "v")]


def test_widgets(nodes):
    got = sorted((r.doc_id, r.page, r.ord, r.name, r.alt, r.kind, r.raw, r.signed, r.sig_name) for r in S.widgets(nodes).collect())
    assert got == [
        (1, 1, "000000/000000", "first", "Person", "Text", " Jane ", False, ""), (1, 1, "000000/000001", "person", "Person", "Checkbox / Radio", "/Off", False, ""), (1, 1, "000001", "lead", "", "Dropdown / List", "x", False, ""),
        (1, 2, "000002/000000", "sig", "", "Signature", None, True, "Ann Lee"), (1, 2, "000003", "sig2", "", "Signature", None, False, ""), (2, 1, "000000", "loose", "", "Text", "/abc  d", False, ""),
    ]


LINES = [(1, 2, 1, "Digitally signed by Ann Lee"), (1, 2, 2, "Date: 2024.12.09 08:36:48 -06'00'"), (1, 1, 1, "Digitaly signed bv: Bob Roe,"), (1, 1, 2, "note"), (1, 1, 3, "Date 2023-01-02")]


def test_long_wide_and_summary_rows(spark, nodes):
    lines = spark.createDataFrame(LINES, "doc_id long, page int, ord int, text string")
    rows = fields.long_rows(S.widgets(nodes), lines)
    got = [(r.doc_id, r.ord, r["Page Number"], r["Field Name"], r["Field Type"], r.Value, r["Read Only"], r.Signed, r["Signer Name"], r["Signed Date"], r.Source) for r in rows.orderBy("doc_id", "ord").collect()]
    assert [g[:9] + g[10:] for g in got] == [
        (1, 1, 1, "first", "Text", "Jane", "No", "", "", ""), (1, 2, 1, "person", "Checkbox / Radio", "/Off", "No", "", "", ""), (1, 3, 1, "lead", "Dropdown / List", "x", "Yes", "", "", ""), (1, 4, 1, "", "Signature (flattened)", "Bob Roe", "", "Yes", "Bob Roe", "page text (flattened)"),
        (1, 5, 2, "sig", "Signature", "Ann Lee", "No", "Yes", "Ann Lee", "signature field"), (1, 6, 2, "sig2", "Signature", "", "No", "No", "", "signature field"), (2, 1, 1, "loose", "Text", "/abc  d", "No", "", "", ""),
    ]
    assert got[4][9].startswith("2024-01-02 03:04:05") and got[3][9] == "2023-01-02"
    wide = {r.doc_id: r.row for r in fields.wide_rows(rows).collect()}
    assert wide[1]["Person"] == "Jane" and wide[1]["Person (2)"] == "/Off" and wide[1]["lead"] == "x" and wide[1]["Signature 1 Signer Name"] == "Bob Roe" and wide[1]["Signature 2 Signed"] == "Yes" and wide[1]["Signature 3 Signed"] == "No"
    boxes = spark.createDataFrame([(1, 1, 1, "HCC Advisor", 100.0, 100.0, 200.0, 110.0), (1, 1, 2, "Other", 300.0, 100.0, 350.0, 110.0), (1, 2, 3, "Missing", 10.0, 10.0, 20.0, 20.0)], "doc_id long, page int, ord int, label string, x0 double, top double, x1 double, bottom double")
    drawn = S.widgets(nodes).selectExpr("doc_id", "page", "ord", "kind", "raw", "x0", "792 - y1 as top", "x1", "792 - y0 as bottom")
    text = spark.createDataFrame([(1, 1, 1, "far above", 300.0, 40.0, 340.0, 50.0), (1, 1, 2, "just above", 300.0, 85.0, 340.0, 95.0), (1, 1, 3, "other value", 300.0, 118.0, 340.0, 126.0)], "doc_id long, page int, line_no int, text string, x0 double, top double, x1 double, bottom double")
    found = fields.beside_labels(boxes, drawn, text)
    assert sorted((r.label, r.value, r.source) for r in found.collect()) == [("HCC Advisor", "Jane", "form field"), ("Missing", "", ""), ("Other", "just above", "page text (flattened)")]
    s = {r.doc_id: r for r in fields.summary(found, rows).collect()}[1]
    assert s["values"]["HCC Advisor"] == "Jane" and s.Signed == "Yes" and s["Signer Name"] == "Bob Roe; Ann Lee" and s["Signature Source"] == "page text (flattened); signature field"


def test_generic_document(spark, nodes):
    def word(page, y, x, text, size=10.0, font="Plain"):
        return (1, page, int(y * 1000 + x), float(x), float(y), float(x + 8 * len(text)), float(y + 8), text, size, font)

    words = [
        *(word(1, 10, 10 + 60 * i, t) for i, t in enumerate(["EMPLOYER", "ID:", "12"])), word(1, 20, 10, "lost"), *(word(1, 30, 10 + 60 * i, t, 14.0) for i, t in enumerate(["Big", "Header:"])), word(1, 40, 10, "some"), word(1, 40, 80, "value"), word(1, 50, 10, "a:"), word(1, 50, 80, "b"),
        word(1, 60, 10, "Bold", 10.0, "Arial-Bold"), word(1, 200, 10, "cell"), word(2, 10, 10, "SECTION", None, None), word(2, 20, 10, "text", None, None), word(2, 30, 10, "EMPTY", None, None),
    ]
    w = spark.createDataFrame(words, "doc_id long, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string, size double, font string")
    boxes = spark.createDataFrame([(1, 1, 0.0, 190.0, 600.0, 300.0)], "doc_id long, page int, bx0 double, btop double, bx1 double, bbottom double")
    s = generic.sections(generic.section_lines(w, boxes))
    assert sorted((r.page, r.ord, r.header, r.value) for r in s.collect()) == [(1, 1, "EMPLOYER ID", "12"), (1, 2, "Big Header", "some value a: b"), (1, 3, "Bold", ""), (2, 1, "SECTION", "text"), (2, 2, "EMPTY", "")]
    raw = [(1, 1, 1, 0, ["", None]), (1, 1, 1, 1, ["Name", "Date", "Total"]), (1, 1, 1, 2, ["Ann", " 1/2 "]), (1, 1, 1, 3, [" ", "x", ""]), (1, 2, 1, 0, ["Only Heads"]), (1, 2, 2, 0, ["12345", "b"]), (1, 2, 2, 1, ["c"])]
    rows = spark.createDataFrame(raw, "doc_id long, page int, tbl int, row int, cells array<string>")
    t = generic.table_rows(rows)
    assert sorted((r.page, r.tbl, r.n, r.headers, r.cells) for r in t.collect()) == [
        (1, 1, 1, ["Name", "Date", "Total"], ["Ann", "1/2", ""]), (1, 1, 2, ["Name", "Date", "Total"], ["", "x", ""]), (2, 1, 1, ["Column_1"], ["Only Heads"]), (2, 2, 1, ["Column_1", "Column_2"], ["12345", "b"]), (2, 2, 2, ["Column_1", "Column_2"], ["c", ""]),
    ]
    assert generic.widest(rows) == 3 and generic.padded(rows, 3).columns[-3:] == ["Col_1", "Col_2", "Col_3"]
    lines = spark.createDataFrame([(1, 1, 1, 20.0, 82.0, 95.0, 92.0, "First name:")], "doc_id long, page int, line_no int, x0 double, top double, x1 double, bottom double, text string")
    heights = spark.createDataFrame([(1, 1, 792.0)], "doc_id long, page int, height double")
    f = generic.form_fields(S.widgets(nodes).filter("doc_id = 1 and page = 1"), lines, heights)
    assert sorted((r.ord, r.name, r.value) for r in f.collect()) == [("000000/000000", "First name", "Jane"), ("000000/000001", "First name", "No"), ("000001", "First name", "x")]
    got = [(r["Source File"], r.Page, r.Category, r["Field Name"], r.Value) for r in generic.unified(s, t, f).orderBy("Source File", "ord").collect()]
    assert [g[1:] for g in got] == [
        ("1", "Form Field", "First name", "Jane"), ("1", "Form Field", "First name", "No"), ("1", "Form Field", "First name", "x"), ("1", "Section", "EMPLOYER ID", "12"), ("1", "Section", "Big Header", "some value a: b"),
        ("1", "Table", "Row 1 (Table 1)", "Name: Ann | Date: 1/2 | Total: "), ("1", "Table", "Row 2 (Table 1)", "Name:  | Date: x | Total: "), ("2", "Section", "SECTION", "text"), ("2", "Section", "EMPTY", ""),
        ("2", "Table", "Row 1 (Table 1)", "Column_1: Only Heads"), ("2", "Table", "Row 1 (Table 2)", "Column_1: 12345 | Column_2: b"), ("2", "Table", "Row 2 (Table 2)", "Column_1: c | Column_2: "),
    ]


def test_deep_trees_and_broken_ones(spark, monkeypatch):
    """A chain of nodes hands its kind down; a node without its parent gives nothing; a node below itself is an error."""
    chain = [node(1, 1, FT="/Tx", T="top"), *(node(1, n, n - 1, n) for n in range(2, 13)), node(2, 5, 4, T="lost")]
    found = S.walk(spark.createDataFrame(chain, S.NODE))
    assert sorted((r.doc_id, r.node, r.name, r.kind, r.up, r.path.count("/")) for r in found.collect()) == [(1, n, "top", "/Tx", n - 1 or None, n - 1) for n in range(1, 13)]
    assert S.walk(spark.createDataFrame([], S.NODE)).collect() == []
    monkeypatch.setattr(S, "DEEPEST", 3)
    with pytest.raises(ValueError, match="levels"):
        S.walk(spark.createDataFrame([node(1, 1), node(1, 2, 1), node(1, 1, 2)], S.NODE))
