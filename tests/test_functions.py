"""Scalar functions against small tables of input and expected output."""

import pytest
from pyspark.sql import functions as F

from paperloom.functions import names, predicates, text, values


def run(spark, fn, *inputs):
    df = spark.createDataFrame([tuple(x) if isinstance(x, tuple) else (x,) for x in inputs], ", ".join(f"c{i} string" for i in range(len(inputs[0]) if isinstance(inputs[0], tuple) else 1)))
    cols = [F.col(c) for c in df.columns]
    return [r[0] for r in df.select(fn(*cols)).collect()]


@pytest.mark.parametrize(
    ("name", "last", "first", "middle"),
    [("Smith, Jonathan", "Smith", "Jonathan", ""), ("Torres, Efrain", "Torres", "Efrain", ""), ("Vaughan, Antione D.", "Vaughan", "Antione", "D."), ("Valencia, Patrick G.", "Valencia", "Patrick", "G."), ("Strunk, William", "Strunk", "William", ""), ("", "", "", ""), ("No Comma", "", "", "")],
)
def test_payroll_names(spark, name, last, first, middle):
    got = run(spark, lambda c: names.last_first(c, names.CHANGE_SUFFIXES, False), name)[0]
    assert (got["last"], got["first"], got["middle"], got["suffix"]) == (last, first, middle, "")


def test_creditor_names(spark):
    got = run(spark, names.last_first, "Acme Inc, Suite 4", "Roe Jr, Ann", "Roe, Ann Mary MD", "Acme", "  ", None)
    assert [tuple(r) for r in got] == [("Acme Inc, Suite 4", "", "", ""), ("Roe", "Ann", "", "Jr"), ("Roe", "Ann", "Mary", "MD"), ("Acme", "", "", ""), ("", "", "", ""), ("", "", "", "")]


def test_employee_header(spark):
    line = "7TG  Smith, Jonathan  Associate ID: A12345  Position ID: P67890  Home Department: B04103-LM Bellingham Warehouse  Home Cost Number: 99"
    got = run(spark, names.header_fields, line)[0]
    assert (got["last"], got["first"], got["associate"], got["position"], got["cost"]) == ("Smith", "Jonathan", "A12345", "P67890", "99") and "Bellingham" in got["department"]


def test_line_kinds(spark):
    assert run(spark, predicates.line_kind, "Associate ID: 4", "Deduction Code", "Page 1 of 3", "Changed Field Changed From Changed To", "Roe, Ann") == ["employee", "data", "chrome", "table", "name"]


def test_numbers_and_money(spark):
    assert run(spark, values.ssn, "900 45 6789", "900456789", "no", None) == ["900-45-6789", "900-45-6789", "", ""]
    assert run(spark, values.ssn_repaired, "9OO-4S-67B9", "none") == ["900-45-6789", ""]
    assert run(spark, values.ssn_canonical, "900-45-67", "900-45", "xxx-xx-1234", "***-45-1234", "90045678", "9004", "", "abc") == ["900-45-67XX", "900-45-XXXX", "XXX-XX-1234", "XXX-45-1234", "900-45-678X", "900-4X-XXXX", "", "abc"]
    assert run(spark, values.amount, "54321.00", "54,321.00", "$1", "none") == ["54321.00", "54321.00", "1.00", ""]
    assert run(spark, values.money, "x ($1,234.50) y", "\n1863.84") == ["($1,234.50)", "1863.84"]


def test_dates(spark):
    assert [str(d) for d in run(spark, values.date, "1/2/68", "1/2/69", "12/31/2020", "2/30/2020", "soon")] == ["2068-01-02", "1969-01-02", "2020-12-31", "None", "None"]
    assert run(spark, values.pdf_date, "D:20240315143000-05'00'", "x") == ["2024-03-15 14:30:00 -05:00", "x"]
    assert run(spark, values.visible_date, "2024.12.09 08:36:48 -06'00'") == ["2024-12-09 08:36:48 -06:00"]


def test_text(spark):
    assert run(spark, text.title, "o'brien smith-jones", "") == ["O'Brien Smith-Jones", ""]
    assert run(spark, text.fold, "“A” – ﬁne x", " plain \t text ") == ['"A" - fine x', "plain text"]
    assert run(spark, text.formula_safe, "=1", "-x", "a", "") == ["'=1", "'-x", "a", ""]
    assert run(spark, text.mask, "Ab1-é") == ["XX#-é"]


def test_garbled(spark):
    assert run(spark, predicates.garbled, "a", "a b c d e f g h", "an ordinary line of text here", "", None) == [True, True, False, False, False]


def test_labels(spark):
    assert run(spark, predicates.looks_like_label, "Name:", "TOTAL DUE", "an ordinary sentence", "one two three four five six seven eight nine:") == [True, True, False, False]
