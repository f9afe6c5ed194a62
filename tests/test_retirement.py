"""Plan reports: each way in which a record is found, with the rows spelled out."""

import pytest

from paperloom.plans import retirement, templates


@pytest.fixture(scope="module")
def records(spark):
    fields = spark.createDataFrame([("form", 1, "Employee Name", "Roe, Jane Ann Jr."), ("form", 2, "SSN", "900-11-2222"), ("form", 3, "Gross Pay", "$1,200.50"), ("form", 4, "box", "/Off"), ("odd", 1, "field 7", "x 900-22-33** y"), ("none", 1, "first name", "/Off")], "doc_id string, ord int, name string, value string")
    head = ["Name", "SSN", "Gross Wages", "Company Match %", "Employee ID"]
    rows = [
        ("tab", 1, 0, 0, head), ("tab", 1, 0, 1, ["Smith, John Q.", "900-33-4444", "5,000.00", "12", "E-1"]), ("tab", 1, 0, 2, [None, "", None, "", ""]), ("tab", 1, 0, 3, ["Smith, Johnny", "900-33-4444", "", "", ""]),
        ("bare", 1, 0, 0, ["JANE ROE", "x"]), ("bare", 1, 0, 1, ["", "900-44-1111"]), ("bare", 1, 1, 0, ["900-44-2222 MARY POE", "7"]), ("bare", 1, 2, 0, ["id", "900-44-3333", "Ann Lee"]), ("form", 1, 0, 0, ["900-99-9999", "John Doe"]),
        ("part", 1, 0, 0, ["900-55-1234", "Al Bo"]), ("part", 1, 0, 1, ["900-55-12", "Al Bo"]),
    ]
    text = [
        ("txt", 1, 1, "Employee Name: Gray, Tom"), ("txt", 1, 2, "SSN 900-66-7777"), ("txt", 1, 3, "Gross salary: $9,000.00 Employer match 45.10"), ("txt", 1, 4, "Employee ID: A77"),
        ("txt", 2, 1, "900-77-8888"), ("txt", 2, 2, "no name here 1"), ("txt", 2, 3, "MARY LOU POE"), ("lab", 1, 1, "First Name: ann"), ("lab", 1, 2, "Last name: lee"), ("lab", 1, 3, "ssn: 900 88 9999"),
        ("two", 1, 1, "900-12-0001 and 900-12-0002"), ("xpad", 1, 1, "Roe, Jane 900-13-12XX"),
    ]
    out = retirement.employees(fields, spark.createDataFrame(rows, "doc_id string, page int, tbl int, row int, cells array<string>"), spark.createDataFrame(text, "doc_id string, page int, ord int, text string"))
    return out


def test_every_way_of_finding_a_record(records):
    got = sorted((r.doc_id, r.ord, r.last, r["first"], r.middle, r.suffix, r.ssn, r.gross_salary, r.er_match, r.ee_id) for r in records.collect())
    assert got == [
        ("bare", 1, "Jane Roe", "", "", "", "900-44-1111", "", "", ""),
        ("bare", 2, "Mary Poe", "", "", "", "900-44-2222", "", "", ""),
        ("bare", 3, "Ann Lee", "", "", "", "900-44-3333", "", "", ""),
        ("form", 1, "Roe", "Jane", "Ann", "Jr.", "900-11-2222", "1200.50", "", ""),
        ("lab", 1, "Lee", "Ann", "", "", "900-88-9999", "", "", ""),
        ("odd", 1, "", "", "", "", "900-22-33XX", "", "", ""),
        ("part", 1, "Al Bo", "", "", "", "900-55-1234", "", "", ""),
        ("tab", 1, "Smith", "Johnny", "Q.", "", "900-33-4444", "5000.00", "12", "E-1"),
        ("two", 1, "", "", "", "", "900-12-0001", "", "", ""),
        ("two", 2, "", "", "", "", "900-12-0002", "", "", ""),
        ("txt", 1, "Gray", "Tom", "", "", "900-66-7777", "9000.00", "45.10", "A77"),
        ("txt", 2, "Mary Lou Poe", "", "", "", "900-77-8888", "", "", ""),
        ("xpad", 1, "Roe", "Jane", "", "", "900-13-12XX", "", "", ""),
    ]


def test_template_rows(records):
    rows = retirement.template(records)
    assert rows.columns == list(templates.REVIEW) and len(rows.columns) == 38
    r = {r.DOCID: r for r in rows.collect()}["txt"] if rows.filter("DOCID = 'txt'").count() == 1 else rows.filter("DOCID = 'txt' and `Last Name` = 'Gray'").collect()[0]
    assert (r["Data Subject Type"], r["Government- Issued Identification"], r["Social Security Number"], r["Work-Related Information"], r["Employee Identification Number"], r["Zip Code"]) == ("Employee", "Social Security Number (SSN)", "900-66-7777", "Salary or Compensation Information: 9000.00 | Employer Match: 45.10", "A77", "")
