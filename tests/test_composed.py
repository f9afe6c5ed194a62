"""The composed extractors on small pages, with the rows spelled out."""

import pytest

from paperloom.plans import changes, remittance


def words(spark, pages, width=8.0):
    """pages: (doc_id, page, [(y, x, text of several words)]). Words of a text follow each other ``width`` a letter."""
    rows = []
    for doc, page, lines in pages:
        n = 0
        for y, x, text in lines:
            for w in text.split(" "):
                rows.append((doc, page, n, float(x), float(y), float(x + width * len(w)), float(y + 8), w))
                x += width * (len(w) + 1)
                n += 1
    return spark.createDataFrame(rows, "doc_id string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string")


HEAD = [(10, 10, "Employee Payroll Changes"), (30, 10, "CHANGED FIELD"), (30, 240, "CHANGED FROM"), (30, 450, "CHANGED TO")]
LOG = [
    ("a", 1, [*HEAD, (50, 10, "7TG Smith, Jonathan Q. Jr"), (60, 10, "Associate ID: A1 Position ID: P1"), (70, 10, "Home Department: B0-LM Big Home Cost Number: 99"), (90, 10, "Home Phone"), (90, 240, "555-1"), (90, 450, "555-2"), (100, 10, "Rate 1"), (100, 450, "12.50"), (110, 10, "Page 1 of 2")]),
    ("a", 2, [(20, 10, "Address - City"), (20, 240, "Reno"), (20, 450, "n/a"), (40, 10, "Roe, Ann"), (50, 10, "Poe, Bob"), (60, 10, "Associate ID: B2"), (80, 10, "SSN"), (80, 450, "=900-11-2222"), (100, 10, "Associate ID: C3"), (110, 10, "Status"), (110, 450, "Active")]),
    ("b", 1, [(20, 10, "Lone"), (20, 300, "data"), (40, 10, "Lee, Kim"), (60, 10, "Moe, Sue"), (60, 260, "x")]),
    ("c", 1, [(20, 10, "only words here")]),
]


def test_change_log(spark):
    w = words(spark, LOG)
    found = changes.changes(w)
    got = sorted((r.DOCID, r.ord, r.Name, r["Associate ID"], r["Position ID"], r["Home Department"], r["Home Cost Number"], r["Changed Field"], r["Changed From"], r["Changed To"]) for r in changes.log(found).collect())
    assert [g[:1] + g[2:] for g in got] == [
        ("a", "Smith, Jonathan Q.", "A1", "P1", "B0-LM Big", "99", "Home Phone", "555-1", "555-2"),
        ("a", "Smith, Jonathan Q.", "A1", "P1", "B0-LM Big", "99", "Rate 1", "", "12.50"),
        ("a", "Smith, Jonathan Q.", "A1", "P1", "B0-LM Big", "99", "Address - City", "Reno", "n/a"),
        ("a", "Poe, Bob", "B2", "", "", "", "SSN", "", "'=900-11-2222"),
        ("a", "Poe, Bob", "C3", "", "", "", "Status", "", "Active"),
    ]
    assert sorted(tuple(r) for r in changes.report(w, found).collect()) == [("a", 5, 2, "Yes", ""), ("b", 0, 1, "No", changes.NO_RECORDS), ("c", 0, 1, "No", changes.NO_RECORDS)]
    kinds = [(r.page, r.kind) for r in changes.kinds(w).filter("doc_id = 'a'").orderBy("page", "line").collect()]
    assert kinds == [(1, "chrome"), (1, "table"), (1, "name"), (1, "employee"), (1, "employee"), (1, "data"), (1, "data"), (1, "chrome"), (2, "data"), (2, "name"), (2, "name"), (2, "employee"), (2, "data"), (2, "employee"), (2, "data")]


def test_change_pivot(spark):
    headers = spark.createDataFrame([("Home Phone", "Home Phone"), ("Rate 1", "Rate 1"), ("Address - City", "Address - City"), ("SSN", "Social Security Number"), ("Status", "Status")], "field string, header string")
    rows = {r["Employee Identification Number"]: r for r in changes.pivoted(changes.changes(words(spark, LOG)), headers).collect()}
    a = rows["A1"]
    assert (a["Last Name"], a["First Name"], a["Middle Name"], a["Data Subject Type"], a["City"], a["Phone Number"]) == ("Smith", "Jonathan", "Q.", "Employee", "Reno", "555-2")
    assert a["Contact Information"] == "Personal phone number (home);Home address" and a["Work-Related Information"] == "Salary or Compensation Information"
    assert rows["B2"]["Social Security Number"] == "=900-11-2222" and rows["B2"]["Government- Issued Identification"] == "Social Security Number (SSN)"


REMIT = [
    ("b", 1, [
        (10, 10, "Medi-Cal ROE, Jane Payee: X"), (30, 10, "Health Plan ID: H77 Claim: 123 -01"), (50, 10, "Pat. Acct # P-9"), (70, 10, "Service Revenue CPT- Billed"), (90, 10, "1/5/21"), (90, 80, "0450"), (90, 146, "A9100"), (90, 186, "$5.00"), (110, 10, "02/03/2021"), (110, 146, "none"), (110, 186, "$7.00"),
        (130, 10, "Health Plan ID: H88 Claim: 9"), (150, 10, "User Comments: POE, Al"), (170, 10, "LEE, Kim"),
    ]),
    ("b", 2, [(10, 10, "ROE, Jane Payee: X"), (30, 10, "Health Plan ID: H77 Claim: 456"), (50, 10, "Pat Acct # P-10"), (70, 10, "Service Revenue CPT- Billed"), (90, 10, "3/4/2020"), (90, 146, "777")]),
    ("t", 1, [
        (10, 10, "M-55 something"), (30, 10, "C123 VILLA, Daniel 01/01/2020 A1234"), (50, 10, "Patient Acct. # AC1"), (70, 10, "02/01/2020 9921 03/05/2020 9922"), (90, 10, "04/01/2020"), (110, 10, "Patient Acct. # AC2"),
    ]),
    ("t", 2, [(10, 10, "Member Totals: 5"), (30, 10, "C9 MOE, Max"), (50, 10, "Member Totals: 1"), (70, 10, "C10 OLD, Ann"), (90, 10, "C11 NEW, Ben 5/6/19 100"), (110, 10, "Patient Acct # Z"), (130, 10, "Member Totals ; 2")]),
]


@pytest.fixture(scope="module")
def remit(spark):
    return remittance.oriented(words(spark, REMIT))


def test_claims(remit):
    got = [(r.doc_id, r.name, r.plan, r.member, r.claim, r.acct, r.service_date, r.cpt, r.page) for r in remittance.claims(remit).orderBy("doc_id", "ord").collect()]
    assert got == [
        ("b", "ROE, Jane", "H77", "", "123-01;456", "P-9;P-10", "02/03/2021", "A9100;777", "1;2"),
        ("b", "", "H88", "", "9", "P-9", "", "", "1"),
        ("t", "VILLA, Daniel", "", "M-55", "C123", "AC2", "03/05/2020", "", "1"),
        ("t", "NEW, Ben", "", "C10", "C11", "Z", "05/06/2019", "", "2"),
    ]
    assert remittance.claim_rows(remittance.claims(remit)).columns[2:] == list(remittance.CLAIM_COLUMNS)
    assert [(r.name, r.missing) for r in remittance.incomplete(remit).collect()] == [("MOE, Max", ["Pat. Acct #", "Service Date", "Member #"])]


def test_pages_are_turned(spark):
    """A page whose words are mirrored, and one whose lines run bottom up."""
    plain = words(spark, [("m", 1, REMIT[0][2][:7])])
    turned = plain.selectExpr("doc_id", "page", "ord", "612 - x1 as x0", "y0", "612 - x0 as x1", "y1", "text")
    up = plain.selectExpr("'u' as doc_id", "page", "ord", "x0", "700 - y1 as y0", "x1", "700 - y0 as y1", "text")
    want = [(r.idx, r.text) for r in remittance.oriented(plain).orderBy("idx").collect()]
    got = remittance.oriented(turned.unionByName(up)).orderBy("doc_id", "idx").collect()
    assert [(r.idx, r.text) for r in got if r.doc_id == "m"] == want == [(r.idx, r.text) for r in got if r.doc_id == "u"]


def test_patients(spark):
    b = "x\nROE, Jane Payee: Y\nHealth Plan ID: H1 Claim: 55 Pat. Acct # 900\nService Date Rev CPT-\n1/2/2020 0450  A99 $5.00\n"
    pages = [("d", 1, b + b.replace("900", "901").replace("1/2/2020", "3/4/20")), ("d", 2, "Health Plan ID: H2 nothing\n" + "y" * 600), ("d", 3, "123456789 VILLA, Daniel 1/1/2020 A100\nPatient Acct # 1\nPatient Acct # 2\nPatient Acct # 1\non 2/2/2020 x\nMember Totals: 9\nMOE, Max\nMember Totals: 1")]
    got = [tuple(r)[2:] for r in remittance.patient_rows(remittance.patients(spark.createDataFrame(pages, "doc_id string, page int, text string"))).orderBy("ord").collect()]
    assert got == [
        ("A", "VILLA, Daniel", "", "123456789", "123456789", "1:2", "2/2/2020", "A100", "", 3),
        ("B", "ROE, Jane", "H1", "55", "", "900:901", "3/4/20", "", "0450 A99", 1),
    ]


def _scans(df):
    return df._jdf.queryExecution().analyzed().toString().count("Relation [")


def test_rendered_inputs_read_their_table_once(spark, sf):
    """Words, lines and rows of a rendered document come from one generator a row."""
    from paperloom.plans import catalog
    from paperloom.plans.registry import rendered

    found = {n: _scans(rendered(spark, sf, q.source)) for n, q in catalog.queries().items() if "<each>" in getattr(q, "source", "")}
    assert len(found) > 30 and set(found.values()) == {1}


@pytest.mark.parametrize("name, most", [("x_claim", 2), ("win_14", 1), ("lay_07", 1), ("win_07", 1), ("x_1095c", 1), ("x_pat", 2), ("x_chg", 6), ("x_gross", 4), ("x_w2b", 9), ("x_401k", 10)])
def test_plans_scan_their_input_a_few_times(spark, sf, name, most):
    from paperloom.plans import catalog

    assert _scans(catalog.queries()[name](spark, sf)) <= most


def test_claims_are_made_in_one_pass(spark, sf):
    """Labelled and tabular records of a document come from one reading and turning of its pages."""
    from paperloom.plans import catalog

    assert _scans(catalog.queries()["x_claim"](spark, sf)) == 1
