"""Queries over sources, sinks, projections, reports and the composed pipelines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import predicates as P
from ..functions import text as T
from ..functions import values as V
from ..operators import layout as L
from ..operators import neighbourhood as A
from ..operators import records as R
from ..sources import lines as SRC
from . import grid as GR
from .composed import when, words_sql
from .forms import FORMS, route, sample_pages
from .grid import STOP
from .registry import each_row, query
from .relations import LINES, SSN_ROWS
from .scalars import AREA, FIRST, GROUP, LAST, SERIAL

_SSN = f"{AREA} || '-' || {GROUP} || '-' || {SERIAL}"
_ID = "c_custkey AS doc_id, CAST(1 AS INT) AS page"
_NL = "chr(10)"
_MONEY = "CAST(1000 + c_custkey % 9000 AS STRING) || '.' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0')"
W2_PAGES = f"""SELECT {_ID}, c_nationkey, 'Form W-2 Wage and Tax Statement 20' || CAST(10 + c_nationkey AS STRING) || {_NL} || 'a Employee''s social security number' || {_NL} || {_SSN} || {_NL} || 'b Employer identification number 12-' || lpad(CAST(c_custkey AS STRING), 7, '0') || {_NL} ||
    'c Employer''s name, address' || {_NL} || 'Acme ' || CAST(c_nationkey AS STRING) || {_NL} || 'd Control number: C' || CAST(c_custkey AS STRING) || {_NL} || 'e Employee''s first name' || {_NL} || {FIRST} || ' ' || {LAST} || {_NL} ||
    '1 Wages, tips' || {_NL} || {_MONEY} || {_NL} || '2 Federal income tax withheld $' || CAST(c_custkey % 500 AS STRING) || '.00' || {_NL} || CASE WHEN c_custkey % 2 = 0 THEN '15 State WI' ELSE '' END AS text FROM {{customer}}"""
_W2_NAME = FIRST.replace("c_custkey", "doc_id") + " || ' ' || " + LAST.replace("c_custkey", "doc_id")
_OSSN = _SSN.replace("c_custkey", "doc_id").replace("STRING", "VARCHAR")
query("x_lv_forms", W2_PAGES, f"""SELECT doc_id, page, '20' || (10 + c_nationkey) AS tax_year, {_OSSN} AS employee_ssn, '12-' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS employer_ein, 'Acme ' || c_nationkey AS employer_name_address, 'C' || doc_id AS control_number, {_W2_NAME} AS employee_name_address,
    (1000 + doc_id % 9000) || '.' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS box_1_wages, '$' || doc_id % 500 || '.00' AS box_2_federal_tax, '' AS box_3_ss_wages, '' AS box_4_ss_tax, '' AS box_5_medicare_wages, '' AS box_6_medicare_tax, CASE WHEN doc_id % 2 = 0 THEN 'WI' ELSE '' END AS box_15_state, '' AS box_16_state_wages, '' AS box_17_state_tax FROM t""")(FORMS["w2"].extract)
PAGES_1099 = f"SELECT {_ID}, 'Form 1099-NEC 2023' || {_NL} || 'PAYER''S TIN 98-' || lpad(CAST(c_custkey AS STRING), 7, '0') || {_NL} || 'RECIPIENT''S TIN ' || {_SSN} || {_NL} || 'RECIPIENT''S name' || {_NL} || {LAST} || {_NL} || 'Account number A-' || CAST(c_custkey AS STRING) || {_NL} || '1 Nonemployee compensation $ ' || {_MONEY} || {_NL} || '7 State income (12.00)' AS text FROM {{customer}}"
query("x_lv_1099", PAGES_1099, f"SELECT doc_id, page, '2023' AS tax_year, '98-' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS payer_tin, '' AS payer_name_address, {_OSSN} AS recipient_tin, {LAST.replace('c_custkey', 'doc_id')} AS recipient_name_address, 'A-' || doc_id AS account_number, '$ ' || (1000 + doc_id % 9000) || '.' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS box_1_compensation, '' AS box_4_federal_tax, '' AS box_5_state_tax, '' AS box_6_state_no, '(12.00)' AS box_7_state_income FROM t")(FORMS["1099"].extract)
PAY_PAGES = f"SELECT {_ID}, 'Employee Name: ' || {LAST} || {_NL} || 'File Number: F' || CAST(c_custkey AS STRING) || {_NL} || 'SSN: XXX-XX-' || {SERIAL} || {_NL} || 'Pay Date 1/15/2024 Period Beginning 1/1/2024 Period Ending 1/14/2024' || {_NL} || 'Gross Pay ' || {_MONEY} || {_NL} || 'Regular Hours 80.00' AS text FROM {{customer}}"
query("x_lv_pay", PAY_PAGES, f"SELECT doc_id, page, {LAST.replace('c_custkey', 'doc_id')} AS employee_name, 'F' || doc_id AS employee_id, 'XXX-XX-' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') AS ssn, '' AS company, '1/15/2024' AS pay_date, '1/1/2024' AS period_begin, '1/14/2024' AS period_end, (1000 + doc_id % 9000) || '.' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS gross_pay, '' AS net_pay, '' AS federal_tax, '' AS state_tax, '' AS social_security, '' AS medicare, '80.00' AS regular_hours, '' AS overtime_hours FROM t")(FORMS["pay"].extract)
query("prj_11", W2_PAGES, f"SELECT doc_id, {_OSSN} AS employee_ssn, 'C' || doc_id AS control_number FROM t")(lambda df: FORMS["w2"].extract(df).select("doc_id", "employee_ssn", "control_number"))

# Sources and sinks.
_PAGES = "SELECT c_custkey AS doc_id, CAST(1 + c_custkey % 5 AS INT) AS page, CASE WHEN c_custkey % 7 = 0 THEN ' ' WHEN c_custkey % 7 = 1 THEN 'Member Totals: see the health plan ID of this patient' WHEN c_custkey % 7 = 2 THEN 'Form 1095-C Employer-Provided Health Insurance Offer' WHEN c_custkey % 7 = 3 THEN 'Employee Payroll Changes for the period that ended' WHEN c_custkey % 7 = 4 THEN 'Your 401 (k) plan statement for the year that ended' WHEN c_custkey % 7 = 5 THEN 'Gross To Net report of all employees of the company' ELSE 'An ordinary letter with a sufficient amount of text' END AS text FROM {customer}"
query("src_05", "SELECT doc_id, text FROM {documents}", "SELECT doc_id, CAST(i AS BIGINT) AS line_no, rtrim(l[i]) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM t)")(lambda df: SRC.layout_lines(df))
query("src_14", LINES, "SELECT doc_id, page, string_agg(text, chr(10) ORDER BY ord) AS text FROM t GROUP BY ALL")(lambda df: SRC.pages_of_lines(df))
query("src_15", LINES, "SELECT doc_id, page, string_agg(kind || text, chr(10) ORDER BY ord) AS text FROM t GROUP BY ALL")(lambda df: SRC.pages_of_lines(df.withColumn("text", F.concat("kind", "text"))))
query("src_21", _PAGES, "SELECT doc_id, lower(text) AS text, length(trim(text)) >= 40 AS has_text FROM t WHERE page <= 3")(sample_pages)
query("dsp_01", _PAGES, """SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'patient-info' WHEN 1 THEN 'claims' WHEN 2 THEN '1095c' WHEN 3 THEN 'bucket11' WHEN 4 THEN '401k' WHEN 5 THEN 'gross-pay' ELSE 'generic' END AS format FROM t WHERE page <= 3""")(lambda df: route(sample_pages(df)).select("doc_id", "format"))
# Projections.
query("prj_01", SSN_ROWS.replace("ELSE '' END AS first", "END AS first"), "SELECT doc_id, ord, coalesce(first, '') AS first FROM t")(lambda df: df.select("doc_id", "ord", T.text(F.col("first")).alias("first")))
query("prj_04", "SELECT s_suppkey AS k, s_name || ', Ann Mary MD' AS name, CAST(s_suppkey AS STRING) || ' Main St|Reno, NV 89501' AS address FROM {supplier}", "SELECT k, name[:-14] AS last, 'Ann' AS first, 'Mary' AS middle, 'MD' AS suffix, k || ' Main St' AS street, 'Reno' AS city, 'NV' AS state, '89501' AS zip FROM t")(
    lambda df: df.select("k", N.last_first(F.col("name")).alias("n"), V.creditor_address(F.split("address", r"\|")).alias("a")).select("k", "n.*", "a.*")
)
query("prj_05", SSN_ROWS, "SELECT doc_id, ord, CASE WHEN first = '' AND middle = '' THEN last ELSE last || ', ' || trim(first || ' ' || middle) END AS name FROM t")(lambda df: df.select("doc_id", "ord", N.display_name(F.col("last"), F.col("first"), F.col("middle")).alias("name")))
query("prj_07", SSN_ROWS, "SELECT doc_id, ord, concat_ws(' | ', CASE WHEN first <> '' OR middle <> '' THEN first || ': ' || middle END, last || ': ' || suffix) AS row FROM t")(
    lambda df: df.select("doc_id", "ord", F.array_join(F.transform(F.filter(F.array(F.struct(F.col("first").alias("a"), F.col("middle").alias("b")), F.struct(F.col("last").alias("a"), F.col("suffix").alias("b"))), lambda x: (x["a"] != "") | (x["b"] != "")), lambda x: F.concat(x["a"], F.lit(": "), x["b"])), " | ").alias("row"))
)

query("prj_10", "SELECT c_custkey AS k, '/in/' || c_mktsegment || '.pdf' AS path FROM {customer}", "SELECT k, replace(path, '.pdf', '_w2.csv') AS output FROM t")(lambda df: df.select("k", F.regexp_replace("path", r"\.[^./]+$", "_w2.csv").alias("output")))

# Reports.
query("obs_02", "SELECT doc_id, text AS s FROM {documents}", "SELECT doc_id, CAST((length(lower(s)) - length(replace(lower(s), 'the', ''))) // 3 AS BIGINT) AS the, CAST((length(lower(s)) - length(replace(lower(s), 'license', ''))) // 7 AS BIGINT) AS license FROM t")(lambda df: df.select("doc_id", *[((F.length(F.lower("s")) - F.length(F.replace(F.lower("s"), F.lit(w)))) / len(w)).cast("long").alias(w) for w in ("the", "license")]))
query("obs_03", SSN_ROWS, "SELECT doc_id, ord, list_filter([CASE WHEN first = '' THEN 'first' END, CASE WHEN middle = '' THEN 'middle' END], x -> x IS NOT NULL) AS missing FROM t WHERE first = '' OR middle = ''")(lambda df: df.filter("first = '' or middle = ''").select("doc_id", "ord", F.array_compact(F.array(F.expr("case when first = '' then 'first' end"), F.expr("case when middle = '' then 'middle' end"))).alias("missing")))
# Pipelines.
_CELL = "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0')"
_EMPLOYEE_LINES = (
    ("'a Employee''s social security number'", 0), (_SSN, 1), ("'e Employee''s name, address, and ZIP code'", 2), (f"{FIRST} || ' ' || 'Roe Jr'", 3),
    ("CAST(c_custkey AS STRING) || ' Main St'", 4), ("'Springfield, WI ' || " + _CELL, 5), ("'15 State'", 6), ("'WI'", 7), ("'1 Wages, tips, other comp. ' || " + _MONEY, 8),
)
W2_LINES = "SELECT doc_id, ord, text FROM (SELECT c_custkey AS doc_id, " + each_row([f"({i}, {e})" for e, i in _EMPLOYEE_LINES], "ord INT, text VARCHAR") + " FROM {customer}) AS w"


def _w2(df):
    """Number near its caption, name and address below theirs, wages after their label; one record per document and number."""
    w = Window.partitionBy("doc_id").orderBy("ord")
    d = df.withColumn("text", T.fold(F.col("text"))).withColumn("ctx", A.around("text", ["doc_id"], ["ord"], 2, 2)).withColumn("below", F.collect_list("text").over(w.rowsBetween(1, 8)))
    block = A.until_stop(F.filter("below", lambda x: x != ""), lambda x: x.rlike(STOP))
    found = d.groupBy("doc_id").agg(
        F.min_by(V.ssn_repaired(F.col("ctx")), F.when(F.col("text").rlike(r"(?i)Employee.?s\s+(?:social security number|SSN)\b"), F.col("ord"))).alias("ssn"),
        F.min_by(block, F.when(F.col("text").rlike(r"(?i)Employee.?s\s+name,\s*address"), F.col("ord"))).alias("block"),
        F.min_by(V.amount(F.regexp_extract("text", r"(?i)wages, tips, other comp\.?(.*)$", 1)), F.when(F.lower("text").contains("wages, tips, other comp"), F.col("ord"))).alias("box_1"),
    )
    rest = F.slice("block", 2, 20)
    line = F.coalesce(F.try_element_at(F.filter(rest, lambda x: x.rlike(V.CITY_STATE_ZIP)), F.lit(1)), F.lit(""))
    street = A.until_stop(rest, lambda x: x.rlike(V.CITY_STATE_ZIP))
    found = found.select("doc_id", "ssn", N.by_whitespace(F.coalesce(F.try_element_at("block", F.lit(1)), F.lit(""))).alias("n"), F.array_join(street, " ").alias("street"), V.city_state_zip(line).alias("a"), "box_1")
    return R.first_wins(found.select("doc_id", "n.first", "n.last", "n.suffix", "street", "a.city", "a.state", "a.zip", "ssn", "box_1"), [F.col("doc_id"), F.col("ssn")], ["doc_id"], F.col("ssn") == "")


query("x_w2", W2_LINES, f"SELECT doc_id, {FIRST.replace('c_custkey', 'doc_id')} AS first, 'Roe' AS last, 'Jr' AS suffix, doc_id || ' Main St' AS street, 'Springfield' AS city, 'WI' AS state, lpad(CAST(doc_id % 100000 AS VARCHAR), 5, '0') AS zip, {_OSSN} AS ssn, (1000 + doc_id % 9000) || '.' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS box_1 FROM t WHERE ord = 0")(_w2)
# Pages with one employee, two, four, none with a caption, one with a name box, and none at all.
_K6 = "c_custkey % 6"


def _employee(cond: str, x: int, y: int, tag: int) -> list[tuple]:
    own = lambda *tokens: [f"=CASE WHEN {cond} THEN {t[1:]} ELSE '' END" if t.startswith("=") else when(cond, t) for t in tokens]
    return [(1, y, x, own("Employee's", "social", "security", "number")), (1, y + 10, x, own(f"=CONCAT('90{tag}-12-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))")), (1, y + 20, x, own("Employee's", "name,", "address,")),
            (1, y + 30, x, own("Jane", f"=CONCAT('Roe{tag}x', CAST(c_custkey AS STRING))")), (1, y + 40, x, own(f"{tag}", "Elm", "St")), (1, y + 50, x, own("Reno,", "NV", "89501"))]


_LINE = lambda cond, y, x, *tokens: (1, y, x, [when(cond, t) for t in tokens])
GRID_PAGES = words_sql([
    *_employee(f"{_K6} <= 2", 10, 51, 1), *_employee(f"{_K6} IN (1, 2)", 320, 51, 2), *_employee(f"{_K6} = 2", 10, 450, 3), *_employee(f"{_K6} = 2", 320, 450, 4),
    _LINE(f"{_K6} = 3", 51, 10, "EIN", "12-3456789"), _LINE(f"{_K6} = 3", 60, 10, "Acme", "Works"), _LINE(f"{_K6} = 3", 69, 10, "Mill", "Road"), _LINE(f"{_K6} = 3", 81, 10, "Reno,", "NV", "89509"),
    (1, 90, 10, [f"=CASE WHEN {_K6} = 3 THEN CONCAT('905-12-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) ELSE '' END"]), _LINE(f"{_K6} = 3", 99, 10, "12", "34"), _LINE(f"{_K6} = 3", 111, 10, "a"),
    _LINE(f"{_K6} = 3", 120, 10, "Ann", "Lee", "Jr"), _LINE(f"{_K6} = 3", 129, 10, "5", "Elm", "St"), _LINE(f"{_K6} = 3", 141, 10, "Reno,", "NV", "89502"),
    _LINE(f"{_K6} = 4", 51, 10, "Employee's", "SSN"), (1, 60, 10, [f"=CASE WHEN {_K6} = 4 THEN CONCAT('906-12-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) ELSE '' END"]),
    _LINE(f"{_K6} = 4", 69, 10, "Employee's", "first", "name", "and", "initial", "Last", "name", "Suff."), _LINE(f"{_K6} = 4", 81, 10, "Mary", "Ann"), _LINE(f"{_K6} = 4", 81, 370, "Poe"), _LINE(f"{_K6} = 4", 81, 514, "III"),
    _LINE(f"{_K6} = 4", 90, 10, "f", "Employee's", "address"), _LINE(f"{_K6} = 4", 99, 10, "6", "Elm", "St"), _LINE(f"{_K6} = 4", 99, 450, "12a", "500.00"), _LINE(f"{_K6} = 4", 111, 10, "Reno,", "NV", "89503"), _LINE(f"{_K6} = 4", 120, 10, "Form", "W-2"),
    _LINE(f"{_K6} = 5", 51, 10, "nothing", "here", "is", "of", "use", "at", "all"),
])


def _grid(df):
    found = GR.employees(df).select("doc_id", "cell", "way", "first", "last", "suffix", "street", "city", "state", "zip", "ssn")
    return found.unionByName(GR.rejected(df).select("doc_id", F.lit("").alias("cell"), F.col("why").alias("way"), *[F.lit("").alias(c) for c in ("first", "last", "suffix", "street", "city", "state", "zip", "ssn")]))


_CELLS_OF = (("= 0", 1, "Single"), ("= 1", 1, "Left"), ("= 1", 2, "Right"), ("= 2", 1, "TopLeft"), ("= 2", 2, "TopRight"), ("= 2", 3, "BottomLeft"), ("= 2", 4, "BottomRight"))
_DOCS, _NUMBER = "(SELECT DISTINCT doc_id FROM t)", "lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0')"
query("x_w2_grid", GRID_PAGES, " UNION ALL ".join([f"SELECT doc_id, '{c}' AS cell, 'block' AS way, 'Jane' AS first, 'Roe{n}x' || doc_id AS last, '' AS suffix, '{n} Elm St' AS street, 'Reno' AS city, 'NV' AS state, '89501' AS zip, '90{n}-12-' || {_NUMBER} AS ssn FROM {_DOCS} WHERE doc_id % 6 {w}" for w, n, c in _CELLS_OF] + [
    f"SELECT doc_id, 'Single', 'shape', 'Ann', 'Lee', 'Jr', '5 Elm St', 'Reno', 'NV', '89502', '905-12-' || {_NUMBER} FROM {_DOCS} WHERE doc_id % 6 = 3",
    f"SELECT doc_id, 'Single', 'box', 'Mary Ann', 'Poe', 'III', '6 Elm St', 'Reno', 'NV', '89503', '906-12-' || {_NUMBER} FROM {_DOCS} WHERE doc_id % 6 = 4",
    f"SELECT doc_id, '', 'no number', '', '', '', '', '', '', '', '' FROM {_DOCS} WHERE doc_id % 6 = 5",
]))(_grid)

# The headings of a gross-to-net report.
GROSS_HEADINGS = {
    "EE ID": ("EE", "ID"), "Employee Name": ("Employee", "Name"), "SSN": ("SSN",), "Payment Date": ("Payment", "Date"), "Total Hrs/Units": ("Total", "Hrs/Units"), "Total Earnings": ("Total", "Earnings"),
    "Total Deductions": ("Total", "Deductions"), "Total Taxes": ("Total", "Taxes"), "Net Pay": ("Net", "Pay"),
}


def gross(words):
    """doc_id, page, y and the report's columns, of each line below a header that shows an id or a number; pages without a header give none.

    The first line with "EE" and "SSN" is the header, others like it are no rows. Words belong to the last heading that
    begins at or left of them.
    """
    starts = L.heading_starts(words, GROSS_HEADINGS, ("EE", "SSN"))
    lined = words.withColumn("y", F.rint(F.col("y0") / 3) * 3)
    heads = lined.groupBy(*L.PAGE, "y").agg(F.collect_set("text").alias("t")).filter("array_contains(t, 'EE') and array_contains(t, 'SSN')").select(*L.PAGE, "y")
    top = starts.groupBy(*L.PAGE).agg(F.min("y").alias("top"))
    body = lined.join(top, L.PAGE).filter("y > top").drop("top").join(heads, [*L.PAGE, "y"], "left_anti")
    wide = L.assign_columns(body, starts.select(*L.PAGE, "name", "x"), 1.0).groupBy(*L.PAGE, "y").pivot("column", list(GROSS_HEADINGS)).agg(L.words_text(["x0", "ord"]))
    rows = wide.select(*L.PAGE, "y", *[T.text(F.col(f"`{c}`")).alias(c) for c in GROSS_HEADINGS])
    return rows.filter(P.pay_row(F.col("`EE ID`"), F.col("SSN"))).withColumn("SSN", V.ssn_pay(F.col("SSN")))


GROSS = words_sql([
    (1, 10, 10, ["Gross", "to", "Net"]), (1, 30, 10, ["EE", "ID"]), (1, 30, 100, ["Employee", "Name"]), (1, 30, 300, ["SSN"]), (1, 30, 400, ["Total", "Earnings"]), (1, 30, 540, ["Net", "Pay"]),
    (1, 50, 10, ["=CONCAT('E', CAST(c_custkey AS STRING))"]), (1, 50, 100, ["Roe,", "Jane"]), (1, 50, 300, [f"={_SSN}"]), (1, 50, 400, ["1,200.50"]), (1, 50, 541, ["900.00"]), (1, 70, 10, ["Total", "for", "all"]), (1, 90, 10, ["EE", "SSN"]), (1, 110, 300, ["XXX-XX-1234"]),
    (2, 10, 10, ["EE", "alone"]), (2, 30, 10, ["E9"]),
])
query("x_gross", GROSS, f"""SELECT doc_id, 1 AS page, 'E' || doc_id AS ee_id, 'Roe, Jane' AS name, {_OSSN} AS ssn, '' AS paid, '' AS earnings, '1,200.50' AS taxes, '900.00' AS net FROM (SELECT DISTINCT doc_id FROM t) UNION ALL SELECT doc_id, 1, '', '', 'XXX-XX-1234', '', '', '', '' FROM (SELECT DISTINCT doc_id FROM t)""")(  # "Total" alone is where every such heading begins that the line doesn't spell out; the last one has the words
    lambda df: gross(df).select("doc_id", "page", *[F.col(f"`{a}`").alias(b) for a, b in (("EE ID", "ee_id"), ("Employee Name", "name"), ("SSN", "ssn"), ("Payment Date", "paid"), ("Total Earnings", "earnings"), ("Total Taxes", "taxes"), ("Net Pay", "net"))])
)
query("x_lines", "SELECT doc_id, text FROM {documents}", "SELECT doc_id, count(*) AS lines, count(*) FILTER (trim(l) <> '') AS filled FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM t) GROUP BY doc_id")(lambda df: SRC.layout_lines(df).groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(F.trim("text") != "").alias("filled")))
