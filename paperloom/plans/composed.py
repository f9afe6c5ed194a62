"""Queries over the composed extractors: change logs, remittances, plan reports. Each document is one customer's rendered pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import layout as L
from . import changes as C
from . import remittance as M
from . import retirement as K
from .registry import each_row, query

KEY = "c_custkey"


def words_sql(lines: list[tuple], letter: int = 8) -> str:
    """Words of (page, y, x, tokens) lines, generated from each customer's one row. A token is a word, or after '=' SQL over customer that gives one; '' is no word."""
    out, n = [], 0
    for page, y, x, tokens in lines:
        for t in tokens:
            text = t[1:] if t.startswith("=") else "'" + t.replace("'", "''") + "'"
            size = 8 if t.startswith("=") else len(t)
            out.append(f"({page}, {n}, {x}, {y}, {x + letter * size}, {y + 8}, {text})")
            x, n = x + letter * (size + 1), n + 1
    cast = ", ".join(f"CAST({c} AS {'INT' if c in ('page', 'ord') else 'DOUBLE'}) AS {c}" for c in ("page", "ord", "x0", "y0", "x1", "y1"))
    return f"SELECT doc_id, {cast}, text FROM (SELECT {KEY} AS doc_id, {each_row(out, 'page INT, ord INT, x0 INT, y0 INT, x1 INT, y1 INT, text VARCHAR')} FROM {{customer}}) AS w WHERE text <> ''"


def when(cond: str, word: str) -> str:
    return f"=CASE WHEN {cond} THEN '" + word.replace("'", "''") + "' ELSE '' END"


# Change logs: a table header on page 1, or only on page 2, or one without "changed" before from and to.
_K = f"CAST({KEY} AS STRING)"
CHANGE_WORDS = words_sql([
    (1, 10, 10, ["Payroll", "Changes"]), (1, 30, 10, [when(f"{KEY} % 3 <> 1", "CHANGED"), when(f"{KEY} % 3 <> 1", "FIELD")]), (1, 30, 240, [when(f"{KEY} % 3 = 0", "CHANGED")]), (1, 30, 303, [when(f"{KEY} % 3 <> 1", "FROM")]),
    (1, 30, 450, [when(f"{KEY} % 3 = 0", "CHANGED")]), (1, 30, 513, [when(f"{KEY} % 3 <> 1", "TO")]), (1, 50, 10, ["7TG", "Smith,", f"=CONCAT('Jo', {_K})", "Q.", "Jr"]), (1, 60, 10, ["Associate", "ID:", f"=CONCAT('A', {_K})", "Position", "ID:", "P1"]),
    (1, 70, 10, ["Home", "Department:", "B0-LM", "Big", "Home", "Cost", "Number:", "99"]), (1, 90, 10, ["Home", "Phone"]), (1, 90, 320, [f"=CONCAT('555-', {_K})"]), (1, 90, 520, ["555-2"]), (1, 110, 10, ["Page", "1", "of", "2"]),
    (2, 20, 10, ["Address", "-", "City"]), (2, 20, 330, ["Reno"]), (2, 20, 530, ["n/a"]), (2, 30, 10, ["CHANGED", "FIELD"]), (2, 30, 200, ["CHANGED", "FROM"]), (2, 30, 400, ["CHANGED", "TO"]), (2, 40, 10, ["Roe,", "Ann"]), (2, 50, 10, ["Poe,", "Bob"]),
    (2, 60, 10, ["Associate", "ID:", "B2"]), (2, 80, 10, ["SSN"]), (2, 80, 530, [f"=CONCAT('=', {_K})"]),
])
_D = "(SELECT DISTINCT doc_id FROM t)"
query("x_chg", CHANGE_WORDS, f"""SELECT doc_id AS "DOCID", ord, name AS "Name", a AS "Associate ID", p AS "Position ID", d AS "Home Department", c AS "Home Cost Number", f AS "Changed Field", o AS "Changed From", w AS "Changed To" FROM (
    SELECT doc_id, 4 AS ord, 'Smith, Jo' || doc_id || ' Q.' AS name, 'A' || doc_id AS a, 'P1' AS p, 'B0-LM Big' AS d, '99' AS c, 'Home Phone' AS f, '555-' || doc_id AS o, '555-2' AS w FROM {_D}
    UNION ALL SELECT doc_id, 5, 'Smith, Jo' || doc_id || ' Q.', 'A' || doc_id, 'P1', 'B0-LM Big', '99', 'Address - City', 'Reno', 'n/a' FROM {_D} UNION ALL SELECT doc_id, 9, 'Poe, Bob', 'B2', '', '', '', 'SSN', '', '''=' || doc_id FROM {_D})""")(lambda df: C.log(C.changes(df)).withColumn("DOCID", F.col("DOCID").cast("long")))
query("win_15", CHANGE_WORDS, f"SELECT doc_id, 4 AS ord, 'Jo' || doc_id AS first, 'A' || doc_id AS associate, 'Home Phone' AS field FROM {_D} UNION ALL SELECT doc_id, 5, 'Jo' || doc_id, 'A' || doc_id, 'Address - City' FROM {_D} UNION ALL SELECT doc_id, 9, 'Bob', 'B2', 'SSN' FROM {_D}")(
    lambda df: C.changes(df).select("doc_id", "ord", "first", "associate", "field")
)
query("lay_12", CHANGE_WORDS, f"SELECT doc_id, CAST(CASE doc_id % 3 WHEN 0 THEN 240 WHEN 2 THEN 303 ELSE 232.56 END AS DOUBLE) AS c2, CAST(CASE doc_id % 3 WHEN 0 THEN 450 WHEN 2 THEN 513 ELSE 410.04 END AS DOUBLE) AS c3 FROM {_D}")(lambda df: L.header_starts(L.lines_anchor(df, 3.0, True), (612 * 0.38, 612 * 0.67)))
query("obs_01", CHANGE_WORDS, r"""SELECT doc_id, page, line, CASE WHEN text LIKE 'Page%' OR text = 'Payroll Changes' THEN 'chrome' WHEN text LIKE 'CHANGED FIELD%' THEN 'table' WHEN text LIKE '%Associate%' OR text LIKE 'Home Dep%' THEN 'employee' WHEN text LIKE '%, %' THEN 'name' ELSE 'data' END AS kind,
    regexp_replace(regexp_replace(text, '[0-9]', '#', 'g'), '[A-Za-z]', 'X', 'g') AS masked FROM (SELECT doc_id, page, CAST(dense_rank() OVER (PARTITION BY doc_id, page ORDER BY y0) - 1 AS INT) AS line, string_agg(text, ' ' ORDER BY x0) AS text FROM t GROUP BY doc_id, page, y0)""")(
    lambda df: C.kinds(df).select("doc_id", "page", "line", "kind", T.mask(F.col("text")).alias("masked"))
)
query("obs_04", CHANGE_WORDS, f"""SELECT doc_id AS "File Name", 3 AS "Change Rows", 2 AS "Pages", 'Yes' AS "Records Found", '' AS "Warnings" FROM {_D}""")(lambda df: C.report(df, C.changes(df)))


def _pivot(df):
    names = df.sparkSession.createDataFrame([("Home Phone", "Home Phone"), ("Address - City", "Address - City"), ("SSN", "Social Security Number")], "field string, header string")
    return C.pivoted(C.changes(df), F.broadcast(names)).select(F.col("DOCID").cast("long").alias("doc_id"), *[F.col(a).alias(b) for a, b in (("Employee Identification Number", "associate"), ("First Name", "first"), ("Phone Number", "phone"), ("City", "city"), ("Social Security Number", "ssn"), ("Contact Information", "contact"), ("Government- Issued Identification", "government"))])


query("x_chg_template", CHANGE_WORDS, f"""SELECT doc_id, 'A' || doc_id AS associate, 'Jo' || doc_id AS first, '555-2' AS phone, 'Reno' AS city, '' AS ssn, 'Personal phone number (home);Home address' AS contact, '' AS government FROM {_D}
    UNION ALL SELECT doc_id, 'B2', 'Bob', '', '', '=' || doc_id, '', 'Social Security Number (SSN)' FROM {_D}""")(_pivot)

# Remittances: names beside, above, below or nowhere; accounts in three of four; member totals a page later.
_R = [
    (1, 10, 10, [when(f"{KEY} % 4 = 0", "ROE,"), when(f"{KEY} % 4 = 0", "Jane"), "Payee:", "X"]), (1, 30, 10, [when(f"{KEY} % 4 = 1", "ROE,"), when(f"{KEY} % 4 = 1", "Jane"), "Health", "Plan", "ID:", f"=CONCAT('H', {_K})", "Claim:", f"=CONCAT('C', {_K})"]),
    (1, 50, 10, [when(f"{KEY} % 3 <> 0", w) for w in ("Pat.", "Acct", "#")] + [f"=CASE WHEN {KEY} % 3 <> 0 THEN CONCAT('P', {_K}) ELSE '' END"]), (1, 60, 10, [when(f"{KEY} % 4 = 2", "POE,"), when(f"{KEY} % 4 = 2", "Al")]),
    (1, 70, 10, ["Service"]), (1, 70, 80, ["Revenue"]), (1, 70, 146, ["CPT-"]), (1, 70, 186, ["Billed"]), (1, 90, 10, ["1/5/21"]), (1, 90, 80, ["0450"]), (1, 90, 146, [f"=CONCAT('A', lpad(CAST({KEY} % 1000 AS STRING), 4, '9'))"]), (1, 90, 200, ["$5.00"]),
    (1, 110, 10, [f"=CONCAT('02/', lpad(CAST(1 + {KEY} % 28 AS STRING), 2, '0'), '/2021')"]), (1, 110, 146, ["none"]), (2, 10, 10, [f"=CONCAT('M', {_K})", "x"]), (2, 30, 10, [f"=CONCAT('C9', {_K})", "VILLA,", "Daniel", "01/01/2020", "A1234"]),
    (2, 50, 10, [when(f"{KEY} % 5 <> 0", w) for w in ("Patient", "Acct.", "#")] + [f"=CASE WHEN {KEY} % 5 <> 0 THEN CONCAT('Q', {_K}) ELSE '' END"]), (2, 70, 10, ["02/01/2020", "9921", "03/05/2020", "9922"]), (3, 10, 10, ["Member", "Totals:", "5"]),
]
CLAIM_WORDS = words_sql(_R)


def _straight(df):
    """The lines of a document as they stand."""
    return L.lines_chain(df, 5.0, True).withColumn("idx", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "line"))).select("doc_id", "idx", "page", "text", "words")


ORIENTED = words_sql([x for x in _R if x[1] != 60])
_NAME = "CASE doc_id % 4 WHEN 0 THEN 'ROE, Jane' WHEN 1 THEN 'ROE, Jane' WHEN 2 THEN 'POE, Al' ELSE '' END"
_CODE, _DAY = "'A' || lpad(CAST(doc_id % 1000 AS VARCHAR), 4, '9')", "'02/' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || '/2021'"
query("x_claim", ORIENTED, f"""SELECT doc_id, 1 AS ord, replace({_NAME}, 'POE, Al', '') AS name, 'H' || doc_id AS plan, '' AS member, 'C' || doc_id AS claim, CASE WHEN doc_id % 3 <> 0 THEN 'P' || doc_id ELSE '' END AS acct, {_DAY} AS service_date, {_CODE} AS cpt, '1' AS page FROM {_D}
    UNION ALL SELECT doc_id, 2, 'VILLA, Daniel', '', 'M' || doc_id, 'C9' || doc_id, 'Q' || doc_id, '03/05/2020', '', '2' FROM {_D} WHERE doc_id % 5 <> 0""")(lambda df: M.claims(M.oriented(df)))
query("win_07", CLAIM_WORDS, f"SELECT doc_id, {_NAME} AS name FROM {_D}")(lambda df: M.labelled(_straight(df)).select("doc_id", "name"))
query("win_08", CLAIM_WORDS, f"SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 'P' || doc_id ELSE '' END AS acct FROM {_D}")(lambda df: M.labelled(_straight(df)).select("doc_id", "acct"))
query("win_09", CLAIM_WORDS, f"SELECT doc_id, {_DAY} AS service_date, {_CODE} AS cpt FROM {_D}")(lambda df: M.labelled(_straight(df)).select("doc_id", "service_date", "cpt"))
query("win_14", ORIENTED, f"SELECT doc_id, 'closed' AS state, 'VILLA, Daniel' AS name, 'M' || doc_id AS member, [] AS missing FROM {_D} WHERE doc_id % 5 <> 0 UNION ALL SELECT doc_id, 'incomplete', 'VILLA, Daniel', '', ['Pat. Acct #'] FROM {_D} WHERE doc_id % 5 = 0")(
    lambda df: M.tabular_states(M.oriented(df)).select("doc_id", "state", "name", F.when(F.col("state") == "closed", F.col("member")).otherwise("").alias("member"), F.when(F.col("state") == "closed", F.array().cast("array<string>")).otherwise(F.col("missing")).alias("missing"))
)
query("agg_04", "SELECT l_orderkey AS doc_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS ord, CAST(l_linenumber AS INT) AS page, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_returnflag END AS name, l_linestatus AS plan, '' AS member, CAST(l_suppkey % 5 AS STRING) AS claim, CAST(l_partkey % 5 AS STRING) AS acct, CONCAT(CAST(1 + l_partkey % 12 AS STRING), '/3/2021') AS service_date, '' AS cpt FROM {lineitem}", r"""
    WITH g AS (SELECT *, CASE WHEN name = '' THEN ord END AS own FROM t), j AS (SELECT doc_id, plan, name, own, min(ord) AS o, strftime(max(strptime(service_date, '%m/%d/%Y')), '%m/%d/%Y') AS service_date FROM g GROUP BY ALL),
    c AS (SELECT doc_id, plan, name, own, string_agg(claim, ';' ORDER BY o) AS claim FROM (SELECT doc_id, plan, name, own, claim, min(ord) AS o FROM g GROUP BY ALL) GROUP BY ALL), a AS (SELECT doc_id, plan, name, own, string_agg(acct, ';' ORDER BY o) AS acct FROM (SELECT doc_id, plan, name, own, acct, min(ord) AS o FROM g GROUP BY ALL) GROUP BY ALL),
    p AS (SELECT doc_id, plan, name, own, min(ord) AS o, string_agg(CAST(page AS VARCHAR), ';' ORDER BY o2) AS page, arg_min(page, o2) AS first FROM (SELECT doc_id, plan, name, own, page, min(ord) AS ord, min(ord) AS o2 FROM g GROUP BY ALL) GROUP BY doc_id, plan, name, own)
    SELECT j.doc_id, CAST(row_number() OVER (PARTITION BY j.doc_id ORDER BY p.first, j.o) AS INT) AS ord, j.name, j.plan, '' AS member, claim, acct, service_date, '' AS cpt, page FROM j JOIN c ON j.doc_id = c.doc_id AND j.plan = c.plan AND j.name = c.name AND j.own IS NOT DISTINCT FROM c.own
    JOIN a ON j.doc_id = a.doc_id AND j.plan = a.plan AND j.name = a.name AND j.own IS NOT DISTINCT FROM a.own JOIN p ON j.doc_id = p.doc_id AND j.plan = p.plan AND j.name = p.name AND j.own IS NOT DISTINCT FROM p.own""")(lambda df: M.merged(df))
MIRRORED = f"SELECT doc_id, page, ord, CASE WHEN doc_id % 2 = 0 THEN 612 - x1 ELSE x0 END AS x0, y0, CASE WHEN doc_id % 2 = 0 THEN 612 - x0 ELSE x1 END AS x1, y1, text, x0 AS real FROM ({words_sql(_R[:3])}) AS m"
query("lay_07", MIRRORED, "SELECT doc_id, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY page, y0) AS INT) AS idx, string_agg(text, ' ' ORDER BY real) AS text FROM t GROUP BY doc_id, page, y0")(lambda df: M.oriented(df).select("doc_id", "idx", "text"))
PATIENT_PAGES = "SELECT doc_id, page, text FROM (SELECT c_custkey AS doc_id, " + each_row([
    f"(1, 'x' || chr(10) || 'ROE, Jane Payee: Y' || chr(10) || 'Health Plan ID: H' || {_K} || ' Claim: 55 Pat. Acct # ' || CASE WHEN {KEY} % 4 = 0 THEN '-' ELSE 'P' || {_K} END || chr(10) || 'Service Date Rev CPT-' || chr(10) || '1/2/2020 0450  A99 $5.00')",
    f"(2, repeat('y', 600) || chr(10) || 'ROE, Jane Payee: Z' || chr(10) || 'Health Plan ID: H' || {_K} || ' Claim: 56 Pat Acct # R1' || chr(10) || 'Service Date CPT-' || chr(10) || CASE WHEN {KEY} % 2 = 0 THEN '3/4/20' ELSE '5/6/2019' END || ' 77 $1')",
    f"(3, '123456789 VILLA, Daniel 1/1/2020 A100' || chr(10) || 'Patient Acct # 1' || chr(10) || 'Patient Acct # 2' || chr(10) || 'on 2/2/2020 x' || chr(10) || CASE WHEN {KEY} % 3 = 0 THEN 'MOE, Max' ELSE 'note' END || chr(10) || 'Member Totals: 9')",
], "page INT, text VARCHAR") + " FROM {customer}) AS p"
query("x_pat", PATIENT_PAGES, f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS ord, format, name, plan, claim, member, acct, service_date, proc, cpt, page FROM (
    SELECT doc_id, 1 AS o, 'A' AS format, 'VILLA, Daniel' AS name, '' AS plan, '123456789' AS claim, '123456789' AS member, '1:2' AS acct, '2/2/2020' AS service_date, 'A100' AS proc, '' AS cpt, 3 AS page FROM {_D} WHERE doc_id % 3 <> 0
    UNION ALL SELECT doc_id, 2, 'B', 'ROE, Jane', 'H' || doc_id, CASE WHEN doc_id % 4 = 0 THEN '56' ELSE '55' END, '', CASE WHEN doc_id % 4 = 0 THEN 'R1' ELSE 'P' || doc_id || ':R1' END, CASE WHEN doc_id % 4 = 0 THEN '3/4/20' WHEN doc_id % 2 = 0 THEN '3/4/20' ELSE '1/2/2020' END, '', CASE WHEN doc_id % 4 = 0 THEN '77' ELSE '0450 A99' END, CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END FROM {_D})""")(M.patients)
query("agg_05", PATIENT_PAGES, f"SELECT doc_id, 'H' || doc_id AS plan, CASE WHEN doc_id % 4 = 0 THEN 'R1' ELSE 'P' || doc_id || ':R1' END AS acct, CASE WHEN doc_id % 2 = 0 THEN '3/4/20' ELSE '1/2/2020' END AS service_date FROM {_D} UNION ALL SELECT doc_id, '', '1:2', '2/2/2020' FROM {_D} WHERE doc_id % 3 <> 0")(
    lambda df: M.patients(df).select("doc_id", "plan", "acct", "service_date")
)

# Plan reports: form fields, else tables and text lines of one document.
_SSN = f"'900-' || lpad(CAST({KEY} % 90 + 10 AS STRING), 2, '0') || '-' || lpad(CAST({KEY} % 10000 AS STRING), 4, '0')"
#: When a row is there, what it is, page, table or line, row, name, text.
_P = "SELECT doc_id, what, page, a, b, name, s FROM (SELECT c_custkey AS doc_id, " + each_row([f"({KEY} % 4 {cond}, '{what}', 1, {a}, {b}, '{name}', {s})" for cond, what, a, b, name, s in (
    ("= 0", "field", 1, 0, "Employee Name", "'Roe, Jane Ann Jr'"), ("= 0", "field", 2, 0, "ssn", _SSN), ("= 0", "field", 3, 0, "box", "'Off'"),
    ("<= 2", "cells", 0, 0, "", "'Name|SSN|Gross Wages|Company Match'"), ("<= 1", "cells", 0, 1, "", f"'Smith, John|' || {_SSN} || '|5,000.00|12'"), ("<= 1", "cells", 0, 2, "", f"'Smith, Johnny Q.|' || {_SSN} || '||'"),
    ("= 2", "cells", 0, 1, "", "'JANE ROE|x'"), ("= 2", "cells", 0, 2, "", f"'|' || {_SSN} || '|7|'"),
    ("= 3", "line", 1, 0, "", "'Employee Name: Gray, Tom'"), ("= 3", "line", 2, 0, "", f"'SSN ' || {_SSN}"), ("= 3", "line", 3, 0, "", f"'Gross salary: $9,000.00 Employee ID: E' || {_K}"),
)], "there BOOLEAN, what VARCHAR, page INT, a INT, b INT, name VARCHAR, s VARCHAR") + " FROM {customer}) AS p WHERE there"
_OSSN = _SSN.replace(KEY, "doc_id").replace("STRING", "VARCHAR")


def _employees(df):
    fields = df.filter("what = 'field'").select("doc_id", F.col("a").alias("ord"), "name", F.col("s").alias("value"))
    rows = df.filter("what = 'cells'").select("doc_id", "page", F.col("a").alias("tbl"), F.col("b").alias("row"), F.split("s", r"\|").alias("cells"))
    return K.employees(fields, rows, df.filter("what = 'line'").select("doc_id", "page", F.col("a").alias("ord"), F.col("s").alias("text")))


_FOUR = "CASE doc_id % 4 WHEN 0 THEN '{0}' WHEN 1 THEN '{1}' WHEN 2 THEN '{2}' ELSE '{3}' END"
query("x_401k", _P, f"""SELECT doc_id, {_FOUR.format("Jane", "Johnny", "", "Tom")} AS first, {_FOUR.format("Ann", "Q.", "", "")} AS middle, {_FOUR.format("Roe", "Smith", "Jane Roe", "Gray")} AS last, {_FOUR.format("Jr", "", "", "")} AS suffix, {_OSSN} AS ssn, {_FOUR.format("", "5000.00", "7", "9000.00")} AS gross_salary, {_FOUR.format("", "12", "", "")} AS er_match,
    CASE WHEN doc_id % 4 = 3 THEN 'E' || doc_id ELSE '' END AS ee_id FROM {_D}""")(lambda df: _employees(df).select("doc_id", "first", "middle", "last", "suffix", "ssn", "gross_salary", "er_match", "ee_id"))
query("prj_02", _P, "SELECT doc_id AS \"DOCID\", " + ", ".join({
    "Last Name": _FOUR.format("Roe", "Smith", "Jane Roe", "Gray"), "First Name": _FOUR.format("Jane", "Johnny", "", "Tom"), "Middle Name": _FOUR.format("Ann", "Q.", "", ""), "Suffix": _FOUR.format("Jr", "", "", ""), "Data Subject Type": "'Employee'",
    "Government- Issued Identification": "'Social Security Number (SSN)'", "Social Security Number": _OSSN, "Work-Related Information": _FOUR.format("", "Salary or Compensation Information: 5000.00 | Employer Match: 12", "Salary or Compensation Information: 7", "Salary or Compensation Information: 9000.00"), "Employee Identification Number": "CASE WHEN doc_id % 4 = 3 THEN 'E' || doc_id ELSE '' END",
}.get(c, "''") + ' AS "' + c + '"' for c in K.REVIEW[1:]) + f" FROM {_D}")(lambda df: K.template(_employees(df)).withColumn("DOCID", F.col("DOCID").cast("long")))
query("set_03", _P, f"SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 0 WHEN doc_id % 4 = 3 THEN 2 ELSE 1 END AS method FROM {_D}")(lambda df: _employees(df).select("doc_id", F.col("method").cast("long").alias("method")))
query("win_13", _P, f"SELECT doc_id, 'Jane Roe' AS last FROM {_D} WHERE doc_id % 4 = 2")(lambda df: K.parsed(K.in_tables(df.filter("what = 'cells' and doc_id % 4 = 2").select("doc_id", "page", F.col("a").alias("tbl"), F.col("b").alias("row"), F.split("s", r"\|").alias("cells")))).select("doc_id", "last"))
