"""Queries over layout, joins, aggregates, windows, order and sets."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import layout as L
from ..operators import neighbourhood as A
from ..operators import records as R
from .registry import query
from .templates import CHANGES as CHANGE_FIELDS
from .templates import changed_field, plan_role

_ORD = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
WORDS = f"""SELECT *, x0 + 20 AS x1, y0 + 10 AS y1 FROM (SELECT l_orderkey AS doc_id, CAST(1 + l_orderkey % 2 AS INT) AS page, CAST({_ORD} AS INT) AS ord,
    CAST(l_partkey % 580 AS DOUBLE) AS x0, CAST(l_suppkey % 3 * 1.5 + l_linenumber * 4 AS DOUBLE) AS y0, l_returnflag || l_linestatus || CAST(l_linenumber AS STRING) AS text FROM {{lineitem}}) AS w"""
LINES = f"SELECT l_orderkey AS doc_id, CAST({_ORD} AS INT) AS ord, CAST(1 + l_orderkey % 3 AS INT) AS page, l_returnflag AS kind, l_linestatus AS status, CAST(l_partkey AS STRING) AS text, CAST(l_shipdate AS DATE) AS day, l_suppkey AS n FROM {{lineitem}}"

_FIXED = "SELECT doc_id, page, round_even(y0 / {0}, 0) * {0} AS y, string_agg(text, ' ' ORDER BY {1}) AS text, min(x0) AS x0, min(y0) AS top, max(x1) AS x1, max(y1) AS bottom FROM t GROUP BY ALL"
query("lay_01", WORDS, _FIXED.format(3, "x0, ord"))(lambda df: L.lines_fixed(df, 3.0))
query("lay_02", WORDS, _FIXED.format(2, "ord"))(lambda df: L.lines_fixed(df, 2.0, by_x=False))
query("lay_03", WORDS, "SELECT doc_id, page, y, text, x0, top, x1, bottom, x1 - x0 AS width FROM (" + _FIXED.format(3, "x0, ord") + ")")(lambda df: L.lines_fixed(df, 3.0).withColumn("width", F.col("x1") - F.col("x0")))
query("lay_04", WORDS, """SELECT doc_id, page, line, string_agg(text, ' ' ORDER BY x0, ord) AS text FROM (SELECT *, sum(brk) OVER (PARTITION BY doc_id, page ORDER BY mid, x0, ord ROWS UNBOUNDED PRECEDING) AS line FROM
    (SELECT *, CASE WHEN mid - lag(mid) OVER (PARTITION BY doc_id, page ORDER BY mid, x0, ord) > 5 THEN 1 ELSE 0 END AS brk FROM (SELECT *, (y0 + y1) / 2 AS mid FROM t))) GROUP BY ALL""")(lambda df: L.lines_chain(df, 5.0))
_ANCHORED = """SELECT doc_id, page, CAST(line AS INT) AS line, string_agg(text, ' ' ORDER BY x0, ord) AS text FROM (
    WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY round(y0, 1), x0, ord) AS i FROM t {1}),
    r AS (SELECT doc_id, page, i, x0, ord, text, y0 AS top, 0 AS line FROM o WHERE i = 1 UNION ALL
      SELECT o.doc_id, o.page, o.i, o.x0, o.ord, o.text, CASE WHEN abs(o.y0 - r.top) <= {0} THEN r.top ELSE o.y0 END, r.line + CASE WHEN abs(o.y0 - r.top) <= {0} THEN 0 ELSE 1 END FROM r JOIN o ON o.doc_id = r.doc_id AND o.page = r.page AND o.i = r.i + 1)
    SELECT * FROM r) GROUP BY ALL"""
query("lay_05", WORDS, _ANCHORED.format(3, ""))(lambda df: L.lines_anchor(df, 3.0))
query("lay_06", WORDS, _ANCHORED.format(4, "WHERE x0 < 200 AND y0 <= 35"))(lambda df: L.lines_anchor(df.filter("x0 < 200 and y0 <= 35"), 4.0))
HEADS = "SELECT o_orderkey AS doc_id, CAST(1 AS INT) AS page, n_nationkey AS i, CAST(n_nationkey * 60 + o_orderkey % 7 AS DOUBLE) AS x0, CASE n_nationkey WHEN 0 THEN 'EE' WHEN 1 THEN 'ID' WHEN 2 THEN 'SSN' WHEN 3 THEN 'Net' WHEN 4 THEN 'Pay' ELSE 'Total' END AS text FROM {orders} CROSS JOIN {nation} WHERE n_nationkey < 6"
query("lay_10", WORDS, "SELECT doc_id, ord, CASE WHEN x0 + 1 >= 400 THEN 'c' WHEN x0 + 1 >= 150 + doc_id % 9 THEN 'b' ELSE 'a' END AS \"column\" FROM t")(
    lambda df: L.assign_columns(df, df.select("doc_id", "page").distinct().select("doc_id", "page", F.expr("stack(3, 'a', 40D, 'b', cast(150 + doc_id % 9 as double), 'c', 400D) as (name, x)")), 1.0).select("doc_id", "ord", "column")
)
query("lay_11", WORDS, "SELECT doc_id, page, coalesce(string_agg(text, ' ' ORDER BY x0, ord) FILTER (x0 < 230), '') AS c1, coalesce(string_agg(text, ' ' ORDER BY x0, ord) FILTER (x0 >= 230 AND x0 < 440), '') AS c2, coalesce(string_agg(text, ' ' ORDER BY x0, ord) FILTER (x0 >= 440), '') AS c3 FROM t GROUP BY ALL")(
    lambda df: df.groupBy("doc_id", "page").agg(*L.three_columns(F.lit(230), F.lit(440)))
)
query("lay_13", WORDS, "SELECT doc_id, ord, CAST(least(CAST(trunc(((x0 + x1) / 2 - l) / ((r - l) / 3)) AS INT), 2) AS INT) AS col FROM (SELECT *, min(x0) OVER (PARTITION BY doc_id, page) AS l, max(x1) OVER (PARTITION BY doc_id, page) AS r FROM t)")(lambda df: L.equal_columns(df, 3).select("doc_id", "ord", "col"))
query("lay_14", WORDS.replace("l_linenumber * 4", "l_linenumber * 13"), """SELECT doc_id, ord, CAST(sum(brk) OVER (PARTITION BY doc_id, page ORDER BY y0, ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block FROM
    (SELECT *, CASE WHEN y0 - lag(y1) OVER (PARTITION BY doc_id, page ORDER BY y0, ord) > 0.2 * avg(y1 - y0) OVER (PARTITION BY doc_id, page) THEN 1 ELSE 0 END AS brk FROM t)""")(
    lambda df: L.gap_blocks(df.withColumnsRenamed({"y0": "top", "y1": "bottom"}), ["doc_id", "page"], 0.2).select("doc_id", "ord", "block")
)
query("lay_17", WORDS.replace("* 4", "* 60"), "SELECT doc_id, page, ord, x0, y0 FROM t WHERE y0 <= 280 AND x0 <= 60")(lambda df: df.filter("y0 <= 280 and x0 <= 60").select("doc_id", "page", "ord", "x0", "y0"))
query("lay_18", WORDS.replace("* 4", "* 100"), """SELECT doc_id, page, array_to_string(list_transform(range(0, 192), i -> CASE WHEN list_contains(cells, i) THEN '1' ELSE '0' END), '') AS grid FROM
    (SELECT doc_id, page, list(DISTINCT r * 12 + c) AS cells FROM (SELECT doc_id, page, unnest(range(greatest(0, least(CAST(trunc(y0 / 792 * 16) AS BIGINT), 15)), greatest(0, least(CAST(trunc(y1 / 792 * 16) AS BIGINT), 15)) + 1)) AS r, a, b FROM
    (SELECT *, greatest(0, least(CAST(trunc(x0 / 612 * 12) AS BIGINT), 11)) AS a, greatest(0, least(CAST(trunc(x1 / 612 * 12) AS BIGINT), 11)) AS b FROM t)) q, (SELECT unnest(range(0, 12)) AS c) z WHERE c BETWEEN a AND b GROUP BY ALL)""")(lambda df: L.occupancy(df, 612.0, 792.0))
query("lay_19", WORDS, "SELECT doc_id, ord, x0, 792 - y1 AS top, x1, 792 - y0 AS bottom FROM t")(lambda df: df.select("doc_id", "ord", "x0", (792 - F.col("y1")).alias("top"), "x1", (792 - F.col("y0")).alias("bottom")))

# Joins.
FIELDS = f"""SELECT l_orderkey AS doc_id, CAST(1 AS INT) AS page, CAST({_ORD} AS INT) AS field, CAST(l_partkey % 500 AS DOUBLE) AS fx0, CAST(l_suppkey % 700 AS DOUBLE) AS ftop, CAST(l_partkey % 500 + 80 AS DOUBLE) AS fx1, CAST(l_suppkey % 700 + 12 AS DOUBLE) AS fbottom, 'f' || CAST(l_linenumber AS STRING) AS fallback,
    CAST({_ORD} AS INT) AS line_no, CAST((l_partkey * 7) % 450 AS DOUBLE) AS x0, CAST((l_suppkey * 13) % 700 AS DOUBLE) AS top, CAST((l_partkey * 7) % 450 + 60 AS DOUBLE) AS x1, CAST((l_suppkey * 13) % 700 + 10 AS DOUBLE) AS bottom, CASE WHEN l_linenumber = 7 THEN ' ' ELSE l_returnflag || CAST(l_partkey AS STRING) || ':' END AS text FROM {{lineitem}}"""
query("join_01", FIELDS, """SELECT doc_id, page, field, coalesce(nullif(trim(rtrim(label, ':')), ''), fallback) AS label FROM (SELECT f.doc_id, f.page, f.field, f.fallback, arg_min(text, struct_pack(d := d, l := line_no)) FILTER (d IS NOT NULL) AS label FROM
    (SELECT a.doc_id, a.page, a.field, a.fallback, b.text, b.line_no, CASE WHEN b.x1 <= a.fx0 + 5 AND abs((b.top + b.bottom) / 2 - (a.ftop + a.fbottom) / 2) <= 14 THEN (a.fx0 - b.x1) + abs((b.top + b.bottom) / 2 - (a.ftop + a.fbottom) / 2) * 0.5
      WHEN b.bottom <= a.ftop + 4 AND b.x0 < a.fx1 + 10 AND b.x1 > a.fx0 - 10 THEN (a.ftop - b.bottom) + abs((b.x0 + b.x1) / 2 - (a.fx0 + a.fx1) / 2) * 0.3
      WHEN b.bottom <= a.ftop + 4 AND abs((b.x0 + b.x1) / 2 - (a.fx0 + a.fx1) / 2) <= (a.fx1 - a.fx0) * 0.9 THEN (a.ftop - b.bottom) * 1.5 + abs((b.x0 + b.x1) / 2 - (a.fx0 + a.fx1) / 2) END AS d
      FROM t a LEFT JOIN t b ON a.doc_id = b.doc_id AND a.page = b.page AND trim(b.text) <> '') f GROUP BY ALL)""")(
    lambda df: A.nearest_label(df.select("doc_id", "page", "field", "fx0", "ftop", "fx1", "fbottom", "fallback"), df.select("doc_id", "page", "line_no", "x0", "top", "x1", "bottom", "text"))
)
query("join_03", FIELDS, "SELECT doc_id, line_no FROM t a WHERE NOT EXISTS (SELECT 1 FROM t b WHERE a.doc_id = b.doc_id AND a.page = b.page AND (a.x0 + a.x1) / 2 BETWEEN b.fx0 AND b.fx1 AND (a.top + a.bottom) / 2 BETWEEN b.ftop - 30 AND b.fbottom + 30)")(
    lambda df: A.outside(df.select("doc_id", "page", "line_no", "x0", "x1", F.col("top").alias("y0"), F.col("bottom").alias("y1")), df.select("doc_id", "page", F.col("fx0").alias("bx0"), (F.col("ftop") - 30).alias("btop"), F.col("fx1").alias("bx1"), (F.col("fbottom") + 30).alias("bbottom"))).select("doc_id", "line_no")
)
query("join_04", LINES, "SELECT doc_id, ord, kind FROM t a WHERE NOT (kind = 'A' AND EXISTS (SELECT 1 FROM t b WHERE a.doc_id = b.doc_id AND b.kind = 'R'))")(
    lambda df: df.filter("kind <> 'A'").select("doc_id", "ord", "kind").unionByName(df.filter("kind = 'A'").join(df.filter("kind = 'R'").select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "ord", "kind"))
)
CELLS = "SELECT o_orderkey AS k, CASE o_orderkey % 9 WHEN 0 THEN 'Gross Wages' WHEN 1 THEN 'Employee  SSN:' WHEN 2 THEN 'Company Match %' WHEN 3 THEN 'YTD' WHEN 4 THEN 'The gross wages ytd' WHEN 5 THEN 'Roth Contribution' WHEN 6 THEN 'EE ID' WHEN 7 THEN 'Plan participant last name (legal)' ELSE 'Other' END AS header FROM {orders}"
query("join_05", CELLS, "SELECT k, CASE k % 9 WHEN 0 THEN 'gross_salary' WHEN 1 THEN 'ssn' WHEN 2 THEN 'er_match' WHEN 3 THEN 'ytd_contribution' WHEN 4 THEN 'gross_salary' WHEN 5 THEN 'ee_contribution' WHEN 6 THEN 'ee_id' WHEN 7 THEN 'last_name' END AS role FROM t")(lambda df: df.select("k", plan_role(F.col("header")).alias("role")))


def _known_fields(df):
    """The known field of each changed field: by spelling, else the one most like it, of similarity 0.65 or more; one look for each distinct field."""
    known = [c[0] for c in CHANGE_FIELDS]

    @F.pandas_udf("string")
    def closest(s: pd.Series) -> pd.Series:
        lower = [" ".join(x.lower().replace("-", " ").split()) for x in known]
        pick = lambda x: next((known[lower.index(m)] for m in difflib.get_close_matches(x, lower, 1, 0.65)), None)
        return s.map(pick)

    fields = df.select("field").distinct().select("field", changed_field(F.col("field")).alias("exact"), T.column_key(F.col("field")).alias("key"))
    fields = fields.filter("exact is not null").select("field", F.col("exact").alias("header")).unionByName(fields.filter("exact is null").select("field", closest("key").alias("header")))
    return df.join(fields, "field", "left").select("k", "header")


query("join_06", "SELECT o_orderkey AS k, CASE o_orderkey % 8 WHEN 0 THEN 'Basis-of Pay' WHEN 1 THEN 'Home Phon' WHEN 2 THEN 'pay rate' WHEN 3 THEN 'SSN' WHEN 4 THEN 'Termination Reasn' WHEN 5 THEN 'Address - City' WHEN 6 THEN 'E-Mail' ELSE 'zzz' END AS field FROM {orders}", "SELECT k, CASE k % 8 WHEN 0 THEN 'Basis of Pay' WHEN 1 THEN 'Home Phone' WHEN 2 THEN 'Rate 1' WHEN 3 THEN 'Social Security Number' WHEN 4 THEN 'Termination Reason' WHEN 5 THEN 'Address - City' WHEN 6 THEN 'Personal E-mail' END AS header FROM t")(_known_fields)
STARTS = "SELECT l_orderkey AS doc_id, CAST(l_partkey % 580 AS DOUBLE) AS x, l_linenumber % 2 AS is_start, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_extendedprice) AS ord FROM {lineitem}"
query("join_07", STARTS, "SELECT a.doc_id, a.ord, max(b.x) AS start FROM t a LEFT JOIN t b ON a.doc_id = b.doc_id AND b.is_start = 1 AND b.x <= a.x + 2 WHERE a.is_start = 0 GROUP BY ALL")(
    # Starts move left by the tolerance; one ordered pass over both carries the last start forward.
    lambda df: df.withColumn("at", F.when(F.col("is_start") == 1, F.col("x") - 2).otherwise(F.col("x"))).withColumn("start", F.last(F.when(F.col("is_start") == 1, F.col("x")), True).over(Window.partitionBy("doc_id").orderBy("at", F.desc("is_start"), "x").rowsBetween(Window.unboundedPreceding, 0)))
    .filter("is_start = 0").select("doc_id", "ord", "start")
)
query("join_09", LINES, "SELECT a.doc_id, a.ord FROM t a WHERE a.status = 'O' AND NOT EXISTS (SELECT 1 FROM t b WHERE b.status = 'F' AND a.doc_id = b.doc_id AND a.page = b.page AND lower(a.kind) = lower(b.kind))")(
    lambda df: df.filter("status = 'O'").withColumn("n", F.lower("kind")).join(df.filter("status = 'F'").select("doc_id", "page", F.lower("kind").alias("n")), ["doc_id", "page", "n"], "left_anti").select("doc_id", "ord")
)
SSN_ROWS = f"SELECT l_orderkey AS doc_id, CAST({_ORD} AS INT) AS ord, lpad(CAST(900 + l_partkey % 3 AS STRING), 3, '0') || '-' || lpad(CAST(1 + l_suppkey % 2 AS STRING), 2, '0') || CASE l_linenumber % 3 WHEN 0 THEN '-XXXX' WHEN 1 THEN '-1234' ELSE '-12XX' END AS ssn, CASE l_suppkey % 4 WHEN 0 THEN 'Jo' WHEN 1 THEN 'John' WHEN 2 THEN 'Johnny' ELSE '' END AS first, CASE l_linenumber % 2 WHEN 0 THEN 'Q' ELSE '' END AS middle, l_returnflag AS last, CASE l_linenumber % 5 WHEN 0 THEN 'Jr' ELSE '' END AS suffix FROM {{lineitem}}"
query("join_10", SSN_ROWS, "SELECT doc_id, ord, ssn FROM (SELECT *, max(CASE WHEN length(regexp_replace(ssn, '\\D', '', 'g')) = 9 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, ssn[:6]) AS f FROM t) WHERE f = 0 OR length(regexp_replace(ssn, '\\D', '', 'g')) = 9")(lambda df: R.drop_partial(df, "ssn", ["doc_id"]).select("doc_id", "ord", "ssn"))
_KIN = "(starts_with(lower(p.first), lower(rs[k + 1].first)) OR starts_with(lower(rs[k + 1].first), lower(p.first)))"
_NEWER = "rs[k + 1].{0} <> '' AND (length(rs[k + 1].first) > length(p.first) OR p.{0} = '')"
query("join_11", SSN_ROWS, f"""
    WITH RECURSIVE own AS (SELECT *, first <> '' AND trim(last) <> '' AND trim(ssn) <> '' AS named FROM t),
    g AS (SELECT doc_id, list(struct_pack(ord := ord, ssn := ssn, first := first, middle := middle, last := last, suffix := suffix) ORDER BY ord) AS rs FROM own WHERE named GROUP BY doc_id, trim(ssn), lower(trim(last))),
    r AS (SELECT doc_id, rs, 1 AS k, rs[:1] AS done FROM g
      UNION ALL SELECT doc_id, rs, k + 1, CASE WHEN pos IS NULL THEN list_append(done, rs[k + 1]) ELSE list_transform(done, lambda p, i: CASE WHEN i = pos THEN struct_pack(ord := p.ord, ssn := p.ssn, first := CASE WHEN length(rs[k + 1].first) > length(p.first) THEN rs[k + 1].first ELSE p.first END,
        middle := CASE WHEN {_NEWER.format('middle')} THEN rs[k + 1].middle ELSE p.middle END, last := p.last, suffix := CASE WHEN {_NEWER.format('suffix')} THEN rs[k + 1].suffix ELSE p.suffix END) ELSE p END) END
      FROM (SELECT *, list_position(list_transform(done, lambda p: {_KIN}), true) AS pos FROM r WHERE k < len(rs))),
    done AS (SELECT doc_id, unnest(done, recursive := true) FROM (SELECT doc_id, done FROM r WHERE k = len(rs)))
    SELECT doc_id, ord, ssn, first, middle, last, suffix FROM done UNION ALL SELECT doc_id, ord, ssn, first, middle, last, suffix FROM own WHERE NOT named""")(lambda df: R.merge_prefixes(df.select("doc_id", "ord", "ssn", "first", "middle", "last", "suffix")))
query("join_12", "SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN 'Address - City' WHEN 1 THEN 'Rate 1' WHEN 2 THEN 'Employee Name - Salutation' WHEN 3 THEN 'Dependents No' WHEN 4 THEN 'Social Security Number' ELSE 'Unknown' END AS header FROM {orders}",
    "SELECT k, CASE k % 6 WHEN 0 THEN 'City' WHEN 2 THEN 'Suffix' WHEN 4 THEN 'Social Security Number' END AS value_col, CASE k % 6 WHEN 0 THEN 'Contact Information' WHEN 1 THEN 'Work-Related Information' WHEN 3 THEN 'Family Information' WHEN 4 THEN 'Government-Issued Identification' END AS category, CASE k % 6 WHEN 0 THEN 'Home address' WHEN 1 THEN 'Salary or Compensation Information' WHEN 4 THEN 'Social Security Number (SSN)' END AS note FROM t")(
    lambda df: df.join(F.broadcast(df.sparkSession.createDataFrame(list(CHANGE_FIELDS), "header string, value_col string, category string, note string")), "header", "left").select("k", "value_col", "category", "note")
)
query("join_13", LINES, "SELECT doc_id, ord, kind, lead(ord) OVER (PARTITION BY doc_id ORDER BY ord) AS next_label FROM t WHERE kind <> 'N'")(lambda df: df.filter("kind <> 'N'").select("doc_id", "ord", "kind", F.lead("ord").over(Window.partitionBy("doc_id").orderBy("ord")).alias("next_label")))
query("join_14", LINES, """SELECT doc_id, max(ord) AS block FROM (SELECT t.doc_id, ord, e, count(*) OVER (PARTITION BY t.doc_id) AS n FROM t LEFT JOIN (SELECT doc_id, min(ord) AS e FROM t WHERE kind = 'A' GROUP BY doc_id) q ON t.doc_id = q.doc_id WHERE kind <> 'A') WHERE (e IS NULL AND n > 1) OR ord - e > 5 GROUP BY doc_id""")(
    lambda df: df.withColumn("e", F.min(F.when(F.col("kind") == "A", F.col("ord"))).over(Window.partitionBy("doc_id"))).filter("kind <> 'A'").withColumn("n", F.count("*").over(Window.partitionBy("doc_id"))).filter("(e is null and n > 1) or ord - e > 5").groupBy("doc_id").agg(F.max("ord").alias("block"))
)
SETS = "SELECT conv_id, turn, text FROM {conversations}"
query("join_15", SETS, rf"""WITH w AS (SELECT conv_id, turn, list_distinct(list_filter(list_transform(string_split_regex(lower(text), '\s+'), x -> regexp_replace(x, '\P{{L}}', '', 'g')), x -> length(x) >= 4 AND NOT list_contains([{", ".join(f"'{x}'" for x in T.STOP_WORDS)}], x))) AS v FROM t)
    SELECT a.conv_id, a.turn AS ta, b.turn AS tb, len(list_intersect(a.v, b.v)) AS shared FROM w a JOIN w b ON a.conv_id = b.conv_id AND a.turn < b.turn WHERE len(list_intersect(a.v, b.v)) >= 0.02 * len(list_distinct(list_concat(a.v, b.v))) AND len(a.v) > 0 AND len(b.v) > 0""")(
    lambda df: (lambda w: w.select("conv_id", F.col("turn").alias("ta"), F.col("v").alias("va")).join(w.select("conv_id", F.col("turn").alias("tb"), F.col("v").alias("vb")), "conv_id").filter("ta < tb and size(va) > 0 and size(vb) > 0 and size(array_intersect(va, vb)) >= 0.02 * size(array_union(va, vb))").select("conv_id", "ta", "tb", F.size(F.array_intersect("va", "vb")).cast("long").alias("shared")))(df.select("conv_id", "turn", T.vocabulary(F.col("text")).alias("v")))
)

# Aggregates.
query("agg_02", SSN_ROWS, "SELECT doc_id, ord, first, last FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(trim(first)), lower(trim(middle)), lower(trim(last)) ORDER BY ord) AS rn FROM t) WHERE rn = 1")(lambda df: R.first_wins(df, [F.col("doc_id"), *[F.lower(F.trim(c)) for c in ("first", "middle", "last")]], ["ord"]).select("doc_id", "ord", "first", "last"))
query("agg_03", SSN_ROWS, "SELECT doc_id, ord, first, ssn FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(first), lower(last), ssn ORDER BY ord) AS rn FROM t) WHERE rn = 1")(lambda df: R.first_wins(df, [F.col("doc_id"), F.lower("first"), F.lower("last"), F.col("ssn")], ["ord"], (F.col("ssn") == "") & (F.col("first") == "")).select("doc_id", "ord", "first", "ssn"))
CHANGES = f"SELECT l_orderkey AS k, CAST({_ORD} AS INT) AS ord, l_returnflag AS field, CAST(l_partkey % 20 AS STRING) AS old, CASE l_linenumber % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN ' - ' ELSE CAST(l_suppkey % 30 AS STRING) END AS new FROM {{lineitem}}"
query("agg_06", CHANGES, """SELECT k, coalesce(max(v) FILTER (field = 'A'), '') AS a, coalesce(max(v) FILTER (field = 'N'), '') AS n, coalesce(max(v) FILTER (field = 'R'), '') AS r FROM (
    WITH RECURSIVE o AS (SELECT k, field, CASE WHEN lower(trim(new)) IN ('', 'n/a', '-') THEN trim(old) ELSE trim(new) END AS v, row_number() OVER (PARTITION BY k, field ORDER BY ord) AS i, count(*) OVER (PARTITION BY k, field) AS c FROM t),
    f AS (SELECT k, field, v, i, c FROM o WHERE i = 1 UNION ALL SELECT o.k, o.field, CASE WHEN contains(f.v, o.v) THEN f.v ELSE f.v || '; ' || o.v END, o.i, o.c FROM f JOIN o ON o.k = f.k AND o.field = f.field AND o.i = f.i + 1) SELECT * FROM f WHERE i = c) GROUP BY k""")(
    lambda df: df.withColumn("v", V.chosen_value(F.col("old"), F.col("new"))).groupBy("k").agg(*[R.appended(F.transform(F.array_sort(F.collect_list(F.when(F.col("field") == f, F.struct("ord", "v")))), lambda x: x["v"]), "; ").alias(f.lower()) for f in "ANR"])
)
query("agg_09", LINES, "SELECT doc_id, list_sort(list(n))[count(*) // 2 + 1] AS median FROM t GROUP BY doc_id")(lambda df: df.groupBy("doc_id").agg(F.expr("element_at(array_sort(collect_list(n)), cast(count(*) div 2 as int) + 1)").alias("median")))
query("agg_10", LINES, "SELECT doc_id, count(*) FILTER (kind IN ('A', 'N')) AS native, count(*) FILTER (kind = 'R') AS ocr FROM t GROUP BY doc_id")(lambda df: df.groupBy("doc_id").agg(F.count_if(F.col("kind").isin("A", "N")).alias("native"), F.count_if(F.col("kind") == "R").alias("ocr")))
query("agg_11", LINES, "SELECT kind, status, count(*) AS n FROM t GROUP BY ALL")(lambda df: df.groupBy("kind", "status").agg(F.count("*").alias("n")))
query("agg_12", LINES, "SELECT doc_id, string_agg(text, chr(10) ORDER BY ord) AS text FROM t GROUP BY doc_id")(lambda df: df.groupBy("doc_id").agg(R.ordered_concat("text", ["ord"], "\n").alias("text")))
query("agg_13", LINES, "SELECT doc_id, max(day) FILTER (kind = 'R') AS last_day FROM t GROUP BY doc_id")(lambda df: df.groupBy("doc_id").agg(F.max(F.when(F.col("kind") == "R", F.col("day"))).alias("last_day")))
query("agg_14", SSN_ROWS, "SELECT doc_id, coalesce(arg_min(first, ord) FILTER (first <> ''), '') AS first, coalesce(arg_min(suffix, ord) FILTER (suffix <> ''), '') AS suffix FROM t GROUP BY doc_id")(lambda df: df.groupBy("doc_id").agg(R.first_filled("first", "ord").alias("first"), R.first_filled("suffix", "ord").alias("suffix")))
query("agg_16", LINES, "SELECT doc_id, string_agg(kind, '; ' ORDER BY ord) AS signers, (SELECT string_agg(status, '; ' ORDER BY o) FROM (SELECT status, min(ord) AS o FROM t b WHERE b.doc_id = a.doc_id GROUP BY status)) AS sources FROM t a GROUP BY doc_id")(lambda df: df.groupBy("doc_id").agg(R.ordered_concat("kind", ["ord"], "; ").alias("signers"), R.ordered_distinct("status", ["ord"], "; ").alias("sources")))
query("agg_17", LINES, "SELECT count(*) AS n, count(DISTINCT doc_id) AS docs, CAST(sum(n) AS BIGINT) AS total FROM t")(lambda df: df.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"), F.sum("n").alias("total")))

# Neighbourhoods.
query("win_01", LINES, "SELECT doc_id, ord, ctx FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS rn FROM (SELECT *, string_agg(text, ' ') OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS ctx FROM t) WHERE kind = 'R') WHERE rn = 1")(
    lambda df: A.first_where(df.withColumn("ctx", A.around("text", ["doc_id"], ["ord"], 2, 2)), F.col("kind") == "R", ["doc_id"], ["ord"]).select("doc_id", "ord", "ctx")
)


def _after_caption(reach, skip=None):
    def run(df):
        after = F.collect_list(F.struct("kind", "text")).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(1, reach))
        block = A.until_stop(F.col("after"), lambda x: x["kind"] == "A")
        if skip:
            block = F.filter(block, lambda x: ~x["text"].startswith(skip))
        return A.first_where(df.withColumn("after", after), F.col("kind") == "R", ["doc_id"], ["ord"]).select("doc_id", "ord", F.array_join(F.transform(block, lambda x: x["text"]), "|").alias("block"))

    return run


_BLOCK = """SELECT c.doc_id, c.ord, coalesce(string_agg(l.text, '|' ORDER BY l.ord) FILTER ({1}), '') AS block FROM (SELECT doc_id, min(ord) AS ord FROM t WHERE kind = 'R' GROUP BY doc_id) c
    LEFT JOIN t l ON l.doc_id = c.doc_id AND l.ord > c.ord AND l.ord <= c.ord + {0} AND NOT EXISTS (SELECT 1 FROM t s WHERE s.doc_id = c.doc_id AND s.kind = 'A' AND s.ord > c.ord AND s.ord <= l.ord) GROUP BY c.doc_id, c.ord"""
query("win_02", LINES, _BLOCK.format(8, "true"))(_after_caption(8))
query("win_03", LINES, _BLOCK.format(39, "NOT starts_with(l.text, '1')"))(_after_caption(39, "1"))
query("win_04", LINES, "SELECT doc_id, ord, coalesce((SELECT string_agg(b.text, '|' ORDER BY b.ord) FROM t b WHERE b.doc_id = a.doc_id AND b.ord < a.ord AND b.ord >= a.ord - 3 AND NOT EXISTS (SELECT 1 FROM t s WHERE s.doc_id = a.doc_id AND s.kind = 'A' AND s.ord < a.ord AND s.ord >= b.ord)), '') AS block FROM t a WHERE kind = 'R'")(
    lambda df: df.withColumn("up", F.reverse(F.collect_list(F.struct("kind", "text")).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(-3, -1)))).filter("kind = 'R'").select("doc_id", "ord", F.array_join(F.transform(F.reverse(A.until_stop(F.col("up"), lambda x: x["kind"] == "A")), lambda x: x["text"]), "|").alias("block"))
)
query("win_05", LINES, r"SELECT doc_id, min(struct_pack(o := ord, s := span)).o AS first, min(struct_pack(o := ord, s := span)).s AS span FROM (SELECT doc_id, ord, unnest([1, 2, 3]) AS span, k1, k2, k3 FROM (SELECT doc_id, ord, kind AS k1, lead(kind) OVER w AS k2, lead(kind, 2) OVER w AS k3 FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY ord))) WHERE CASE span WHEN 1 THEN k1 WHEN 2 THEN k1 || ' ' || k2 ELSE k1 || ' ' || k2 || ' ' || k3 END LIKE 'N R%' GROUP BY doc_id")(
    lambda df: (lambda w: df.select("doc_id", "ord", F.array(F.col("kind"), F.concat("kind", F.lit(" "), F.lead("kind").over(w)), F.concat("kind", F.lit(" "), F.lead("kind").over(w), F.lit(" "), F.lead("kind", 2).over(w))).alias("a")))(Window.partitionBy("doc_id").orderBy("ord"))
    .select("doc_id", "ord", F.posexplode("a").alias("p", "j")).filter(F.col("j").rlike("^N R")).groupBy("doc_id").agg(F.min(F.struct("ord", (F.col("p") + 1).alias("span"))).alias("x")).select("doc_id", F.col("x.ord").alias("first"), "x.span")
)
query("win_06", LINES, "SELECT c.doc_id, coalesce(string_agg(l.text, ' ' ORDER BY l.ord), '') AS between_labels FROM (SELECT doc_id, min(ord) AS a FROM t WHERE kind = 'R' GROUP BY doc_id) c LEFT JOIN (SELECT doc_id, max(ord) AS b FROM t WHERE kind = 'A' GROUP BY doc_id) e ON c.doc_id = e.doc_id LEFT JOIN t l ON l.doc_id = c.doc_id AND l.ord > a AND l.ord < b GROUP BY c.doc_id")(
    lambda df: (lambda w: df.withColumn("a", F.min(F.when(F.col("kind") == "R", F.col("ord"))).over(w)).withColumn("b", F.max(F.when(F.col("kind") == "A", F.col("ord"))).over(w)))(Window.partitionBy("doc_id")).filter("a is not null")
    .groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("ord") > F.col("a")) & (F.col("ord") < F.col("b")), F.struct("ord", "text")))), lambda x: x["text"]), " ").alias("between_labels"))
)


def _cascade(offsets):
    """The first neighbour of kind N, in the order of the offsets."""
    def run(df):
        w = Window.partitionBy("doc_id").orderBy("ord")
        side = lambda o, c: F.lag(c, -o).over(w) if o < 0 else F.lead(c, o).over(w)
        found = F.coalesce(*[F.when(side(o, "kind") == "N", side(o, "text")) for o in offsets])
        return df.withColumn("found", found).filter("kind = 'R'").select("doc_id", "ord", "found")

    return run


def _cascade_sql(offsets):
    parts = ", ".join(f"CASE WHEN lead(kind, {o}) OVER w = 'N' THEN lead(text, {o}) OVER w END" if o > 0 else f"CASE WHEN lag(kind, {-o}) OVER w = 'N' THEN lag(text, {-o}) OVER w END" for o in offsets)
    return f"SELECT doc_id, ord, found FROM (SELECT *, coalesce({parts}) AS found FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY ord)) WHERE kind = 'R'"


_TEN = tuple(s * i for i in range(1, 11) for s in (-1, 1))
query("win_12", LINES, _cascade_sql(_TEN))(_cascade(_TEN))
query("win_10", LINES, "SELECT doc_id, seg, max(day) AS last_day, arg_min(text, ord) AS first_text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, seg ORDER BY ord) AS rn FROM (SELECT *, CAST(sum(CASE WHEN kind = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seg FROM t)) WHERE seg > 0 AND rn <= 26 GROUP BY ALL")(
    lambda df: A.segments(df, F.col("kind") == "R", ["doc_id"], ["ord"]).withColumnRenamed("segment", "seg").withColumn("rn", F.row_number().over(Window.partitionBy("doc_id", "seg").orderBy("ord"))).filter("seg > 0 and rn <= 26").groupBy("doc_id", "seg").agg(F.max("day").alias("last_day"), F.min_by("text", "ord").alias("first_text"))
)
query("win_11", LINES, "SELECT doc_id, ord, ctx FROM (SELECT *, string_agg(text, ' ') OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN 20 PRECEDING AND 19 FOLLOWING) AS ctx FROM t) WHERE kind = 'R'")(lambda df: df.withColumn("ctx", A.around("text", ["doc_id"], ["ord"], 20, 19)).filter("kind = 'R'").select("doc_id", "ord", "ctx"))
query("win_16", SSN_ROWS, "SELECT doc_id, ord, last_value(nullif(first, '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS name FROM t")(lambda df: df.select("doc_id", "ord", F.last(F.nullif("first", F.lit("")), True).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)).alias("name")))
query("win_17", "SELECT doc_id AS k, text AS s FROM {documents}", "SELECT k, i AS n, pos, substr(s, greatest(1, pos - 20), pos - greatest(1, pos - 20) + 50) AS ctx FROM (SELECT k, s, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS pos FROM (SELECT k, s, list_transform(range(1, len(string_split(s, ' the '))), i -> length(array_to_string(string_split(s, ' the ')[1:i], ' the ')) + 1) AS p FROM t))")(
    lambda df: df.withColumn("parts", F.split("s", " the ")).select("k", "s", F.expr("posexplode(transform(sequence(1, greatest(size(parts) - 1, 1)), i -> case when size(parts) > 1 then length(array_join(slice(parts, 1, i), ' the ')) + 1 end)) as (p, at)")).filter("at is not null")
    .select("k", (F.col("p") + 1).cast("long").alias("n"), F.col("at").cast("long").alias("pos"), F.expr("substr(s, greatest(1, at - 20), at - greatest(1, at - 20) + 50)").alias("ctx"))
)
GAPS = "SELECT o_orderkey AS k, 'Gross Pay' || CASE WHEN o_orderkey % 3 = 0 THEN repeat('.', 130) ELSE ': ' END || CAST(o_custkey AS STRING) || '.50 Net Pay  (' || CAST(o_orderkey % 90 AS STRING) || '.25)' AS s, o_custkey FROM {orders}"
query("win_18", GAPS, "SELECT k, CASE WHEN k % 3 = 0 THEN '' ELSE o_custkey || '.50' END AS gross, '(' || k % 90 || '.25)' AS net FROM t")(lambda df: df.select("k", A.label_value(F.col("s"), ["Gross Pay"], V.MONEY).alias("gross"), A.label_value(F.col("s"), ["No Such Pay", "Net Pay"], V.MONEY).alias("net")))
SIGNED = f"SELECT l_orderkey AS doc_id, CAST({_ORD} AS INT) AS ord, CASE l_linenumber % 3 WHEN 0 THEN 'Digitally signed by Ann ' || l_returnflag WHEN 1 THEN 'Date: 2024.12.0' || CAST(1 + l_linenumber AS STRING) || ' 08:36:48' ELSE 'note' END AS text FROM {{lineitem}}"
query("win_19", SIGNED, r"SELECT doc_id, ord, regexp_extract(text, 'signed by (.*)', 1) AS signer, replace(regexp_extract(ctx, 'Date: (\d{4}\.\d{2}\.\d{2})', 1), '.', '-') || CASE WHEN regexp_matches(ctx, 'Date: ') THEN ' 08:36:48' ELSE '' END AS signed FROM (SELECT *, string_agg(text, ' ') OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS ctx FROM t) WHERE text LIKE 'Digital%'")(
    lambda df: df.withColumn("ctx", A.around("text", ["doc_id"], ["ord"], 0, 3)).filter(F.col("text").rlike(r"(?i)Digital+y\s+sign\w*\s+b[yv]")).select("doc_id", "ord", F.btrim(F.regexp_extract("text", r"(?i)Digital+y\s+sign\w*\s+b[yv]\s*:?\s*(.*)", 1), F.lit(" :,")).alias("signer"), V.visible_date(F.regexp_extract("ctx", r"(?i)Date\s*:?\s*(\d{4}[.\-/]\d{2}[.\-/]\d{2}(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?)", 1)).alias("signed"))
)
WAGES = f"SELECT l_orderkey AS doc_id, CAST({_ORD} AS INT) AS ord, CASE l_linenumber % 3 WHEN 0 THEN '1 Wages, tips, other comp. ' || CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_partkey AS STRING) || '.5' ELSE '' END WHEN 1 THEN '54,321.00' ELSE 'Other' END AS text FROM {{lineitem}}"
query("win_20", WAGES, r"SELECT doc_id, ord, coalesce(nullif(CASE WHEN length(text) > 27 THEN text[28:] || '0' ELSE '' END, ''), CASE WHEN nxt = '54,321.00' THEN '54321.00' WHEN nxt LIKE '1 W%' THEN '1.00' ELSE '' END, '') AS amount FROM (SELECT *, lead(text) OVER (PARTITION BY doc_id ORDER BY ord) AS nxt FROM t) WHERE text LIKE '1 Wages%'")(
    lambda df: df.withColumn("nxt", F.lead("text").over(Window.partitionBy("doc_id").orderBy("ord"))).filter(F.lower("text").contains("wages, tips, other comp")).select("doc_id", "ord", F.coalesce(F.nullif(V.amount(F.regexp_extract(F.col("text"), r"(?i)wages, tips, other comp\.?(.*)$", 1)), F.lit("")), V.amount(F.col("nxt"))).alias("amount"))
)
query("win_21", WORDS, "SELECT a.doc_id, a.ord, arg_min(b.text, struct_pack(x := b.x0, o := b.ord)) AS right_word FROM t a JOIN t b ON a.doc_id = b.doc_id AND a.page = b.page AND b.x0 > a.x1 AND abs(b.y0 - a.y0) <= 6 WHERE a.text LIKE 'R%' GROUP BY ALL")(
    lambda df: df.filter(F.col("text").startswith("R")).select("doc_id", "page", "ord", F.col("x1").alias("ax"), F.col("y0").alias("ay")).join(df.select("doc_id", "page", F.col("ord").alias("bo"), "x0", "y0", "text"), ["doc_id", "page"]).filter("x0 > ax and abs(y0 - ay) <= 6").groupBy("doc_id", "ord").agg(F.min_by("text", F.struct("x0", "bo")).alias("right_word"))
)
query("win_22", LINES, "SELECT a.doc_id, a.ord, (SELECT arg_min(b.text, b.ord) FROM t b WHERE b.doc_id = a.doc_id AND b.ord > a.ord AND b.kind = 'A') AS address FROM t a WHERE kind = 'R'")(
    lambda df: df.withColumn("address", F.first(F.when(F.col("kind") == "A", F.col("text")), True).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(1, Window.unboundedFollowing))).filter("kind = 'R'").select("doc_id", "ord", "address")
)
# Order, limits, sets.
PAGED = "SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS STRING) || ';3' WHEN 1 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS page FROM {orders}"
query("ord_01", PAGED, "SELECT k, coalesce(TRY_CAST(split_part(page, ';', 1) AS INT), 0) AS p, row_number() OVER (ORDER BY coalesce(TRY_CAST(split_part(page, ';', 1) AS INT), 0), k) AS place FROM t")(
    lambda df: _numbered(df.withColumn("p", F.coalesce(F.split("page", ";")[0].try_cast("int"), F.lit(0))), ["p", "k"]).select("k", "p", "place")
)
query("ord_02", WORDS, "SELECT doc_id, ord, row_number() OVER (PARTITION BY doc_id ORDER BY round(y0, 1), x0, ord) AS place FROM t")(lambda df: df.select("doc_id", "ord", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.bround("y0", 1), "x0", "ord")).cast("long").alias("place")))
query("ord_03", LINES, "SELECT doc_id, ord, row_number() OVER (PARTITION BY doc_id ORDER BY page, CASE kind WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, ord) AS place FROM t")(lambda df: df.select("doc_id", "ord", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", F.expr("case kind when 'R' then 0 when 'A' then 1 else 2 end"), "ord")).cast("long").alias("place")))
query("ord_04", LINES, "SELECT doc_id, arg_min(text, struct_pack(n := n, o := ord)) AS text FROM t GROUP BY doc_id")(lambda df: df.groupBy("doc_id").agg(F.min_by("text", F.struct("n", "ord")).alias("text")))
query("ord_05", LINES, "SELECT doc_id, ord, text[:2] AS head FROM t WHERE ord <= 3")(lambda df: df.filter("ord <= 3").select("doc_id", "ord", F.substring("text", 1, 2).alias("head")))
CHATS_CELLS = "SELECT conv_id, turn, text AS s FROM {conversations}"
query("ord_06", CHATS_CELLS, r"SELECT conv_id, arg_max(turn, struct_pack(n := len(string_split_regex(trim(s), '\s+')), o := -turn)) AS longest FROM t GROUP BY conv_id")(lambda df: df.groupBy("conv_id").agg(F.max_by("turn", F.struct(F.size(F.split(F.trim("s"), r"\s+")), -F.col("turn"))).alias("longest")))
query("ord_07", LINES, "SELECT doc_id, string_agg(kind, '' ORDER BY page, ord) AS kinds FROM t GROUP BY doc_id")(lambda df: df.repartition("ord").groupBy("doc_id").agg(R.ordered_concat("kind", ["page", "ord"], "").alias("kinds")))
query("set_01", LINES, "SELECT doc_id, ord, 'A' AS format FROM t WHERE kind = 'A' UNION ALL SELECT doc_id, ord, 'B' FROM t WHERE status = 'O'")(lambda df: df.filter("kind = 'A'").select("doc_id", "ord", F.lit("A").alias("format")).unionByName(df.filter("status = 'O'").select("doc_id", "ord", F.lit("B").alias("format"))))
query("set_02", LINES, "SELECT doc_id, text, min(src) AS src FROM (SELECT doc_id, text, 1 AS src FROM t WHERE kind = 'A' UNION ALL SELECT doc_id, text, 2 FROM t WHERE kind <> 'N') GROUP BY ALL")(lambda df: df.filter("kind = 'A'").select("doc_id", "text", F.lit(1).alias("src")).unionByName(df.filter("kind <> 'N'").select("doc_id", "text", F.lit(2).alias("src"))).groupBy("doc_id", "text").agg(F.min("src").alias("src")))
query("set_04", LINES, "SELECT doc_id, ord, CASE WHEN kind = 'A' THEN text ELSE status END AS v FROM t")(lambda df: df.select("doc_id", "ord", F.coalesce(F.when(F.col("kind") == "A", F.struct("text")), F.struct(F.col("status").alias("text")))["text"].alias("v")))
query("set_05", SSN_ROWS, "SELECT doc_id, ord, coalesce(nullif(middle, ''), nullif(suffix, ''), '') AS v FROM t")(lambda df: df.select("doc_id", "ord", F.coalesce(F.nullif("middle", F.lit("")), F.nullif("suffix", F.lit("")), F.lit("")).alias("v")))
query("set_06", LINES, "SELECT doc_id, ord, 'field' AS source FROM t WHERE kind = 'A' UNION ALL SELECT doc_id, ord, 'text' FROM t a WHERE kind = 'R' AND NOT EXISTS (SELECT 1 FROM t b WHERE b.kind = 'A' AND b.doc_id = a.doc_id AND b.page = a.page AND b.status = a.status)")(
    lambda df: df.filter("kind = 'A'").select("doc_id", "ord", F.lit("field").alias("source")).unionByName(df.filter("kind = 'R'").join(df.filter("kind = 'A'").select("doc_id", "page", "status"), ["doc_id", "page", "status"], "left_anti").select("doc_id", "ord", F.lit("text").alias("source")))
)
query("set_07", LINES, "SELECT doc_id, len(list_intersect(list(DISTINCT kind), ['A', 'R'])) AS both_, len(list_distinct(list_concat(list(DISTINCT kind), ['A', 'R']))) AS either FROM t GROUP BY doc_id")(lambda df: df.groupBy("doc_id").agg(F.collect_set("kind").alias("k")).select("doc_id", F.expr("cast(size(array_intersect(k, array('A', 'R'))) as long)").alias("both_"), F.expr("cast(size(array_union(k, array('A', 'R'))) as long)").alias("either")))
query("set_08", LINES, "SELECT 'doc_' || doc_id AS \"Source File\", ord, text FROM t")(lambda df: df.select(F.concat(F.lit("doc_"), "doc_id").alias("Source File"), "ord", "text"))
query("flt_03", LINES, "SELECT doc_id, page, ord FROM t WHERE page <= 2")(lambda df: df.filter("page <= 2").select("doc_id", "page", "ord"))
query("flt_07", WORDS, "SELECT doc_id, page, y FROM (SELECT doc_id, page, round_even(y0 / 3, 0) * 3 AS y, max(x1) - min(x0) AS w FROM t GROUP BY ALL) WHERE w <= 612 * 0.55")(lambda df: L.lines_fixed(df, 3.0).filter("x1 - x0 <= 612 * 0.55").select("doc_id", "page", "y"))
query("flt_13", SSN_ROWS, "SELECT doc_id, ord, CASE WHEN middle = '' AND suffix = '' THEN 'middle, suffix' WHEN middle = '' THEN 'middle' WHEN suffix = '' THEN 'suffix' ELSE '' END AS missing FROM t WHERE first <> ''")(lambda df: df.filter("first <> ''").select("doc_id", "ord", F.concat_ws(", ", F.expr("case when middle = '' then 'middle' end"), F.expr("case when suffix = '' then 'suffix' end")).alias("missing")))
query("flt_19", SSN_ROWS, "SELECT doc_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, first ORDER BY ord) AS rn FROM t) WHERE first = '' OR rn = 1")(lambda df: R.first_wins(df, [F.col("doc_id"), F.col("first")], ["ord"], F.col("first") == "").select("doc_id", "ord"))


def _numbered(df, order):
    """A global row number without one task for all rows: counts of range partitions give each its offset."""
    d = df.repartitionByRange(df.sparkSession.sparkContext.defaultParallelism, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    sizes = d.groupBy("_p").agg(F.count("*").alias("_n"))
    offsets = sizes.withColumn("_o", F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))).select("_p", F.coalesce("_o", F.lit(0)).alias("_o"))
    return d.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order))).join(F.broadcast(offsets), "_p").withColumn("place", (F.col("_r") + F.col("_o")).cast("long")).drop("_p", "_r", "_o")
