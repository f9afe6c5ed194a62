"""Queries over sources, sinks, form fields, generic documents, W-2 templates and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import predicates as P
from ..functions import text as T
from ..functions import values as V
from ..operators import layout as L
from ..operators import neighbourhood as A
from ..operators import records as R
from ..sinks import files as W
from ..sources import fields as S
from ..sources import files as FS
from ..sources import lines as SL
from . import blocks as B
from . import coverage, creditors
from . import fields as FF
from . import generic as G
from .composed import when, words_sql
from .forms import dispatched
from .registered import EXTRACTORS
from .registry import QUERIES, each_row, query
from .relations import LINES, SSN_ROWS
from .templates import EMPLOYEE, WAGE_BOXES, filled

_D = "(SELECT DISTINCT doc_id FROM t)"


class Files:
    """A query over the tables' own files."""

    def __init__(self, run, oracle: str):
        self.run, self.sql = run, oracle

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(spark, sf_dir)


_FILE = lambda: F.regexp_extract("path", r"([^/]+)$", 1).alias("name")
_FILES = "SELECT unnest(['benchmark', 'conversations', 'customer', 'documents', 'embeddings', 'events', 'labels', 'lineitem', 'nation', 'orders', 'pages', 'part', 'region', 'supplier']) || '.parquet' AS name"
QUERIES["src_01"] = Files(lambda spark, sf: FS.list_files(spark, sf, "*.parquet").select(_FILE()), _FILES)
QUERIES["src_02"] = Files(lambda spark, sf: FS.resolve(spark, sf, "PARQUET").select(_FILE()), _FILES)

CELLS = f"SELECT l_orderkey AS doc_id, CAST(1 + l_orderkey % 2 AS INT) AS page, CAST(1 AS INT) AS tbl, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS row, CASE WHEN l_linenumber % 4 = 0 THEN ' |' WHEN l_linenumber = 1 AND l_orderkey % 3 > 0 THEN 'Name|Ship Date|Total' WHEN l_linenumber % 2 = 0 THEN 'x  ' || CAST(l_partkey AS STRING) || '|' || l_returnflag ELSE CAST(l_partkey + 10000 AS STRING) || '|b|c|' || l_linestatus END AS s FROM {{lineitem}}".replace("{{", "{").replace("}}", "}")
_CELLS = lambda df: df.select("doc_id", "page", "tbl", "row", F.split("s", r"\|").alias("cells"))
query("src_06", CELLS, "SELECT doc_id, page, tbl, row, CAST(i - 1 AS INT) AS col, c[i] AS cell FROM (SELECT *, string_split(s, '|') AS c, unnest(range(1, len(string_split(s, '|')) + 1)) AS i FROM t)")(lambda df: _CELLS(df).select("doc_id", "page", "tbl", "row", F.posexplode("cells").alias("col", "cell")))
_CLEAN_ROWS = r"""SELECT *, list_transform(string_split(s, '|'), x -> trim(regexp_replace(x, '\s+', ' ', 'g'))) AS c FROM t WHERE regexp_matches(s, '[^| ]')"""
_HEADED = f"""SELECT *, CASE WHEN first AND doc_id % 3 > 0 AND rows > 1 THEN true ELSE false END AS named FROM (SELECT *, bool_or(pos = 1 AND c[1] = 'Name') OVER (PARTITION BY doc_id) AS first FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY row) AS pos, count(*) OVER (PARTITION BY doc_id) AS rows, max(len(c)) OVER (PARTITION BY doc_id) AS wide FROM ({_CLEAN_ROWS})))"""
_TABLES = f"""SELECT doc_id, page, tbl, pos - CASE WHEN named THEN 1 ELSE 0 END AS n, named, CASE WHEN named THEN 3 ELSE wide END AS w, c FROM ({_HEADED})"""
query("src_07", CELLS, f"SELECT doc_id, page, n, CASE WHEN named THEN 'Name|Ship Date|Total' ELSE array_to_string(list_transform(range(1, w + 1), i -> 'Column_' || i), '|') END AS headers, array_to_string(list_concat(c, list_transform(range(0, greatest(w - len(c), 0)), i -> '')), '|') AS cells FROM ({_TABLES}) WHERE n > 0")(
    lambda df: G.table_rows(_CELLS(df)).select("doc_id", "page", F.col("n").cast("long").alias("n"), F.array_join("headers", "|").alias("headers"), F.array_join("cells", "|").alias("cells"))
)
query("prj_09", CELLS, f"SELECT doc_id, n, named AS is_header, CASE WHEN named THEN 'Name' ELSE 'Column_1' END AS first_header, greatest(len(c), w) AS width FROM ({_TABLES}) WHERE n > 0")(
    lambda df: G.table_rows(_CELLS(df)).select("doc_id", F.col("n").cast("long").alias("n"), (F.col("headers")[0] == "Name").alias("is_header"), F.col("headers")[0].alias("first_header"), F.size("cells").cast("long").alias("width"))
)
query("prj_06", CELLS, "SELECT doc_id, row, " + ", ".join(f"coalesce(c[{i}], '') AS Col_{i}" for i in range(1, 5)) + " FROM (SELECT *, string_split(s, '|') AS c FROM t)")(lambda df: (lambda rows: G.padded(rows, G.widest(rows)))(_CELLS(df).select("doc_id", "row", "cells")))
TEXTS = "SELECT o_orderkey AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'n' || CAST(o_custkey AS STRING) WHEN 1 THEN ' ' ELSE '' END AS native, CASE o_orderkey % 3 WHEN 0 THEN 'p' ELSE ' ' END AS pdfium, CASE o_orderkey % 5 WHEN 0 THEN '' ELSE 'o' END AS ocr FROM {orders}"
_AUTO = "CASE WHEN trim(native) <> '' THEN 'native' WHEN trim(pdfium) <> '' THEN 'pdfium' ELSE '{0}' END"
query("src_08", TEXTS, f"SELECT doc_id, 'auto' AS mode, CASE WHEN trim(native) <> '' THEN native WHEN trim(pdfium) <> '' THEN pdfium ELSE ocr END AS text, {_AUTO.format('ocr')} AS method FROM t UNION ALL SELECT doc_id, 'never', CASE WHEN trim(native) <> '' THEN native ELSE pdfium END, {_AUTO.format('pdfium')} FROM t UNION ALL SELECT doc_id, 'always', ocr, 'ocr' FROM t")(
    lambda df: FS.chosen_text(df, "auto").withColumn("mode", F.lit("auto")).unionByName(FS.chosen_text(df, "never").withColumn("mode", F.lit("never"))).unionByName(FS.chosen_text(df, "always").withColumn("mode", F.lit("always")))
)
query("src_10", "SELECT l_orderkey AS doc_id, l_linenumber AS ord, CAST(l_partkey % 580 AS DOUBLE) AS x0, CAST(l_suppkey AS DOUBLE) AS y0, CAST(l_partkey AS DOUBLE) AS x1, CAST(l_suppkey + 30 AS DOUBLE) AS y1, CASE WHEN l_linenumber % 5 = 0 THEN ' ' ELSE l_returnflag END AS text, CAST(l_suppkey % 7 - 1 AS DOUBLE) AS conf FROM {lineitem}",
    "SELECT doc_id, ord, x0 * (72.0 / 300) AS x0, y0 * (72.0 / 300) AS y0, x1 * (72.0 / 300) AS x1, y1 * (72.0 / 300) AS y1, text FROM t WHERE trim(text) <> '' AND conf >= 0")(lambda df: FS.recognised(df).drop("conf"))
SHORT = "SELECT l_orderkey AS doc_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS page, repeat('x', CAST(l_partkey % 40 AS INT)) AS text, l_orderkey % 3 AS done FROM {lineitem}"
query("src_11", SHORT, "SELECT doc_id, page FROM t WHERE length(text) < 20 AND done <> 0")(lambda df: FS.to_recognise(df, df.filter("done = 0").groupBy("doc_id").agg(F.count("*").alias("pages"))))
query("src_13", SHORT, "SELECT CAST(doc_id AS VARCHAR) AS path, CAST(CASE WHEN max(done) = 1 THEN 0 ELSE max(page) END AS INT) AS pages FROM t GROUP BY doc_id")(
    lambda df: FS.page_counts(df.withColumn("n", F.max("page").over(Window.partitionBy("doc_id"))).select(F.col("doc_id").cast("string").alias("path"), F.when(F.col("done") == 1, 0).otherwise(F.col("n")).cast("int").alias("pages")))
)
_TWICE = ("Last Name", "First", "Last  Name", "", "SSN")
query("src_20", SSN_ROWS, """SELECT doc_id, CAST(2 + ord AS INT) AS row, x.place, x.header, x.nth, x.value FROM (SELECT doc_id, ord, unnest([{'place': 1, 'header': 'last name', 'nth': 1, 'value': last}, {'place': 2, 'header': 'first', 'nth': 1, 'value': first}, {'place': 3, 'header': 'last name', 'nth': 2, 'value': suffix}, {'place': 5, 'header': 'ssn', 'nth': 1, 'value': ssn}]) AS x FROM t)""")(
    lambda df: FS.template_values(W.combined(W.template(df, _TWICE, dict(zip(_TWICE, map(F.col, ("last", "first", "suffix", "middle", "ssn")))), (("Employee data",), _TWICE)), W.work_folder(df.sparkSession), name="doc_id"), 2)
)
PAGE_TEXTS = "SELECT doc_id, page, text FROM (SELECT CONCAT('s', CAST(s_suppkey AS STRING), '.txt') AS doc_id, " + each_row(["(1, s_name || chr(10) || 'line ' || CAST(s_nationkey AS STRING))", "(2, '')", "(3, ' ' || s_name || chr(10))", "(4, CAST(s_nationkey AS STRING))"], "page INT, text VARCHAR") + " FROM {supplier}) AS p"


def _page_files(df):
    at = W.work_folder(df.sparkSession)
    SL.write_page_files(df, at)
    return SL.read_page_files(df.sparkSession, at)


query("src_16", PAGE_TEXTS, "SELECT replace(doc_id, '.txt', '_extracted') AS file, page, text FROM t")(_page_files)

# Page bodies: a text file for each supplier, whose pages tasks read by ranges.
BODIES = "SELECT CONCAT('s', CAST(l_suppkey AS STRING), '.txt') AS doc_id, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS INT) AS page, CAST(l_partkey AS STRING) || ' ' || l_returnflag || chr(10) || ' ' || l_linestatus AS text FROM {lineitem}"
PLAIN = ("paperloom.sources.engine_plain",)


def page_bodies(df: DataFrame) -> DataFrame:
    """The ranges of the files that the pages make."""
    at = W.work_folder(df.sparkSession)
    SL.write_page_files(df, at)
    return FS.page_ranges(df.sparkSession, at, PLAIN, "*.txt")


_OWN = lambda: F.regexp_extract("path", "file=([^/]+)/", 1).alias("file")
query("src_03", BODIES, "SELECT replace(doc_id, '.txt', '_extracted') AS file, page, CAST(count(*) OVER (PARTITION BY doc_id) AS INT) AS pages, text FROM t")(lambda df: FS.range_texts(page_bodies(df), PLAIN).select(_OWN(), "page", "pages", "text"))
query("src_04", BODIES, "SELECT replace(doc_id, '.txt', '_extracted') AS file, page, w.* FROM (SELECT *, unnest([{'ord': 0, 'x0': 0.0::DOUBLE, 'y0': 0.0::DOUBLE, 'text': split_part(split_part(text, chr(10), 1), ' ', 1)}, {'ord': 1, 'x0': 8.0::DOUBLE * (1 + length(split_part(text, ' ', 1))), 'y0': 0.0::DOUBLE, 'text': split_part(split_part(text, chr(10), 1), ' ', 2)}, {'ord': 2, 'x0': 8.0::DOUBLE, 'y0': 20.0::DOUBLE, 'text': split_part(text, chr(10) || ' ', 2)}]) AS w FROM t)")(
    lambda df: FS.range_words(page_bodies(df), PLAIN).select(_OWN(), "page", "ord", "x0", "y0", "text")
)

# Field trees: a person with two drawn kids, a signature drawn as a kid; in every fifth document nothing is listed.
_K = "CAST(c_custkey AS STRING)"


_KINDS = (("T", "VARCHAR"), ("TU", "VARCHAR"), ("FT", "VARCHAR"), ("V", "VARCHAR"), ("flags", "INT"), ("signed", "BOOLEAN"), ("sig_name", "VARCHAR"), ("sig_date", "VARCHAR"), ("sig_reason", "VARCHAR"), ("sig_location", "VARCHAR"), ("sig_contact", "VARCHAR"))


def _node(n: int, parent: str, ord_: int, page: str, box: str, **more: str) -> str:
    x = [f"CAST({v} AS DOUBLE)" for v in (box.split(",") if box else ["NULL"] * 4)]
    return f"({n}, CAST({parent} AS INT), {ord_}, {chr(39) + '/Widget' + chr(39) if n in (2, 3, 5) else chr(39) * 2}, CAST({page} AS INT), {', '.join(x)}, " + ", ".join(f"CAST({more.get(c, 'NULL')} AS {'STRING' if k == 'VARCHAR' else k})" for c, k in _KINDS) + ")"


NODES = "SELECT * FROM (SELECT c_custkey AS doc_id, c_custkey % 5 > 0 AS listed, " + each_row([
    _node(1, "NULL", 0, "NULL", "", T="'person'", FT="'/Tx'", TU="'Person'"), _node(2, "1", 0, "1", "100,700,200,712", T="'first'", V=f"' Jane' || {_K} || ' '"), _node(3, "1", 1, "1", "100,650,200,662", FT="'/Btn'", V="CASE c_custkey % 3 WHEN 0 THEN '/Off' WHEN 1 THEN '/Yes' END", flags="c_custkey % 2"),
    _node(4, "NULL", 1, "NULL", "", T="'sig'", FT="'/Sig'", signed="c_custkey % 2 = 0", sig_name=f"'Ann' || {_K}", sig_reason="'ok'"), _node(5, "4", 0, "2", "10,10,50,20"),
], "node INT, parent INT, ord INT, subtype VARCHAR, page INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, " + ", ".join(f"{c} {k}" for c, k in _KINDS)) + " FROM {customer}) AS n"
query("src_17", NODES, f"SELECT doc_id, '000000/000000' AS ord, 'first' AS name, 'Jane' || doc_id AS value FROM {_D} WHERE doc_id % 5 > 0 UNION ALL SELECT doc_id, '000000/000001', '', '/Yes' FROM {_D} WHERE doc_id % 5 > 0 AND doc_id % 3 = 1")(S.leaf_values)
query("src_18", NODES, f"""SELECT doc_id, 1 AS page, 'first' AS name, 'Person' AS alt, 'Text' AS kind, ' Jane' || doc_id || ' ' AS raw, CAST(100 AS DOUBLE) AS x0 FROM {_D} UNION ALL SELECT doc_id, 1, 'person', 'Person', 'Checkbox / Radio', CASE doc_id % 3 WHEN 0 THEN '/Off' WHEN 1 THEN '/Yes' END, 100 FROM {_D}
    UNION ALL SELECT doc_id, 2, 'sig', '', 'Signature', NULL, 10 FROM {_D}""")(lambda df: S.widgets(df).select("doc_id", "page", "name", "alt", "kind", "raw", "x0"))
_NO_LINES = lambda df: df.sparkSession.createDataFrame([], "doc_id long, page int, ord int, text string")
query("src_19", NODES, f"""SELECT doc_id, 1 AS page, 'first' AS name, 'Jane' || doc_id AS value, 'No' AS read_only, '' AS signed, '' AS source FROM {_D} UNION ALL SELECT doc_id, 1, 'person', CASE doc_id % 3 WHEN 0 THEN '/Off' ELSE '/Yes' END, CASE WHEN doc_id % 2 = 1 THEN 'Yes' ELSE 'No' END, '', '' FROM {_D} WHERE doc_id % 3 < 2
    UNION ALL SELECT doc_id, 2, 'sig', CASE WHEN doc_id % 2 = 0 THEN 'Ann' || doc_id ELSE '' END, 'No', CASE WHEN doc_id % 2 = 0 THEN 'Yes' ELSE 'No' END, 'signature field' FROM {_D}""")(
    lambda df: FF.long_rows(S.widgets(df), _NO_LINES(df)).select("doc_id", F.col("Page Number").alias("page"), F.col("Field Name").alias("name"), F.col("Value").alias("value"), F.col("Read Only").alias("read_only"), F.col("Signed").alias("signed"), F.col("Source").alias("source"))
)


def _form(df):
    """All three modes of one form: long rows counted, the wide row, the value beside a label, the signatures."""
    drawn, docs = S.widgets(df), df.select("doc_id").distinct()
    lines = docs.select("doc_id", F.lit(1).alias("page"), F.lit(1).alias("ord"), F.concat(F.lit("Digitally signed by Bob"), "doc_id").alias("text"))
    rows = FF.long_rows(drawn, lines)
    labels = docs.select("doc_id", F.lit(1).alias("page"), F.lit(1).alias("ord"), F.lit("Advisor").alias("label"), F.lit(100.0).alias("x0"), F.lit(100.0).alias("top"), F.lit(200.0).alias("x1"), F.lit(110.0).alias("bottom"))
    boxes = drawn.selectExpr("doc_id", "page", "ord", "kind", "raw", "x0", "792 - y1 as top", "x1", "792 - y0 as bottom")
    text = docs.select("doc_id", F.lit(1).alias("page"), F.lit(1).alias("line_no"), F.lit("Above").alias("text"), F.lit(100.0).alias("x0"), F.lit(90.0).alias("top"), F.lit(200.0).alias("x1"), F.lit(99.0).alias("bottom"))
    s = FF.summary(FF.beside_labels(labels, boxes, text), rows)
    wide = FF.wide_rows(rows).select("doc_id", *[F.try_element_at("row", F.lit(k)).alias(n) for k, n in (("Person", "person"), ("Person (2)", "second"), ("Signature 1 Signer Name", "signer_1"), ("Signature 2 Signed", "signed_2"))])
    n = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    return n.join(wide, "doc_id").join(s.select("doc_id", F.col("values")["Advisor"].alias("advisor"), F.col("Signed").alias("signed"), F.col("Signer Name").alias("signers"), F.col("Signature Source").alias("sources")), "doc_id")


query("x_form", NODES, f"""SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN 4 ELSE 3 END AS n, 'Jane' || doc_id AS person, CASE doc_id % 3 WHEN 0 THEN '/Off' WHEN 1 THEN '/Yes' END AS second, 'Bob' || doc_id AS signer_1, CASE WHEN doc_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS signed_2, 'Jane' || doc_id AS advisor, 'Yes' AS signed,
    'Bob' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '; Ann' || doc_id ELSE '' END AS signers, 'page text (flattened)' || CASE WHEN doc_id % 2 = 0 THEN '; signature field' ELSE '' END AS sources FROM {_D}""")(_form)
query("agg_07", NODES, f"SELECT doc_id, 'Jane' || doc_id AS first, CASE doc_id % 3 WHEN 0 THEN '/Off' WHEN 1 THEN '/Yes' END AS again, CASE WHEN doc_id % 3 < 2 THEN 6 ELSE 5 END AS columns FROM {_D}")(
    lambda df: FF.wide_rows(FF.long_rows(S.widgets(df), _NO_LINES(df))).select("doc_id", F.try_element_at("row", F.lit("Person")).alias("first"), F.try_element_at("row", F.lit("Person (2)")).alias("again"), F.size("row").alias("columns"))
)

# Generic documents: sized words, a bold line, a page without sizes, a table's box.
_W = ((1, 10, 10, "EMPLOYER", "10.0", ""), (1, 10, 90, "ID:", "10.0", ""), (1, 10, 130, "={k}", "10.0", ""), (1, 20, 10, "lost", "10.0", ""), (1, 30, 10, "Big", "14.0", ""), (1, 30, 50, "Header:", "14.0", ""), (1, 40, 10, "some", "10.0", ""), (1, 40, 60, "={k}", "10.0", ""), (1, 60, 10, "Bold", "10.0", "Arial-Bold"), (1, 60, 60, "mixed", "10.0", ""), (1, 60, 120, "line", "10.0", ""), (1, 70, 10, "Bold", "10.0", "X-BD"), (1, 200, 10, "cell", "10.0", ""), (2, 10, 10, "SECTION", "NULL", ""), (2, 20, 10, "text", "NULL", ""), (2, 30, 10, "EMPTY", "NULL", ""))
WORDS = "SELECT doc_id, page, ord, x0, y0, x1, y1, text, size, font FROM (SELECT c_custkey AS doc_id, " + each_row(
    [f"({p}, {i}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE), CAST({x + 8 * len(t)} AS DOUBLE), CAST({y + 8} AS DOUBLE), {_K if t == '={k}' else repr(t)}, CAST({s} AS DOUBLE), '{f}')" for i, (p, y, x, t, s, f) in enumerate(_W)], "page INT, ord INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, text VARCHAR, size DOUBLE, font VARCHAR"
) + " FROM {customer}) AS w"
_BOXES = lambda df: df.select("doc_id").distinct().select("doc_id", F.lit(1).alias("page"), F.lit(0.0).alias("bx0"), F.lit(190.0).alias("btop"), F.lit(600.0).alias("bx1"), F.lit(300.0).alias("bbottom"))
_SECTIONS = lambda df: G.sections(G.section_lines(df, _BOXES(df)))
_FOUND = "SELECT doc_id, {p} AS page, {o} AS ord, {h} AS header, {v} AS value FROM " + _D
_ALL = " UNION ALL ".join(_FOUND.format(p=p, o=o, h=h, v=v) for p, o, h, v in ((1, 1, "'EMPLOYER ID'", "CAST(doc_id AS VARCHAR)"), (1, 2, "'Big Header'", "'some ' || doc_id || ' Bold mixed line'"), (1, 3, "'Bold'", "''"), (2, 1, "'SECTION'", "'text'"), (2, 2, "'EMPTY'", "''")))
query("win_23", WORDS, _ALL)(_SECTIONS)
query("flt_15", WORDS, f"SELECT doc_id, page, y, page = 1 AND y IN (30, 70) OR page = 2 AND y <> 20 AS header FROM (SELECT DISTINCT doc_id, page, y0 AS y FROM t WHERE y0 < 190)")(lambda df: G.section_lines(df, _BOXES(df)).select("doc_id", "page", "y", "header"))


def _unified(df):
    docs = df.select("doc_id").distinct()
    rows = docs.select("doc_id", F.explode(F.array(*[F.struct(F.lit(p).alias("page"), F.lit(t).alias("tbl"), F.lit(r).alias("row"), F.array(*map(F.lit, c)).alias("cells")) for p, t, r, c in ((1, 1, 1, ("Name", "Total")), (1, 1, 2, ("Ann", "7")), (2, 1, 1, ("x", "")))])).alias("x")).select("doc_id", "x.*")
    fields = docs.select("doc_id", F.lit(2).alias("page"), F.lit("0").alias("ord"), F.lit("Signed").alias("name"), F.lit("=Yes").alias("value"))
    return G.unified(_SECTIONS(df), G.table_rows(rows), fields)


_UNI = " UNION ALL ".join(f"""SELECT CAST(doc_id AS VARCHAR) AS "Source File", {o} AS ord, '{p}' AS "Page", '{c}' AS "Category", {h} AS "Field Name", {v} AS "Value" FROM {_D}""" for o, p, c, h, v in (
    (1, 1, "Section", "'EMPLOYER ID'", "CAST(doc_id AS VARCHAR)"), (2, 1, "Section", "'Big Header'", "'some ' || doc_id || ' Bold mixed line'"), (3, 1, "Section", "'Bold'", "''"), (4, 1, "Table", "'Row 1 (Table 1)'", "'Name: Ann | Total: 7'"), (5, 2, "Form Field", "'Signed'", "'''=Yes'"), (6, 2, "Section", "'SECTION'", "'text'"), (7, 2, "Table", "'Row 1 (Table 1)'", "'Column_1: x | Column_2: '"),
))
query("prj_08", WORDS, _UNI)(_unified)
query("x_gen", WORDS, _UNI)(_unified)
LABELS = "SELECT l_orderkey AS doc_id, CAST(1 AS INT) AS page, CAST(l_linenumber AS INT) AS ord, l_partkey, l_suppkey, l_linenumber FROM {lineitem}"


def _beside(df):
    at = df.groupBy("doc_id", "page").agg(F.min("l_partkey").alias("p"))
    labels = at.select("doc_id", "page", F.lit(1).alias("ord"), F.lit("Advisor").alias("label"), F.lit(100.0).alias("x0"), F.lit(100.0).alias("top"), F.lit(200.0).alias("x1"), F.lit(110.0).alias("bottom"))
    box = lambda top: (F.lit(120.0).alias("x0"), F.lit(top).alias("top"), F.lit(180.0).alias("x1"), F.lit(top + 8.0).alias("bottom"))
    drawn = at.filter("p % 3 = 0").select("doc_id", "page", F.lit(1).alias("ord"), F.lit("Text").alias("kind"), F.concat(F.lit(" f"), "p").alias("raw"), *box(130.0)).unionByName(at.select("doc_id", "page", F.lit(2).alias("ord"), F.lit("Text").alias("kind"), F.lit("far").alias("raw"), *box(300.0)))
    lines = at.filter("p % 3 = 1").select("doc_id", "page", F.lit(1).alias("line_no"), F.lit("above it").alias("text"), *box(85.0)).unionByName(at.filter("p % 3 < 2 or p % 2 = 0").select("doc_id", "page", F.lit(2).alias("line_no"), F.lit("below it").alias("text"), *box(115.0)))
    return FF.beside_labels(labels, drawn, lines)


query("join_02", LABELS, """SELECT doc_id, 'Advisor' AS label, CASE p % 3 WHEN 0 THEN 'f' || p WHEN 1 THEN 'above it' ELSE CASE WHEN p % 2 = 0 THEN 'below it' ELSE '' END END AS value, CASE WHEN p % 3 = 0 THEN 'form field' WHEN p % 3 = 1 OR p % 2 = 0 THEN 'page text (flattened)' ELSE '' END AS source FROM (SELECT doc_id, min(l_partkey) AS p FROM t GROUP BY doc_id)""")(_beside)

# Sinks: written, and read back.
_AT = lambda df: W.work_folder(df.sparkSession)
SUPPLIED = "SELECT CONCAT('s', CAST(l_suppkey AS STRING), '.pdf') AS doc_id, l_orderkey AS ord, CAST(l_partkey AS STRING) AS text FROM {lineitem}"
query("snk_01", SUPPLIED, "SELECT replace(doc_id, '.pdf', '_extracted') AS file, doc_id, ord, text FROM t")(lambda df: W.per_document(df, _AT(df)))
query("snk_02", LINES, 'SELECT doc_id AS "Document ID", ord, text FROM t')(lambda df: W.combined(df.select("doc_id", "ord", "text"), _AT(df)))
query("snk_03", LINES, "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(ord AS VARCHAR) AS ord, CASE WHEN kind = 'R' THEN '''=' || text ELSE 'a \"b\", ' || text END AS v FROM t")(lambda df: W.csv(df.select("doc_id", "ord", F.expr("case when kind = 'R' then concat('=', text) else concat('a \"b\", ', text) end").alias("v")), _AT(df), True))
query("snk_04", SSN_ROWS, "SELECT 'all' AS sheet, doc_id, ord FROM t UNION ALL SELECT 'people', doc_id, ord FROM t WHERE first <> '' UNION ALL SELECT 'numbered', doc_id, ord FROM t WHERE NOT contains(ssn, 'X')")(
    lambda df: (lambda v: v["all"].withColumn("sheet", F.lit("all")).unionByName(v["people"].withColumn("sheet", F.lit("people"))).unionByName(v["numbered"].withColumn("sheet", F.lit("numbered"))))(W.views({"all": df.select("doc_id", "ord"), "people": df.filter("first <> ''").select("doc_id", "ord"), "numbered": df.filter("not contains(ssn, 'X')").select("doc_id", "ord")}, _AT(df)))
)
query("snk_08", SSN_ROWS, "SELECT doc_id, CAST(2 + ord AS INT) AS row, last || '|' || first || '||Employee|' || ssn AS cells FROM t UNION ALL SELECT DISTINCT doc_id, 1, 'Employee data||||' FROM t UNION ALL SELECT DISTINCT doc_id, 2, 'Last|First|Middle|Type|SSN' FROM t")(
    lambda df: W.template(df, ("Last", "First", "Middle", "Type", "SSN"), {"Last": F.col("last"), "First": F.col("first"), "Type": F.lit("Employee"), "SSN": F.col("ssn")}, (("Employee data",), ("Last", "First", "Middle", "Type", "SSN"))).select("doc_id", "row", F.array_join("cells", "|").alias("cells"))
)


def _increments(df):
    at, rows = _AT(df), df.select((F.col("doc_id") % 7).alias("part"), "doc_id", "ord", "kind")
    W.increment(rows, at, "part")
    return W.increment(rows.filter("part = 3").withColumn("kind", F.lit("new")), at, "part").select("doc_id", "ord", "kind", "part")


query("snk_09", LINES, "SELECT doc_id, ord, CASE WHEN doc_id % 7 = 3 THEN 'new' ELSE kind END AS kind, doc_id % 7 AS part FROM t")(_increments)
query("snk_10", SSN_ROWS, " UNION ALL ".join(f"SELECT '{c}' AS \"column\", least(greatest(max(length(CAST({c} AS VARCHAR))), {len(c)}) + 2, 60) AS width FROM t" for c in ("doc_id", "ssn", "first", "suffix")))(lambda df: W.widths(df.select("doc_id", "ssn", "first", "suffix")).withColumn("width", F.col("width").cast("long")))

def _dumped(df):
    """Both modes over one input: its lines as text, those with bars as table rows too."""
    at = _AT(df)
    lines = df.select("doc_id", "page", F.col("row").alias("ord"), F.col("s").alias("text"))
    W.dump(lines, lines.filter("contains(text, '|')").select("doc_id", "page", "ord", F.split("text", r"\|").alias("cells")), at, "/in/forms/", "2026-07-04")
    read = lambda mode: df.sparkSession.read.parquet(f"{at}/forms_07042026/{mode}")
    cells = [F.coalesce(f"Col_{i}", F.lit("")) for i in range(1, 5)]
    return read("text").select(F.lit("text").alias("mode"), F.col("File Name").alias("doc_id"), F.col("Page Number").alias("page"), "ord", F.col("Extracted Text").alias("value")).unionByName(read("tables").select(F.lit("tables").alias("mode"), F.col("File Name").alias("doc_id"), F.col("Page Number").alias("page"), "ord", F.concat_ws("|", *cells).alias("value")))


query("x_lines_dump", CELLS, """SELECT 'text' AS mode, doc_id, page, row AS ord, rtrim(s) AS value FROM t
    UNION ALL SELECT 'tables', doc_id, page, row, array_to_string(list_transform(range(1, 5), lambda i: coalesce(string_split(s, '|')[i], '')), '|') FROM t WHERE contains(s, '|')""")(_dumped)

# W-2 rows in the standard template, and their summary.
RAW = f"SELECT c_custkey AS doc_id, 'f' || CAST(c_custkey % 100 AS STRING) || '.pdf' AS file, CAST(1 + c_custkey % 3 AS INT) AS page, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Jane Roe' WHEN 2 THEN 'Jane Q Roe Jr' ELSE 'Cher' END AS name, CASE c_custkey % 3 WHEN 0 THEN '' ELSE '1 Main St, Reno, NV 8950' || CAST(c_custkey % 10 AS STRING) END AS address, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '900-01-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END AS ssn, CAST(c_custkey AS STRING) || '.00' AS wages FROM {{customer}}".replace("{{", "{").replace("}}", "}")


def employee_rows(df: DataFrame, boxes: dict[str, str] | None = None) -> DataFrame:
    """Rows of the standard template. df: file, name, address, ssn and the columns that ``boxes`` names for wage boxes."""
    d = df.withColumn("n", N.first_middle_last(F.col("name"))).withColumn("a", V.comma_address(F.col("address")))
    values = {
        "Document Id": F.regexp_replace("file", r"\.[^./]+$", ""), "Document": F.col("file"), "First Name": F.col("n.first"), "Middle Name": F.col("n.middle"), "Last Name": F.col("n.last"), "Suffix": F.col("n.suffix"), "Entity Type": F.lit("Employee"),
        "Street Address": F.col("a.street"), "City": F.col("a.city"), "State": F.col("a.state"), "Zip Code": F.col("a.zip"), "Social Security Number": F.col("ssn"),
    }
    return filled(d, EMPLOYEE + (WAGE_BOXES if boxes is not None else ()), values | {b: F.col(c) for b, c in (boxes or {}).items()})


def employee_summary(df: DataFrame, failed: DataFrame) -> DataFrame:
    """One row for each document: pages, records, numbers, names, addresses, status and error. failed: file and error of documents that couldn't be read."""
    filled_in = lambda c: F.count_if(F.col(c) != "")
    done = df.groupBy("file").agg(F.countDistinct("page").alias("Pages Processed"), F.count("*").alias("Entity Count"), filled_in("ssn").alias("SSN Count"), filled_in("name").alias("Names Found"), filled_in("address").alias("Addresses Found")).withColumn("Status", F.lit("Success")).withColumn("Error", F.lit(""))
    bad = failed.select("file", *[F.lit(0).cast("long").alias(c) for c in ("Pages Processed", "Entity Count", "SSN Count", "Names Found", "Addresses Found")], F.lit("Failed").alias("Status"), F.col("error").alias("Error"))
    every = done.unionByName(bad)
    return every.select(F.col("file").alias("Document Name"), F.regexp_replace("file", r"\.[^./]+$", "").alias("Document Id"), *[c for c in every.columns if c != "file"])


_N4 = "CASE doc_id % 4 WHEN 0 THEN '{0}' WHEN 1 THEN '{1}' WHEN 2 THEN '{2}' ELSE '{3}' END"
_STD = {"Document Id": "replace(file, '.pdf', '')", "Document": "file", "First Name": _N4.format("", "Jane", "Jane", "Cher"), "Middle Name": _N4.format("", "", "Q", ""), "Last Name": _N4.format("", "Roe", "Roe", ""), "Suffix": _N4.format("", "", "Jr", ""), "Entity Type": "'Employee'", "Street Address": "CASE WHEN address = '' THEN '' ELSE '1 Main St' END", "City": "CASE WHEN address = '' THEN '' ELSE 'Reno' END", "State": "CASE WHEN address = '' THEN '' ELSE 'NV' END", "Zip Code": "CASE WHEN address = '' THEN '' ELSE address[-5:] END", "Social Security Number": "ssn", "Box 1 Wages Tips Other Comp": "wages"}
_AS = lambda c: '"' + c + '"'
query("prj_03", RAW, "SELECT " + ", ".join(f"{_STD.get(c, chr(39) * 2)} AS {_AS(c)}" for c in EMPLOYEE + WAGE_BOXES) + " FROM t")(lambda df: employee_rows(df, {"Box 1 Wages Tips Other Comp": "wages"}))
query("prj_03_plain", RAW, "SELECT " + ", ".join(f"{_STD.get(c, chr(39) * 2)} AS {_AS(c)}" for c in EMPLOYEE) + " FROM t")(employee_rows)
query("agg_08", RAW, """SELECT file AS "Document Name", replace(file, '.pdf', '') AS "Document Id", count(DISTINCT page) AS "Pages Processed", count(*) AS "Entity Count", count(*) FILTER (ssn <> '') AS "SSN Count", count(*) FILTER (name <> '') AS "Names Found", count(*) FILTER (address <> '') AS "Addresses Found", 'Success' AS "Status", '' AS "Error" FROM t GROUP BY file
    UNION ALL SELECT 'bad.pdf', 'bad', 0, 0, 0, 0, 0, 'Failed', 'no text'""")(lambda df: employee_summary(df, df.sparkSession.createDataFrame([("bad.pdf", "no text")], "file string, error string")))
_AGG1 = "SELECT doc_id % 20 AS doc_id, doc_id AS ord, name, address, ssn FROM t"
query("agg_01", RAW, f"SELECT doc_id, ord, ssn, name FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, CASE WHEN ssn <> '' THEN ssn ELSE name || '|' || address END ORDER BY ord) AS rn FROM ({_AGG1})) WHERE rn = 1")(
    lambda df: R.first_wins(df.selectExpr("doc_id % 20 as doc_id", "doc_id as ord", "name", "address", "ssn"), [F.col("doc_id"), F.when(F.col("ssn") != "", F.col("ssn")).otherwise(F.concat("name", F.lit("|"), "address"))], ["ord"]).select("doc_id", "ord", "ssn", "name")
)
_SSN = "CONCAT('900-', lpad(CAST(c_custkey % 90 + 10 AS STRING), 2, '0'), '-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))"
#: Blocks in three of four documents, one of them twice; text alone in the others.
BLOCK_WORDS = words_sql([
    (1, 100, 20, [when("c_custkey % 4 > 0", "e/f")]), (1, 112, 20, [when("c_custkey % 4 > 0", "Jane"), f"=CASE WHEN c_custkey % 4 > 0 THEN CONCAT('Roe', {_K}) ELSE '' END"]), (1, 122, 20, [when("c_custkey % 4 IN (1, 2)", x) for x in ("1", "Main", "St")]),
    (1, 132, 20, [when("c_custkey % 4 > 0", x) for x in ("Reno,", "NV", "89501")]), (1, 160, 20, [f"=CASE WHEN c_custkey % 4 IN (1, 3) THEN {_SSN} ELSE '' END"]), (1, 160, 210, [f"=CASE WHEN c_custkey % 4 = 2 THEN {_SSN} ELSE '' END"]),
    (1, 200, 20, [when("c_custkey % 4 = 1", "e/f")]), (1, 212, 20, [when("c_custkey % 4 = 1", "Jane"), f"=CASE WHEN c_custkey % 4 = 1 THEN CONCAT('Roe', {_K}) ELSE '' END"]), (1, 222, 20, [when("c_custkey % 4 = 1", "x"), when("c_custkey % 4 = 1", "y")]), (1, 250, 20, [f"=CASE WHEN c_custkey % 4 = 1 THEN {_SSN} ELSE '' END"]),
    (1, 400, 20, ["footer"]),
])
_T = f"'Form W-2' || chr(10) || 'Employee''s Social Security Number: ' || {_SSN} || chr(10) || 'e/f Employee''s name, address, and ZIP code' || chr(10) || 'Ann Lee' || chr(10) || CASE WHEN c_custkey % 8 = 0 THEN 'GROSS PAY' ELSE '2 Elm St' END || chr(10) || 'Reno, NV 89502'"


def _employees(df):
    """The text of a page comes with its footer."""
    pages = df.filter("text = 'footer'").select("doc_id", "page", F.expr("case when doc_id % 4 = 0 then _text else 'no employee here' end").alias("text"))
    return B.employees(df.drop("_text"), pages)


query("x_w2b", f"SELECT w.*, {_T.replace('c_custkey', 'w.doc_id')} AS _text FROM ({BLOCK_WORDS}) AS w", f"""SELECT doc_id, 1 AS page, CASE WHEN doc_id % 4 = 0 THEN 'Ann Lee' ELSE 'Jane Roe' || doc_id END AS name, {_SSN.replace('c_custkey', 'doc_id').replace('STRING', 'VARCHAR')} AS ssn,
    CASE WHEN doc_id % 4 = 0 THEN CASE WHEN doc_id % 8 = 0 THEN 'Reno, NV 89502' ELSE '2 Elm St, Reno, NV 89502' END WHEN doc_id % 4 = 3 THEN 'Reno, NV 89501' ELSE '1 Main St, Reno, NV 89501' END AS address FROM {_D}""")(lambda df: _employees(df).select("doc_id", "page", "name", "ssn", "address"))
ETA = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -1.0 ELSE CAST(o_custkey * (o_orderkey % 7) AS DOUBLE) + 0.5 END AS s FROM {orders}"
query("fn_date_05", ETA, """SELECT k, CASE WHEN s IS NULL OR s < 0 THEN 'calculating...' WHEN n >= 3600 THEN (n // 3600) || 'h ' || lpad(CAST(n % 3600 // 60 AS VARCHAR), 2, '0') || 'm ' || lpad(CAST(n % 60 AS VARCHAR), 2, '0') || 's' WHEN n >= 60 THEN (n // 60) || 'm ' || lpad(CAST(n % 60 AS VARCHAR), 2, '0') || 's' ELSE n || 's' END AS eta FROM (SELECT *, CAST(floor(s) AS BIGINT) AS n FROM t)""")(
    lambda df: df.select("k", V.eta(F.col("s")).alias("eta"))
)


# Dispatch: documents of five formats, one that shows none when only three are selected, one with nothing in it.
DISPATCH = f"""SELECT c_custkey AS doc_id, CAST(1 AS INT) AS page, CASE c_custkey % 5 WHEN 0 THEN 'Wage and Tax Statement of the year' || chr(10) || 'ssn ' || {_SSN} WHEN 1 THEN 'Your 401 (k) plan statement for the year' || chr(10) || 'Roe, Jane ' || {_SSN}
    WHEN 2 THEN 'Form 1095-C Employer-Provided Health Insurance' || chr(10) || '1 Name of employee' || chr(10) || 'Jane Roe' WHEN 3 THEN 'Wage and Tax Statement without any number at all' ELSE 'An ordinary letter with a sufficient amount of text' END AS text FROM {{customer}}"""


def _dispatched(df):
    words = df.select("doc_id", "page", F.posexplode(F.split("text", r"\s")).alias("ord", "text")).select("doc_id", "page", "ord", *[(F.col("ord") * 40.0).alias(c) for c in ("x0", "y0", "x1", "y1")], "text")
    rows, rejects = dispatched(df, words, {**{k: EXTRACTORS[k] for k in ("w2", "401k", "1095c")}, "claims": lambda pages, _: pages.select("no_such_column")}, ["w2", "401k", "1095c", "claims"])
    f = lambda c: F.coalesce(F.try_element_at("fields", F.lit(c)), F.lit(""))
    return rows.select("doc_id", "format", F.lit("").alias("why"), f("ssn").alias("ssn"), F.concat_ws(" ", F.nullif(f("first"), F.lit("")), F.nullif(f("last"), F.lit(""))).alias("name")).unionByName(rejects.select("doc_id", "format", "why", F.lit("").alias("ssn"), F.lit("").alias("name")))


query("dsp_02", DISPATCH, f"""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'w2' WHEN 1 THEN '401k' WHEN 2 THEN '1095c' WHEN 3 THEN 'w2' END AS format, CASE doc_id % 5 WHEN 3 THEN 'nothing found' WHEN 4 THEN 'no format' ELSE '' END AS why,
    CASE WHEN doc_id % 5 < 2 THEN {_SSN.replace('c_custkey', 'doc_id').replace('STRING', 'VARCHAR')} ELSE '' END AS ssn, CASE doc_id % 5 WHEN 1 THEN 'Jane Roe' WHEN 2 THEN 'Jane Roe' ELSE '' END AS name FROM t""")(_dispatched)


# A batch of all nine formats, of which one fails in the midst of its data and one finds nothing.
_BATCH = {
    "w2": f"'Wage and Tax Statement of the year' || chr(10) || 'ssn ' || {_SSN}", "401k": f"'Your 401 (k) plan statement for the year' || chr(10) || 'Roe, Jane ' || {_SSN}",
    "1095c": "'Form 1095-C Employer-Provided Health Insurance' || chr(10) || '1 Name of employee' || chr(10) || 'Jane Roe'",
    "bucket11": "'Employee Payroll Changes' || chr(10) || rpad('CHANGED FIELD', 30, ' ') || rpad('CHANGED FROM', 26, ' ') || 'CHANGED TO' || chr(10) || 'Roe, Jane' || chr(10) || 'Associate ID: A' || CAST(c_custkey AS STRING) || chr(10) || rpad('Home Phone', 30, ' ') || rpad('555-1', 26, ' ') || '555-2'",
    "gross-pay": f"'Gross to Net report' || chr(10) || rpad('EE ID', 12, ' ') || rpad('Employee Name', 24, ' ') || 'SSN' || chr(10) || rpad('E1', 12, ' ') || rpad('Jane Roe', 24, ' ') || {_SSN}",
    "claims": "'Health Plan remittance of the month' || chr(10) || 'ROE, Jane Payee: X' || chr(10) || 'Health Plan ID: H1 Claim: C1'", "patient-info": "'A scan'",
    "creditor-list": "'Mailing matrix of the case, by name and address'", "generic": "'SECTION' || chr(10) || 'a letter with a sufficient amount of text'",
}
BATCH = "SELECT c_custkey AS doc_id, CAST(1 AS INT) AS page, CASE c_custkey % 9 " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(_BATCH.values())) + " END AS text FROM {customer}"


def _batch(df):
    fails = lambda pages, _: pages.select("doc_id", F.when(F.length("text") > 0, F.raise_error(F.lit("planted"))).cast("string").alias("name"))
    rows, rejects = dispatched(df, SL.laid_out_words(df), {**EXTRACTORS, "creditor-list": fails})
    f = lambda *cs: F.coalesce(*[F.try_element_at("fields", F.lit(c)) for c in cs], F.lit(""))
    name = F.coalesce(F.nullif(F.concat_ws(" ", F.nullif(f("first"), F.lit("")), F.nullif(f("last"), F.lit(""))), F.lit("")), f("name", "Employee Name"))
    planted = F.when(F.contains("why", F.lit("planted")), "planted").otherwise(F.col("why"))
    return rows.select("doc_id", "format", F.lit("").alias("why"), f("ssn", "SSN").alias("ssn"), name.alias("name")).unionByName(rejects.select("doc_id", "format", planted.alias("why"), F.lit("").alias("ssn"), F.lit("").alias("name")))


query("dsp_02_batch", BATCH, "SELECT doc_id, CASE doc_id % 9 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_BATCH)) + f""" END AS format, CASE doc_id % 9 WHEN 6 THEN 'nothing found' WHEN 7 THEN 'planted' ELSE '' END AS why,
    CASE WHEN doc_id % 9 IN (0, 1, 4) THEN {_SSN.replace('c_custkey', 'doc_id').replace('STRING', 'VARCHAR')} ELSE '' END AS ssn, CASE WHEN doc_id % 9 IN (1, 2, 3, 4) THEN 'Jane Roe' WHEN doc_id % 9 = 5 THEN 'ROE, Jane' WHEN doc_id % 9 = 8 THEN 'SECTION' ELSE '' END AS name FROM t""")(_batch)


# What dispatch hands on beside pages and words: plan reports by form fields and by tables, generic documents with tables, drawn fields and page sizes.
FURTHER_PAGES = f"""SELECT c_custkey AS doc_id, CAST(1 AS INT) AS page, {_K} AS k, {_SSN} AS ssn, CASE WHEN c_custkey % 4 < 2 THEN 'Your 401 (k) plan statement for the year' ELSE 'SECTION' || chr(10) || 'letter ' || {_K} || chr(10) || 'Name Total' || chr(10) || 'Ann ' || {_K} || chr(10) || chr(10) || 'First name:' END AS text FROM {{customer}}"""


def _further(df: DataFrame) -> dict[str, DataFrame]:
    """Nodes, table rows and page sizes of the documents, by what doc_id leaves of 4."""
    node = lambda n, at, name, value, rest="null, null, null, null, null, null": f"struct(cast({n} as int) as node, cast({at} as int) as ord, '{name}' as T, {value} as V, {rest})"
    drawn = lambda page, top, height: f"'/Tx', {page}, 100.0d, {height - top - 10}.0d, 200.0d, {height - top}.0d"
    each = f"""case doc_id % 4 when 0 then array({node(1, 0, "Employee Name", "'Roe, Jane Ann Jr'")}, {node(2, 1, "ssn", "ssn")}, {node(3, 2, "Company Match", "k")})
        when 2 then array({node(1, 0, "f1", "concat(' Jane', k)", drawn(1, 100, 800))}) when 3 then array({node(1, 0, "f1", "concat('Joe', k)", drawn(2, 100, 792))}) else array() end"""
    filled = dict(zip(("FT", "page", "x0", "y0", "x1", "y1"), ("col1", "col2", "col3", "col4", "col5", "col6")))
    raw = df.select("doc_id", F.expr(f"inline({each})"))
    raw = raw.toDF("doc_id", "node", "ord", "T", "V", *filled)
    kinds = {f.name: f.dataType for f in df.sparkSession.createDataFrame([], S.NODE).schema}
    nodes = raw.select([(F.col(c) if c in raw.columns else F.lit(True) if c == "listed" else F.when(F.col("page").isNotNull(), "Person") if c == "TU" else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])
    row = lambda n, *cells: f"struct({n} as row, array({', '.join(cells)}) as cells)"
    rows = f"""case doc_id % 4 when 1 then array({row(0, "'Name'", "'SSN'", "'Gross Wages'")}, {row(1, "'Smith, John'", "ssn", "concat(k, '.50')")}) when 2 then array({row(0, "'Name'", "'Total'")}, {row(1, "'Ann'", "k")}) when 3 then array({row(0, "k", "'b'")}) else array() end"""
    box = {"x0": 0.0, "y0": 36.0, "x1": 600.0, "y1": 80.0}
    tables = df.select("doc_id", "page", F.lit(1).alias("tbl"), F.expr(f"inline({rows})"), *[F.when(F.col("doc_id") % 4 > 1, v).alias(c) for c, v in box.items()])
    return {"nodes": nodes, "tables": tables, "sizes": df.filter("doc_id % 4 = 2").select("doc_id", "page", F.lit(800.0).alias("height"))}


def _with_further(df):
    pages = df.select("doc_id", "page", "text")
    rows, rejects = dispatched(pages, SL.laid_out_words(pages), EXTRACTORS, further=_further(df))
    f = lambda c: F.coalesce(F.try_element_at("fields", F.lit(c)), F.lit(""))
    found = rows.select("doc_id", "format", f("category").alias("category"), F.coalesce(F.nullif(f("name"), F.lit("")), F.concat_ws(" ", f("first"), f("last"))).alias("name"), F.concat(f("value"), f("ssn")).alias("value"), f("gross_salary").alias("gross"), f("er_match").alias("er_match"))
    return found.unionByName(rejects.select("doc_id", "format", F.lit("reject").alias("category"), *[F.lit("").alias(c) for c in ("name", "value", "gross", "er_match")]))


_PLAN, _OWN_ID = "SELECT doc_id, '401k' AS format, '' AS category, {0} AS name, " + _SSN.replace("c_custkey", "doc_id").replace("STRING", "VARCHAR") + " AS value, {1} AS gross, {2} AS er_match FROM t WHERE doc_id % 4 = {3}", "CAST(doc_id AS VARCHAR)"
query("dsp_02_inputs", FURTHER_PAGES, " UNION ALL ".join([_PLAN.format("'Jane Roe'", "''", _OWN_ID, 0), _PLAN.format("'John Smith'", f"{_OWN_ID} || '.50'", "''", 1), *[
    f"SELECT doc_id, 'generic', '{c}', {n}, {v}, '', '' FROM t WHERE doc_id % 4 {on}" for c, n, v, on in (
        ("Section", "'SECTION'", f"'letter ' || {_OWN_ID}", "> 1"), ("Form Field", "'First name'", f"'Jane' || {_OWN_ID}", "= 2"), ("Form Field", "'Person'", f"'Joe' || {_OWN_ID}", "= 3"),
        ("Table", "'Row 1 (Table 1)'", f"'Name: Ann | Total: ' || {_OWN_ID}", "= 2"), ("Table", "'Row 1 (Table 1)'", f"'Column_1: ' || {_OWN_ID} || ' | Column_2: b'", "= 3"), ("Section", "'First name'", "''", "= 3"),
    )
]]))(_with_further)


# Layout by what pages show: captions, name rows, headings, offsets.
_C = lambda page, y, x, cond: (page, y, x, [when(cond, "SSN")])
GRID_WORDS = words_sql([_C(1, 30, 40, "c_custkey % 4 > 0"), _C(1, 30, 400, "c_custkey % 4 > 1"), _C(1, 500, 40, "c_custkey % 4 = 3"), (1, 100, 50, ["a"]), (1, 100, 450, ["b"]), (1, 600, 50, ["c"]), (1, 600, 450, ["d"])])
query("lay_08", GRID_WORDS, """SELECT doc_id, ord, CASE doc_id % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Single' WHEN 2 THEN CASE WHEN (x0 + x1) / 2 < 306 THEN 'Left' ELSE 'Right' END ELSE CASE WHEN y0 >= 396 THEN 'Bottom' WHEN (x0 + x1) / 2 < 306 THEN 'TopLeft' ELSE 'TopRight' END END AS cell FROM t""")(lambda df: L.caption_grid(df, "SSN").select("doc_id", "ord", "cell"))
NAME_WORDS = words_sql([(1, 10, 10, ["First"]), (1, 10, 150, [when("c_custkey % 3 > 0", "Last")]), (1, 10, 300, [when("c_custkey % 3 > 1", "Suff.")]), (1, 30, 10, ["Mary", "Ann"]), (1, 30, 160, [f"=CONCAT('Roe', {_K})"]), (1, 30, 305, ["Jr"]), (1, 30, 450, [when("c_custkey % 2 = 0", "12a")]), (1, 30, 500, ["500.00"])])
query("lay_16", NAME_WORDS, """SELECT doc_id, 1 AS page, CASE WHEN doc_id % 3 = 0 THEN 'Mary Ann Roe' || doc_id || ' Jr' || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' 500.00' END ELSE 'Mary Ann' END AS first, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'Roe' || doc_id || ' Jr' || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' 500.00' END ELSE 'Roe' || doc_id END AS last,
    CASE WHEN doc_id % 3 = 2 THEN 'Jr' ELSE '' END AS suffix FROM (SELECT DISTINCT doc_id FROM t)""")(lambda df: L.name_row(df.filter("y0 = 10"), df.filter("y0 = 30")))
HEAD_WORDS = words_sql([(1, 10, 10, ["EE", "report"]), (1, 30, 10, [when("c_custkey % 2 = 0", "EE"), when("c_custkey % 4 = 0", "ID")]), (1, 30, 100, ["SSN"]), (1, 30, 200, ["Net"]), (1, 30, 240, [when("c_custkey % 3 = 0", "Pay")]), (1, 50, 10, ["E1"])])
query("lay_09", HEAD_WORDS, """SELECT doc_id, name, x FROM (SELECT DISTINCT doc_id, unnest([{'name': 'EE ID', 'x': 10.0::DOUBLE}, {'name': 'SSN', 'x': 100.0::DOUBLE}, {'name': 'Net Pay', 'x': 200.0::DOUBLE}], recursive := true) FROM t) WHERE doc_id % 2 = 0""")(
    lambda df: L.heading_starts(df, {"EE ID": ("EE", "ID"), "SSN": ("SSN",), "Net Pay": ("Net", "Pay"), "Gross": ("Gross",)}, ("EE", "SSN")).select("doc_id", "name", "x")
)
PROVIDER_WORDS = words_sql([(1, 10, 10, ["Claim"]), (1, 10, 200, [when("c_custkey % 2 = 0", "Provider"), "Name"]), (1, 30, 10, [f"=CONCAT('C', {_K})", "ROE,"]), (1, 30, 196, ["near"]), (1, 30, 200, ["VILLA,"])])
query("lay_15", PROVIDER_WORDS, "SELECT doc_id, 'C' || doc_id || ' ROE,' || CASE WHEN doc_id % 2 = 0 THEN ' near' ELSE ' near VILLA,' END AS text FROM (SELECT DISTINCT doc_id FROM t)")(
    lambda df: (lambda lines, head: lines.filter("line = 1").join(head, "doc_id", "left").select("doc_id", L.left_of(F.col("words"), F.col("limit")).alias("text")))(
        L.lines_chain(df, 5.0, True), df.filter("text = 'Provider'").groupBy("doc_id").agg((F.min_by("x0", "ord") - 2).alias("limit")))
)
query("join_08", LINES, "SELECT doc_id, place, page FROM (SELECT doc_id, unnest(range(0, CAST(total AS BIGINT), 7)) AS place, ends FROM (SELECT doc_id, sum(length(text) + 1) AS total, list(b ORDER BY ord) AS ends FROM (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM t) GROUP BY doc_id)) q, LATERAL (SELECT len(list_filter(ends, x -> x <= place)) AS page)")(
    lambda df: df.withColumn("b", F.coalesce(F.sum(F.length("text") + 1).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).groupBy("doc_id").agg(F.sum(F.length("text") + 1).alias("total"), F.array_sort(F.collect_list("b")).alias("begins"))
    .select("doc_id", "begins", F.explode(F.expr("sequence(0L, total - 1, 7L)")).alias("place")).select("doc_id", "place", A.page_at(F.col("place"), F.col("begins")).alias("page"))
)
query("agg_15", CELLS, r"""SELECT doc_id, row, CAST(good AS DOUBLE) / n AS share, CAST(good AS DOUBLE) / n >= 0.6 AS is_header FROM (SELECT doc_id, row, len(own) AS n, len(list_filter(own, x -> len(list_filter(string_split_regex(x, '\s+'), w -> w <> '')) <= 5 AND NOT regexp_matches(x, '\d{4,}')
    AND (regexp_matches(x, '^\p{Lu}') OR (length(regexp_replace(x, '\P{L}', '', 'g')) >= 3 AND length(regexp_replace(x, '[^\p{Lu}]', '', 'g')) >= 0.75 * length(regexp_replace(x, '\P{L}', '', 'g')))))) AS good FROM (SELECT *, list_filter(string_split(s, '|'), x -> trim(x) <> '') AS own FROM t)) WHERE n > 0""")(
    lambda df: _CELLS(df).select("doc_id", "row", P.heading_share(F.col("cells")).alias("share")).filter("share is not null").withColumn("is_header", F.col("share") >= 0.6)
)


# Layout groups: each conversation is a page on which its turns are boxes and its first words the words.
PRINTS = "SELECT conv_id AS doc_id, CAST(1 AS INT) AS page, CAST(turn AS DOUBLE) AS turn, CAST(length(text) % 4 * 150 AS DOUBLE) AS x0, CAST(length(text) % 4 * 150 + 60 AS DOUBLE) AS x1, CAST(turn % 9 * 80 AS DOUBLE) AS y0, CAST(turn % 9 * 80 + 30 AS DOUBLE) AS y1, text FROM {conversations}"


def fingerprints(boxes: DataFrame) -> DataFrame:
    """file, orientation, grid and tokens of each page."""
    grid = L.occupancy(boxes, 612.0, 792.0)
    words = boxes.groupBy("doc_id", "page").agg(T.vocabulary(F.min_by("text", "turn")).alias("tokens"))
    return grid.join(words, ["doc_id", "page"]).select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("file"), F.when(F.col("doc_id") % 2 == 0, "portrait").otherwise("landscape").alias("orientation"), "grid", "tokens")


query("x_grp", PRINTS)(lambda df: R.greedy_groups(fingerprints(df)))


# Creditor lists: a heading across the page, a person and a foreign address in one column, a company and a person beside them.
CREDITOR_WORDS = words_sql([
    (1, 5, 10, ["Mailing"]), (1, 5, 500, ["matrix"]), (1, 40, 10, ["Roe,", f"=CONCAT('Ann', {_K})"]), (1, 50, 10, [f"={_K}", "Main", "St"]), (1, 60, 10, ["Reno,", "NV", "89501"]), (1, 120, 10, ["Lee,", "Kim", "Q.", "Jr"]), (1, 130, 10, ["5", "Weg"]), (1, 140, 10, ["Germany"]),
    (1, 45, 220, ["Acme", "Inc"]), (1, 55, 220, ["PO", "Box", "7"]), (1, 34, 420, ["=CASE WHEN c_custkey % 2 = 0 THEN CONCAT(chr(61), 'x') ELSE '' END", when("c_custkey % 2 = 1", "Poe,"), when("c_custkey % 2 = 1", "Bob")]), (1, 300, 560, ["1"]),
])


def _sheets(df):
    # Entries are worked out and written once; the three sheets are read from them.
    v = W.views(creditors.sheets(W.combined(creditors.entries(df), _AT(df), name="doc_id")), _AT(df))
    wide = v["extracted"].select(F.lit("extracted").alias("sheet"), "doc_id", "ord", F.col("Full Name").alias("a"), F.col("Address Information").alias("b"))
    name = F.concat_ws("|", "First Name", "Last Name", "Middle Name", "Suffix"), F.concat_ws("|", "Street Address", "City", "State", "ZIP Code")
    for n in ("parsed", "people"):
        wide = wide.unionByName(v[n].select(F.lit(n).alias("sheet"), "doc_id", "ord", name[0].alias("a"), name[1].alias("b")))
    return wide


_ENTRIES = (
    (1, "'Roe, Ann' || doc_id", "doc_id || ' Main St, Reno, NV 89501'", "'Ann' || doc_id || '|Roe||'", "doc_id || ' Main St|Reno|NV|89501'", "true"), (2, "'Lee, Kim Q. Jr'", "'5 Weg, Germany'", "'Kim|Lee|Q.|Jr'", "'5 Weg|||'", "true"), (3, "'Acme Inc'", "'PO Box 7'", "'|Acme Inc||'", "'PO Box 7|||'", "false"),
    (4, "CASE WHEN doc_id % 2 = 0 THEN chr(39) || '=x' ELSE 'Poe, Bob' END", "''", "CASE WHEN doc_id % 2 = 0 THEN '|' || chr(39) || '=x||' ELSE 'Bob|Poe||' END", "'|||'", "doc_id % 2 = 1"), (5, "'1'", "''", "'|1||'", "'|||'", "false"),
)
query("x_cred", CREDITOR_WORDS, " UNION ALL ".join(f"SELECT 'extracted' AS sheet, doc_id, {o} AS ord, {a} AS a, {b} AS b FROM {_D} UNION ALL SELECT 'parsed', doc_id, {o}, {c}, {d} FROM {_D} UNION ALL SELECT 'people', doc_id, {o}, {c}, {d} FROM {_D} WHERE {p}" for o, a, b, c, d, p in _ENTRIES))(_sheets)

FLAT = "SELECT lpad(CAST(c_custkey AS STRING), 9, '0') AS file, CASE WHEN c_custkey % 2 = 0 THEN 'p' ELSE 'l' END AS orientation, CONCAT(repeat('1', CAST(floor(c_acctbal * c_acctbal) AS INT) % 190), repeat('0', 192 - CAST(floor(c_acctbal * c_acctbal) AS INT) % 190)) AS grid, CASE WHEN c_custkey % 3 = 0 THEN CONCAT('aaaa bbbb w', CAST(c_custkey % 40 AS STRING), ' x', CAST(c_custkey % 7 AS STRING)) ELSE CONCAT('t', CAST(c_custkey AS STRING)) END AS s FROM {customer}"
query("join_15_prints", FLAT, """WITH p AS (SELECT a.orientation, a.file AS a, b.file AS b FROM (SELECT *, string_split(s, ' ') AS w FROM t) a JOIN (SELECT *, string_split(s, ' ') AS w FROM t) b ON a.orientation = b.orientation AND a.file < b.file
    WHERE 192 - hamming(a.grid, b.grid) >= 0.92 * 192 OR len(list_intersect(a.w, b.w)) >= 0.6 * len(list_distinct(list_concat(a.w, b.w))))
    SELECT orientation, file, min(file) OVER (PARTITION BY orientation, grid, list_sort(list_distinct(string_split(s, ' ')))) AS class, coalesce(n, 0) AS links
    FROM t LEFT JOIN (SELECT file, count(*) AS n FROM (SELECT a AS file FROM p UNION ALL SELECT b FROM p) GROUP BY file) USING (file)""")(lambda df: R.alike_links(df.select("file", "orientation", "grid", F.split("s", " ").alias("tokens"))))


# Coverage statements: the first layout, with a label over two lines, in odd documents, the second in even ones.
_LINES_1095 = (
    (1, "'EMPLOYEE''s name, address,'", 1), (2, "'ZIP/postal code & country'", 1), (3, f"'Jane Q Roe' || {_K}", 1), (4, "CASE WHEN c_custkey % 3 = 0 THEN 'nowhere' ELSE '7 Elm St' END", 1), (5, "'Reno, NV 89501 USA'", 1), (6, "'Do not attach to your tax return'", 1), (7, "'EMPLOYEE''s social security number (SSN) XXX-XX-1234'", 1), (8, "'Department of the Treasury'", 1),
    (1, "'1 Name of employee Jane'", 0), (2, f"'Roe' || {_K}", 0), (3, "'2 Social security number (SSN)'", 0), (4, "'XXX-XX-9876'", 0), (5, "'3 Street address (including apartment no.)'", 0), (6, "'5 Main'", 0), (7, "CASE WHEN c_custkey % 4 = 0 THEN '4 City or town Reno' ELSE 'x' END", 0), (8, "'6 Country and ZIP or foreign postal code USA 89502'", 0), (9, "'7 Name of employer Acme'", 0),
)
COVERED = "SELECT doc_id, page, ord, text FROM (SELECT c_custkey AS doc_id, " + each_row([f"(c_custkey % 2 = {o}, 1, {i}, {e})" for i, e, o in _LINES_1095], "there BOOLEAN, page INT, ord INT, text VARCHAR") + " FROM {customer}) AS w WHERE there"
query("x_1095c", COVERED, f"""SELECT doc_id, 1 AS page, CASE WHEN o THEN 'A' ELSE 'B' END AS format, 'Jane' AS first, CASE WHEN o THEN 'Q' ELSE '' END AS middle, 'Roe' || doc_id AS last, CASE WHEN o THEN CASE WHEN doc_id % 3 = 0 THEN 'nowhere' ELSE '7 Elm St' END WHEN doc_id % 4 = 0 THEN '5 Main' ELSE '5 Main x' END AS street,
    CASE WHEN o OR doc_id % 4 = 0 THEN 'Reno' ELSE '' END AS city, CASE WHEN o THEN 'NV' ELSE '' END AS state, CASE WHEN o THEN '89501' ELSE '89502' END AS zip, 'USA' AS country, CASE WHEN o THEN 'XXX-XX-1234' ELSE 'XXX-XX-9876' END AS ssn FROM (SELECT DISTINCT doc_id, doc_id % 2 = 1 AS o FROM t)""")(coverage.employees)
