"""Any document as rows: sections of text under headers, table rows, form fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from ..functions import values as V
from ..operators import layout as L
from ..operators import neighbourhood as A

# The columns of the unified rows; the share of header words in a header line; how much larger header words are; a size where none is known.
COLUMNS = ("Source File", "Page", "Category", "Field Name", "Value")
HEADER_SHARE, LARGER, SIZE = 0.6, 1.15, 10.0


def header_word(size, font, median):
    """Is a word larger than the page's middle size by 15 %, or bold?"""
    return (F.coalesce(size, F.lit(0.0)) > median * LARGER) | F.lower(T.text(font)).rlike("bold|bd")


def section_lines(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """doc_id, page, y, text and header of each line outside tables. words: with size and font; boxes: doc_id, page, bx0, btop, bx1, bbottom.

    A line is a header if six in ten of its words are; where no word's size is known, if it looks like a label.
    """
    page = ["doc_id", "page"]
    own = A.outside(words, boxes)
    middle = own.filter("size > 0").groupBy(*page).agg(F.expr("element_at(array_sort(collect_list(size)), cast(count(size) div 2 as int) + 1)").alias("median"))
    d = own.join(middle, page, "left").withColumn("head", header_word(F.col("size"), F.col("font"), F.coalesce("median", F.lit(SIZE))).cast("int")).withColumn("y", F.rint(F.col("y0") / 2) * 2)
    lines = d.groupBy(*page, "y").agg(T.clean(L.words_text(["ord"])).alias("text"), F.avg("head").alias("share"), F.max((F.coalesce("size", F.lit(0.0)) > 0).cast("int")).alias("sized"))
    header = (F.col("share") >= HEADER_SHARE) | ((F.col("sized") == 0) & P.looks_like_label(F.col("text")))
    return lines.filter("text <> ''").select(*page, "y", "text", header.alias("header"))


def sections(lines: DataFrame) -> DataFrame:
    """doc_id, page, ord, header and value: the lines after each header up to the next; before the first header of a page only lines "LABEL: value"."""
    page = ["doc_id", "page"]
    d = A.segments(lines, F.col("header"), page, ["y"])
    own = F.array_sort(F.collect_list(F.when(~F.col("header"), F.struct("y", "text"))))
    under = d.filter("segment > 0").groupBy(*page, "segment").agg(F.min("y").alias("y"), F.regexp_replace(F.min_by("text", "y"), ":+$", "").alias("header"), T.clean(F.array_join(F.transform(own, lambda x: x["text"]), " ")).alias("value")).drop("segment").filter("header <> ''")
    label = F.substring_index("text", ":", 1)
    pairs = d.filter("segment = 0 and contains(text, ':')").filter(P.looks_like_label(label)).select(*page, "y", T.strip(label).alias("header"), T.strip(F.expr("substring(text, locate(':', text) + 1)")).alias("value"))
    return under.unionByName(pairs).withColumn("ord", F.row_number().over(Window.partitionBy(*page).orderBy("y"))).select(*page, "ord", "header", "value")


def table_rows(rows: DataFrame) -> DataFrame:
    """doc_id, page, tbl, n, headers and cells of each data row. rows: doc_id, page, tbl, row, cells (ragged).

    Blank rows go. A first row of headings names the columns if there is another row; else they are Column_1, Column_2 ...
    Short rows are padded.
    """
    table = ["doc_id", "page", "tbl"]
    d = rows.withColumn("cells", F.transform("cells", lambda x: T.clean(x))).filter(F.exists("cells", lambda x: x != ""))
    w = Window.partitionBy(*table)
    d = d.withColumn("at", F.row_number().over(w.orderBy("row"))).withColumn("rows", F.count("*").over(w)).withColumn("wide", F.max(F.size("cells")).over(w))
    heads = F.when((F.col("at") == 1) & (F.col("rows") >= 2) & P.header_row(F.col("cells")), F.col("cells"))
    d = d.withColumn("named", F.first(heads, True).over(w.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    d = d.withColumn("headers", F.coalesce("named", F.expr("transform(sequence(1, wide), i -> concat('Column_', i))"))).withColumn("n", F.col("at") - F.col("named").isNotNull().cast("int")).filter("n > 0")
    return d.select(*table, "n", "headers", F.concat("cells", F.array_repeat(F.lit(""), F.greatest(F.size("headers") - F.size("cells"), F.lit(0)))).alias("cells"))


def padded(rows: DataFrame, widest: int) -> DataFrame:
    """Ragged rows as columns Col_1 ... Col_n; see ``widest``."""
    return rows.select(*[c for c in rows.columns if c != "cells"], *[T.text(F.get("cells", F.lit(i))).alias(f"Col_{i + 1}") for i in range(widest)])


def widest(rows: DataFrame) -> int:
    """The most cells that a row has: one number, which names the columns."""
    return rows.agg(F.coalesce(F.max(F.size("cells")), F.lit(0)).alias("n")).collect()[0]["n"]


def form_fields(widgets: DataFrame, lines: DataFrame, heights: DataFrame) -> DataFrame:
    """doc_id, page, ord, name and value of each drawn field; its name is the nearest printed label, else its own. heights: doc_id, page, height; boxes of widgets count from below."""
    d = widgets.join(heights, ["doc_id", "page"], "left").withColumn("h", F.coalesce("height", F.lit(792.0)))
    d = d.select("doc_id", "page", F.col("ord").alias("field"), F.col("x0").alias("fx0"), (F.col("h") - F.col("y1")).alias("ftop"), F.col("x1").alias("fx1"), (F.col("h") - F.col("y0")).alias("fbottom"), F.coalesce(F.nullif("alt", F.lit("")), "name").alias("fallback"), V.box_value(F.col("raw"), F.col("kind") == "Checkbox / Radio").alias("value"))
    label = A.nearest_label(d.drop("value"), lines)
    return d.select("doc_id", "page", "field", "value").join(label, ["doc_id", "page", "field"]).select("doc_id", "page", F.col("field").alias("ord"), F.col("label").alias("name"), "value")


def document_rows(found: DataFrame, tables: DataFrame, fields: DataFrame) -> DataFrame:
    """doc_id, ord, page, category, name and value of all rows, by page, fields before sections before tables; blank sections go on pages that have fields."""
    key = ["doc_id", "page"]
    f = fields.select(*key, F.lit(0).alias("p"), F.lit(0).alias("t"), F.col("ord").cast("string").alias("o"), F.lit("Form Field").alias("category"), F.col("name"), F.col("value"))
    s = found.filter("value <> ''").unionByName(found.filter("value = ''").join(fields.select(*key).distinct(), key, "left_anti"))
    s = s.select(*key, F.lit(1).alias("p"), F.lit(0).alias("t"), F.lpad(F.col("ord").cast("string"), 9, "0").alias("o"), F.lit("Section").alias("category"), F.col("header").alias("name"), "value")
    pairs = F.array_join(F.transform(F.filter(F.arrays_zip(F.col("headers").alias("h"), F.slice("cells", 1, F.size("headers")).alias("c")), lambda x: (x["h"] != "") | (x["c"] != "")), lambda x: F.concat(x["h"], F.lit(": "), x["c"])), " | ")
    t = tables.select(*key, F.lit(2).alias("p"), F.col("tbl").alias("t"), F.lpad(F.col("n").cast("string"), 9, "0").alias("o"), F.lit("Table").alias("category"), F.concat(F.lit("Row "), "n", F.lit(" (Table "), "tbl", F.lit(")")).alias("name"), pairs.alias("value"))
    every = f.unionByName(s).unionByName(t)
    order = Window.partitionBy("doc_id").orderBy("page", "p", "t", "o")
    return every.select("doc_id", F.row_number().over(order).alias("ord"), "page", "category", "name", "value")


def unified(found: DataFrame, tables: DataFrame, fields: DataFrame) -> DataFrame:
    """The rows of documents in ``COLUMNS``; what a workbook would take for a formula is quoted."""
    safe = lambda c: T.formula_safe(F.col(c))
    return document_rows(found, tables, fields).select("ord", safe("doc_id").alias("Source File"), safe("page").alias("Page"), F.col("category").alias("Category"), safe("name").alias("Field Name"), safe("value").alias("Value"))
