"""Creditor lists: three columns of entries parted by gaps, as extracted, as parsed, and people alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from ..functions import values as V
from ..operators import layout as L

# The columns of the parsed view, and the share of a page's width beyond which a line is a heading.
PARSED = ("First Name", "Last Name", "Middle Name", "Suffix", "Street Address", "City", "State", "ZIP Code", "Page Number")
WIDE, TOLERANCE, GAP = 0.55, 3.0, 0.6


def entries(words: DataFrame, width: float = 612.0) -> DataFrame:
    """doc_id, page, col, block, full_name, address, and the address's parts, of each entry.

    Lines of more than 55 % of the page's width are headings and go. Words are dealt to three equal parts of what is left;
    in each, words of one top are a line, and a gap of more than 0.6 mean line heights parts entries. The first line is the
    name.
    """
    lines = L.lines_anchor(words, TOLERANCE, True).select(*L.PAGE, "line", F.explode("words").alias("w")).select(*L.PAGE, "line", "w.ord")
    extent = Window.partitionBy(*L.PAGE, "line")
    d = words.join(lines, [*L.PAGE, "ord"]).withColumn("wide", F.max("x1").over(extent) - F.min("x0").over(extent)).filter(F.col("wide") <= width * WIDE)
    d = L.equal_columns(d, 3).groupBy(*L.PAGE, "col", F.col("y0").alias("top")).agg(T.clean(L.words_text(["x0", "ord"])).alias("text"), F.max("y1").alias("bottom"), F.min("ord").alias("ord"))
    d = L.gap_blocks(d, [*L.PAGE, "col"], GAP).filter("text <> ''")
    each = d.groupBy(*L.PAGE, "col", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("top", "text"))), lambda x: x["text"]).alias("lines"))
    each = each.withColumn("rest", F.slice("lines", 2, F.size("lines")))
    return each.select(*L.PAGE, "col", "block", F.col("lines")[0].alias("full_name"), F.array_join("rest", ", ").alias("address"), V.creditor_address(F.col("rest")).alias("a"))


def sheets(found: DataFrame) -> dict[str, DataFrame]:
    """The three views: extracted, parsed, people."""
    order = Window.partitionBy("doc_id").orderBy("page", "col", "block")
    d = found.withColumn("ord", F.row_number().over(order)).withColumn("n", N.last_first(F.col("full_name")))
    plain = d.select("doc_id", "ord", T.formula_safe(F.col("full_name")).alias("Full Name"), T.formula_safe(F.col("address")).alias("Address Information"), F.col("page").alias("Page Number"))
    cells = dict(zip(PARSED, ("n.first", "n.last", "n.middle", "n.suffix", "a.street", "a.city", "a.state", "a.zip")))
    parsed = d.select("doc_id", "ord", *[T.formula_safe(F.col(v)).alias(k) for k, v in cells.items()], F.col("page").alias("Page Number"))
    return {"extracted": plain, "parsed": parsed, "people": parsed.filter(N.is_person(F.col("First Name")))}
