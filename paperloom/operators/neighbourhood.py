"""Looks around an anchor line or label: windows, segments, nearest labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def around(text: str, by: list[str], order: list[str], before: int, after: int, sep: str = " ") -> Column:
    """The texts of the lines from ``before`` above to ``after`` below, joined."""
    return F.array_join(F.collect_list(text).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(-before, after)), sep)


def lines_around(lines: DataFrame, anchors: Column, by: list[str], at: str, before: int, after: int, keep: list[str]) -> DataFrame:
    """For each line for which ``anchors`` holds: above (nearest first), own and below, arrays of structs of its neighbours.

    ``at`` numbers the lines of each group without gaps. Anchors are few: each line learns from a window which of them are
    near and goes to these alone, so the lines are read once and no neighbours are gathered for other lines.
    """
    near = F.collect_list(F.when(anchors, F.col(at))).over(Window.partitionBy(*by).orderBy(at).rowsBetween(-after, before))
    met = lines.select(*by, F.col(at).alias("_n"), F.struct(*keep).alias("_x"), near.alias("_near")).select(*by, "_n", "_x", F.explode("_near").alias("_at")).withColumn("_d", F.col("_n") - F.col("_at"))
    every = F.array_sort(F.collect_list(F.struct("_d", "_x")))
    part = lambda cond: f"transform(filter(_every, e -> {cond}), e -> e._x)"
    return met.groupBy(*by, "_at").agg(every.alias("_every")).select(*by, F.col("_at").alias(at), F.expr(f"reverse({part('e._d < 0')})").alias("above"), F.expr(f"{part('e._d = 0')}[0]").alias("own"), F.expr(part("e._d > 0")).alias("below"))


def first_where(df: DataFrame, is_anchor: Column, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group for which ``is_anchor`` holds."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.filter(is_anchor).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def until_stop(lines: Column, is_stop) -> Column:
    """The lines before the first one for which ``is_stop`` holds."""
    stops = F.filter(F.transform(lines, lambda x, i: F.when(is_stop(x), i)), lambda i: i.isNotNull())
    first = F.coalesce(F.try_element_at(stops, F.lit(1)), F.size(lines))
    return F.filter(lines, lambda x, i: i < first)


def segments(df: DataFrame, opens: Column, by: list[str], order: list[str]) -> DataFrame:
    """Adds segment: how many opening lines there were up to this one (0: before the first)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("segment", F.sum(opens.cast("int")).over(w))


def label_value(text: Column, labels: list[str], value: str, reach: int = 120) -> Column:
    """The first text of shape ``value`` within ``reach`` characters after a label.

    Spellings of the label are tried in turn; of each only its first place counts. '' if none has a value.
    """
    found = []
    for label in labels:
        tail = F.regexp_extract(text, rf"(?s)(?:{label})(.{{0,{reach}}})", 1)
        hit = F.regexp_extract(tail, f"({value})", 1)
        found.append(F.when(tail.rlike(f"(?:{value})"), F.regexp_replace(hit, r"(?U)^\s+|\s+$", "")))
    return F.coalesce(*found, F.lit(""))


def nearest_label(fields: DataFrame, lines: DataFrame) -> DataFrame:
    """doc_id, page, field and the label line nearest to it by three rules in turn: left of it, above and overlapping, above and centred.

    fields: doc_id, page, field, fx0, ftop, fx1, fbottom, fallback; lines: doc_id, page, line_no, x0, top, x1, bottom, text.
    """
    d = fields.join(lines.filter("trim(text) <> ''"), ["doc_id", "page"], "left")
    fy, fx, ly, lx = (f"({a} + {b}) / 2" for a, b in (("ftop", "fbottom"), ("fx0", "fx1"), ("top", "bottom"), ("x0", "x1")))
    distance = F.expr(f"""case when x1 <= fx0 + 5 and abs({ly} - {fy}) <= 14 then (fx0 - x1) + abs({ly} - {fy}) * 0.5
        when bottom <= ftop + 4 and x0 < fx1 + 10 and x1 > fx0 - 10 then (ftop - bottom) + abs({lx} - {fx}) * 0.3
        when bottom <= ftop + 4 and abs({lx} - {fx}) <= (fx1 - fx0) * 0.9 then (ftop - bottom) * 1.5 + abs({lx} - {fx}) end""")
    near = d.withColumn("d", distance).groupBy("doc_id", "page", "field").agg(F.min_by("text", F.when(F.col("d").isNotNull(), F.struct("d", "line_no"))).alias("label"), F.first("fallback").alias("fallback"))
    return near.select("doc_id", "page", "field", F.coalesce(F.nullif(F.trim(F.regexp_replace("label", ":+$", "")), F.lit("")), "fallback").alias("label"))


def outside(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """The words whose centre lies in no box of their page. boxes: doc_id, page, bx0, btop, bx1, bbottom."""
    x, y = "(x0 + x1) / 2", "(y0 + y1) / 2"
    own = boxes.select(F.col("doc_id").alias("bd"), F.col("page").alias("bp"), "bx0", "btop", "bx1", "bbottom")
    return words.join(own, F.expr(f"doc_id = bd and page = bp and {x} between bx0 and bx1 and {y} between btop and bbottom"), "left_anti")


def page_at(place: Column, begins: Column) -> Column:
    """The number of the page that holds a place in the joined text of all pages: how many pages begin at or before it."""
    return F.size(F.filter(begins, lambda b: b <= place))
