"""Words to lines, lines to cells and columns. All order is by explicit columns: page, y, x0, ord."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = ["doc_id", "page"]
# Fixed value: labels of the boxes to the right of the name box.
BOX_LABEL = r"^1[1-4][a-d]?$"


def words_text(order: list[str], text: str = "text") -> Column:
    """The words of a group, in the given order, joined by blanks."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text))), lambda w: w[text]), " ")


def lines_fixed(words: DataFrame, tolerance: float = 3.0, by_x: bool = True) -> DataFrame:
    """Words whose y rounds (half to even) to one multiple of the tolerance are a line; with its box."""
    y = (F.rint(F.col("y0") / tolerance) * tolerance).alias("y")
    order = ["x0", "ord"] if by_x else ["ord"]
    return words.groupBy(*PAGE, y).agg(words_text(order).alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("top"), F.max("x1").alias("x1"), F.max("y1").alias("bottom"))


def line_words() -> Column:
    """Aggregate: a line's words by place, as structs of x0, ord and text."""
    return F.array_sort(F.collect_list(F.struct("x0", "ord", "text")))


def lines_chain(words: DataFrame, tolerance: float = 5.0, with_words: bool = False, mirror: float | None = None) -> DataFrame:
    """A word that is further than the tolerance below the one before it begins a line.

    ``with_words`` adds each line's words, ``mirror`` (a page's width) its words when read right to left.
    """
    w = Window.partitionBy(*PAGE).orderBy("mid", "x0", "ord")
    d = words.withColumn("mid", (F.col("y0") + F.col("y1")) / 2)
    d = d.withColumn("new", (F.col("mid") - F.lag("mid").over(w) > tolerance).cast("int"))
    d = d.withColumn("line", F.sum(F.coalesce("new", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    turned = [F.array_sort(F.collect_list(F.struct((F.lit(mirror) - F.col("x1")).alias("x0"), "ord", "text"))).alias("mirrored")] if mirror is not None else []
    return d.groupBy(*PAGE, "line").agg(words_text(["x0", "ord"]).alias("text"), *([line_words().alias("words")] if with_words else []), *turned)


def lines_anchor(words: DataFrame, tolerance: float = 3.0, with_words: bool = False) -> DataFrame:
    """A word that is further than the tolerance from the first word of the current line begins a line; words come by (rounded y, x0)."""
    one = F.struct(F.round("y0", 1).alias("r"), F.col("x0"), F.col("ord"), F.col("y0").alias("y"), F.col("text"))
    page = words.groupBy(*PAGE).agg(F.array_sort(F.collect_list(one)).alias("w"))
    start = F.struct(F.lit(-1).alias("line"), F.lit(None).cast("double").alias("top"), F.array().cast("array<int>").alias("lines"))

    def step(a: Column, w: Column) -> Column:
        same = F.coalesce(F.abs(w["y"] - a["top"]) <= tolerance, F.lit(False))
        line = a["line"] + F.when(same, 0).otherwise(1)
        return F.struct(line.alias("line"), F.when(same, a["top"]).otherwise(w["y"]).alias("top"), F.concat(a["lines"], F.array(line)).alias("lines"))

    page = page.withColumn("lines", F.aggregate("w", start, step, lambda a: a["lines"]))
    each = page.select(*PAGE, F.explode(F.arrays_zip("w", "lines")).alias("z")).select(*PAGE, F.col("z.lines").alias("line"), F.col("z.w.x0").alias("x0"), F.col("z.w.ord").alias("ord"), F.col("z.w.text").alias("text"))
    return each.groupBy(*PAGE, "line").agg(words_text(["x0", "ord"]).alias("text"), *([line_words().alias("words")] if with_words else []))


def caption_grid(words: DataFrame, caption: str | Column, height: float = 792.0, width: float = 612.0, split: float = 0.5) -> DataFrame:
    """Cells by the captions that each page shows: as many bands as lines hold the caption, two columns where one holds it twice. ``caption``: a pattern, or an aggregate over a line's words that gives one."""
    caption = F.lit(caption) if isinstance(caption, str) else caption
    y = (F.rint(F.col("y0") / 3) * 3).alias("y")
    lines = words.groupBy(*PAGE, y).agg(F.regexp_count(words_text(["x0", "ord"]), caption).alias("n")).filter("n > 0")
    counts = lines.groupBy(*PAGE).agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "n"))), lambda x: x["n"]).alias("counts"))
    d = words.join(counts, PAGE, "left").withColumn("_rows", F.greatest(F.coalesce(F.size("counts"), F.lit(1)), F.lit(1)))
    return grid_cells(d, F.col("_rows"), lambda band: F.coalesce(F.get("counts", band), F.lit(1)) >= 2, height, width, split).drop("counts", "_rows")


def name_row(caption: DataFrame, row: DataFrame) -> DataFrame:
    """doc_id, page and a name row's first, last and suffix, by where the caption line above says "Last" and "Suff".

    The row ends at a box label, or else 15 points after "Suff". Without "Last" all is the first name.
    """
    bare = F.lower(F.btrim("text", F.lit(".:,")))
    place = lambda w, c: F.min_by(c, F.when(bare == w, F.struct("x0", "ord")))
    limits = caption.groupBy(*PAGE).agg(place("last", "x0").alias("last_x"), place("suff", "x0").alias("suff_x"), (place("suff", "x1") + 15).alias("edge"))
    label = F.when(F.btrim("text", F.lit(".:,")).rlike(BOX_LABEL), F.struct("x0", "ord"))
    ends = row.groupBy(*PAGE).agg(F.min_by("x0", label).alias("end"))
    d = row.join(limits, PAGE).join(ends, PAGE).filter("coalesce(end, edge) is null or x0 < coalesce(end, edge)")
    own = F.array_sort(F.collect_list(F.struct("x0", "ord", "text", F.expr("case when last_x is null or x0 < last_x then 1 when suff_x is null or x0 < suff_x then 2 else 3 end").alias("part"))))
    part = lambda n: F.array_join(F.transform(F.filter(own, lambda w: w["part"] == n), lambda w: w["text"]), " ")
    return d.groupBy(*PAGE).agg(part(1).alias("first"), part(2).alias("last"), part(3).alias("suffix"))


def heading_starts(words: DataFrame, headings: dict[str, tuple[str, ...]], both: tuple[str, str]) -> DataFrame:
    """doc_id, page, y, name and x of the headings in the first line of a page that has both words of ``both``.

    A heading begins where its words follow each other; where they don't, at the first place of its first word. Headings
    that the line doesn't show are left out.
    """
    y = (F.rint(F.col("y0") / 3) * 3).alias("y")
    lines = words.groupBy(*PAGE, y).agg(line_words().alias("words"))
    has = lambda w: F.exists("words", lambda x: x["text"] == w)
    head = lines.filter(has(both[0]) & has(both[1])).groupBy(*PAGE).agg(F.min_by(F.struct("y", "words"), "y").alias("h")).select(*PAGE, "h.*")
    found = []
    for name, tokens in headings.items():
        rest = " and ".join(f"words[i - 1 + {k}].text = '{t}'" for k, t in enumerate(tokens))
        run = F.expr(f"try_element_at(transform(filter(sequence(1, greatest(size(words) - {len(tokens) - 1}, 1)), i -> size(words) >= {len(tokens)} and {rest}), i -> words[i - 1].x0), 1)")
        bare = F.expr(f"try_element_at(transform(filter(words, w -> w.text = '{tokens[0]}'), w -> w.x0), 1)")
        found.append(F.struct(F.lit(name).alias("name"), F.coalesce(run, bare).alias("x")))
    return head.select(*PAGE, "y", F.explode(F.array(*found)).alias("s")).select(*PAGE, "y", "s.name", "s.x").filter("x is not null")


def grid_cells(words: DataFrame, rows: Column, two, height: float = 792.0, width: float = 612.0, split: float = 0.5) -> DataFrame:
    """Adds band (equal page heights) and cell: Single, Left, Right, Top, Bottom, Row3, with the side where a band has two columns. ``two``: a condition, or a function of the band that gives one."""
    mid = (F.col("y0") + F.col("y1")) / 2
    band = F.greatest(F.lit(0), F.least(F.floor(mid / (F.lit(height) / rows)), rows - 1)).cast("int")
    two = two(band) if callable(two) else two
    prefix = F.when(rows == 1, "").when(rows == 2, F.when(band == 0, "Top").otherwise("Bottom")).otherwise(F.concat(F.lit("Row"), (band + 1).cast("string")))
    side = F.when((F.col("x0") + F.col("x1")) / 2 < width * split, "Left").otherwise("Right")
    return words.withColumn("band", band).withColumn("cell", F.when(two, F.concat(prefix, side)).when(prefix == "", "Single").otherwise(prefix))


def last_start(x0: Column, starts: Column, tolerance: float) -> Column:
    """The last of the sorted starts (structs of x and name) at or before x0 + tolerance; else the first."""
    before = F.filter(starts, lambda s: s["x"] <= x0 + tolerance)
    return F.coalesce(F.try_element_at(before, F.lit(-1)), F.try_element_at(starts, F.lit(1)))["name"]


def assign_columns(words: DataFrame, starts: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Adds to each word the name of its column. ``starts``: doc_id, page, name, x."""
    heads = starts.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("x", "name"))).alias("starts"))
    return words.join(heads, PAGE).withColumn("column", last_start(F.col("x0"), F.col("starts"), tolerance)).drop("starts")


def three_columns(second: Column, third: Column) -> list[Column]:
    """Aggregates: the words of a line left of ``second``, left of ``third``, and the rest."""
    own = F.array_sort(F.collect_list(F.struct(F.col("x0"), F.col("ord"), F.col("text"), F.when(F.col("x0") < second, 1).when(F.col("x0") < third, 2).otherwise(3).alias("c"))))
    part = lambda n: F.array_join(F.transform(F.filter(own, lambda w: w["c"] == n), lambda w: w["text"]), " ").alias(f"c{n}")
    return [part(n) for n in (1, 2, 3)]


def equal_columns(words: DataFrame, n: int = 3) -> DataFrame:
    """Adds col: which of n equal parts of the page's text extent holds the word's centre."""
    w = Window.partitionBy(*PAGE)
    left, right = F.min("x0").over(w), F.max("x1").over(w)
    return words.withColumn("col", F.least(((((F.col("x0") + F.col("x1")) / 2 - left) / ((right - left) / n))).cast("int"), F.lit(n - 1)))


def gap_blocks(lines: DataFrame, by: list[str], factor: float = 0.6) -> DataFrame:
    """Adds block: a gap above a line of more than ``factor`` mean line heights begins one."""
    w = Window.partitionBy(*by).orderBy("top", "ord")
    gap = F.col("top") - F.lag("bottom").over(w) > F.avg(F.col("bottom") - F.col("top")).over(Window.partitionBy(*by)) * factor
    return lines.withColumn("_new", F.coalesce(gap.cast("int"), F.lit(0))).withColumn("block", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def occupancy(boxes: DataFrame, width: float, height: float, cols: int = 12, rows: int = 16) -> DataFrame:
    """doc_id, page and the page's grid as a text of 0 and 1, row by row: which cells do the boxes touch?"""
    part = lambda c, size, n: F.greatest(F.lit(0), F.least((F.col(c) / size * n).cast("int"), F.lit(n - 1)))
    cells = boxes.select(*PAGE, F.explode(F.sequence(part("y0", height, rows), part("y1", height, rows))).alias("r"), part("x0", width, cols).alias("a"), part("x1", width, cols).alias("b"))
    cells = cells.select(*PAGE, F.explode(F.expr(f"transform(sequence(a, b), c -> r * {cols} + c)")).alias("cell")).distinct()
    return cells.groupBy(*PAGE).agg(F.collect_set("cell").alias("on")).select(*PAGE, F.expr(f"array_join(transform(sequence(0, {cols * rows - 1}), i -> case when array_contains(on, i) then '1' else '0' end), '')").alias("grid"))


def mirrored(words: DataFrame, width: float) -> DataFrame:
    """The words of pages whose text layer runs right to left: boxes mirrored about the page's middle."""
    return words.withColumns({"x0": F.lit(width) - F.col("x1"), "x1": F.lit(width) - F.col("x0")})


def left_of(words: Column, limit: Column) -> Column:
    """The text of a line's words that begin left of ``limit``; of all of them where it is null."""
    return F.array_join(F.transform(F.filter(words, lambda w: limit.isNull() | (w["x0"] < limit)), lambda w: w["text"]), " ")


def header_starts(lines: DataFrame, default: tuple[float, float]) -> DataFrame:
    """doc_id, c2, c3: where the second and the third column of a change table begin; see ``with_starts``."""
    return with_starts(lines, default).select("doc_id", "c2", "c3").distinct()


def with_starts(lines: DataFrame, default: tuple[float, float]) -> DataFrame:
    """``lines`` with c2 and c3: where the second and the third column of their document's change table begin.

    Only a document's first page counts; there the first line that has "changed", "from" and "to" and whose starts rise. A
    pair "changed from" (the last one) goes before a bare "from" (the first one), and so for "to".
    """
    own, low = Window.partitionBy("doc_id"), F.lower("text")
    head = (F.col("page") == F.col("_p")) & F.contains(low, F.lit("changed")) & F.contains(low, F.lit("from")) & F.contains(low, F.lit("to"))
    pair = lambda w: f"transform(filter(sequence(1, size(words)), i -> i > 1 and lower(words[i - 1].text) = '{w}' and lower(words[i - 2].text) = 'changed'), i -> words[i - 2].x0)"
    bare = lambda w: f"transform(filter(words, x -> lower(x.text) = '{w}'), x -> x.x0)"
    start = lambda w: F.coalesce(F.expr(f"try_element_at({pair(w)}, -1)"), F.expr(f"try_element_at({bare(w)}, 1)"))
    d = lines.withColumn("_p", F.min("page").over(own)).withColumn("_s", F.when(head, F.struct(start("from").alias("a"), start("to").alias("b"))))
    found = F.expr("_s.a <> 0 and _s.b <> 0 and _s.a < _s.b")
    d = d.withColumn("_s", F.min_by("_s", F.when(found, F.col("line"))).over(own))
    return d.withColumns({"c2": F.coalesce("_s.a", F.lit(default[0])), "c3": F.coalesce("_s.b", F.lit(default[1]))}).drop("_p", "_s")


def upright(lines: DataFrame, mirrored: DataFrame, readable: Column, names: Column) -> DataFrame:
    """Per document: the lines as read, or mirrored where only these are readable, or bottom up where that shows more names.

    Both inputs: doc_id, line_no, text. Forward wins ties.
    """
    d = lines.withColumn("side", F.lit(0)).unionByName(mirrored.withColumn("side", F.lit(1)))
    score = d.groupBy("doc_id", "side").agg(F.max(readable.cast("int")).alias("ok"), F.sum(names.cast("int")).alias("names"))
    best = score.groupBy("doc_id").agg(F.max_by("side", F.struct("ok", -F.col("side"))).alias("side"))
    return d.join(best, ["doc_id", "side"])
