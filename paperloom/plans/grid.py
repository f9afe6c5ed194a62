"""Employees of W-2 pages that hold one, two or a grid of them: cells by captions, or by numbers where no page text shows a caption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from ..functions import values as V
from ..operators import layout as L
from ..operators import neighbourhood as A
from ..operators import records as R

# Captions and shapes of a page, what ends an address, the least text of a page, how many lines are looked at.
CAPTION = r"(?i)Employee.?s\s+(?:social security number|SSN)\b"
NAME_BOX, NAME_ADDRESS, ADDRESS = r"(?i)Employee.?s\s+first name and initial\b", r"(?i)Employee.?s\s+name,\s*address", r"(?i)\bf\s+Employee.?s address\b"
STOP = r"(?i)^(?:\d{1,2}\s+State\b|Employer.s state ID|Local income tax|Locality name|Form\s*W-?2\b|Wage\s*(?:&|and)\s*Tax Statement|Copy\s+[A-Z0-9]|For (?:Official|Privacy)|Department of the Treasury|20\d{2}$)"
EIN = r"\b\d{2}-\d{7}\b"
LEAST_TEXT, AROUND, BLOCK_LINES, BOX_LINES, SHAPE_LINES, EMPLOYER_LINES, BEYOND = 20, 2, 8, 39, 3, 5, 15.0
PARTS = ("first", "last", "suffix", "street", "city", "state", "zip")


def page_methods(words: DataFrame) -> DataFrame:
    """doc_id, page, method and marker: pages with a caption are read by captions, those with numbers alone by shape; others are rejects (no number, little text) without a marker."""
    lines = words.groupBy(*L.PAGE, _y()).agg(L.words_text(["x0", "ord"]).alias("text"))
    whole = T.fold(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "text"))), lambda x: x["text"]), " "))
    d = lines.groupBy(*L.PAGE).agg(whole.alias("text"))
    method = F.when(F.length("text") < LEAST_TEXT, "little text").when(F.col("text").rlike(CAPTION), "caption").when(F.col("text").rlike(V.SSN), "shape").otherwise("no number")
    return d.select(*L.PAGE, method.alias("method")).withColumn("marker", F.when(F.col("method") == "caption", CAPTION).when(F.col("method") == "shape", V.SSN))


def _y() -> Column:
    return (F.rint(F.col("y0") / 3) * 3).alias("y")


def cells(words: DataFrame) -> DataFrame:
    """doc_id, page, band, cell, method and the cell's lines (structs of y, text and words), of pages that have a marker."""
    marked = words.join(page_methods(words).filter("marker is not null"), L.PAGE)
    placed = L.caption_grid(marked, F.first("marker"))
    own = F.array_sort(F.collect_list(F.struct("x0", "ord", "text", "x1")))
    lines = placed.groupBy(*L.PAGE, "band", "cell", "method", _y()).agg(own.alias("words")).withColumn("text", T.fold(F.array_join(F.transform("words", lambda w: w["text"]), " ")))
    return lines.groupBy(*L.PAGE, "band", "cell", "method").agg(F.array_sort(F.collect_list(F.struct("y", "text", "words"))).alias("lines"))


def _place(texts: str, pattern: str) -> Column:
    """The place (from 1) of the first text that shows the pattern; 0."""
    return F.array_position(F.transform(texts, lambda t: t.rlike(pattern)), True).cast("int")


def _letters(t: Column) -> Column:
    count = lambda p: F.length(F.regexp_replace(t, p, ""))
    return (count(r"\P{L}") >= 3) & (count(r"\P{L}") > count(r"\P{Nd}"))


def _address(lines: Column) -> Column:
    """street, city, state and zip of address lines; without a line like a city all is street."""

    def parts(at: Column) -> Column:
        city = V.city_state_zip(F.coalesce(F.get(lines, at - 1), F.lit("")))
        return T.let(city, lambda c: F.struct(F.array_join(F.slice(lines, 1, F.when(at > 0, at - 1).otherwise(F.size(lines))), " ").alias("street"), *[F.when(at > 0, c[k]).otherwise("").alias(k) for k in ("city", "state", "zip")]))

    return T.let(F.array_position(F.transform(lines, lambda x: x.rlike(V.CITY_STATE_ZIP)), True).cast("int"), parts)


def _record(way: str, name: Column, address: Column) -> Column:
    return F.struct(F.lit(way).alias("way"), *[name[c].alias(c) for c in PARTS[:3]], *[address[c].alias(c) for c in PARTS[3:]])


def employees(words: DataFrame) -> DataFrame:
    """doc_id, page, band, cell, way and the record of each employee; of one document and number the first.

    A cell's name and address come from the first of three ways that its page leaves open and that finds a name: the row
    under a name box, cut where "Last" and "Suff." stand in its caption and left of other boxes; the block under a
    caption of name and address; lines above one like a city that don't belong to the employer's number. Cells without a
    caption, or by shape without a number, are no employees.
    """
    d = cells(words).withColumn("texts", F.transform("lines", lambda x: x["text"]))
    d = d.withColumns({"cap": _place("texts", CAPTION), "box": _place("texts", NAME_BOX), "both": _place("texts", NAME_ADDRESS), "ein": _place("texts", EIN)})
    near = F.expr(f"array_join(slice(texts, greatest(cap - {AROUND}, 1), cap + {AROUND + 1} - greatest(cap - {AROUND}, 1)), ' ')")
    by_shape = F.try_element_at(F.filter(F.transform("texts", V.ssn_repaired), lambda x: x != ""), F.lit(1))
    d = d.withColumn("near", F.when(F.col("cap") > 0, near)).withColumn("ssn", F.when(F.col("method") == "caption", V.ssn_repaired(F.col("near"))).otherwise(by_shape))
    d = d.filter("(method = 'caption' and cap > 0) or (method = 'shape' and ssn <> '')")
    # Under a name box: rows left of other boxes; the first one is the name, the rest the address.
    bare = lambda w: F.lower(F.btrim(w["text"], F.lit(".:,")))
    head = F.when(F.col("box") > 0, F.expr("lines[box - 1].words"))
    first = lambda ws, w: F.try_element_at(F.filter(ws, lambda x: bare(x) == w), F.lit(1))
    d = d.withColumn("head", head).withColumns({"last_x": first("head", "last")["x0"], "suff_x": first("head", "suff")["x0"], "edge": first("head", "suff")["x1"] + BEYOND})
    below = A.until_stop(F.when(F.col("box") > 0, F.expr(f"slice(lines, box + 1, {BOX_LINES})")).otherwise(F.expr("slice(lines, 1, 0)")), lambda x: x["text"].rlike(STOP))
    limit = lambda x: F.coalesce(F.try_element_at(F.filter(x["words"], lambda w: F.btrim(w["text"], F.lit(".:,")).rlike(L.BOX_LABEL)), F.lit(1))["x0"], F.col("edge"))
    left = lambda x: F.struct(F.filter(x["words"], lambda w: limit(x).isNull() | (w["x0"] < limit(x))).alias("words"), x["text"].alias("whole"))
    d = d.withColumn("rows", F.transform(below, left)).withColumn("rows", F.transform("rows", lambda x: F.struct(x["words"].alias("words"), x["whole"].alias("whole"), F.array_join(F.transform(x["words"], lambda w: w["text"]), " ").alias("text"))))
    d = d.withColumn("rows", F.filter("rows", lambda x: (x["text"] != "") & ~x["whole"].rlike(ADDRESS) & (_letters(x["text"]) | x["text"].rlike(V.CITY_STATE_ZIP))))
    d = d.withColumn("name_row", F.get("rows", F.lit(0))["words"]).withColumn("box_rest", F.transform(F.expr("slice(rows, 2, size(rows))"), lambda x: x["text"]))
    part = lambda cond: T.strip(F.array_join(F.transform(F.filter("name_row", cond), lambda w: w["text"]), " "))
    inside = lambda w, a, b: (a.isNull() | (w["x0"] >= a)) & (b.isNull() | (w["x0"] < b))
    last, suff, none = F.col("last_x"), F.col("suff_x"), F.lit("")
    row = F.struct(part(lambda w: inside(w, F.lit(None).cast("double"), last)).alias("first"), F.when(last.isNull(), none).otherwise(part(lambda w: inside(w, last, suff))).alias("last"), F.when(last.isNull() | suff.isNull(), none).otherwise(part(lambda w: inside(w, suff, F.lit(None).cast("double")))).alias("suffix"))
    # Under a caption of name and address: the block down to a stop.
    raw = F.when((F.col("box") == 0) & (F.col("both") > 0), F.expr(f"filter(slice(texts, both + 1, {BLOCK_LINES}), t -> t <> '')")).otherwise(F.expr("slice(texts, 1, 0)"))
    d = d.withColumn("block", A.until_stop(raw, lambda x: x.rlike(STOP) | x.rlike(ADDRESS)))
    # By shape: up to three lines above each line like a city; blocks that begin close below the employer's number are the employer's.
    city = F.transform("texts", lambda t: t.rlike(V.CITY_STATE_ZIP))
    d = d.withColumn("city", city).withColumn("ok", F.transform("texts", lambda t, i: (t != "") & ~F.get("city", i) & _letters(t)))
    ok = lambda k: f"coalesce(get(ok, i - {k}), false)"
    tall = f"case when not {ok(1)} then 0 when not {ok(2)} then 1 when not {ok(3)} then 2 else {SHAPE_LINES} end"
    d = d.withColumn("blocks", F.expr(f"filter(transform(filter(transform(city, (c, i) -> if(c, i, -1)), i -> i >= 0), i -> struct(i - ({tall}) as a, i as z)), b -> b.a < b.z)"))
    d = d.withColumn("own", F.expr(f"case when ein = 0 then if(size(blocks) > 1, try_element_at(blocks, -1), null) else try_element_at(filter(blocks, b -> b.a - (ein - 1) > {EMPLOYER_LINES}), -1) end"))
    d = d.withColumn("shaped", F.expr("case when method = 'shape' and own is not null then slice(texts, own.a + 1, own.z - own.a + 1) else slice(texts, 1, 0) end"))
    ways = []
    for way, open_, name, address in (
        ("box", F.col("name_row").isNotNull() & (F.col("method") == "caption"), row, _address(F.col("box_rest"))),
        ("block", (F.size("block") > 0) & (F.col("method") == "caption"), N.by_whitespace(F.coalesce(F.get("block", F.lit(0)), none)), _address(F.expr("slice(block, 2, size(block))"))),
        ("shape", F.size("shaped") > 0, N.by_whitespace(F.coalesce(F.get("shaped", F.lit(0)), none)), _address(F.expr("slice(shaped, 2, size(shaped))"))),
    ):
        ways.append(F.when(open_, T.let(F.struct(name.alias("n"), address.alias("a")), lambda x, way=way: _record(way, x["n"], x["a"]))))
    nothing = F.struct(F.lit("none").alias("way"), *[none.alias(c) for c in PARTS])
    d = d.withColumn("r", F.coalesce(*ways, nothing)).withColumn("side", F.when(F.col("cell").endswith("Right"), 1).otherwise(0))
    found = d.select(*L.PAGE, "band", "side", "cell", "r.*", "ssn")
    return R.first_wins(found, [F.col("doc_id"), F.col("ssn")], ["page", "band", "side"], F.col("ssn") == "").drop("side")


def rejected(words: DataFrame) -> DataFrame:
    """doc_id, page and why, of the pages that show neither a caption nor a number, or hardly any text."""
    return page_methods(words).filter("marker is null").select(*L.PAGE, F.col("method").alias("why"))
