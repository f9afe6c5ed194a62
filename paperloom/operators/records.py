"""Keyed de-duplication, merging and pivoting of extracted records, by explicit order."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sinks.files import work_folder
from . import spread


def first_wins(df: DataFrame, key: list[Column], order: list[str], keyless: Column | None = None) -> DataFrame:
    """The first row of each key; rows for which ``keyless`` holds all stay."""
    w = Window.partitionBy(*key).orderBy(*order)
    d = df.withColumn("_rn", F.row_number().over(w))
    keep = F.col("_rn") == 1
    return d.filter(keep if keyless is None else keep | keyless).drop("_rn")


def ordered_distinct(value: str, order: list[str], sep: str) -> Column:
    """Aggregate: the distinct non-blank values in the order they were first seen."""
    seen = F.transform(F.array_sort(F.collect_list(F.when(F.col(value) != "", F.struct(*order, value)))), lambda x: x[value])
    return F.array_join(F.array_distinct(seen), sep)


def ordered_concat(value: str, order: list[str], sep: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, value))), lambda x: x[value]), sep)


def first_filled(value: str, order: str) -> Column:
    """Aggregate: the first non-blank value, or ''."""
    return F.coalesce(F.min_by(F.nullif(F.col(value), F.lit("")), F.when(F.col(value) != "", F.col(order))), F.lit(""))


def latest(value: str, day: str, order: str) -> Column:
    """Aggregate: the value of the latest day; the first on ties; unparsed days are the oldest."""
    return F.max_by(value, F.struct(F.coalesce(F.col(day), F.lit("0001-01-01").cast("date")), -F.col(order)))


def appended(values: Column, sep: str) -> Column:
    """Values in turn, each left out that is already contained in what is there."""
    return F.aggregate(values, F.lit(""), lambda a, v: F.when(F.contains(a, v), a).when(a == "", v).otherwise(F.concat(a, F.lit(sep), v)))


def drop_partial(df: DataFrame, number: str, by: list[str]) -> DataFrame:
    """Without rows of a partial number whose front has a full one beside it."""
    front = F.regexp_extract(number, r"^(\d{3}-\d{2})-", 1)
    full = F.length(F.regexp_replace(number, r"\D", "")) == 9
    any_full = F.max(full.cast("int")).over(Window.partitionBy(*by, front))
    return df.withColumn("_full", any_full).filter((front == "") | full | (F.col("_full") == 0)).drop("_full")


def merge_prefixes(df: DataFrame, blanks: bool = False) -> DataFrame:
    """Per document, number and last name: a record joins the earliest one whose first name is a prefix of its own or the other way round.

    df: doc_id, ord, ssn, first, middle, last, suffix and any other columns, which stay those of the earliest record. The
    longer first name wins and brings its other parts; blanks are filled. Prefixes aren't transitive, so records are folded
    in order, by an aggregate over a group's records. Rows without a number or a name pass through; with ``blanks``, only
    those without a first name do. A number is shared by few records of a document, so groups are small.
    """
    own = T.strip(F.col("first")) != "" if blanks else (T.strip(F.col("first")) != "") & (F.trim("last") != "") & (F.trim("ssn") != "")
    rest = [c for c in df.columns if c != "ord"]
    # A row that passes through is a group of its own, so that what is before this is worked out once.
    alone = F.when(own, F.lit(None)).otherwise(F.col("ord"))
    each = df.select(F.lower(F.trim("last")).alias("_l"), F.trim("ssn").alias("_s"), F.col("doc_id").alias("_d"), alone.alias("_a"), F.struct("ord", T.strip(F.col("first")).alias("_f"), *rest).alias("_r"))
    rows = each.groupBy("_d", "_s", "_l", "_a").agg(F.array_sort(F.collect_list("_r")).alias("rows"))
    kind = rows.schema["rows"].dataType.elementType.simpleString()

    def merged(p: Column, r: Column) -> Column:
        longer = F.length(r["_f"]) > F.length(p["_f"])
        filled = lambda c: F.when((r[c] != "") & (longer | (p[c] == "")), r[c]).otherwise(p[c])
        new = {"_f": F.when(longer, r["_f"]).otherwise(p["_f"]), "first": F.when(longer, r["_f"]).otherwise(p["first"]), "middle": filled("middle"), "suffix": filled("suffix")}
        return F.struct(*[new.get(c, p[c]).alias(c) for c in ("ord", "_f", *rest)])

    def step(done: Column, r: Column) -> Column:
        begins = lambda a, b: F.startswith(F.lower(a), F.lower(b))
        alike = F.array_position(F.transform(done, lambda p: begins(p["_f"], r["_f"]) | begins(r["_f"], p["_f"])), True)
        return T.let(alike, lambda at: F.when(at == 0, F.concat(done, F.array(r))).otherwise(F.transform(done, lambda p, i: F.when(i == at - 1, merged(p, r)).otherwise(p))))

    # A record alone is done; so all but a few skip the fold.
    folded = F.when(F.size("rows") == 1, F.col("rows")).otherwise(F.aggregate("rows", F.array().cast(f"array<{kind}>"), step))
    return rows.select(F.explode(folded).alias("x")).select(*[F.col(f"x.{c}").alias(c) for c in df.columns])


#: How many places of two texts of 0 and 1 agree: 60 places at a time as bits, which differ where one of them is set alone; what is longer agrees with nothing.
_SAME = "aggregate(sequence(0, cast((least(length(ga), length(gb)) - 1) / 60 as int)), 0, (n, i) -> n + least(60, least(length(ga), length(gb)) - i * 60) - bit_count(conv(substr(substr(ga, 1, least(length(ga), length(gb))), i * 60 + 1, 60), 2, 10)::bigint ^ conv(substr(substr(gb, 1, least(length(ga), length(gb))), i * 60 + 1, 60), 2, 10)::bigint))"
#: The bits of one text, and the same number from bits made before, where both texts are as long.
_BITS = "transform(sequence(0, cast((greatest(length(grid), 1) - 1) / 60 as int)), i -> conv(substr(grid, i * 60 + 1, 60), 2, 10)::bigint)"
_AGREE = f"case when length(ga) = length(gb) then length(ga) - aggregate(zip_with(ba, bb, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x) else {_SAME} end"


def _layout_of(prints: DataFrame, n: str) -> DataFrame:
    return prints.filter("grid <> ''").select("orientation", F.col("file").alias(n), F.col("grid").alias(f"g{n}"), F.expr(_BITS).alias(f"b{n}"))


def _alike_layouts(layout: float) -> str:
    return f"{_AGREE} >= {layout} * length(ga)"


def _rare_words(prints: DataFrame, text: float) -> DataFrame:
    """orientation, file, n and k: the rarest of a set's n words; sets that share ``text`` of their union have one of these in common."""
    each = prints.select("orientation", "file", F.size(F.array_distinct("tokens")).alias("n"), F.explode(F.array_distinct("tokens")).alias("w"))
    often = each.groupBy("w").agg(F.count("*").alias("m"))
    rare = each.join(often, "w").groupBy("orientation", "file", "n").agg(F.array_sort(F.collect_list(F.struct("m", "w"))).alias("ws"))
    return rare.select("orientation", "file", "n", F.explode(F.expr(f"slice(ws, 1, size(ws) - cast(ceil({text} * size(ws)) as int) + 1)")).alias("x")).select("orientation", "file", "n", F.col("x.w").alias("k"))


def _word_pairs(early: DataFrame, late: DataFrame, rare: DataFrame, text: float) -> DataFrame:
    """orientation, a of ``early`` and b of ``late``, a before b by file name and alike on words; ``rare`` are the rare words of all."""
    keys = lambda df, n: rare.join(df.select("orientation", "file"), ["orientation", "file"], "left_semi").select("orientation", "k", F.col("file").alias(n), F.col("n").alias(f"n{n}"))
    met = keys(early, "a").join(keys(late, "b"), ["orientation", "k"]).filter(f"a < b and na >= {text} * nb and nb >= {text} * na").select("orientation", "a", "b").distinct()
    own = lambda df, n: df.select("orientation", F.col("file").alias(n), F.array_distinct("tokens").alias(f"t{n}"))
    both = met.join(own(early, "a"), ["orientation", "a"]).join(own(late, "b"), ["orientation", "b"])
    return both.filter(f"size(array_intersect(ta, tb)) >= {text} * size(array_union(ta, tb))").select("orientation", "a", "b")


def _layout_pairs(prints: DataFrame, layout: float) -> DataFrame:
    """orientation, a and b, a before b by file name and alike on layout. Layouts that differ in less than a twelfth of their cells agree on twelve cells in a row at a multiple of twelve; only such pairs are compared."""
    cells = prints.select("orientation", "file", F.expr("transform(sequence(0, cast(length(grid) / 12 as int)), i -> concat(i, ':', substr(grid, i * 12 + 1, 12)))").alias("k"))
    keys = cells.select("orientation", "file", F.explode(F.filter("k", lambda x: F.length(F.substring_index(x, ":", -1)) == 12)).alias("k"))
    met = keys.withColumnRenamed("file", "a").join(keys.withColumnRenamed("file", "b"), ["orientation", "k"]).filter("a < b").select("orientation", "a", "b").distinct()
    return met.join(_layout_of(prints, "a"), ["orientation", "a"]).join(_layout_of(prints, "b"), ["orientation", "b"]).filter(_alike_layouts(layout)).select("orientation", "a", "b")


def _kept(df: DataFrame) -> DataFrame:
    at = work_folder(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def _once(prints: DataFrame) -> tuple[DataFrame, list[str]]:
    """Fingerprints with sorted distinct words, and the columns in which copies are equal. Blank fingerprints are like nothing, not even each other."""
    d = prints.withColumn("tokens", F.array_sort(F.array_distinct("tokens"))).withColumn("own", F.when((F.col("grid") == "") & (F.size("tokens") == 0), F.col("file")).otherwise(""))
    return d, ["orientation", "grid", "tokens", "own"]


def alike_links(prints: DataFrame, layout: float = 0.92, text: float = 0.60) -> DataFrame:
    """orientation, file, class and links: the first file whose fingerprint is equal, and how many other files are alike on layout or words.

    ``prints``: orientation, file, grid, tokens; grids are of one length or blank. Pairs are made between different layouts
    and between different word sets alone, and stand for the files behind them: links are those by layout and those by words
    less those by both.
    """
    d, same = _once(prints)
    one = _kept(d.groupBy(*same).agg(F.min("file").alias("class"), F.count("*").alias("n")))

    def kinds(by: str, there: str) -> DataFrame:
        return _kept(one.filter(there).groupBy("orientation", by).agg(F.min("class").alias("file"), F.sum("n").alias("n")))

    def each_way(pairs: DataFrame, of: DataFrame) -> DataFrame:
        back, self = pairs.select("orientation", F.col("b").alias("a"), F.col("a").alias("b")), of.select("orientation", F.col("file").alias("a"), F.col("file").alias("b"))
        return _kept(pairs.unionByName(back).unionByName(self))

    layouts, sets = kinds("grid", "grid <> ''"), kinds("tokens", "size(tokens) > 0")
    near = each_way(_layout_pairs(layouts, layout), layouts)
    shared = each_way(_word_pairs(sets, sets, _rare_words(sets, text), text), sets)
    beside = lambda pairs, of, name: pairs.join(of.select("orientation", F.col("file").alias("b"), "n"), ["orientation", "b"]).groupBy("orientation", F.col("a").alias(name)).agg(F.sum("n").alias(f"by_{name}"))
    named = one.join(layouts.select("orientation", "grid", F.col("file").alias("g")), ["orientation", "grid"], "left").join(sets.select("orientation", "tokens", F.col("file").alias("t")), ["orientation", "tokens"], "left")
    named = _kept(named.select("orientation", "class", "n", "g", "t"))
    # Files of alike words, by layout; of these the ones whose layout is alike too.
    full = named.filter("g is not null and t is not null").select("orientation", "g", "t", "n")
    around = full.join(shared.withColumnRenamed("b", "t"), ["orientation", "t"]).groupBy("orientation", F.col("a").alias("t"), F.col("g").alias("b")).agg(F.sum("n").alias("n"))
    both = around.join(full.select("orientation", "g", "t"), ["orientation", "t"]).join(near.withColumnRenamed("a", "g"), ["orientation", "g", "b"], "left_semi").groupBy("orientation", "g", "t").agg(F.sum("n").alias("by_both"))
    counted = named.join(beside(near, layouts, "g"), ["orientation", "g"], "left").join(beside(shared, sets, "t"), ["orientation", "t"], "left").join(both, ["orientation", "g", "t"], "left")
    zero = F.lit(0).cast("long")
    links = F.greatest(F.coalesce("by_g", zero) + F.coalesce("by_t", zero) - F.coalesce("by_both", zero) - 1, zero)
    found = one.join(counted.select("orientation", "class", links.alias("links")), ["orientation", "class"])
    return d.select("file", *same).join(found.drop("n"), same).select("orientation", "file", "class", "links")


#: Fingerprints of an orientation that are settled first, and at most at a time.
FIRST, BLOCK = 500, 4000


def greedy_groups(prints: DataFrame, layout: float = 0.92, text: float = 0.60, first: int = FIRST, block: int = BLOCK) -> DataFrame:
    """file, group: each fingerprint, by file name, joins the first group of its orientation whose founder is alike on layout or words.

    ``prints``: file, orientation, grid (text of 0 and 1), tokens (array). Equal fingerprints stand for one. The first
    undecided ones are compared with each other, round by round: those found a group that no undecided one alike precedes.
    What is undecided after them is compared with these founders alone, and then the next ones' turn comes. So pairs are made
    with founders and within a block, never among all; a broadcast holds a block at most.
    """
    spark, key = prints.sparkSession, ["orientation", "file"]
    d, same = _once(prints)
    one = _kept(d.groupBy(*same).agg(F.min("file").alias("file")))
    rare = _kept(_rare_words(one, text))

    def alike(early: DataFrame, late: DataFrame, rows: int) -> DataFrame:
        """Pairs of a block's ``early`` with ``late``, of which there are so many."""
        dealt = late.repartition(spread.parts(rows, spark.sparkContext.defaultParallelism), "file")
        near = _layout_of(dealt, "b").join(F.broadcast(_layout_of(early, "a")), "orientation").filter(f"a < b and {_alike_layouts(layout)}").select("orientation", "a", "b")
        return near.unionByName(_word_pairs(early, late, rare, text))

    left, placed, n = one, [], first
    while rows := left.count():
        turn = F.row_number().over(Window.partitionBy("orientation").orderBy("file"))
        head = _kept(left.withColumn("_n", turn).filter(F.col("_n") <= n).drop("_n"))
        edges, open_, founders = _kept(alike(head, head, head.count())), head.select(*key), []
        while not open_.isEmpty():
            early = edges.join(open_.withColumnRenamed("file", "a"), ["orientation", "a"], "left_semi")
            founders.append(_kept(open_.join(early.select("orientation", F.col("b").alias("file")).distinct(), key, "left_anti")))
            joined = edges.join(founders[-1].withColumnRenamed("file", "a"), ["orientation", "a"], "left_semi").select("orientation", F.col("b").alias("file")).distinct()
            open_ = _kept(open_.join(founders[-1], key, "left_anti").join(joined, key, "left_anti"))
        new = head.join(functools.reduce(DataFrame.unionByName, founders), key, "left_semi")
        own = new.select("orientation", "file", F.col("file").alias("founder"))
        members = alike(_kept(new), left, rows).groupBy("orientation", F.col("b").alias("file")).agg(F.min("a").alias("founder"))
        placed.append(_kept(own.unionByName(members)))
        left, n = _kept(left.join(placed[-1], key, "left_anti")), min(4 * n, block)
    if not placed:
        return prints.select("file", F.lit("").alias("group")).filter("false")
    of = functools.reduce(DataFrame.unionByName, placed)
    named = of.filter("file = founder").withColumn("n", F.row_number().over(Window.partitionBy("orientation").orderBy("file"))).select("orientation", "founder", F.concat_ws("_", "orientation", "n").alias("group"))
    placed_one = one.join(of, key).join(named, ["orientation", "founder"])
    return d.select("file", *same).join(placed_one.drop("file", "founder"), same).select("file", "group")
