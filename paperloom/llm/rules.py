"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

Each rule is a condition under which a document goes. On a bounded sample the rejection rate of every rule is measured, and
the time it takes beyond that of a rule that rejects nothing; the cascade tries rules by falling rejections per cost, and a document stops at its first failed rule. The
order changes the work, not the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
SPLIT = r"[\x20\x09-\x0D]+"
#: Rows of the sample on which rules are timed, one of so many rows by a hash of the text; how often each rule judges each
#: row in a run, and the runs, of which the fastest counts.
SAMPLE, ONE_OF, TIMES, RUNS = 2048, 4, 4, 3
#: Repeated windows up to which positions are looked up one by one; beyond, windows are sorted with their positions.
FEW = 16


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT))


def duplicate_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line of the text."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the base counts; a null or blank text has no words and counts of 0."""
    d = docs.withColumn("_w", words(F.col("text")))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    d = d.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
    d = d.withColumn("n_symbols", F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"))
    d = d.withColumn("n_dup_lines", duplicate_lines(F.col("text")))
    at = "w -> xxhash64(_w[w], _w[w + 1], _w[w + 2])"
    d = d.withColumn("_h", F.expr(f"case when n_words >= 3 then transform(sequence(0, cast(n_words as int) - 3), {at}) else cast(array() as array<bigint>) end"))
    d = d.withColumn("_s", F.sort_array("_h"))
    d = d.withColumn("_d", F.array_distinct(F.expr("filter(_s, (x, i) -> i > 0 and x = _s[i - 1])")))
    few = "filter(sequence(0, size(_h) - 1), i -> array_contains(_d, _h[i]))"
    pairs = "sort_array(transform(_h, (h, i) -> struct(h, i)))"
    many = "sort_array(transform(filter(_p, (x, i) -> (i > 0 and x.h = _p[i - 1].h) or (i + 1 < size(_p) and x.h = _p[i + 1].h)), x -> x.i))"
    d = d.withColumn("_p", F.expr(f"case when size(_d) > {FEW} then {pairs} end"))
    d = d.withColumn("_at", F.expr(f"case when size(_d) = 0 then cast(array() as array<int>) when size(_d) <= {FEW} then {few} else {many} end"))
    # A repeated window covers three words, less what the next one covers too.
    covered = "aggregate(_at, struct(cast(0 as bigint) as n, -3 as last), (a, i) -> struct(a.n + least(3, i - a.last) as n, i as last), a -> a.n)"
    d = d.withColumn("n_repeat_words", F.expr(covered))
    return d.drop("_w", "_h", "_s", "_d", "_p", "_at")


BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def standard_rules() -> list[Rule]:
    """The rules behind the verdict; those on base counts first in the text, wherever the cascade puts them."""
    return [
        Rule("symbols", F.expr("10 * n_symbols > n_words")),
        Rule("short_words", F.expr("word_chars < 2 * n_words")),
        Rule("long_words", F.expr("word_chars > 20 * n_words")),
        Rule("repeated_lines", F.expr("n_dup_lines >= 2 and 10 * n_dup_lines > 3 * size(split(text, '\\n'))")),
        Rule("shouting", F.expr("length(text) - length(replace(text, '!!', '!')) > 0.3 * n_words")),
        Rule("few_letters", F.expr(r"10 * length(regexp_replace(text, '[^\\p{L}\\p{M}]+', '')) < 5 * word_chars")),
        Rule("capitals", F.expr(r"2 * length(regexp_replace(text, '[^\\p{Lu}]+', '')) > word_chars")),
    ]


def cascade_order(counted: DataFrame, rules: list[Rule], sample: int = SAMPLE) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, rejection rate) by falling rejections per second, measured on at most ``sample`` rows.

    Seconds are those of the fastest of some runs, less those of a rule that is false, so that scheduling doesn't count.
    """
    rows = counted.filter(F.pmod(F.xxhash64("text"), F.lit(ONE_OF)) == 0).limit(sample).cache()
    try:
        n = rows.count()
        many = rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(TIMES))))

        def seconds(rejects: Column) -> float:
            # The condition reads _i, or else it would be judged before rows are repeated.
            judged, took = many.filter(F.when(F.col("_i") > 0, rejects)), []
            for _ in range(RUNS):
                began = time.perf_counter()
                judged.count()
                took.append(time.perf_counter() - began)
            return min(took)

        idle = seconds(F.lit(False) & F.col("_i").isNull())
        rates = rows.agg(F.lit(0).alias("_"), *(F.count_if(F.coalesce(r.rejects, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules))).collect()[0]
        found = [(r, max(seconds(r.rejects) - idle, 1e-4), rates[f"r{i}"] / max(n, 1)) for i, r in enumerate(rules)]
    finally:
        rows.unpersist()
    return sorted(found, key=lambda x: -(x[2] + 1e-4) / x[1])


def cascade(rules: list[Rule]) -> Column:
    """True if no rule rejects; CASE stops at the first that does, a null outcome counts as passed."""
    out = None
    for rule in rules:
        hit = F.coalesce(rule.rejects, F.lit(False))
        out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of each row, also of rows of one doc_id or without one.

    Null texts count as empty, and those fail. An empty table gives no rows. One text is held whole by one task.
    """
    counted = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    rules = standard_rules() if rules is None else rules
    ordered = [r for r, _, _ in cascade_order(counted, rules, sample)]
    counted = counted.withColumn("base_failed", F.expr(BASE_FAILED))
    return counted.withColumn("kept", ~F.col("base_failed") & cascade(ordered)).drop("text")
