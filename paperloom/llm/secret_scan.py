"""Secret scans by a trigram index. [native]

Each rule's regular expression is turned into a Boolean query over trigrams: alternatives, each a set of trigrams that every
match of it must hold. The index has, shard by shard, the postings of the trigrams that the queries name; intersecting them
gives the documents that a rule may match, and only these are searched with its expression. Rules without mandatory trigrams
search all documents. Everything is built-in functions; expressions are written so that Java and RE2 read them alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and don't overlap; those whose ``part`` (0: all of it) is shorter than ``least`` go."""

    kind: str
    pattern: str
    part: int = 0
    least: int = 0


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Kinds in the order of their spans, and their shapes. The first three are the base.
_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]+", 0, 16),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9._~%-]+:[^\x00-\x20/@:]{3,}@"),
)
BASE = 3
#: Alternatives that a query keeps apart; beyond, a part of the expression is passed over, which only lets more documents through.
ALTERNATIVES = 64
#: Items whose prefix sums one step works out.
BLOCK = 256


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each the lower-case trigrams that its matches must hold; None where some match needs none."""
    found = set()
    for alternative in _pieces(parser.parse(pattern)):
        grams = frozenset(p[i : i + 3] for p in alternative for i in range(len(p) - 2))
        if not grams:
            return None
        found.add(grams)
    return sorted((a for a in found if not any(b < a for b in found)), key=sorted)


_GAP = ("", "")


def _joined(left: list[tuple], right: list[tuple]) -> list[tuple]:
    """Each alternative of one part followed by each of the next; an alternative is a run of texts with gaps of anything between."""
    if len(left) * len(right) > ALTERNATIVES:
        right = [_GAP]
    return list(dict.fromkeys(a[:-1] + (a[-1] + b[0],) + b[1:] for a in left for b in right))


def _pieces(tree) -> list[tuple]:
    out: list[tuple] = [("",)]
    for op, value in tree:
        out = _joined(out, _piece(op, value))
    return out


def _piece(op, value) -> list[tuple]:
    if op is sre.LITERAL:
        return [(chr(value).translate(str.maketrans(UPPER, LOWER)),)]
    if op is sre.IN:
        letters = {chr(v).translate(str.maketrans(UPPER, LOWER)) for o, v in value if o is sre.LITERAL}
        return [(c,) for c in sorted(letters)] if all(o is sre.LITERAL for o, _ in value) and len(letters) <= 8 else [_GAP]
    if op is sre.BRANCH:
        found = list(dict.fromkeys(p for b in value[1] for p in _pieces(b)))
        return found if len(found) <= ALTERNATIVES else [_GAP]
    if op is sre.SUBPATTERN:
        return _pieces(value[3])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = value
        once = _pieces(inner)
        out: list[tuple] = [("",)]
        for _ in range(min(least, 8)):
            out = _joined(out, once)
        if most == 1 and least == 0:
            return list(dict.fromkeys([("",), *once]))
        return out if least == most and least <= 8 else _joined(out, [_GAP])
    if op is sre.AT:
        return [("",)]
    return [_GAP]


def queries(rules: tuple[Rule, ...] = RULES) -> dict[str, list[frozenset[str]] | None]:
    return {r.kind: trigram_query(r.pattern) for r in rules}


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings, sorted by trigram in each shard: trigram and doc_id of the documents that hold it, in any case of A-Z. Rows without a doc_id are left out."""
    low = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    each = docs.filter("doc_id is not null").select("doc_id", low.alias("low")).select("doc_id", F.explode(held).alias("trigram"))
    return each.sortWithinPartitions("trigram", "doc_id")


def candidates(postings: DataFrame, asked: dict[str, list[frozenset[str]]]) -> DataFrame:
    """doc_id and kinds: the rules for one of whose alternatives a document holds all trigrams.

    Postings meet the trigrams of the queries, which are as many as the rules make them, and are counted by alternative.
    """
    terms = [(t, kind, i, len(grams)) for kind, alternatives in asked.items() for i, grams in enumerate(alternatives) for t in sorted(grams)]
    table = postings.sparkSession.createDataFrame(terms, "trigram string, kind string, alternative int, size int")
    # A repeated doc_id has several postings of one trigram, hence the set.
    met = postings.join(F.broadcast(table), "trigram").groupBy("doc_id", "kind", "alternative").agg(F.size(F.collect_set("trigram")).alias("n"), F.first("size").alias("size"))
    return met.filter("n = size").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def prefix_sums(sizes: Column) -> Column:
    """The sum of the items before each item, and of all, at last: sums within blocks, then those of the blocks before."""
    ahead = lambda xs: F.aggregate(xs, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: ahead(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
    with_starts = lambda bs: F.struct(bs.alias("bs"), ahead(F.transform(bs, lambda b: F.element_at(b, -1))).alias("starts"))
    shifted = lambda x: F.flatten(F.transform(x["bs"], lambda b, i: F.transform(F.slice(b, 1, F.size(b) - 1), lambda s: s + F.get(x["starts"], i))))
    return _let(_let(blocks, with_starts), lambda x: F.concat(shifted(x), F.array(F.element_at(x["starts"], -1))))


def _let(c: Column, use) -> Column:
    """``use(c)`` with ``c`` worked out once."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """start, kind (its order) and end of a rule's matches, in code points.

    What lies between the matches, and they themselves, add up to their places.
    """
    whole, between = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.part)) if rule.part else whole
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    # Gap, match, gap, match, ...: the odd places of the sums are where matches begin.
    met = F.struct(F.transform(whole, lambda x: F.length(x)).alias("sizes"), F.transform(part, lambda x: F.length(x)).alias("parts"), F.transform(between, lambda x: F.length(x)).alias("gaps"))
    sums = lambda m: F.struct(m["sizes"].alias("sizes"), m["parts"].alias("parts"), prefix_sums(F.flatten(F.zip_with(F.slice(m["gaps"], 1, F.size(m["sizes"])), m["sizes"], lambda g, s: F.array(g, s)))).alias("sums"))
    one = lambda m: F.transform(m["sizes"], lambda s, i: F.when(F.get(m["parts"], i) >= rule.least, F.struct(F.get(m["sums"], 2 * i + 1).alias("start"), F.lit(order).alias("kind"), (F.get(m["sums"], 2 * i + 1) + s).alias("end"))))
    any_long = lambda m: F.exists(m["parts"], lambda n: n >= rule.least)
    return _let(met, lambda m: F.when(any_long(m), _let(sums(m), lambda x: F.array_compact(one(x)))).otherwise(empty))


def listed(found: Column, rules: tuple[Rule, ...]) -> Column:
    """Spans as kind:start:end, by start and then by kind, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _searched(docs: DataFrame, rules: tuple[Rule, ...], kinds: Column) -> DataFrame:
    """Adds found: the spans of all rules that search everything (``kinds`` null) or that ``kinds`` names."""
    asked = queries(rules)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    per = [spans(F.col("text"), r, i) if asked[r.kind] is None else F.when(kinds.isNull() | F.array_contains(kinds, r.kind), spans(F.col("text"), r, i)).otherwise(empty) for i, r in enumerate(rules)]
    return docs.select("doc_id", *[c.alias(f"s{i}") for i, c in enumerate(per)])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and s0, s1, ...: the spans of each rule in the whole text.

    Null texts are empty, empty tables give no rows. Rows of one doc_id share their candidates and are searched each in
    its own text; rows without a doc_id can't be in an index and are searched with every rule. Other columns are ignored.
    """
    asked = {k: q for k, q in queries(rules).items() if q is not None}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    trigrams = sorted({t for alternatives in asked.values() for grams in alternatives for t in grams})
    postings = materialise(index(rows, trigrams), "zstd")
    met = materialise(candidates(postings, asked))
    named = rows.filter("doc_id is not null").join(met, "doc_id", "left").withColumn("kinds", F.coalesce("kinds", F.array().cast("array<string>")))
    nameless = rows.filter("doc_id is null").withColumn("kinds", F.lit(None).cast("array<string>"))
    return _searched(named, rules, F.col("kinds")).unionByName(_searched(nameless, rules, F.col("kinds")))


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the counts of the base kinds, the digest of their spans, and all spans."""
    found = scan(docs, rules)
    base = F.flatten(F.array(*[f"s{i}" for i in range(BASE)]))
    every = F.flatten(F.array(*[f"s{i}" for i in range(len(rules))]))
    counts = [F.size(f"s{i}").cast("long").alias(f"n_{rules[i].kind}") for i in range(BASE)]
    return found.select("doc_id", *counts, F.sha2(F.encode(listed(base, rules), "utf-8"), 256).alias("base_sha256"), listed(every, rules).alias("spans"))


def plain_spans(text: str, rules: tuple[Rule, ...] = RULES) -> list[str]:
    """The spans of one text, one rule after the other, for tests and small uses."""
    found = [(m.start(), i, m.end()) for i, r in enumerate(rules) for m in re.finditer(r.pattern, text) if len(m.group(r.part)) >= r.least]
    return [f"{rules[i].kind}:{a}:{b}" for a, i, b in sorted(found)]
