"""Phrase collocation mining: count tries of limited depth, one for each shard, merged by prefix range.

Words first: only words that occur often enough can stand in a phrase, and only pairs that do can stand in a longer one. Both
are passed on as filters of bounded size, which may let more through and never less. Tries over what is left are written as
sorted blocks, cut where ranges of paths begin and merged range by range; the merged trie's walk gives the counts of left
parts, its suffix links (joins of the far fewer frequent paths) those of right parts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import filters
from .common import BATCH_BYTES, lean, materialise, mix, small_batches, steps

#: Where pieces end, and what parts words within them.
ENDS, BLANKS = ".,;:!?\n\v\f\r", " \t"
#: Bytes of text in one trie.
TRIE_BYTES = 12_000_000
DEPTH = 5
#: A trie's nodes in sorted blocks; how many a block has at most, and how many a range is meant to have.
BLOCKS = "lang string, paths array<string>, counts array<long>"
BLOCK, RANGE = 65_536, 1_000_000
#: Languages whose totals are broadcast.
LANGUAGES = 10_000


def _texts(docs: DataFrame) -> DataFrame:
    """lang (null: und) and text (null: empty)."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


_CLASS = np.zeros(256, np.uint8)
_CLASS[[ord(c) for c in BLANKS]] = 1
_CLASS[[ord(c) for c in ENDS]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the code of each word, and whether it follows the word before it in one piece."""
    flat, offsets = filters.parts(texts)
    kind = _CLASS[flat]
    inside = kind == 0
    edge = np.zeros(len(flat) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    sizes = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)
    # A text's last word and the next one's first may touch; both begin at a start, so the sum over bytes of words alone is right.
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    data = np.ascontiguousarray(_LOWER[flat[inside]])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    follows = np.zeros(len(starts), bool)
    if len(starts):
        text = np.searchsorted(offsets, starts, "right")
        follows[1:] = ~np.logical_or.reduceat(kind == 2, starts)[:-1] & (text[1:] == text[:-1])
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), follows


def _by_lang(batches):
    """(language, distinct words, codes, follows) of the texts of each language in shards of about ``TRIE_BYTES``."""
    held, size = [], 0
    for batch in steps(batches, limit=TRIE_BYTES):
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= TRIE_BYTES:
            yield from _split(held)
            held, size = [], 0
    if held:
        yield from _split(held)


def _split(held: list[pa.RecordBatch]):
    shard = pa.Table.from_batches(held)
    for lang in pc.unique(shard.column(0)).to_pylist():
        own = shard.column(1).filter(pc.equal(shard.column(0), lang)).cast(pa.large_string()).combine_chunks()
        own = own if isinstance(own, pa.Array) else pa.concat_arrays(own.chunks)
        words, codes, follows = words_of(own)
        if len(codes):
            yield lang, words, codes, follows


def _rows(lang: str, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), n), *columns.values()], names=["lang", *columns])


def _word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    seed = filters.hashes(pa.array([lang + "\n"]))[0]
    return mix(filters.hashes(words) ^ seed)


def _pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0xC2B2AE3D27D4EB4F) + b)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word and n of all words."""

    def run(batches):
        for lang, words, codes, _ in _by_lang(batches):
            yield _rows(lang, {"word": words.cast(pa.string()), "n": pa.array(np.bincount(codes, minlength=len(words)))})

    return _texts(docs).mapInArrow(lean(run), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _filter(frame: DataFrame, run) -> tuple:
    """The filter over the hashes that ``run`` gives for a frame's batches, broadcast, and its shift."""
    held, shift = filters.build(frame.mapInArrow(lean(run), "h long"), "h")
    return frame.sparkSession.sparkContext.broadcast(held), shift


def _frequent_words(words: DataFrame):
    def run(batches):
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                own = batch.column(1).filter(pc.equal(batch.column(0), lang))
                yield pa.RecordBatch.from_arrays([pa.array(_word_hashes(lang, own).view(np.int64))], names=["h"])

    return _filter(words.select("lang", "word"), run)


def _among(held, shift: int, h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), bool)
    out[filters.maybe(held, shift, h)] = True
    return out


def _pairs(lang, words, codes, follows, frequent) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and at which places a pair of frequent words begins."""
    h = _word_hashes(lang, words)
    good = _among(frequent[0].value, frequent[1], h)[codes]
    begins = np.zeros(len(codes), bool)
    begins[:-1] = follows[1:] & good[1:] & good[:-1]
    return h, begins


def pair_hashes(docs: DataFrame, frequent, least: int) -> DataFrame:
    """Hashes (h) under which pairs of frequent words occur ``least`` times or more; pairs of one hash count together, so none is missed."""

    def run(batches):
        for lang, words, codes, follows in _by_lang(batches):
            h, begins = _pairs(lang, words, codes, follows, frequent)
            at = np.flatnonzero(begins)
            pairs, n = np.unique(codes[at] * len(words) + codes[at + 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_pair_hashes(h[pairs // len(words)], h[pairs % len(words)]).view(np.int64)), pa.array(n)], names=["h", "n"])

    return _texts(docs).mapInArrow(lean(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("h")


def tries(docs: DataFrame, frequent, pairs, depth: int) -> DataFrame:
    """Each shard's trie over runs of frequent pairs, as rows of up to ``BLOCK`` nodes: lang, paths (texts of two words or more, in the order of their words) and counts."""

    def run(batches):
        for lang, words, codes, follows in _by_lang(batches):
            h, begins = _pairs(lang, words, codes, follows, frequent)
            at = np.flatnonzero(begins)
            at = at[_among(pairs[0].value, pairs[1], _pair_hashes(h[codes[at]], h[codes[at + 1]]))]
            linked = np.zeros(len(codes) + depth, bool)
            linked[at] = True
            # A node is its parent and one more word; the first level's nodes are the words themselves, by their places in order.
            order = pc.array_sort_indices(words).to_numpy(zero_copy_only=False)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            codes, words = place[codes], words.take(pa.array(order))
            node, level = codes[at], np.arange(len(words), dtype=np.int32)[:, None]
            paths, counts = [], []
            for k in range(2, depth + 1):
                on = linked[at + k - 2]
                at, node = at[on], node[on]
                keys, node, n = np.unique(node * len(words) + codes[at + k - 1], return_inverse=True, return_counts=True)
                if not len(keys):
                    break
                level = np.concatenate([level[keys // len(words)], (keys % len(words)).astype(np.int32)[:, None]], 1)
                paths.append(np.pad(level, ((0, 0), (0, depth - k)), constant_values=-1))
                counts.append(n)
            if paths:
                yield from _blocks(lang, words, np.concatenate(paths), np.concatenate(counts))

    return _texts(docs).mapInArrow(lean(run), BLOCKS)


def _blocks(lang: str, words: pa.Array, paths: np.ndarray, counts: np.ndarray):
    """Nodes (rows of places in ``words``, which are sorted; -1 for none) as sorted blocks."""
    order = np.lexsort(paths.T[::-1])
    paths, counts = paths[order], counts[order]
    for a in range(0, len(counts), BLOCK):
        part = paths[a : a + BLOCK]
        filled = part >= 0
        ends = np.concatenate(([0], np.cumsum(filled.sum(1)))).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), words.take(pa.array(part[filled])).cast(pa.string())), " ")
        yield _block(lang, texts, counts[a : a + BLOCK])


def _block(lang: str, texts: pa.Array, counts: np.ndarray, **first: int) -> pa.RecordBatch:
    ends = pa.array([0, len(texts)], pa.int32())
    columns = [*[pa.array([v], pa.int64()) for v in first.values()], pa.array([lang]), pa.ListArray.from_arrays(ends, texts), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=[*first, "lang", "paths", "counts"])


def word_blocks(words: DataFrame) -> DataFrame:
    """The nodes of single words, as ``tries`` has those of longer paths. words: lang, word, n."""

    def run(batches):
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                own = batch.filter(pc.equal(batch.column(0), lang))
                own = own.take(pc.array_sort_indices(own.column(1)))
                yield _block(lang, own.column(1), own.column(2).to_numpy())

    return words.select("lang", "word", "n").mapInArrow(lean(run), BLOCKS)


def boundaries(blocks: DataFrame, least: int) -> list[tuple]:
    """Where ranges of paths begin (the first one has no beginning): at least ``least`` ranges of about ``RANGE`` nodes, by some 20,000 paths. They deal out the work and decide nothing else."""
    n = blocks.agg(F.sum(F.size("counts"))).first()[0] or 0
    some = blocks.select("lang", F.explode(F.expr("filter(paths, (p, i) -> i % 499 = 0)")).alias("path"))
    some = sorted((r.lang, r.path.split(" ")) for r in some.orderBy(F.xxhash64("path"), "lang", "path").limit(20_000).collect())
    ranges = max(least, -(-n // RANGE))
    found = [some[len(some) * i // ranges] for i in range(1, ranges)] if some else []
    return [x for i, x in enumerate(found) if i == 0 or x != found[i - 1]]


def merged(blocks: DataFrame, least: int, begins: list[tuple]) -> DataFrame:
    """lang, path, a (its count) and lefts: blocks cut where ranges begin, each range's merged and walked as a trie.

    lefts[k - 1] is the count of the first k words, null where that node is in an earlier range. blocks: as ``tries`` has
    them, written down. A task holds one range at a time: its rows come in the order of the ranges.
    """

    def cut(batches):
        for batch in batches:
            for lang, paths, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                texts, n = paths.values, counts.values.to_numpy()
                path = lambda i: (lang, texts[i].as_py().split(" "))  # noqa: E731, B023
                at, which = 0, bisect_right(begins, path(0))
                while at < len(texts):
                    to = bisect_left(range(len(texts)), begins[which], lo=at, key=path) if which < len(begins) else len(texts)
                    if to > at:
                        yield _block(lang, texts.slice(at, to - at), n[at:to], range=which)
                    at, which = to, which + 1

    def run(batches):
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)))
        for (_, lang), own in groupby(rows, key=lambda r: r[:2]):
            # Counts are added up whenever as many nodes have come as the sums hold: copies of nodes are not all held.
            sums, held, size = None, [], 0
            for _, _, paths, counts in own:
                held.append(pa.table([paths.values, counts.values], names=["path", "n"]))
                size += len(paths.values)
                if size >= max(RANGE, len(sums) if sums else 0):
                    sums, held, size = _summed([sums, *held] if sums else held), [], 0
            sums = _summed([sums, *held] if sums else held) if held else sums
            sums = sums.filter(pc.greater_equal(sums.column("n"), least))
            nodes = sorted((p.split(" "), n) for p, n in zip(sums.column("path").to_pylist(), sums.column("n").to_pylist()))
            found = ((lang, path, n, lefts) for path, n, lefts in _walk(nodes))
            while part := list(islice(found, 4096)):
                yield _batch(part)

    dealt = blocks.mapInArrow(lean(cut), f"range long, {BLOCKS}").repartitionByRange(len(begins) + 1, "range").sortWithinPartitions("range", "lang")
    return dealt.mapInArrow(lean(run), "lang string, path array<string>, a long, lefts array<long>")


def _summed(tables: list[pa.Table]) -> pa.Table:
    """path and n: the sum of each path's counts."""
    return pa.concat_tables(tables).group_by("path").aggregate([("n", "sum")]).select(["path", "n_sum"]).rename_columns(["path", "n"])


def _walk(nodes: list[tuple]):
    """(path, count, counts of its ancestors) of sorted nodes, by a stack of the nodes above."""
    stack: list[tuple] = []
    for path, n in nodes:
        while stack and path[: len(stack[-1][0])] != stack[-1][0]:
            stack.pop()
        known = {len(p): m for p, m in stack}
        yield path, n, [known.get(k) for k in range(1, len(path))]
        stack.append((path, n))


def _batch(held: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=["lang", "path", "a", "lefts"])


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds l, r, n and score of the lowest-scoring cut (ties: the first) to the paths of two words or more. found: ``merged``, written down; totals: lang, n."""
    paths = found.select(F.col("lang"), F.col("path").alias("part"), F.col("a").alias("count"))
    cuts = found.filter(F.size("path") > 1).select("lang", "path", "a", F.posexplode("lefts").alias("k", "l"))
    cuts = cuts.withColumn("k", F.col("k") + 1)
    # Left parts come from the walk; those of earlier ranges are looked up.
    known, other = cuts.filter("l is not null"), cuts.filter("l is null").drop("l").withColumn("part", F.slice("path", 1, F.col("k")))
    cuts = known.unionByName(other.join(paths, ["lang", "part"]).select("lang", "path", "a", "k", F.col("count").alias("l")))
    # Suffix links: what is left when the first k words go.
    cuts = cuts.withColumn("part", F.slice("path", F.col("k") + 1, F.size("path"))).join(paths, ["lang", "part"]).select("lang", "path", "a", "k", "l", F.col("count").alias("r"))
    exact = F.expr("(cast(1000 * a as decimal(18, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(19, 0)))")
    # The totals go to every task while they are few; a table of more languages is joined.
    held = materialise(totals)
    each = cuts.join(F.broadcast(held) if held.count() <= LANGUAGES else held, "lang").withColumn("score", exact.cast("long"))
    return each.groupBy("lang", "path").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "path", "a", "m.l", "m.r", "n", "m.score")


def without_parts(candidates: DataFrame, share: int = 100) -> DataFrame:
    """Candidates that lie in no longer one with ``share`` percent of their count or more. candidates: lang, path, a, written down.

    Whatever lies in a longer candidate lies in every one between; counts never rise with length, so with a share of 100
    it is enough to look at those with one word more. Lower shares look at all parts.
    """
    longer = candidates.filter(F.size("path") > 2).select("lang", "path", F.col("a").alias("longer"))
    if share == 100:
        inner = F.array(F.slice("path", 1, F.size("path") - 1), F.slice("path", 2, F.size("path") - 1))
    else:
        inner = F.expr("flatten(transform(sequence(2, size(path) - 1), m -> transform(sequence(1, size(path) - m + 1), i -> slice(path, i, m))))")
    within = longer.select("lang", "longer", F.explode(inner).alias("path")).groupBy("lang", "path").agg(F.max("longer").alias("longer"))
    return candidates.join(within, ["lang", "path"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))).drop("longer")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, depth: int = DEPTH, share: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's first ``top`` phrases of 2 to ``depth`` words with ``least`` occurrences or more.

    Null texts count as empty, a null lang as "und"; empty tables give no rows, repeated rows count as often as they come;
    other columns are ignored. To every task go two filters of a bounded size and the totals of each language, nothing else.
    """
    spark = docs.sparkSession
    counts = materialise(word_counts(docs), "zstd")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = counts.filter(F.col("n") >= least)
    frequent = _frequent_words(words)
    hashed = materialise(pair_hashes(docs, frequent, least))
    held, shift = filters.build(hashed, "h")
    pairs = (spark.sparkContext.broadcast(held), shift)
    blocks = materialise(tries(docs, frequent, pairs, depth).unionByName(word_blocks(words)), "zstd", True)
    found = materialise(merged(blocks, least, boundaries(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    kept = without_parts(materialise(scored(found, totals)), share).withColumn("phrase", F.array_join("path", " "))
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # The first of each of 64 deals of a language, then the first of these.
    first = kept.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
