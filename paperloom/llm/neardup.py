"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of sketches, each of two minima, are computed for a document's set of word shingles; every pair of
one sketch of either collection is a table key, so 32 minima give 64 tables. Documents of equal sets are one node. In each
table bucket a document is held against the bucket's smallest one, on full sets. In buckets that still span several
components, documents are held against the one that shares most, and at last against those documents of other components
with which the place of the first shingle in common leaves room for a link; nothing is held against all of a bucket.
Components are contracted by tables, never on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, free_name, lean, materialise, mix, steps, word_codes

#: Sketches in each of the two collections; each is made of two minima.
SIDE = 8
#: A node of the graph: the smallest doc_id that has a set, and the hash of its text.
NODE = "struct<doc_id:bigint,hash:bigint>"
_M = np.uint64(0x9FB21C651E98DF25)
_ODD = mix(np.arange(1, 4 * SIDE + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix(np.arange(101, 4 * SIDE + 101, dtype=np.uint64))


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of all texts in a row, and where each text's begin (one more entry at the end).

    A shingle is ``size`` words in a row, lower-cased (A-Z); shorter texts are one shingle, texts without words none.
    """
    words, codes, first = word_codes(pc.ascii_lower(texts))
    n = np.diff(first)
    w = word_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    h = np.zeros(len(w), np.uint64)
    whole = np.zeros(len(w), bool)
    if len(w) >= size:
        acc = np.zeros(len(w) - size + 1, np.uint64)
        for k in range(size):
            acc = acc * _M + w[k : len(w) - size + 1 + k]
        h[: len(acc)] = acc
        last = np.repeat(first[1:], n) - np.arange(len(w))  # words from here to the text's end
        whole = last >= size
    for t in np.flatnonzero((n > 0) & (n < size)).tolist():
        acc = np.uint64(n[t])
        for k in range(first[t], first[t + 1]):
            acc = acc * _M + w[k]
        h[first[t]] = acc
        whole[first[t]] = True
    doc = np.repeat(np.arange(len(n)), n)[whole]
    h = mix(h[whole])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, the text's hash, n_shingles, a 128-bit hash of the set (s1, s2), and the sketches of both collections; null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]):
        with np.errstate(over="ignore"):
            for batch in steps(batches):
                h, at = shingle_sets(batch.column(1), size)
                n = np.diff(at)
                full = np.flatnonzero(n)
                sums = np.zeros((2, len(n)), np.uint64)
                sketch = np.zeros((len(n), 2 * SIDE), np.uint64)
                if len(full):
                    begin = at[full]
                    sums[0, full] = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), begin)
                    sums[1, full] = np.add.reduceat(mix(h + np.uint64(0x14057B7EF767814F)), begin)
                    minima = np.stack([np.minimum.reduceat(h * o + a, begin) for o, a in zip(_ODD, _ADD)], 1)
                    sketch[full] = mix(minima[:, 0::2] * _M + minima[:, 1::2])
                lists = pa.FixedSizeListArray.from_arrays(_signed(sketch.ravel()), 2 * SIDE).cast(pa.list_(pa.int64()))
                lists = pc.if_else(pa.array(n > 0), lists, pa.nulls(len(n), lists.type))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), _signed(sums[0]), _signed(sums[1]), lists], ["doc_id", "hash", "n_shingles", "s1", "s2", "sketch"])

    return documents(docs).withColumn("hash", F.xxhash64("text")).mapInArrow(lean(run), "doc_id long, hash long, n_shingles long, s1 long, s2 long, sketch array<long>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """node and the sorted shingles as binary of each row (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]):
        with np.errstate(over="ignore"):
            for batch in steps(batches):
                h, at = shingle_sets(batch.column(1), size)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h[at[i] : at[i + 1]].tobytes() for i in range(batch.num_rows)], pa.binary())], ["node", "shingles"])

    return docs.mapInArrow(lean(run), f"node {NODE}, shingles binary")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets share at least ``percent`` of their union."""
    left = pairs.join(sets.withColumnsRenamed({"node": "b", "shingles": "sb"}), "b")
    both = left.join(sets.withColumnsRenamed({"node": "a", "shingles": "sa"}), "a").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                lo, hi = min(len(x), len(y)), max(len(x), len(y))
                if not lo or 100 * lo < percent * hi:
                    keep.append(False)
                    continue
                every = np.concatenate([x, y])
                every.sort()
                common = int((every[1:] == every[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep))

    return both.mapInArrow(lean(run), f"a {NODE}, b {NODE}")


def _able(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """node, n (the set's size) and shared (the rarest of its shared shingles first, as structs m, h) of the rows' nodes that can have a link among them.

    Shingles that no other of the nodes has can't be shared. If they are too many, the node goes; without such nodes others
    share less, so the rest is counted again.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                h = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
                size = np.array([len(x) for x in h])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.repeat(np.arange(len(size)), size))), pa.array(np.concatenate(h))], ["node", "h"])

    own = sets.join(rows.select("node").distinct(), "node").select("node", "shingles")
    size = own.select("node", (F.length("shingles") / 8).cast("long").alias("n"))
    alone = own.mapInArrow(lean(run), f"node {NODE}, h long").groupBy("h").agg(F.min("node").alias("node"), F.count("*").alias("m")).filter("m = 1").groupBy("node").agg(F.count("*").alias("alone"))
    fit = materialise(size.join(alone, "node", "left").filter(f"100 * (n - coalesce(alone, 0)) >= {percent} * n").select("node", "n"))
    every = sets.join(fit.select("node"), "node").select("node", "shingles").mapInArrow(lean(run), f"node {NODE}, h long")
    often = every.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1")
    shared = every.join(often, "h").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("m", "h"))).alias("shared"))
    return materialise(fit.join(shared, "node").filter(f"100 * size(shared) >= {percent} * n"))


def _first_shared(able: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of different components that can be linked, by the place of their first common shingle.

    A node's shingles are in one order for all, rare ones first. If the first that two sets have in common is at place i of
    n and at place j of m, they share min(n - i, m - j) at most; so links need a common shingle far enough in front. The
    smaller set of a pair stands under its size class, the larger one asks the classes that its places leave room for:
    sets that have many shingles of their own in front meet only sets that are smaller enough.
    """
    p = percent
    d = able.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    d = d.withColumn("room", F.size("shared").cast("long")).withColumn("own", F.col("n") - F.col("room"))
    d = d.withColumn("front", F.expr(f"slice(shared, 1, cast(greatest(0, n - own - cast(ceil({p} * n / 100) as long) + 1) as int))"))
    each = d.select("node", "root", "n", "room", "own", F.posexplode("front").alias("at", "x")).select("node", "root", "n", "room", F.col("x.h").alias("h"), (F.col("n") - F.col("own") - F.col("at")).alias("rest"))
    kind = lambda n: f"cast(floor(ln({n}) * 25) as int)"  # noqa: E731  classes are 4 % wide
    small = each.filter(f"{100 + p} * rest >= {2 * p} * n").select("h", F.expr(kind("n")).alias("c"), *(F.col(x).alias(f"{x}_a") for x in ("node", "root", "n", "room", "rest")))
    most = f"least(n, cast(floor(({100 + p} * rest - {p} * n) / {p}) as long))"
    large = each.withColumn("least", F.expr(f"cast(ceil({p} * n / 100) as long)")).withColumn("most", F.expr(most)).filter("most >= least")
    large = large.select("h", F.explode(F.expr(f"sequence({kind('least')}, {kind('most')})")).alias("c"), *(F.col(x).alias(f"{x}_b") for x in ("node", "root", "n", "room", "rest")))
    fits = F.expr(f"root_a <> root_b and (n_a < n_b or (n_a = n_b and node_a < node_b)) and {100 + p} * least(rest_a, rest_b, room_a, room_b) >= {p} * (n_a + n_b)")
    met = small.join(large, (small["h"] == large["h"]) & (small["c"] == large["c"]) & fits)
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) for all nodes of the edges (a, b).

    Each node points to its smallest neighbour; pointers are followed to their ends, then trees that an edge joins are
    hooked to the smaller root, until no edge crosses.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
    while True:
        roots = _followed(roots)
        ra = roots.withColumnsRenamed({"node": "a", "root": "ra"})
        rb = roots.withColumnsRenamed({"node": "b", "root": "rb"})
        cross = edges.join(ra, "a").join(rb, "b").filter("ra <> rb")
        hooks = materialise(cross.groupBy(F.greatest("ra", "rb").alias("root")).agg(F.min(F.least("ra", "rb")).alias("to")))
        if hooks.isEmpty():
            return roots
        roots = roots.join(hooks, "root", "left").select("node", F.coalesce("to", "root").alias("root"))


def _followed(roots: DataFrame) -> DataFrame:
    while True:
        ends = roots.select(F.col("node").alias("root"), F.col("root").alias("to"))
        step = materialise(roots.join(ends, "root").select("node", F.col("to").alias("root"), (F.col("to") != F.col("root")).alias("moved")))
        roots = step.select("node", "root")
        if step.filter("moved").isEmpty():
            return roots


def _open(bucket: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (k, node, root) of buckets that span components; a component holds its documents, so links inside it are settled."""
    at = bucket.join(roots, "node", "left").select("k", "node", F.coalesce("root", "node").alias("root"))
    spans = at.groupBy("k").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("k")
    return materialise(at.join(spans, "k"))


def _joined(edges: DataFrame, roots: DataFrame, tested: DataFrame, more: DataFrame, sets: DataFrame, percent: int):
    """edges, roots and tested after the pairs ``more`` have been held against each other."""
    more = materialise(more.join(tested, ["a", "b"], "left_anti"))
    new = materialise(linked(more, sets, percent))
    if new.isEmpty():
        return edges, roots, tested.unionByName(more)
    edges = edges.unionByName(new)
    return edges, components(edges), tested.unionByName(more)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    Documents without words are linked with nothing. Rows without a doc_id are linked with nothing and have a null
    component. Each text of a doc_id is compared on its own set, and all texts of a doc_id are in one component. An empty table gives no rows.
    """
    found = materialise(signatures(docs, size))
    full = found.filter("sketch is not null and doc_id is not null")
    key = ["s1", "s2", "n_shingles"]
    nodes = materialise(full.groupBy(*key).agg(F.min(F.struct("doc_id", "hash", "sketch")).alias("x")).select(F.struct("x.doc_id", "x.hash").alias("node"), "x.sketch", *key))
    pairs = [F.xxhash64(F.lit(i * SIDE + j), F.col("sketch")[i], F.col("sketch")[SIDE + j]) for i in range(SIDE) for j in range(SIDE)]
    keys = nodes.select("node", F.explode(F.array(*pairs)).alias("k"))
    least = keys.groupBy("k").agg(F.min("node").alias("a"), F.count("*").alias("m")).filter("m > 1").drop("m")
    # Buckets of two documents or more, with their smallest one.
    bucket = materialise(keys.join(least, "k"))
    first = materialise(bucket.filter("a <> node").groupBy(F.col("node").alias("b")).agg(F.min("a").alias("a")))
    wanted = bucket.select("node").distinct()
    texts = documents(docs).withColumn("hash", F.xxhash64("text")).join(wanted.select("node.*"), ["doc_id", "hash"], "left_semi").groupBy("doc_id", "hash").agg(F.min("text").alias("text"))
    sets = materialise(full_sets(texts.select(F.struct("doc_id", "hash").alias("node"), "text"), size), "none")
    tested = first.select("a", "b")
    edges = materialise(linked(tested, sets, percent))
    roots = components(edges)
    open_ = _open(bucket, roots)
    if not open_.isEmpty():
        able = _able(open_, sets, percent)
        # Each bucket's centre is the document that shares most; where copies differ at random, it is linked to all that have any link.
        live = open_.join(able.select("node", "n", F.size("shared").cast("long").alias("room")), "node")
        centre = live.groupBy("k").agg(F.max(F.struct((F.col("room") / F.col("n")).alias("share"), "node", "root", "n", "room")).alias("c"))
        met = live.join(centre, "k").filter(f"root <> c.root and {100 + percent} * least(room, c.room) >= {percent} * (n + c.n)")
        more = met.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
        edges, roots, tested = _joined(edges, roots, tested, more, sets, percent)
        # What still spans components: exact pairs by the first shingle that two sets share.
        still = able.join(_open(bucket.join(able.select("node"), "node", "left_semi"), roots).select("node").distinct(), "node", "left_semi")
        edges, roots, tested = _joined(edges, roots, tested, _first_shared(still, roots, percent), sets, percent)
    # A copy's node, then the node's component; several nodes of one doc_id fall together.
    node = full.select("doc_id", *key).join(nodes.select("node", *key), key).select("doc_id", "node")
    placed = materialise(node.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node")["doc_id"].alias("root")).distinct())
    torn = placed.groupBy("doc_id").agg(F.min("root").alias("lo"))
    split = placed.join(torn, "doc_id").filter("lo <> root").select(F.col("lo").alias("a"), F.col("root").alias("b"))
    if not split.isEmpty():  # texts of one doc_id in several components join these
        over = components(split)
        torn = torn.join(over.select(F.col("node").alias("lo"), "root"), "lo", "left").select("doc_id", F.coalesce("root", "lo").alias("lo"))
    out = found.select("doc_id", "n_shingles").join(torn.select("doc_id", F.col("lo").alias("component_id")), "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each component (that with the smallest doc_id); of equal rows one."""
    key = free_name(docs.columns, "id_")
    found = near_duplicates(docs, size, percent).filter("doc_id is not null").groupBy(F.col("doc_id").alias(key)).agg(F.min("kept").alias("kept_"), F.count("*").alias("n_"))
    found = materialise(found.filter("n_ > 1 or not kept_"))
    same = F.col("doc_id").cast("long") == F.col(key)
    again = found.filter("kept_").select(key)
    rest = docs.join(found.select(key), same, "left_anti")
    return rest if again.isEmpty() else rest.unionByName(docs.join(again, same, "left_semi").dropDuplicates())
