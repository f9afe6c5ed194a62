"""Toxicity from the nearest labelled examples.

A bounded sample of labelled documents becomes TF-IDF vectors of unit length over all their terms; a term's chi-square to
the label raises its weight, and leaves no term out. An inverted index keeps, for each term, the postings by block of
examples and the largest weight in each block. For a document, block maxima bound the cosine of every
example in a block; blocks are opened by falling bound until no closed block can hold one of the k nearest, so the
neighbours are exact. Votes weighted by distance give a raw score; a logistic curve, fitted on the examples' own
leave-one-out votes, calibrates it. The neighbours' ids are the evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, keep_rows, lean, steps, word_codes

SCORED = "doc_id long, score double, raw double, neighbours array<long>, cosines array<double>"
#: Labelled examples of each label at most; those with the smallest hashes of their ids.
EXAMPLES = 1500
NEIGHBOURS = 24
BLOCK = 64
_TRIM = ".,;:!?\"'()[]{}<>«»“”‘’¡¿*-_"


def term_counts(texts: pa.Array):
    """(text, term, count) in three arrays, after the list of terms: lower-cased words without the marks around them."""
    words, codes, offsets = word_codes(texts)
    terms = pc.utf8_trim(pc.utf8_lower(words), _TRIM).dictionary_encode()
    names, of = terms.dictionary.to_pylist(), terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    n = max(len(names), 1)
    key, count = np.unique(row * n + of[codes], return_counts=True)
    return names, key // n, key % n, count


@dataclass
class Index:
    """Postings sorted by (term, block), and the largest weight of each (term, block) pair."""

    terms: dict[str, int]
    factor: np.ndarray  # of each term; the last is that of terms which no example has
    pair_start: np.ndarray  # first pair of each term
    pair_block: np.ndarray
    peak: np.ndarray
    post_start: np.ndarray  # first posting of each pair
    post_doc: np.ndarray
    weight: np.ndarray
    n: int
    ids: np.ndarray
    toxic: np.ndarray
    slope: tuple[float, float] = (1.0, 0.0)

    @property
    def blocks(self) -> int:
        return -(-self.n // BLOCK)

    def vectors(self, texts: pa.Array):
        """For each text: known terms and their TF-IDF weights in a vector of unit length over all terms of the text."""
        return self.weigh(len(texts), *term_counts(texts))

    def weigh(self, n: int, names: list[str], row: np.ndarray, term: np.ndarray, count: np.ndarray):
        """As ``vectors``, for ``n`` texts given as what ``term_counts`` says of them."""
        get, unknown = self.terms.get, len(self.terms)
        known = np.fromiter((get(w, unknown) for w in names), np.int64, len(names))[term]
        w = (1 + np.log(count)) * self.factor[known]
        norm = np.sqrt(np.bincount(row, w * w, minlength=n))
        w = w / np.maximum(norm[row], 1e-12)
        row, known, w = (x[known < unknown] for x in (row, known, w))
        at = np.searchsorted(row, np.arange(n + 1))
        return [(known[at[i] : at[i + 1]], w[at[i] : at[i + 1]]) for i in range(n)]

    def nearest(self, terms: np.ndarray, q: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosine, nearest first (ties: the smaller id), and the cosines; those that share no term are none."""
        a, b = self.pair_start[terms], self.pair_start[terms + 1]
        size = b - a
        pairs = np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())
        weight = np.repeat(q, size)
        block = self.pair_block[pairs]
        bound = np.bincount(block, weight * self.peak[pairs], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        scores = np.full(self.n, -1.0)
        done, step, least = 0, 6, -1.0
        while done < self.blocks:
            chosen = order[done : done + step]
            chosen = chosen[bound[chosen] >= least - 1e-9]
            if not len(chosen):
                break
            opened = np.zeros(self.blocks, bool)
            opened[chosen] = True
            inside = np.flatnonzero(opened[block])
            p = pairs[inside]
            m = self.post_start[p + 1] - self.post_start[p]
            posts = np.repeat(self.post_start[p] - np.cumsum(m) + m, m) + np.arange(m.sum())
            found = np.bincount(self.post_doc[posts], self.weight[posts] * np.repeat(weight[inside], m), minlength=self.n)
            rows = (chosen[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            rows = rows[rows < self.n]
            scores[rows] = found[rows]
            if skip >= 0:
                scores[skip] = -1.0
            done += step
            step *= 2
            if self.n > k:
                least = np.partition(scores, self.n - k)[self.n - k]
        scores = np.round(scores, 12)  # sums of the same numbers in another order are ties
        top = np.lexsort((self.ids, -scores))[:k]
        top = top[scores[top] > 0]
        return top, scores[top]

    def vote(self, top: np.ndarray, cos: np.ndarray) -> float:
        """Share of toxic votes; a neighbour at cosine c counts c^2 / (1 - c), so near copies decide."""
        if not len(top):
            return 0.0
        w = cos**2 / (1.02 - np.minimum(cos, 1.0))
        return float((w * self.toxic[top]).sum() / max(w.sum(), 1e-12))

    def score(self, raw: float) -> float:
        a, b = self.slope
        return float(1 / (1 + np.exp(-(a * raw + b))))


def build(ids: np.ndarray, texts: list[str], toxic: np.ndarray, natural: float, k: int = NEIGHBOURS) -> Index:
    """An index over whole texts; see ``assemble``."""
    return assemble(ids, term_counts(pa.array(texts, pa.string())), toxic, natural, k)


def assemble(ids: np.ndarray, counts: tuple, toxic: np.ndarray, natural: float, k: int = NEIGHBOURS) -> Index:
    """An index over examples given as what ``term_counts`` says of them; ``natural``: the share of toxic rows among all labelled ones, for calibration.

    Examples are laid out by their heaviest term, so that blocks hold like examples and their maxima are tight.
    """
    words, row, term, count = counts
    n = len(ids)
    df = np.bincount(term, minlength=len(words))
    factor = factors(df, np.bincount(term, toxic[row], minlength=len(words)), n, float(toxic.sum()))
    w = (1 + np.log(count)) * factor[term]
    norm = np.sqrt(np.bincount(row, w * w, minlength=n))
    w = w / np.maximum(norm[row], 1e-12)
    heavy = np.zeros(n, np.int64)
    order = np.argsort(w * (df[term] >= BLOCK // 4), kind="stable")
    heavy[row[order]] = term[order]
    place = np.empty(n, np.int64)
    place[np.lexsort((ids, heavy))] = np.arange(n)
    row = place[row]
    by_row = np.lexsort((term, row))
    own = (words, row[by_row], term[by_row], count[by_row])
    sort = np.lexsort((row, term))
    row, term, w = row[sort], term[sort], w[sort]
    pair = term * (n // BLOCK + 1) + row // BLOCK
    begin = np.flatnonzero(np.diff(pair, prepend=-1)) if len(pair) else np.zeros(0, np.int64)
    back = np.argsort(place)
    index = Index(
        {t: i for i, t in enumerate(words)}, factor,
        np.searchsorted(term[begin], np.arange(len(words) + 1)), (row // BLOCK)[begin],
        np.maximum.reduceat(w, begin) if len(begin) else np.zeros(0), np.append(begin, len(w)), row, w, n, ids[back], toxic[back].astype(float),
    )
    vectors = index.weigh(n, *own) if n else []
    raw = np.array([index.vote(*index.nearest(*v, k, skip=i)) for i, v in enumerate(vectors)]) if n else np.zeros(0)
    share = index.toxic.mean() if n else 0.0
    each = np.where(index.toxic == 1, natural / max(share, 1e-9), (1 - natural) / max(1 - share, 1e-9))
    index.slope = logistic(raw, index.toxic, each)
    return index


def factors(df: np.ndarray, with_label: np.ndarray, n: int, labelled: float) -> np.ndarray:
    """IDF times 1 + chi-square (how much a term's presence and the label depend on each other), never 0.

    One more at the end, for terms that no example has: that of a term in one example, without chi-square.
    """
    share, a = labelled / max(n, 1), with_label
    spread = df * share * (1 - share) * (1 - df / max(n, 1))
    chi = np.where(spread > 0, (a - df * share) ** 2 / np.maximum(spread, 1e-9), 0)
    return np.append(np.log(1 + n / np.maximum(df, 1)) * (1 + chi), np.log(1 + n))


def logistic(x: np.ndarray, y: np.ndarray, each: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """Slope and intercept by Newton's method on weighted rows; a single class gives a flat curve at its side."""
    if len(y) == 0 or y.min() == y.max():
        return 0.0, (-6.0 if len(y) == 0 or y[0] == 0 else 6.0)
    z, beta = np.stack([x, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        g = z.T @ (each * (y - p)) - ridge * beta
        h = (z * (each * p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, label: str = "toxic", examples: int = EXAMPLES, k: int = NEIGHBOURS) -> Index:
    """An index over at most ``examples`` labelled documents of each label, chosen by hashes of their ids.

    ``allowed`` restricts the labelled rows by doc_id. Null labels and null ids don't count; of several labels of a
    document the largest counts, of several texts the first in order. Terms are counted where the texts are; the driver gets
    the examples' distinct terms with their counts. Without a usable label the index is empty.
    """
    found = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    if allowed is not None:
        found = found.filter(allowed)
    found = found.groupBy("doc_id").agg((F.max("y") > 0).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in found.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        part = found.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
        chosen = part if chosen is None else chosen.unionByName(part)
    keys = {r["doc_id"]: r["y"] for r in chosen.collect()}  # at most 2 * examples rows
    spark = docs.sparkSession
    small = spark.createDataFrame([(i, y) for i, y in keys.items()], "doc_id long, y int")
    total = sum(counts.values())
    natural = counts.get(1, 0) / total if total else 0.0

    def count(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            names, row, term, times = term_counts(batch.column(2))
            at = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, x) for x in (pa.array(names, pa.string()).take(pa.array(term)), pa.array(times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["doc_id", "y", "terms", "counts"])

    texts = documents(docs).join(F.broadcast(small), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    found = texts.mapInArrow(lean(count), "doc_id long, y int, terms array<string>, counts array<long>").toArrow() if keys else None
    if found is None or not found.num_rows:
        return assemble(np.zeros(0, np.int64), ([], *[np.zeros(0, np.int64)] * 3), np.zeros(0, np.int64), natural, k)
    found = found.sort_by("doc_id")
    terms, times = (pa.concat_arrays(found.column(c).chunks) for c in ("terms", "counts"))
    coded = terms.flatten().dictionary_encode()
    row = np.repeat(np.arange(found.num_rows), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
    counted = coded.dictionary.to_pylist(), row, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), times.flatten().to_numpy(zero_copy_only=False)
    return assemble(found.column("doc_id").to_numpy(), counted, found.column("y").to_numpy().astype(np.int64), natural, k)


def votes(index: Index, texts: pa.Array, k: int = NEIGHBOURS) -> list[pa.Array]:
    """score, raw, neighbours and cosines of each text."""
    raw, near, cosines = [], [], []
    for terms, q in index.vectors(texts):
        top, cos = index.nearest(terms, q, k) if len(terms) else (np.zeros(0, np.int64), np.zeros(0))
        raw.append(index.vote(top, cos))
        near.append(index.ids[top].tolist())
        cosines.append(cos.tolist())
    return [pa.array([index.score(x) for x in raw], pa.float64()), pa.array(raw, pa.float64()), pa.array(near, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))]


def score(docs: DataFrame, index: Index, k: int = NEIGHBOURS) -> DataFrame:
    """One row per row of ``docs``, those of one doc_id apart and those without one too; an empty table gives no rows.

    Null, empty and wholly unknown texts have no neighbours, and the score of no toxic votes. Texts are held whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # at most 2 * EXAMPLES vectors

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), *votes(shared.value, batch.column(1), k)], ["doc_id", "score", "raw", "neighbours", "cosines"])

    return documents(docs).mapInArrow(lean(run), SCORED)


def without_toxic(docs: DataFrame, index: Index, most: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``most``; null texts count as empty, each row of a doc_id is judged on its own."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    return keep_rows(docs, lambda batch, texts: pc.less(votes(shared.value, texts)[0], most))
