"""Quality classification by co-training two views of a document.

One logistic model sees the text (statistics and hashed words), another the metadata (language, source, length). Both
start from the same bounded sample of labelled rows; in each round each is calibrated on labelled rows kept apart, scores all
unlabelled rows in a distributed pass, and hands those of which it is surest, and that it hasn't given yet, to the other. A
view that tells nothing about the rows kept apart is sure of nothing, and so gives nothing. Of each view the round that ranks
the rows kept apart best is used. A third logistic model on the two calibrated logits scores all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, keep_rows, lean, materialise, steps, word_codes

SCORED = "doc_id long, text_score double, meta_score double, score double"
#: Labelled rows at most.
LABELLED = 3000
ROUNDS = 4
#: Pseudo-labels that a view gives in a round at most, dealt to the classes by their shares, and how sure it has to be of them.
GIVEN, SURE = 200, 0.95
_BUCKETS, _META = 128, 64


def text_view(texts: pa.Array) -> np.ndarray:
    """One row of features per text: 14 statistics, then shares of hashed words."""
    words, codes, first = word_codes(texts)
    n, total = len(texts), np.maximum(np.diff(first), 1).astype(float)
    row = np.repeat(np.arange(n), np.diff(first))

    def share(of_word, weight=None):
        return np.bincount(row, np.asarray(of_word, float)[codes], minlength=n) / total

    def has(pattern):
        return pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)

    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(float)
    again = np.zeros(len(codes))
    if len(codes) > 1:
        again[1:] = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
    pairs = np.unique(row.astype(np.int64) * max(len(words), 1) + codes)
    distinct = np.bincount(pairs // max(len(words), 1), minlength=n)
    lists = pc.split_pattern(texts.cast(pa.large_string()), "\n")
    lines = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(float)
    at = np.repeat(np.arange(n), lines.astype(int))
    coded = lists.flatten().dictionary_encode()
    keys = np.unique(at * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False))
    own = np.bincount(keys // max(len(coded.dictionary), 1), minlength=n)
    dense = [
        np.log1p(np.diff(first)), share(size), share(size > 14), share(size <= 2), share(has(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$")),
        share(has(r"[^\pL\pN\s]{2,}$")), share(has(r"\pN")), share(has(r"[#*$%&|<>]")), share(has(r"^[^\pL\pN]+$")), share(has(r"(?i)https?:|@|www\.")),
        distinct / total, np.bincount(row, again, minlength=n) / total, own / np.maximum(lines, 1), np.log1p(lines),
    ]
    lower = pc.utf8_trim(pc.utf8_lower(words), ".,;:!?\"'()").to_pylist()
    import zlib

    bucket = np.fromiter((zlib.crc32(w.encode()) % _BUCKETS for w in lower), np.int64, len(lower))
    hashed = np.bincount(row * _BUCKETS + bucket[codes], minlength=n * _BUCKETS).reshape(n, _BUCKETS) / total[:, None]
    return np.concatenate([np.stack(dense, 1), hashed], 1).astype(np.float32)


def meta_view(lang: list, source: list, n_chars: list) -> np.ndarray:
    """Hashed language, source and their pair, and the length as the table states it; nulls have a place of their own."""
    import zlib

    out = np.zeros((len(lang), _META + 2), np.float32)
    for i, (a, b, c) in enumerate(zip(lang, source, n_chars)):
        for x in (f"l={a}", f"s={b}", f"p={a},{b}"):
            out[i, zlib.crc32(x.encode()) % _META] = 1
        out[i, _META] = np.log1p(max(c, 0)) if c is not None else 0
        out[i, _META + 1] = c is None
    return out


@dataclass
class Logistic:
    ridge: float = 1.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def fit(self, x: np.ndarray, y: np.ndarray, each: np.ndarray) -> Logistic:
        """Newton's method; one class alone gives a constant."""
        x = x.astype(float)
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        beta, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], self.ridge)
        penalty[-1] = 1e-3
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            w = each * np.maximum(p * (1 - p), 1e-6)
            step = np.linalg.solve((z * w[:, None]).T @ z + np.diag(penalty), z.T @ (each * (y - p)) - penalty * beta)
            beta += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-6:
                break
        self.beta = beta
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.c_[(x - self.mean) / self.scale, np.ones(len(x))] @ self.beta, -30, 30)


def chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


@dataclass
class Calibrated:
    """A view's model and the curve that makes its logits those of probabilities."""

    model: Logistic
    curve: Logistic

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.curve.logit(self.model.logit(x)[:, None])


def ranking(y: np.ndarray, logit: np.ndarray) -> float:
    """Area under the ROC curve; ties count a half, and one class alone gives a half."""
    n1 = int((y == 1).sum())
    n0 = len(y) - n1
    if not n0 or not n1:
        return 0.5
    _, at, times = np.unique(logit, return_inverse=True, return_counts=True)
    rank = np.cumsum(times) - (times - 1) / 2
    return float((rank[at][y == 1].sum() - n1 * (n1 + 1) / 2) / (n0 * n1))


@dataclass
class Model:
    text: Calibrated
    meta: Calibrated
    both: Logistic
    #: (round, view, AUC on the rows kept apart, pseudo-labels got so far), for each round and view.
    history: list[tuple[int, str, float, int]] = field(default_factory=list)

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.logit(text), self.meta.logit(meta)
        return chance(a), chance(b), chance(self.both.logit(np.stack([a, b], 1)))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, surest: Callable, apart: np.ndarray, rounds: int = ROUNDS) -> Model:
    """``apart``: rows of the labelled ones that calibrate and are not trained on.

    ``surest(models, given, most)`` gives, for each view, at most ``most[c]`` unlabelled rows of each class c whose keys
    aren't in ``given[view]``: key, class, and the features of both views.
    """
    views = {"text": text, "meta": meta}
    given: dict[str, set[int]] = {v: set() for v in views}  # keys of the rows that a view has labelled for the other
    got: dict[str, list] = {v: [] for v in views}  # class and features of the rows that a view has got
    train, models, history = ~apart, {}, []
    best: dict[str, tuple[float, Calibrated]] = {}
    ones = round(GIVEN * float(y[train].mean())) if train.any() else GIVEN // 2
    most = (GIVEN - ones, ones)
    hold = apart if len(set(y[apart].tolist())) == 2 else np.ones(len(y), bool)
    one = np.ones(hold.sum())
    for turn in range(rounds + 1):
        for v in views:
            marks = np.array([c for c, _ in got[v]], float)
            model = Logistic(ridge=2.0).fit(np.stack([*views[v][train], *(x for _, x in got[v])]), np.r_[y[train], marks], np.r_[np.ones(train.sum()), np.full(len(marks), 0.5)])
            raw = model.logit(views[v][hold])
            models[v] = Calibrated(model, Logistic(ridge=0.1).fit(raw[:, None], y[hold], one))
            auc = ranking(y[hold], models[v].logit(views[v][hold]))
            history.append((turn, v, auc, len(marks)))
            if v not in best or auc >= best[v][0]:
                best[v] = auc, models[v]
        if turn == rounds:
            break
        for v, rows in surest(models, given, most).items():
            other = "meta" if v == "text" else "text"
            for key, c, features in rows:
                given[v].add(key)
                got[other].append((c, features[other]))
    pair = np.stack([best[v][1].logit(views[v][hold]) for v in views], 1)
    return Model(best["text"][1], best["meta"][1], Logistic(ridge=0.1).fit(pair, y[hold], one), history)


_FEATURES = "doc_id long, text_view binary, meta_view binary"
_VIEWS = ("text", "meta")


def _dense(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1)


def _first(found: list[np.ndarray], most: int) -> list[np.ndarray]:
    """Of keys and logits, the ``most`` surest ones, each key once."""
    key, at = np.unique(found[0], return_index=True)
    logit = found[1][at]
    order = np.lexsort((key, -np.abs(logit)))[:most]
    return [key[order], logit[order]]


def surest_of(free: DataFrame) -> Callable:
    """What ``co_train`` asks for, over all rows of ``free`` (key, text_view, meta_view); ties go to the smaller key.

    Tasks keep the surest rows of each view and class, which are merged in two steps; at most GIVEN rows of each view reach
    the driver.
    """
    spark = free.sparkSession

    def surest(models: dict[str, Calibrated], given: dict[str, set[int]], most: tuple[int, int]) -> dict[str, list]:
        shared = spark.sparkContext.broadcast((dict(models), {v: np.array(sorted(given[v]), np.int64) for v in _VIEWS}))
        limit = float(np.log(SURE / (1 - SURE)))

        def run(batches: Iterator[pa.RecordBatch]):
            fitted, known = shared.value
            best = {(i, c): [np.zeros(0, np.int64), np.zeros(0)] for i in (0, 1) for c in (0, 1)}
            for b in batches:
                keys = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                for i, v in enumerate(_VIEWS):
                    logit = fitted[v].logit(_dense(b.column(1 + i))) if len(keys) else np.zeros(0)
                    fresh = (np.abs(logit) >= limit) & ~np.isin(keys, known[v])
                    for c in (0, 1):
                        own = fresh & ((logit > 0) == c)
                        if own.any():
                            best[i, c] = _first([np.append(best[i, c][0], keys[own]), np.append(best[i, c][1], logit[own])], most[c])
            for (i, c), (key, logit) in best.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), i, np.int32)), pa.array(np.full(len(key), c, np.int32)), pa.array(-np.abs(logit)), pa.array(key)], ["view", "y", "d", "key"])

        found = free.mapInArrow(lean(run), "view int, y int, d double, key long").withColumn("part", F.pmod("key", F.lit(32)))
        some = found.groupBy("view", "y", "part").agg(F.collect_set(F.struct("d", "key")).alias("x")).select("view", "y", F.explode(_slice("x", most)).alias("x"))
        rows = some.groupBy("view", "y").agg(F.collect_set("x").alias("x")).select("view", "y", F.explode(_slice("x", most)).alias("x")).select("view", "y", "x.key").collect()
        out: dict[str, list] = {v: [] for v in _VIEWS}
        if rows:
            small = spark.createDataFrame([(k,) for k in sorted({r["key"] for r in rows})], "key long")
            features = {r["key"]: {"text": np.frombuffer(r["text_view"], np.float32), "meta": np.frombuffer(r["meta_view"], np.float32)} for r in free.join(F.broadcast(small), "key").dropDuplicates(["key"]).collect()}
            for r in sorted(rows):
                out[_VIEWS[r["view"]]].append((r["key"], r["y"], features[r["key"]]))
        shared.destroy()
        return out

    return surest


def _slice(column: str, most: tuple[int, int]) -> Column:
    """The first most[y] of the sorted array."""
    return F.filter(F.array_sort(column), lambda _, i: i < F.when(F.col("y") == 1, most[1]).otherwise(most[0]))


def _views(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for b in steps(batches):
            t, m = text_view(b.column(1)), meta_view(*(b.column(i).to_pylist() for i in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in t], pa.binary()), pa.array([x.tobytes() for x in m], pa.binary())], ["doc_id", "text_view", "meta_view"])

    return docs.mapInArrow(lean(run), _FEATURES)


def _columns(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, source, n_chars; missing columns are null."""
    d = documents(docs, "lang", "source", "n_chars")
    for c in ("lang", "source", "n_chars"):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("string"))
    return d.select("doc_id", "text", F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("double"))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, label: str = "quality", labelled: int = LABELLED, rounds: int = ROUNDS) -> Model | None:
    """None if no label can be used. Null labels don't count; of several labels of a document the largest counts.

    Unlabelled are all rows with a doc_id that ``labels`` doesn't have; rows that are equal in doc_id and features count once.
    """
    found = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    if allowed is not None:
        found = found.filter(allowed)
    chosen = found.groupBy("doc_id").agg((F.max("y") > 0).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    keys = {r["doc_id"]: r["y"] for r in chosen.collect()}  # at most ``labelled`` rows
    if not keys:
        return None
    spark, every = docs.sparkSession, _columns(docs)
    small = spark.createDataFrame([(i,) for i in keys], "doc_id long")
    rows = {r["doc_id"]: r for r in _views(every.join(F.broadcast(small), "doc_id")).collect()}
    ids = sorted(k for k in keys if k in rows)
    if not ids:
        return None
    text, meta = (np.stack([np.frombuffer(rows[i][c], np.float32) for i in ids]) for c in ("text_view", "meta_view"))
    y = np.array([keys[i] for i in ids], float)
    apart = np.arange(len(ids)) % 4 == 0
    free = _views(every.filter("doc_id is not null")).join(labels.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_anti")
    free = materialise(free.select(F.xxhash64("doc_id", "text_view", "meta_view").alias("key"), "text_view", "meta_view"), "zstd")
    return co_train(text, meta, y, surest_of(free), apart if (~apart).any() else np.zeros(len(ids), bool), rounds)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """text_score, meta_score and score (probabilities that the quality is 1) of each row, also of rows of one doc_id or without one.

    Null texts count as empty, an empty table gives no rows. Without a model all scores are 0.5. Texts are held whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        m = shared.value
        for b in steps(batches):
            if m is None:
                found = [np.full(b.num_rows, 0.5)] * 3
            else:
                found = m.score(text_view(b.column(1)), meta_view(*(b.column(i).to_pylist() for i in (2, 3, 4))))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.float64()) for x in found)], ["doc_id", "text_score", "meta_score", "score"])

    return _columns(docs).mapInArrow(lean(run), SCORED)


def without_poor(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``least`` or more; null texts count as empty, each row of a doc_id is judged on its own, and without a model all score a half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = {c: docs.columns.index(c) for c in ("lang", "source", "n_chars") if c in docs.columns}

    def keep(batch: pa.RecordBatch, texts: pa.Array) -> np.ndarray:
        if shared.value is None:
            return np.full(batch.num_rows, 0.5 >= least)
        meta = [batch.column(place[c]).to_pylist() if c in place else [None] * batch.num_rows for c in ("lang", "source", "n_chars")]
        meta[2] = [None if x is None else float(x) for x in meta[2]]
        return shared.value.score(text_view(texts), meta_view(*meta))[2] >= least

    return keep_rows(docs, keep)
