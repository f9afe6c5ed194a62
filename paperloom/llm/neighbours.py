"""Exact nearest neighbours of a query set by a block matrix join.

Vectors are scaled to unit length and rounded to 8-bit integers once. A tile of queries times a tile of candidates is one
product of small integers, which gives each cosine up to a bound on the error of rounding. Pairs that the bound can't rule
out of a query's k nearest are recomputed in double precision from the vectors themselves; heaps merge what tiles leave.
Candidate tiles stay where they are dealt to; the tiles of queries travel to each group of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOUND = "query_id long, query binary, vec_id long, score double"
#: Bytes of vectors in a tile, and vectors at most.
TILE_BYTES, TILE = 1 << 20, 4096
#: Columns whose products of integers up to 127 sum exactly in 32-bit floats.
_EXACT = 1040


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component to between 1/2 and 1: exact, and squares don't overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None]) if x.size else x


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision, summed in the same order for equal rows."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integers of -127 to 127, the step of each row, and the length of each row's rounding error."""
    x = _scaled(x)
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    step = np.abs(unit).max(1) / 127
    whole = np.rint(unit / step[:, None])
    return whole.astype(np.int8), step, np.sqrt(((unit - whole * step[:, None]) ** 2).sum(1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of 8-bit integers, exact at any width."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], _EXACT):
        out += a[:, at : at + _EXACT].astype(np.float32) @ b[:, at : at + _EXACT].astype(np.float32).T
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v (array<double>) of the vectors that take part: not null, not zero, all components finite numbers."""
    v = F.col(vector).cast("array<double>")
    d = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return d.filter(fine & F.exists("v", lambda x: x != 0))


def search(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of each query, ties to the smaller id; all, if there are fewer.

    ``is_query`` is over the column ``id``. Vectors of other lengths than the query's are no candidates; repeated ids are
    candidates of their own, except those that bear the query's id. Query rows of one id and equal vectors are one query; of
    one id and other vectors, each is a query of its own, with its own ranks. Vectors that are null, zero or hold null or non-finite components take no
    part; an empty table gives no rows.
    """
    every = usable(vectors, key, vector)
    element = getattr(vectors.schema[vector].dataType, "elementType", None)
    kind = "f4" if element == T.FloatType() else "f8"  # 32-bit components travel as they are
    # Each group of candidate tiles gets every tile of queries once.
    groups = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    asked = spread(every.filter(is_query).distinct(), kind).select("width", F.col("tile").alias("asked")).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    tiles = spread(every, kind).withColumn("g", F.pmod(F.xxhash64("tile.ids"), F.lit(groups)).cast("int"))
    joined = tiles.join(asked, ["g", "width"]).select("width", "tile", "asked")

    def multiply(batches: Iterator[pa.RecordBatch]):
        best: dict[tuple[int, bytes], list] = {}  # the k nearest so far of each query (id and vector) in this task
        for batch in batches:
            for row in range(batch.num_rows):
                width, x, q = (batch.column(i)[row].as_py() for i in range(3))
                _tile(Tile.read(q, width, kind), Tile.read(x, width, kind), k, best)
        rows = [(*q, -m, s) for q, heap in best.items() for s, m in heap]
        if rows:
            a, v, b, c = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(v, pa.binary()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], ["query_id", "query", "vec_id", "score"])

    found = joined.mapInArrow(multiply, FOUND)
    top = found.groupBy("query_id", "query").agg(F.expr(f"slice(array_sort(collect_list(struct(-score as d, vec_id, score))), 1, {int(k)})").alias("near"))
    return top.select("query_id", F.posexplode("near").alias("rank", "x")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


@dataclass
class Tile:
    """Vectors of one length: ids, 8-bit integers, their steps and rounding errors, and the vectors themselves."""

    ids: np.ndarray
    small: np.ndarray
    step: np.ndarray
    error: np.ndarray
    whole: np.ndarray

    @classmethod
    def read(cls, row: dict, width: int, kind: str) -> Tile:
        ids, small, step, error, whole = (np.frombuffer(row[c], t) for c, t in zip(_PARTS, (np.int64, np.int8, np.float64, np.float64, kind)))
        return cls(ids, small.reshape(-1, width), step, error, whole.reshape(-1, width))


_PARTS = ("ids", "small", "step", "error", "whole")


def spread(every: DataFrame, kind: str) -> DataFrame:
    """Rows of a width and a tile (see ``Tile``) of a bounded number of bytes."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            size = np.asarray(pc.list_value_length(batch.column(1)))
            for width in np.unique(size).tolist():
                own, most = np.flatnonzero(size == width), min(TILE, max(1, TILE_BYTES // (9 * width)))
                for at in range(0, len(own), most):
                    part = batch.take(pa.array(own[at : at + most]))
                    ids, v = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), _matrix(part.column(1))
                    cells = [pa.array([x.tobytes()], pa.binary()) for x in (ids, *quantise(v), v.astype(kind))]
                    yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.StructArray.from_arrays(cells, list(_PARTS))], ["width", "tile"])

    return every.mapInArrow(run, f"width int, tile struct<{', '.join(f'{c}: binary' for c in _PARTS)}>")


def _tile(q: Tile, x: Tile, k: int, best: dict[tuple[int, bytes], list]) -> None:
    about = products(q.small, x.small) * q.step[:, None] * x.step[None, :]
    # |cos - about| <= |error of a| + |error of b| + their product, for unit vectors; and a little for rounding in doubles.
    slack = q.error[:, None] + x.error[None, :] + q.error[:, None] * x.error[None, :] + 1e-9
    self_pair = q.ids[:, None] == x.ids[None, :]
    low = np.where(self_pair, -np.inf, about - slack)
    least = np.partition(low, len(x.ids) - k, axis=1)[:, len(x.ids) - k] if len(x.ids) > k else np.full(len(q.ids), -np.inf)
    names = [(i, v.tobytes()) for i, v in zip(q.ids.tolist(), q.whole)]
    known = np.array([best[i][0][0] if len(best.get(i, ())) == k else -np.inf for i in names])
    qi, xi = np.nonzero((about + slack >= np.maximum(least, known)[:, None]) & ~self_pair)
    for at in range(0, len(qi), 65_536):
        i, j = qi[at : at + 65_536], xi[at : at + 65_536]
        exact = cosine(_scaled(q.whole[i].astype(np.float64)), _scaled(x.whole[j].astype(np.float64)))
        for at_query, other, s in zip(i.tolist(), x.ids[j].tolist(), exact.tolist()):
            heap = best.setdefault(names[at_query], [])
            if len(heap) < k:
                heapq.heappush(heap, (s, -other))
            elif (s, -other) > heap[0]:
                heapq.heapreplace(heap, (s, -other))
