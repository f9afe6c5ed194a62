"""The frame in which repeated windows of a corpus are found: blocks, anchors, segments.

Documents are packed into blocks of about a fixed size. Of each window of ``window`` units (bytes or words) in a document,
the anchor is the gram with the least hash, leftmost first; equal windows have equal anchors at equal places. Two rounds
of messages, each dealt by anchor, decide everything:

1. Each block sends its distinct anchors (32 bits each) and learns which occur elsewhere too. That only sifts.
2. For anchors found twice, each block sends the segment of units under the windows of that anchor, equal segments once,
   with the smallest doc_id that has it. A kernel (suffix array, or factors) compares the units themselves and answers
   for every window with a smaller doc_id that has it too, if there is one, or else the segment's own.

An anchor that half the corpus shares costs one message for each block, not for each document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from .common import BATCH_BYTES, lean, lean_group, materialise, mix, small_batches, steps

#: Bytes of text in a block, and bytes of text for each bucket of anchors.
BLOCK_BYTES = 2_000_000
BUCKET_BYTES = 2_000_000
#: Units that a kernel handles at a time, but for a single anchor's segments.
SLICE = 800_000
#: Stands in for a null doc_id: never smaller than another, and such rows lose nothing.
NO_ID = np.iinfo(np.int64).max
_STEP = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_POLY = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Kind:
    """How texts become units, and how segments are compared."""

    window: int
    gram: int
    units: Callable  # (texts: pa.Array) -> (what to keep for the output, units, first unit of each text)
    grams: Callable  # (what is kept, units) -> hash of the gram that begins at each unit
    pack: Callable  # (what is kept, units, places) -> the units at the places as bytes; equal units must have equal bytes
    unpack: Callable  # (list of such bytes) -> all units in a row, equal numbers for equal units alone
    kernel: Callable  # (units, first, starts, docs, anchors) -> a smaller doc that has the window too, or the segment's own, window by window
    emit: Callable  # (what was kept, first, removed: bool per unit) -> list of arrays
    schema: str  # of what emit gives
    names: tuple = ()


def blocks_of(docs: DataFrame, size: int = BLOCK_BYTES, rest: tuple[str, ...] = ()) -> DataFrame:
    """One row per block: number, ids, text lengths, the compressed texts and the other columns; written once, so numbers stay."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    chosen = docs.select(F.col("doc_id").cast("long").alias("_paperloom_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *(F.col(c).alias(f"_paperloom_{i}") for i, c in enumerate(rest)))

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        number, pack = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        for batch in steps(batches, limit=size):
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.array([len(t) for t in texts], np.int64)
            sink = pa.BufferOutputStream()
            others = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in batch.columns[2:]], [str(i) for i in range(batch.num_columns - 2)])
            if rest:
                with pa.ipc.new_stream(sink, others.schema) as to:
                    to.write_batch(others)
            cols = [pa.array([number], pa.int64())] + [pa.array([x], pa.binary()) for x in (ids.tobytes(), sizes.tobytes(), pack.compress(b"".join(texts)), pack.compress(sink.getvalue().to_pybytes()))]
            yield pa.RecordBatch.from_arrays(cols, ["block", "ids", "sizes", "body", "rest"])
            number += 1

    return materialise(chosen.mapInArrow(lean(run), "block long, ids binary, sizes binary, body binary, rest binary"), "none", True)


def _opened(table: pa.Table | pa.RecordBatch, row: int = 0):
    """ids and texts of a block."""
    get = lambda c: table.column(table.schema.get_field_index(c))[row].as_py()
    ids, sizes, body = np.frombuffer(get("ids"), np.int64), np.frombuffer(get("sizes"), np.int64), zstandard.decompress(get("body"))
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    return ids, pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(ends.tobytes()), pa.py_buffer(body))


def anchor_runs(hashes: np.ndarray, first: np.ndarray, window: int, gram: int):
    """(first start, last start, anchor) of each run of windows with one anchor. ``hashes``: of the gram at each unit."""
    width, total = window - gram + 1, int(first[-1])
    out = []
    left = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    for at in range(0, total, _STEP):
        part = hashes[at : at + _STEP + width - 1]
        if len(part) < width:
            break
        key = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        have = 1
        while have * 2 <= width:  # minima of 2, 4, 8, ... grams in a row
            key = np.minimum(key[:-have], key[have:])
            have *= 2
        if have < width:
            key = np.minimum(key[: len(key) - (width - have)], key[width - have :])
        place = (key & _PLACE).astype(np.int64)
        valid = left[at : at + len(place)] >= window
        new = valid.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
        end = valid.copy()
        end[:-1] &= new[1:] | ~valid[1:]
        begin = np.flatnonzero(new)
        out.append((begin + at, np.flatnonzero(end) + at, place[begin] + at))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


class Block:
    """A block's units, its anchors, and (given which anchors occur elsewhere) its segments."""

    def __init__(self, kind: Kind, ids: np.ndarray, texts: pa.Array):
        self.kind, self.ids = kind, ids
        self.kept, self.units, self.first = kind.units(texts)
        hashes = kind.grams(self.kept, self.units)
        self.begin, self.end, self.place = anchor_runs(hashes, self.first, kind.window, kind.gram)
        self.hash = hashes[self.place]
        self.doc = ids[np.searchsorted(self.first, self.begin, "right") - 1]
        self.anchors, self.which = np.unique(self.hash, return_inverse=True)

    def buckets(self, n: int) -> np.ndarray:
        """The bucket of each anchor; anchors are sorted, and so are their buckets."""
        return ((self.anchors >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)

    def shared_inside(self) -> np.ndarray:
        """Anchors that two documents of the block have."""
        lo, hi = np.full(len(self.anchors), NO_ID), np.full(len(self.anchors), np.iinfo(np.int64).min)
        np.minimum.at(lo, self.which, self.doc)
        np.maximum.at(hi, self.which, self.doc)
        return lo < hi

    def segments(self, twice: np.ndarray):
        """Runs whose anchor is in ``twice``: their numbers, the distinct segment of each, and for each of these a run and the smallest doc.

        Distinct segments are in the order of their anchors.
        """
        runs = np.flatnonzero(twice[self.which])
        a, b = self.begin[runs], self.end[runs] + self.kind.window
        of, some = distinct(self.units, a, b - a, self.which[runs], self.doc[runs])
        return runs, of, runs[some], self.doc[runs[some]]


def distinct(units: np.ndarray, first: np.ndarray, size: np.ndarray, major: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each segment units[first:first + size], and of each group a segment with the smallest doc.

    Segments of a group are equal in all their units and in ``major``, by which groups are ordered. Hashes bring like
    segments together; units are compared, and if they differ, the units themselves are the keys.
    """
    n = len(units)
    power, inverse = np.full(n + 1, _POLY, np.uint64), np.full(n + 1, np.uint64(pow(int(_POLY), -1, 1 << 64)), np.uint64)
    power[0] = inverse[0] = 1
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    content = mix((sums[first + size] - sums[first]) * inverse[first] + size.astype(np.uint64))
    while True:
        order = np.lexsort((docs, content, size, major))
        new = np.ones(len(order), bool)
        for x in (content[order], size[order], major[order]):
            new[1:] &= x[1:] == x[:-1]
        new[1:] = ~new[1:]
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        some = order[new]
        more = np.flatnonzero(some[of] != np.arange(len(order)))
        if not len(more) or (units[_span(first[more], size[more])] == units[_span(first[some[of[more]]], size[more])]).all():
            return of, some
        seen: dict[bytes, int] = {}
        content = np.array([seen.setdefault(units[a : a + m].tobytes(), len(seen)) for a, m in zip(first.tolist(), size.tolist())], np.uint64)


def _span(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., then those of first[1], and so on."""
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    return np.repeat(first - at[:-1], size) + np.arange(at[-1])


def _rows(cols, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(cols, kinds)], list(names))


_ANCHORS = "bucket int, block long, anchors binary"
_TOLD = "block long, bucket int, segments int, data binary"
_SENT = "bucket int, block long, anchors binary, starts binary, docs binary, units binary"


def _bounds(buckets: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.diff(buckets, prepend=-1)), len(buckets))


def _bits(told: pa.Table, block: Block, n: int) -> np.ndarray:
    """Anchors of the block that occur twice, by the answers of the first round and the block itself."""
    twice = block.shared_inside()
    buckets = block.buckets(n)
    for r in told.to_pylist():
        if r["segments"] < 0:
            a, b = np.searchsorted(buckets, [r["bucket"], r["bucket"] + 1])
            twice[a:b] |= np.unpackbits(np.frombuffer(r["data"], np.uint8), count=b - a).astype(bool)
    return twice


def find(docs: DataFrame, kind: Kind, block_bytes: int = BLOCK_BYTES, rest: tuple[str, ...] = ()) -> DataFrame:
    """What ``kind.emit`` gives for each document, after its doc_id and the columns ``rest``; see the module's text.

    Null texts are empty. Rows without a doc_id lose nothing. Rows of one doc_id take nothing from each other.
    """
    blocks = blocks_of(docs, block_bytes, rest)
    total = blocks.agg(F.coalesce(F.sum(F.length("body")), F.lit(0)).alias("n")).collect()[0]["n"]
    n = max(64, min(1 << 20, 3 * total // BUCKET_BYTES))

    def list_anchors(batches: Iterator[pa.RecordBatch]):
        with np.errstate(over="ignore"):
            for batch in batches:
                for row in range(batch.num_rows):
                    b = Block(kind, *_opened(batch, row))
                    at, buckets = _bounds(b.buckets(n)), b.buckets(n)
                    low = b.anchors.astype(np.uint32)
                    number = batch.column(0)[row].as_py()
                    parts = list(zip(at[:-1].tolist(), at[1:].tolist()))
                    yield _rows([[int(buckets[x]) for x, _ in parts], [number] * len(parts), [low[x:y].tobytes() for x, y in parts]], _ANCHORS)

    def meet(table: pa.Table) -> pa.Table:
        got = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("anchors").combine_chunks()]
        every = np.concatenate(got)
        order = np.argsort(every, kind="stable")
        sorted_ = every[order]
        same = sorted_[1:] == sorted_[:-1]
        twice = np.zeros(len(every), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cut = np.split(twice, np.cumsum([len(x) for x in got])[:-1])
        keep = [i for i, x in enumerate(cut) if x.any()]
        blocks_, bucket = table.column("block").to_pylist(), table.column("bucket")[0].as_py()
        return pa.Table.from_batches([_rows([[blocks_[i] for i in keep], [bucket] * len(keep), [-1] * len(keep), [np.packbits(cut[i]).tobytes() for i in keep]], _TOLD)])

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        pack, out = zstandard.ZstdCompressor(level=1), []
        with np.errstate(over="ignore"):
            for row in range(left.num_rows):
                b = Block(kind, *_opened(left, row))
                number = left.column("block")[row].as_py()
                _, _, some, docs_ = b.segments(_bits(right, b, n))
                bucket = b.buckets(n)[b.which[some]]
                at = _bounds(bucket)
                starts = (b.end - b.begin + 1)[some]
                for x, y in zip(at[:-1].tolist(), at[1:].tolist()):
                    own = some[x:y]
                    units = kind.pack(b.kept, b.units, _span(b.begin[own], starts[x:y] + kind.window - 1))
                    out.append((int(bucket[x]), number, b.hash[own].astype(np.uint32).tobytes(), starts[x:y].astype(np.uint16).tobytes(), docs_[x:y].tobytes(), pack.compress(units)))
        return pa.Table.from_batches([_rows(list(zip(*out)) or [[]] * 6, _SENT)])

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        counts = [len(r["starts"]) // 2 for r in rows]
        anchors, starts, ids = (np.concatenate([np.frombuffer(r[c], t) for r in rows]) for c, t in (("anchors", np.uint32), ("starts", np.uint16), ("docs", np.int64)))
        units = kind.unpack([zstandard.decompress(r["units"]) for r in rows])
        bucket = rows[0]["bucket"]
        for r in rows:
            r.pop("units")
        starts = starts.astype(np.int64)
        size = starts + kind.window - 1
        first = np.cumsum(size) - size
        answers = np.empty(int(starts.sum()), np.int64)
        begin = np.cumsum(starts) - starts
        order = np.argsort(anchors, kind="stable")
        cut = np.append(np.flatnonzero(np.diff(anchors[order].astype(np.int64), prepend=-1)), len(order))
        done = np.append(0, np.cumsum(size[order]))
        at = 0
        with np.errstate(over="ignore"):
            while at < len(order):
                to = int(cut[max(np.searchsorted(cut, at, "right"), np.searchsorted(done[cut], done[at] + SLICE, "right") - 1)])
                own = order[at:to]
                part = units[_span(first[own], size[own])]
                answers[_span(begin[own], starts[own])] = kind.kernel(part, np.cumsum(size[own]) - size[own], starts[own], ids[own], anchors[own])
                at = to
        pack, out, seg = zstandard.ZstdCompressor(level=1), [], 0
        for r, c in zip(rows, counts):
            a = int(begin[seg])
            own = answers[a : a + int(starts[seg : seg + c].sum())]
            change = np.flatnonzero(np.diff(own, prepend=own[0] ^ 1))
            out.append((r["block"], bucket, c, pack.compress(np.int64(len(change)).tobytes() + np.diff(change, append=len(own)).astype(np.uint32).tobytes() + own[change].tobytes())))
            seg += c
        return pa.Table.from_batches([_rows(list(zip(*out)), _TOLD)])

    def strike(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        with np.errstate(over="ignore"):
            for row in range(left.num_rows):
                b = Block(kind, *_opened(left, row))
                runs, of, some, _ = b.segments(_bits(right, b, n))
                starts = (b.end - b.begin + 1)[some]
                least = []
                for r in sorted((r for r in right.to_pylist() if r["segments"] >= 0), key=lambda r: r["bucket"]):
                    raw = zstandard.decompress(r["data"])
                    k = int(np.frombuffer(raw, np.int64, 1)[0])
                    least.append(np.repeat(np.frombuffer(raw, np.int64, k, 8 + 4 * k), np.frombuffer(raw, np.uint32, k, 8)))
                least = np.concatenate(least) if least else np.zeros(0, np.int64)
                where = _span((np.cumsum(starts) - starts)[of], starts[of])
                doc = np.repeat(b.doc[runs], starts[of])
                gone = _span(b.begin[runs], starts[of])[(least[where] < doc) & (doc != NO_ID)]
                edge = np.zeros(len(b.units) + 1, np.int32)
                edge += np.bincount(gone, minlength=len(edge)).astype(np.int32)
                edge -= np.bincount(gone + kind.window, minlength=len(edge)).astype(np.int32)
                cols = kind.emit(b.kept, b.first, np.cumsum(edge)[:-1] > 0)
                ids = pa.array(b.ids, mask=b.ids == NO_ID)
                others = pa.ipc.open_stream(zstandard.decompress(left.column("rest")[row].as_py())).read_next_batch().columns if rest else []
                out.append(pa.RecordBatch.from_arrays([ids, *others, *cols], ["doc_id", *rest, *names]))
        return pa.Table.from_batches(out)

    names = kind.names
    told = materialise(blocks.mapInArrow(lean(list_anchors), _ANCHORS).groupBy("bucket").applyInArrow(lean_group(meet), _TOLD))
    sent = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(lean_group(send), _SENT)
    answers = materialise(sent.groupBy("bucket").applyInArrow(lean_group(answer), _TOLD))
    both = told.unionByName(answers)
    schema = StructType().add("doc_id", "long")
    for c in rest:
        schema = schema.add(docs.schema[c])
    for f in T._parse_datatype_string(kind.schema).fields:
        schema = schema.add(f)
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(lean_group(strike), schema)


def spans(first: np.ndarray, removed: np.ndarray) -> pa.Array:
    """Maximal removed runs of each text, as places in it."""
    edge = np.diff(np.concatenate([[0], removed.astype(np.int8), [0]]))
    if len(removed):
        inner = first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(removed))]
        cross = np.unique(inner[removed[inner] & removed[inner - 1]]) if len(inner) else inner
    else:
        cross = np.zeros(0, np.int64)
    begin, end = np.sort(np.append(np.flatnonzero(edge == 1), cross)), np.sort(np.append(np.flatnonzero(edge == -1), cross))
    text = np.searchsorted(first, begin, "right") - 1
    cut = np.searchsorted(text, np.arange(len(first)))
    base = first[text]
    pairs = pa.StructArray.from_arrays([pa.array(begin - base, pa.int64()), pa.array(end - base, pa.int64())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pairs)
