"""Bit filters over string hashes, of a size that is bounded: what they let through is a superset, so exact joins follow them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, mix

#: Base of the polynomial hash (odd, so that it has an inverse modulo 2^64).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bits of a filter: sixteen for each item, within these bounds. The largest is 32 MB, and 67 MB as rows on its way.
LEAST, MOST = 1 << 16, 1 << 28


def powers(n: int) -> np.ndarray:
    """BASE^0 ... BASE^(n - 1) modulo 2^64."""
    out = np.full(max(n, 1), BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def parts(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings in a row, and where each begins (one more entry at the end)."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, offsets - offsets[0]


def hashes(words: pa.Array) -> np.ndarray:
    """The polynomial hash of each string: the sum of (byte + 1) * BASE^place."""
    if not len(words):
        return np.empty(0, np.uint64)
    flat, offsets = parts(words)
    sizes = np.diff(offsets)
    place = np.arange(len(flat), dtype=np.int64) - np.repeat(offsets[:-1], sizes)
    terms = np.concatenate(([np.uint64(0)], (flat.astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[place]))
    sums = np.add.accumulate(terms)
    return sums[offsets[1:]] - sums[offsets[:-1]]


def shift_of(n: int) -> int:
    """How far a hash is shifted to give one of the bits of a filter for n items."""
    return 64 - max(LEAST, min(MOST, 1 << max(16 * n - 1, 1).bit_length())).bit_length() + 1


def _bits(h: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    first = h * np.uint64(0xD6E8FEB86659FD93)
    return first >> np.uint64(shift), mix(first) >> np.uint64(shift)


def build(hashed: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """The filter over a column of 64-bit hashes (as longs), as 64-bit words, and its shift. The driver holds its rows, at most ``MOST`` / 64."""
    shift = shift_of(hashed.count())

    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate(_bits(h, shift))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["at", "bits"])

    rows = hashed.select(column).mapInArrow(lean(run), "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (64 - shift - 6), np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out, shift


def maybe(words: np.ndarray, shift: int, h: np.ndarray) -> np.ndarray:
    """Places in ``h`` (flat) of hashes that the filter may hold. The second bit is looked at only where the first is set."""
    first = h * np.uint64(0xD6E8FEB86659FD93)
    at = first >> np.uint64(shift)
    found = np.flatnonzero((words[(at >> np.uint64(6)).view(np.int64)] >> (at & np.uint64(63))) & np.uint64(1))
    again = mix(first[found]) >> np.uint64(shift)
    return found[((words[(again >> np.uint64(6)).view(np.int64)] >> (again & np.uint64(63))) & np.uint64(1)).astype(bool)]
