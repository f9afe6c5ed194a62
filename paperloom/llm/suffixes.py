"""Suffix-array dedup: bytes under repeated byte strings, by two-stage suffix sorting.

Within a slice of segments only suffixes smaller than their successors are sorted directly, by their bytes. The others are
induced: going through the first bytes in rising order, a suffix that begins with a byte follows the order of its
successors, which are in buckets done already. Common prefixes of neighbours in the array then show equal windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mix
from .repeats import Kind, _span, distinct, find, spans


def _words8(b: np.ndarray, big: bool = False) -> np.ndarray:
    """The 8 bytes that begin at each place, as a number; zeros follow the end."""
    n = len(b)
    raw = np.concatenate([b, np.zeros(16 + (-n) % 8, np.uint8)])
    out = np.empty(n + (-n) % 8, np.uint64)
    for r in range(8):
        out[r::8] = np.frombuffer(raw.data, ">u8" if big else "<u8", len(out) // 8, r)
    return out[:n]


def byte_grams(units: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes that begin at each place."""
    w = np.concatenate([_words8(units), np.zeros(16, np.uint64)])
    n = len(units)
    return mix(mix(w[:n]) * np.uint64(0x9FB21C651E98DF25) + w[8 : n + 8] * np.uint64(0xD6E8FEB86659FD93) + w[16 : n + 16] * np.uint64(0xA0761D6478BD642F))


def two_stage(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The places in ``wanted``, sorted by the ``depth`` values that begin there.

    ``text`` holds 16-bit values in which 0 ends every segment. Suffixes are ranked with the smaller directly sorted set.
    """
    n = len(text)
    nxt = np.append(text[1:], np.uint16(1))
    # A run of equal values takes the type of its end.
    change = np.flatnonzero(text != nxt)
    run_end = change[np.searchsorted(change, np.arange(n))] if len(change) else np.full(n, n - 1)
    smaller = text[run_end] < nxt[run_end]
    # Chains of larger suffixes have to reach a sorted one: members go on from a wanted place to the next smaller one or 0.
    member = np.zeros(n, bool)
    member[wanted] = True
    while True:
        open_ = np.flatnonzero(member & ~smaller & (text != 0))
        more = open_[~member[open_ + 1]] + 1
        if not len(more):
            break
        member[more] = True
    places = np.flatnonzero(member)
    direct = places[smaller[places] | (text[places] == 0)]
    # Direct sorting on 8-byte words; after a segment's end all is 0.
    ends = np.append(np.flatnonzero(text == 0), n)
    left = ends[np.searchsorted(ends, direct)] - direct
    words = _words8((np.maximum(text, 1) - 1).astype(np.uint8), True)
    keys = []
    for k in range(0, depth, 8):
        w = np.zeros(len(direct), np.uint64)
        own = np.flatnonzero(left > k)
        w[own] = words[direct[own] + k]
        short = np.clip(left[own] - k, 0, 8).astype(np.uint64)
        mask = np.where(short >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), ~(np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.minimum(short, np.uint64(7)) * np.uint64(8))))
        w[own] &= mask
        keys.append(w)
    direct = direct[np.lexsort([left, *keys[::-1]])]
    rank = np.zeros(n, np.int64)
    first = text[direct]
    cut = np.searchsorted(first, np.arange(258))
    large = places[~smaller[places] & (text[places] != 0)]
    large = large[np.argsort(text[large], kind="stable")]
    lcut = np.searchsorted(text[large], np.arange(258))
    out, done = [], 0
    for c in range(257):
        own = large[lcut[c] : lcut[c + 1]]
        if len(own):
            # Successors with smaller first values are ranked; then those that follow suffixes of this bucket, level by level.
            ready = text[own + 1] < c
            level, rest = own[ready], own[~ready]
            while len(level):
                level = level[np.argsort(rank[level + 1], kind="stable")]
                rank[level] = done + np.arange(len(level))
                done += len(level)
                out.append(level)
                if not len(rest):
                    break
                fit = np.zeros(n if len(level) > 64 else 0, bool)
                if len(fit):
                    fit[level] = True
                    hit = fit[rest + 1]
                else:
                    hit = np.isin(rest + 1, level)
                level, rest = rest[hit], rest[~hit]
        sorted_ = direct[cut[c] : cut[c + 1]]
        rank[sorted_] = done + np.arange(len(sorted_))
        done += len(sorted_)
        out.append(sorted_)
    every = np.concatenate(out) if out else np.zeros(0, np.int64)
    keep = np.zeros(n, bool)
    keep[wanted] = True
    return every[keep[every]]


def common_prefix(text: np.ndarray, array: np.ndarray, depth: int) -> np.ndarray:
    """For each place in the array after the first: does it agree with the one before on ``depth`` values?"""
    raw = (np.maximum(text, 1) - 1).astype(np.uint8)
    words = np.concatenate([_words8(raw), np.zeros(depth, np.uint64)])
    a, b = array[1:], array[:-1]
    same = np.ones(len(a), bool)
    for k in [*range(0, depth - 7, 8), depth - 8]:
        same &= words[a + k] == words[b + k]
    return same


def byte_kernel(window: int):
    def kernel(units, first, starts, docs, anchors):
        size = starts + window - 1
        of, one = distinct(units, first, size, np.zeros(len(first), np.int64), docs)  # equal segments once, with their smallest doc
        s, st = size[one], starts[one]
        text = np.zeros(int(s.sum()) + len(one), np.uint16)
        f = np.cumsum(s + 1) - (s + 1)
        at = _span(f, s)
        text[at] = units[_span(first[one], s)].astype(np.uint16) + 1
        wanted = _span(f, st)
        array = two_stage(text, wanted, window)
        group = np.append(0, np.cumsum(~common_prefix(text, array, window))) if len(array) else np.zeros(0, np.int64)
        owner = np.empty(len(text), np.int64)
        owner[wanted] = np.repeat(docs[one], st)
        least = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, group, owner[array])
        found = np.empty(len(text), np.int64)
        found[array] = least[group]
        return found[_span(f[of], starts)]

    return kernel


def _bytes(texts: pa.Array):
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 0)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return raw, raw[: ends[-1]], ends


def _emit_bytes(raw, first, removed):
    keep = ~removed
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])[first]
    kept = raw[: len(keep)][keep]
    body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(kept.tobytes())]).cast(pa.binary())
    return [pa.array(np.diff(first), pa.int64()), spans(first, removed), body]


def suffix_dedup(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs, as byte places) and kept (the remaining bytes) of each document.

    A byte goes if a ``window``-byte string over it also starts in a document with a smaller doc_id. Texts shorter than
    the window lose nothing. Null texts count as empty, rows of one doc_id take nothing from each other, rows without a
    doc_id lose nothing; an empty table gives no rows.
    """
    if window < 32:
        raise ValueError("anchors need windows of 32 bytes or more")
    kind = Kind(window, 24, _bytes, lambda _, units: byte_grams(units), lambda _, units, at: units[at].tobytes(), lambda parts: np.frombuffer(b"".join(parts), np.uint8), byte_kernel(window), _emit_bytes, "n_bytes long, spans array<struct<start: long, end: long>>, kept binary", ("n_bytes", "spans", "kept"))
    return find(docs, kind)
