"""Substring dedup by relative Lempel-Ziv factors over words.

All segments that meet in a bucket are the reference block, in the order of their doc_ids, and a suffix array over their
words indexes it. Each segment is parsed greedily: a factor is the longest run of words from here on that a segment of a
smaller doc_id has, found as the nearest such neighbour on either side in the array. The windows inside factors of a window
or more are duplicates; windows that cross a factor's end are looked up in the index one by one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, mix, word_codes
from .neardup import word_hashes
from .repeats import Kind, _span, distinct, find, spans

_WORD = re.compile(r"[^\x20\x09-\x0D]+").findall
_C = np.uint64(0x9E3779B97F4A7C15)


def word_grams(units: np.ndarray) -> np.ndarray:
    """A hash of the 8 words that begin at each place, from the words' hashes."""
    n = len(units)
    w = np.concatenate([units, np.zeros(8, np.uint64)])
    acc = np.zeros(n, np.uint64)
    for k in range(8):
        acc = acc * _C + w[k : n + k]
    return mix(acc)


def names(text: np.ndarray, longest: int) -> list[np.ndarray]:
    """For 1, 2, 4, ... values: numbers, in order, of the strings of so many values that begin at each place. 0 follows the end."""
    out, size = [np.unique(text, return_inverse=True)[1].astype(np.int64)], 1
    while size < longest:
        key = out[-1] * (len(text) + 1)
        key[: len(text) - size] += out[-1][size:] + 1
        order = np.argsort(key, kind="stable")
        found = np.empty(len(text), np.int64)
        found[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) > 0)
        out.append(found)
        size *= 2
    return out


def agreement(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many values from the places a on are equal to those from the places b on."""
    n, same = len(levels[0]), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + same, b + same
        inside = np.maximum(x, y) < n
        same += (inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, y, 0)])) << k
    return same


def nearest_smaller(doc: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each rank the nearest rank before it with a smaller doc (-1: none), and how long both agree.

    ``lcp``: how long a rank agrees with the one before. Each rank points to the one before and goes on to where that
    points, as long as the doc there is no smaller.
    """
    to, same = np.arange(len(doc)) - 1, lcp.copy()
    open_ = np.flatnonzero((to >= 0) & (doc[to] >= doc))
    while len(open_):
        at = to[open_]
        same[open_] = np.minimum(same[open_], same[at])
        to[open_] = to[at]
        open_ = open_[to[open_] >= 0]
        open_ = open_[doc[to[open_]] >= doc[open_]]
    same[to < 0] = 0
    return to, same


def longest_factors(text: np.ndarray, starts: np.ndarray, doc: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place in ``starts``, of a segment of ``doc``: the longest string from there that starts at one of the other
    places with a smaller doc, and that doc.

    In ``text``, each segment ends with a value of its own.
    """
    levels = names(text, longest)
    order = np.lexsort((doc, levels[-1][starts]))
    at, own = starts[order], doc[order]
    lcp = np.zeros(len(at), np.int64)
    lcp[1:] = agreement(levels, at[1:], at[:-1])
    left, a = nearest_smaller(own, lcp)
    right, b = (x[::-1] for x in nearest_smaller(own[::-1], np.append(0, lcp[:0:-1])))
    right = len(at) - 1 - right  # len(at): none
    size, source = np.empty(len(at), np.int64), np.empty(len(at), doc.dtype)
    size[order] = np.maximum(a, b)
    source[order] = own[np.where(a >= b, np.maximum(left, 0), np.minimum(right, len(at) - 1))]
    return size, source


def factor_kernel(window: int):
    def kernel(units, first, starts, docs, anchors):
        of, one = distinct(units, first, starts + window - 1, anchors, docs)
        count, own, size = starts[one], docs[one], starts[one] + window - 1
        # The reference block: the segments, each closed by a value of its own.
        f = np.cumsum(size + 1) - (size + 1)
        text = np.zeros(int((size + 1).sum()), np.int64)
        text[_span(f, size)] = units[_span(first[one], size)]
        text[f + size] = int(units.max()) + 1 + np.arange(len(one))
        begin = np.cumsum(count) - count  # the first window of each segment
        doc = np.repeat(own, count)
        length, source = longest_factors(text, _span(f, count), doc, int(size.max()))
        found = doc.copy()
        at, todo = np.zeros(len(one), np.int64), np.arange(len(one))
        while len(todo):
            here = begin[todo] + at[todo]
            factor = length[here]
            inside = np.maximum(factor - window + 1, 0)  # windows in the factor
            whole = np.minimum(inside, count[todo] - at[todo])
            found[_span(here, whole)] = np.repeat(source[here], whole)
            # Windows that cross the factor's end: each is looked up.
            end = np.minimum(at[todo] + np.maximum(factor, 1), count[todo])
            cross = np.maximum(end - at[todo] - inside, 0)
            place = _span(here + inside, cross)
            hit = place[length[place] >= window]
            found[hit] = source[hit]
            at[todo] = end
            todo = todo[end < count[todo]]
        return found[_span(begin[of], starts)]

    return kernel


def _words(texts: pa.Array):
    words, codes, first = word_codes(texts)
    hashes = word_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    return (words.take(pa.array(codes)), texts, hashes), codes.astype(np.int64), first


def _pack(read, units, places) -> bytes:
    """The words themselves; no word holds a blank."""
    words = read[0].take(pa.array(places))
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
    return pc.binary_join(whole, pa.scalar(" ", words.type))[0].as_buffer().to_pybytes()


def _unpack(parts: list[bytes]) -> np.ndarray:
    body = b" ".join(parts)
    every = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(body)], np.int64).tobytes()), pa.py_buffer(body))
    return word_codes(every)[1].astype(np.int64)


def _emit_words(read, first, removed):
    flat, keep = read[0], ~removed
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])[first]
    kept = pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), flat.filter(pa.array(keep)))
    return [pa.array(np.diff(first), pa.int64()), spans(first, removed), pc.binary_join(kept, pa.scalar(" ", flat.type)).cast(pa.string())]


def _emit_whole(read, first, removed):
    """As ``_emit_words``, but texts that lose nothing stay as they are, and the others keep the lines of the words that stay."""
    n, runs, kept = _emit_words(read, first, removed)
    out = kept.to_pylist()
    for row in np.flatnonzero(np.asarray(pc.list_value_length(runs)) > 0).tolist():
        out[row] = _lines(read[1][row].as_py(), removed[first[row] : first[row + 1]])
    untouched = pc.equal(pc.list_value_length(runs), 0)
    return [n, runs, pc.if_else(untouched, read[1].cast(pa.string()), pa.array(out, pa.string()))]


def _lines(text: str, removed: np.ndarray) -> str:
    """The text without the removed words: words of a line are parted by one blank, lines that lose all their words go."""
    out, at = [], 0
    for line in text.split("\n"):
        words = _WORD(line)
        kept = [w for w, gone in zip(words, removed[at : at + len(words)].tolist()) if not gone]
        at += len(words)
        if kept or not words:
            out.append(" ".join(kept))
    return "\n".join(out) if at > removed.sum() else ""


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated words gone from the texts; n_chars, where it is, is their new length. Null texts become empty.

    Lines stay lines; those that lose all their words go.
    """
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = factor_dedup(docs, window, rest, True)
    kept = _names(rest)[2]
    new = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col(kept), "n_chars": F.length(kept).cast(docs.schema["n_chars"].dataType) if "n_chars" in rest else None}
    return found.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def _names(rest: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(free_name(["doc_id", *rest], c) for c in ("n_words", "spans", "kept"))


def factor_dedup(docs: DataFrame, window: int = 50, rest: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """doc_id, n_words, spans (removed runs, as word places) and kept (the other words, joined by blanks) of each document.

    A word goes if a window of ``window`` words over it also starts in a document with a smaller doc_id. Words are what
    ASCII white space parts, unchanged; hashes only choose what travels, words themselves are compared. Texts shorter than
    the window lose nothing, rows of one doc_id take nothing from each other, rows without a doc_id lose nothing. An empty
    table gives no rows.
    """
    if window < 16:
        raise ValueError("anchors need windows of 16 words or more")
    names_ = _names(rest)
    schema = ", ".join(f"{n} {t}" for n, t in zip(names_, ("long", "array<struct<start: long, end: long>>", "string")))
    kind = Kind(window, 8, _words, lambda read, _: word_grams(read[2]), _pack, _unpack, factor_kernel(window), _emit_whole if whole else _emit_words, schema, names_)
    return find(docs, kind, rest=rest)
