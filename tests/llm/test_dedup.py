import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import factors, neardup, repeats, suffixes

from .data import empty, frame, prose


def spans_of(units, key, window, seen):
    """Marks, and the windows of this text."""
    marks, new = [False] * len(units), []
    for p in range(len(units) - window + 1):
        w = key(units[p : p + window])
        new.append(w)
        if w in seen:
            marks[p : p + window] = [True] * window
    return marks, new


def brute(docs, units, key, window):
    out, seen = {}, set()
    for i, t in sorted(docs, key=lambda x: x[0]):
        marks, new = spans_of(units(t or ""), key, window, seen)
        seen.update(new)
        out[i] = marks
    return out


def many(seed=0, n=60):
    """Texts that share passages, across several blocks."""
    r = random.Random(seed)
    shared = [prose(r.randrange(45, 75), 1000 + i) for i in range(8)]
    return [(100 + i, " ".join(r.choice(shared) if r.random() < 0.5 else prose(r.randrange(5, 60), seed * 999 + i * 7 + j) for j in range(3))) for i in range(n)]


def test_two_stage_order():
    r = np.random.default_rng(0)
    for alphabet in (2, 3, 200):
        segments = [r.integers(1, alphabet + 1, 70) for _ in range(9)]
        text = np.concatenate([np.append(s, 0) for s in segments]).astype(np.uint16)
        wanted = np.concatenate([np.arange(21) + 71 * i for i in range(9)])
        got = suffixes.two_stage(text, wanted, 50)
        want = sorted(wanted.tolist(), key=lambda p: text[p : p + 50].tolist())
        assert sorted(got.tolist()) == sorted(wanted.tolist())
        assert [text[p : p + 50].tolist() for p in got] == [text[p : p + 50].tolist() for p in want]
        same = suffixes.common_prefix(text, got, 50)
        assert [bool(x) for x in same] == [(text[a : a + 50] == text[b : b + 50]).all() for a, b in zip(got[1:], got[:-1])]


@pytest.mark.parametrize("block", [2_000, 2_000_000])
def test_suffix_dedup_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(repeats.find, "__defaults__", (block, ()))
    df = frame(spark, [(i, t, "en", "s", 1, 0.0, "w", 1) for i, t in many()])
    want = brute([(r.doc_id, r.text) for r in df.collect()], lambda t: t.encode(), bytes, 50)
    got = {r.doc_id: r for r in suffixes.suffix_dedup(df).collect()}
    assert got.keys() == want.keys() and sum(map(sum, want.values())) > 1000
    texts = {r.doc_id: (r.text or "").encode() for r in df.collect()}
    for i, marks in want.items():
        assert bytes(got[i].kept) == bytes(b for b, m in zip(texts[i], marks) if not m), i
        found = [False] * len(marks)
        for s in got[i].spans:
            assert 0 <= s.start < s.end <= len(marks) and not (s.start and found[s.start - 1])
            found[s.start : s.end] = [True] * (s.end - s.start)
        assert found == marks, i


@pytest.mark.parametrize("block", [2_000, 2_000_000])
def test_factor_dedup_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(repeats.find, "__defaults__", (block, ()))
    df = frame(spark, [(i, t, "en", "s", 1, 0.0, "w", 1) for i, t in many(1)])
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    rows = df.collect()
    want = brute([(r.doc_id, r.text) for r in rows], words, tuple, 50)
    got = {r.doc_id: r for r in factors.factor_dedup(df).collect()}
    assert sum(map(sum, want.values())) > 500
    for r in rows:
        assert got[r.doc_id].kept == " ".join(w for w, m in zip(words(r.text or ""), want[r.doc_id]) if not m), r.doc_id


def test_variants_beyond_the_references(spark):
    """More variants of one passage than the factors look at, where only a late one repeats a window."""
    passage = prose(130, 5).split()
    rows = []
    for i in range(14):
        w = list(passage)
        w[3 * i] = f"odd{i}"
        rows.append((i, " ".join(w)))
    rows.append((50, " ".join(passage[:60] + ["tail"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, str.split, tuple, 50)
    got = {r.doc_id: r.kept for r in factors.factor_dedup(df).collect()}
    assert got == {i: " ".join(w for w, m in zip(t.split(), want[i]) if not m) for i, t in rows}


def test_words_are_compared_themselves(spark):
    """Two words whose hashes agree in the low 32 bits are different words."""
    base = prose(50, 31).split()
    rows = [(i, " ".join([*base[:25], w, *base[26:]])) for i, w in enumerate(["k9870", "k53003", "k9870"])]
    got = {r.doc_id: r.kept for r in factors.factor_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: rows[0][1], 1: rows[1][1], 2: ""}


def test_segments_whose_hashes_agree_are_told_apart(monkeypatch):
    monkeypatch.setattr(repeats, "mix", lambda x: np.zeros_like(x))
    units, first = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3, 9, 9]), np.array([0, 3, 6, 0])
    of, some = repeats.distinct(units, first, np.array([3, 3, 3, 3]), np.zeros(4, np.int64), np.array([7, 6, 5, 4]))
    assert of[0] == of[2] == of[3] != of[1] and sorted(some.tolist()) == [1, 3]


def test_factors_are_the_longest_of_smaller_documents():
    r = np.random.default_rng(4)
    segments = [r.integers(1, 3, 12) for _ in range(9)]
    doc = np.array([5, 3, 9, 3, 1, 7, 5, 2, 8])
    text = np.concatenate([np.append(s, 100 + i) for i, s in enumerate(segments)])
    starts = np.concatenate([np.arange(10) + 13 * i for i in range(9)])
    size, source = factors.longest_factors(text, starts, np.repeat(doc, 10), 12)
    for at, n, d in zip(starts.tolist(), size.tolist(), source.tolist()):
        own = doc[at // 13]
        best, where = 0, set()
        for other in starts.tolist():
            if doc[other // 13] < own:
                k = 0
                while text[at + k] == text[other + k]:
                    k += 1
                where = where | {int(doc[other // 13])} if k == best else {int(doc[other // 13])} if k > best else where
                best = max(best, k)
        assert n == best and (n == 0 or d in where)


def test_one_long_text(spark):
    """A text far beyond a block is handled whole, and repeats deep inside it are found."""
    long = prose(400_000, 77)
    piece = " ".join(long.split()[350_000:350_090])
    df = spark.createDataFrame([(1, long), (2, "before " + piece + " after"), (3, long)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.kept) for r in factors.factor_dedup(df).collect()}
    assert got[1] == (400_000, long) and got[2] == (92, "before after") and got[3] == (400_000, "")
    cut = {r.doc_id: bytes(r.kept) for r in suffixes.suffix_dedup(df).collect()}
    assert cut[1] == long.encode() and cut[2] == b"beforeafter" and cut[3] == b""  # blanks go with the passage


def test_dedup_edge_cases(spark):
    for find in (suffixes.suffix_dedup, factors.factor_dedup):
        assert find(empty(spark)).count() == 0
    text = prose(80, 9)
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (9, text)], "doc_id int, text string")
    for find, unit in ((suffixes.suffix_dedup, "kept"), (factors.factor_dedup, "kept")):
        got = sorted((r.doc_id or 0, len(r[unit])) for r in find(df).collect())
        assert got == [(0, len(text)), (5, len(text)), (5, len(text)), (9, 0)]  # one doc_id takes nothing from itself


def test_without_repeats_keeps_the_lines(spark):
    passage = prose(60, 8)
    rows = [(1, passage), (2, "first line\n" + passage + " rest of it\n\nlast  line\n" + passage)]
    got = {r.doc_id: r.text for r in factors.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: passage, 2: "first line\nrest of it\n\nlast line"}


def test_without_repeats_keeps_columns(spark):
    df = frame(spark)
    got = factors.without_repeats(df)
    assert got.columns == df.columns and got.schema == df.schema
    a, b = ({r.doc_id: r for r in x.collect()} for x in (df, got))
    assert b[2].text == "" and b[2].n_chars == 0 and b[1].text == a[1].text and b[8].text == a[8].text and b[3].source == a[3].source and b[1].word == "w"


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(3)
    base = prose(100, 11).split()
    more = []
    for i in range(40):  # copies around the threshold, so that links chain
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(len(w))] = f"new{r.randrange(50)}"
        more.append((200 + i, " ".join(w), "en", "s", 1, 0.0, "w", 1))
    df = frame(spark, more)
    sets = {x.doc_id: shingles(x.text, 4) for x in df.collect()}
    root = {i: i for i in sets}

    def top(i):
        return i if root[i] == i else top(root[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in neardup.near_duplicates(df, 4, 80).collect()}
    assert got == {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


def test_near_duplicates_edge_cases(spark):
    assert neardup.near_duplicates(empty(spark)).count() == 0
    df = spark.createDataFrame([(1, "a b"), (2, "A  b"), (2, "c d e"), (3, "c d e"), (None, "a b"), (4, None), (5, "")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in neardup.near_duplicates(df).collect())
    assert got == [(-1, -1, True), (1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True)]
    kept = neardup.without_near_duplicates(frame(spark))
    assert kept.columns == frame(spark).columns and {1, 4, 5, 9} <= {r.doc_id for r in kept.collect()} and not {2, 3, 10} & {r.doc_id for r in kept.collect()}


def test_components_of_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 102), (101, 102)], "a long, b long")
    assert {(r.node, r.root) for r in neardup.components(edges).collect()} == {(i, 0) for i in range(31)} | {(i, 100) for i in (100, 101, 102)}


def test_anchor_runs_cover_every_window():
    r = np.random.default_rng(1)
    first = np.array([0, 0, 30, 130, 131, 400])
    hashes = r.integers(0, 1 << 63, 400).astype(np.uint64)
    begin, end, place = repeats.anchor_runs(hashes, first, 50, 8)
    covered = [p for a, b in zip(begin, end) for p in range(a, b + 1)]
    assert covered == [p for a, b in zip(first, first[1:]) for p in range(a, b - 49)]
    for a, b, m in zip(begin, end, place):
        for p in range(a, b + 1):
            assert m == p + int(np.argmin(hashes[p : p + 43] >> np.uint64(24)))


def test_kept_is_the_smallest_id(spark):
    got = neardup.near_duplicates(frame(spark)).filter(F.col("doc_id").isin(1, 2, 3)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1)}
