import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import packing, rules, sentencepieces
from paperloom.llm.queries import tokenizer_file

from .data import empty, frame

BPE, PIECES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("piece_bpe_32k.model")
_merger = sentencepieces.Merger(PIECES)


def encoded(text):
    """ids of the text's chunks, and the decoded text."""
    chunks = _merger.chunks(text)
    if not chunks:
        return [], ""
    ids, first = _merger.encode(chunks)
    return ids.tolist(), "".join(_merger.decode(ids, first).to_pylist())[1:]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text("the 's”.,(²–«»\n▁", max_size=40))
def test_any_text_encodes_as_the_library_does(text):
    ids, back = encoded(text)
    assert ids == _merger.library.encode(text) and back == _merger.library.decode(ids)


def test_long_chunks_encode_as_the_library_does():
    r = random.Random(0)
    for n in (63, 64, 65, 66, 130, 1000, 5001):
        text = "".join(r.choice("thearison日本") for _ in range(n))
        ids, back = encoded(text)
        assert ids == _merger.library.encode(text) and back == text


def test_a_wrong_merge_is_an_error():
    broken = sentencepieces.Merger(PIECES)
    broken.place[:] = sentencepieces._NONE
    with pytest.raises(ValueError, match="library differs"):
        broken.checked(["▁the", "▁path"])


def test_encode_documents(spark, monkeypatch):
    df = frame(spark)
    got = {r.doc_id: r for r in sentencepieces.encode(df, PIECES).collect()}
    for r in df.collect():
        ids = _merger.library.encode(r.text or "")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids, got[r.doc_id].decoded) == (len(ids), ",".join(map(str, ids)), _merger.library.decode(ids))
    assert sentencepieces.encode(empty(spark), PIECES).count() == 0
    twice = spark.createDataFrame([(1, "the path"), (1, "the path"), (None, "the"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.decoded) for r in sentencepieces.encode(twice, PIECES).collect()) == [(0, "the"), (1, "the path"), (1, "the path"), (2, "")]


def test_packing(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(BPE)
    df = frame(spark, [(1, "don't STOP, it's １２ café...", "en", "s", 1, 0.0, "w", 1)])
    rows = packing.best_fit(df, BPE, with_ids=True).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    want = Counter()
    for r in df.collect():
        ids = np.array(tk.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        for n, a in enumerate(range(0, len(ids), 2048)):
            want[(r.doc_id, n, a, ids[a : a + 2048].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in rows) == want
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.best_fit(empty(spark), BPE).count() == 0


def test_bins_are_best_fit_and_bounded():
    r = random.Random(1)
    bins, left, order = packing.OpenBins(100, 10_000), {}, []
    for _ in range(2000):
        n = r.randrange(1, 101)
        fits = {b: f for b, f in left.items() if f >= n}
        b, offset = bins.place(n)
        if fits:
            assert left[b] == min(fits.values())
        else:
            assert b not in left
        left[b] = left.get(b, 100) - n
        assert offset == 100 - left[b] - n
    small = packing.OpenBins(100, 4)
    for _ in range(500):
        small.place(r.randrange(1, 101))
        order.append(small.n)
    assert max(order) <= 4


def test_rules_against_plain_counts(spark):
    df = frame(spark, [(50, "a b c a b c", "en", "s", 1, 0.0, "w", 1), (51, "a a a a", "en", "s", 1, 0.0, "w", 1), (52, " ".join(f"w{i % 40}" for i in range(200)), "en", "s", 1, 0.0, "w", 1)])
    got = {r.doc_id: r for r in rules.judge(df).collect()}
    for r in df.collect():
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c, cover, seen, dup = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
        for i in range(len(w) - 2):
            if c[tuple(w[i : i + 3])] > 1:
                cover |= {i, i + 1, i + 2}
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        o = got[r.doc_id]
        assert (o.n_words, o.word_chars, o.n_symbols, o.n_dup_lines, o.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)), r.doc_id
        assert o.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (o.base_failed and o.kept)
    assert got[1].kept and got[15].kept and not got[12].kept and rules.judge(empty(spark)).count() == 0


def test_cascade_order_changes_nothing(spark):
    df = frame(spark)
    some = rules.standard_rules()
    a, b = ({(r.doc_id, r.kept) for r in rules.judge(df, x).collect()} for x in (some, some[::-1]))
    assert a == b
    ordered = rules.cascade_order(rules.with_counts(df.select("doc_id", "text").na.fill("")), some)
    assert len(ordered) == len(some) and all(s > 0 and 0 <= p <= 1 for _, s, p in ordered)


_library = packing._tokenizer(BPE)
_LETTERS = "abzJHTWY09iI'. ,!?;:\n İıßẞéÉàÀ̱́̇̌̈̊ʾﬁKÅ 　日<|>"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(_LETTERS, max_size=12) | st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>.", "<|StartOfText|>!", "İ!", "it's.", "J̌?", "x<|endoftext|>y;"]) | st.text(max_size=6), max_size=8), st.sampled_from(["", " ", "\t"]))
def test_any_words_have_the_ids_of_the_library(words, between):
    text = between.join(words)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, "end"])], names=["doc_id", "text"])
    assert [ids.tolist()[:-1] for _, ids in packing.token_ids(BPE, batch)] == [_library.encode(t, add_special_tokens=False).ids for t in (text, "end")]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="normalises"):
        packing._tokenizer(tokenizer_file("byte_bpe_50k.json"))
