import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.llm import lattice, neighbours, quality, toxicity
from paperloom.llm.queries import tokenizer_file

from .data import COLUMNS, empty, frame, prose

MODEL = "piece_bpe_32k.model"


def test_nearest_examples_are_exact():
    r = np.random.default_rng(0)
    texts = [prose(int(r.integers(5, 60)), int(i)) for i in range(400)]
    toxic = np.array([i % 3 == 0 for i in range(400)]).astype(int)
    texts = [t + " vile" * int(y) for t, y in zip(texts, toxic)]
    ix = toxicity.build(np.arange(400), texts, toxic, 0.3, 7)
    dense = np.zeros((400, len(ix.terms)))
    for row, (terms, w) in enumerate(ix.vectors(pa.array([texts[i] for i in ix.ids]))):
        dense[row, terms] = w
    for terms, q in ix.vectors(pa.array(["harbour vile stone", "vile vile", prose(30, 77)])):
        v = np.zeros(len(ix.terms))
        v[terms] = q
        cos = dense @ v
        top, found = ix.nearest(terms, q, 7)
        assert np.allclose(np.sort(cos)[::-1][:7], found) and np.allclose(cos[top], found)


def test_toxicity_learns_and_handles_edges(spark):
    docs = [(i, prose(40, i) + (" scoundrel rotten" if i % 4 == 0 else ""), None, None, None, None, None, None) for i in range(200)] + [(900, None, *[None] * 6), (901, "", *[None] * 6), (None, "scoundrel rotten", *[None] * 6)]
    df = spark.createDataFrame(docs, COLUMNS)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(150)] + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    ix = toxicity.fit(df, labels)
    got = {r.doc_id: r for r in toxicity.score(df, ix).collect()}
    assert all((got[i].score >= 0.5) == (i % 4 == 0) for i in range(200)) and got[900].score == got[901].score < 0.5 <= got[None].score and got[900].neighbours == []
    kept = toxicity.without_toxic(df, ix)
    assert kept.schema == df.schema and {r.doc_id for r in kept.collect()} == {i for i in range(200) if i % 4} | {900, 901}
    nothing = toxicity.fit(empty(spark), labels.filter("false"))
    assert toxicity.score(empty(spark), nothing).count() == 0 and toxicity.score(df, nothing).filter("score >= 0.5").count() == 0


def test_quality_learns_and_handles_edges(spark):
    docs = [(i, prose(60, i) if i % 3 else "BUY!! NOW!! " * 30, "en", f"s{i % 5}", 100, None, None, None) for i in range(240)] + [(900, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(docs, COLUMNS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(160)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, labels)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert all((got[i] >= 0.5) == (i % 3 > 0) for i in range(240)) and 0 <= got[900] <= 1
    assert quality.without_poor(df, model).schema == df.schema
    assert {r.doc_id for r in quality.without_poor(df, model).collect()} >= {i for i in range(240) if i % 3}
    assert quality.fit(df, labels.filter("false")) is None and {r.score for r in quality.score(df, None).collect()} == {0.5} and quality.score(empty(spark), model).count() == 0
    one = quality.fit(df, labels.filter("quality = 1"))
    assert quality.score(df, one).filter("score < 0.5").count() == 0


def brute_marginal(v, pieces, word):
    """All segmentations, in plain Python."""
    s, n = "▁" + word, len(word) + 1
    best = [-math.inf] * (n + 1)
    best[0] = 0.0
    for j in range(1, n + 1):
        parts = []
        for i in range(j):
            x = s[i:j]
            if x in pieces:
                parts.append(best[i] + v.weight[pieces[x]])
            elif len(x) == 1:
                parts.append(best[i] + sum(v.weight[v.by_byte[b]] for b in x.encode()))
        m = max(parts, default=-math.inf)
        best[j] = m + math.log(sum(math.exp(p - m) for p in parts)) if m > -math.inf else m
    return best[n]


def test_lattice_against_plain_recursion_and_counts():
    import sentencepiece

    path = tokenizer_file(MODEL)
    lib, v = sentencepiece.SentencePieceProcessor(model_file=path), lattice.load(path)
    pieces = {lib.id_to_piece(i): i for i in v.entry.tolist()}
    words = ["the", "harbour", "naïve", "日本語", "x" * 70, "﷽", "a", "inter-national", "the"]
    got = lattice.marginals(v, words)
    assert np.allclose(got, [brute_marginal(v, pieces, w) for w in words])
    uses = lattice.expected(v, ["the"], np.array([3.0]))
    total = sum(math.exp(sum(v.weight[pieces[p]] for p in seg)) for seg in segmentations("▁the", pieces))
    assert math.isclose(uses[pieces["▁the"]], 3 * math.exp(v.weight[pieces["▁the"]]) / total)


def segmentations(s, pieces):
    if not s:
        yield []
    for i in range(1, len(s) + 1):
        if s[:i] in pieces:
            for rest in segmentations(s[i:], pieces):
                yield [s[:i], *rest]


@pytest.mark.parametrize("head", [3, 50_000])
def test_lattice_scores(spark, head):
    import re

    df = frame(spark, [(9, "repeated id", "en", "s", 1, 0.0, "w", 1), (None, "no id", "en", "s", 1, 0.0, "w", 1)])
    train = F.col("doc_id") % 3 != 2
    got = lattice.score(df, train, tokenizer_file(MODEL), rounds=1, head=head).collect()
    low = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    rows = df.collect()
    learn = [low(r.text) for r in rows if r.doc_id is not None and r.doc_id % 3 != 2]
    c = {}
    for w in itertools.chain(*learn):
        c[w] = c.get(w, 0) + 1
    n, v = sum(c.values()) + len(learn), len(c) + 1
    want = sorted(((r.doc_id or -1), len(low(r.text)) + 1, sum(w in c for w in low(r.text)) + 1, round(sum(math.log10((c.get(w, 0) + 1) / (n + v + 1)) for w in low(r.text)) + math.log10((len(learn) + 1) / (n + v + 1)), 6)) for r in rows)
    assert sorted(((r.doc_id or -1), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.train_tokens == n for r in got)
    assert lattice.score(empty(spark), train, tokenizer_file(MODEL), rounds=1).count() == 0


def test_neighbours_against_all_pairs(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 16))
    x[7] = x[100] = x[200]  # ties
    rows = [(i, [float(f) for f in v], 1) for i, v in enumerate(x)] + [(500, None, 1), (550, [0.0] * 16, 1), (600, [float("nan")] * 16, 1), (650, [1.0, None] + [1.0] * 14, 1), (None, [1.0] * 16, 1), (700, [float("inf")] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("ids", F.lit("clash"))
    got = {}
    for g in neighbours.search(df, F.col("id") % 50 == 0, 5).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    assert set(got) == {i for i in range(0, 300, 50)}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    for q, found in got.items():
        cos = unit @ unit[q]
        want = sorted((-round(float(c), 9), i) for i, c in enumerate(cos) if i != q)[:5]
        assert [(n, i) for n, i, _ in sorted(found)] == [(n + 1, i) for n, (_, i) in enumerate(want)]
        assert all(math.isclose(s, cos[i], rel_tol=1e-12) for _, i, s in found)
    few = neighbours.search(df.filter("vec_id < 3"), F.col("id") == 0, 5).collect()
    assert len(few) == 2 and neighbours.search(df.filter("false"), F.col("id") == 0, 5).count() == 0


def test_quantisation_bound_holds():
    r = np.random.default_rng(3)
    a, b = r.normal(size=(50, 33)), r.standard_cauchy(size=(60, 33))
    qa, sa, ea = neighbours.quantise(a)
    qb, sb, eb = neighbours.quantise(b)
    about = neighbours.products(qa, qb) * sa[:, None] * sb[None, :]
    true = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
    assert (np.abs(about - true) <= ea[:, None] + eb[None, :] + ea[:, None] * eb[None, :] + 1e-9).all()


def test_split_is_crc32_of_the_id(spark):
    from paperloom.llm.common import hash_mod

    df = spark.range(50).select(F.col("id").alias("doc_id"))
    assert all(r.m == zlib.crc32(str(r.doc_id).encode()) % 7 for r in df.select("doc_id", hash_mod(F.col("doc_id"), 7).alias("m")).collect())
