"""Operators against plain versions that leave nothing out."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.llm import neardup, neighbours, quality, toxicity

from .data import COLUMNS, prose


def test_nearest_examples_over_the_whole_vocabulary():
    n, k = 200, 7
    toxic = np.array([i % 4 == 0 for i in range(n)]).astype(int)
    texts = [prose(20 + i % 30, i) + (" vile" if y else "") for i, y in enumerate(toxic)]
    ix = toxicity.build(np.arange(n), texts, toxic, 0.25, k)
    sets = [Counter(t.lower().split()) for t in texts]
    df = Counter(w for s in sets for w in s)
    bad = Counter(w for s, y in zip(sets, toxic) if y for w in s)

    def weight(w):
        if w not in df:
            return math.log(1 + n)
        spread = df[w] * 0.25 * 0.75 * (1 - df[w] / n)
        chi = (bad[w] - df[w] * 0.25) ** 2 / spread if spread else 0
        return math.log(1 + n / df[w]) * (1 + chi)

    def unit(s):
        v = {w: (1 + math.log(c)) * weight(w) for w, c in s.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    assert set(ix.terms) == set(df)
    examples = [unit(s) for s in sets]
    # No word of the second tells the labels apart; the third has words that no example has.
    queries = ["harbour vile stone", "window lantern meadow", "harbour unheard unheard of silver", prose(30, 777), texts[3]]
    for text, (terms, q) in zip(queries, ix.vectors(pa.array(queries))):
        v = unit(Counter(text.lower().split()))
        cos = {i: sum(x * e.get(w, 0) for w, x in v.items()) for i, e in enumerate(examples)}
        top, found = ix.nearest(terms, q, k)
        assert len(top) == k and found == pytest.approx(sorted(cos.values(), reverse=True)[:k])
        assert [cos[i] for i in ix.ids[top].tolist()] == pytest.approx(found.tolist())


def test_co_training_reaches_all_unlabelled_rows_and_gives_each_once(spark, monkeypatch):
    docs = [(i, prose(30, i) if i % 3 else "BUY!! NOW!! " * (9 + i % 7), "en", f"s{i % 3}", 100, None, None, None) for i in range(5000)]
    df = spark.createDataFrame(docs, COLUMNS).repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    seen, rounds = [], []
    make = quality.surest_of

    def watched(free):
        seen.append(free.count())
        ask = make(free)

        def surest(models, given, most):
            rows = free.collect()
            found = ask(models, given, most)
            for v in ("text", "meta"):
                p = {r.key: float(models[v].logit(np.frombuffer(r[f"{v}_view"], np.float32)[None])[0]) for r in rows if r.key not in given[v]}
                for c in (0, 1):
                    sure = sorted((-abs(x), k) for k, x in p.items() if abs(x) >= math.log(19) and (x > 0) == c)[: most[c]]
                    mine = [(-abs(p[k]), k) for k, y, _ in found[v] if y == c]
                    assert [d for d, _ in sorted(mine)] == pytest.approx([d for d, _ in sure])
            rounds.append({v: [k for k, _, _ in found[v]] for v in found})
            return found

        return surest

    monkeypatch.setattr(quality, "surest_of", watched)
    assert quality.fit(df, labels, rounds=3) is not None
    assert seen == [4760] and len(rounds) == 3
    for v in ("text", "meta"):
        assert len(rounds[0][v]) == quality.GIVEN == len(rounds[2][v])  # later rounds pass as many new rows
        every = [k for r in rounds for k in r[v]]
        assert len(every) == len(set(every))


def test_a_repeated_query_row_keeps_all_its_neighbours(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(60, 8))
    other = r.normal(size=8)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist()), (1, other.tolist()), (2, x[2].tolist()), (2, x[2].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for g in neighbours.search(df, F.col("id") < 2, 5).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, round(g.score, 9)))

    def nearest(i, v):
        cos = sorted((-float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), j) for j, w in rows if j != i)
        return [(n + 1, j, round(-c, 9)) for n, (c, j) in enumerate(cos[:5])]

    assert sorted(got[0]) == nearest(0, x[0])
    assert sorted(got[1]) == sorted(nearest(1, x[1]) + nearest(1, other))


def test_every_text_of_a_doc_id_is_compared_on_its_own_set(spark):
    first, other, third = (prose(120, i).split() for i in (51, 52, 53))
    near = lambda words: " ".join([*words[:5], "changed", *words[6:]])
    texts = [(1, " ".join(first)), (1, " ".join(other)), (1, " ".join(third)), (2, near(first)), (3, near(other)), (4, near(third)), (5, prose(120, 54)), (5, prose(120, 54))]
    df = spark.createDataFrame([(i, t, *[None] * 6) for i, t in texts], COLUMNS)
    assert {(r.doc_id, r.component_id) for r in neardup.near_duplicates(df).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 5)}
    kept = neardup.without_near_duplicates(df)
    assert kept.schema == df.schema and sorted((r.doc_id, r.text) for r in kept.collect()) == sorted({t for t in texts if t[0] in (1, 5)})


def _nearest(rows, queries, k):
    def cos(a, b):
        a, b = (np.asarray(x, float) / np.abs(x).max() for x in (a, b))
        return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))

    return {q: sorted((-cos(v, w), j) for j, w in rows if j != q and len(w) == len(v))[:k] for q, v in rows if q in queries}


@pytest.mark.parametrize("kind", ["double", "float"])
def test_near_ties_in_wide_vectors(spark, kind):
    """Beyond 1,040 dimensions, with cosines that differ less than 8-bit steps do."""
    r = np.random.default_rng(8)
    base = r.normal(size=1536)
    rows = [(i, np.float32(base + r.normal(size=1536) * 1e-3 * (1 + i % 7)).tolist()) for i in range(300)]
    got = {}
    for g in neighbours.search(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3), F.col("id") % 50 == 0, 5).collect():
        got.setdefault(g.query_id, {})[g["rank"]] = (g.vec_id, g.score)
    want = _nearest(rows, set(range(0, 300, 50)), 5)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [got[q][n][0] for n in range(1, 6)] == [j for _, j in near] and [got[q][n][1] for n in range(1, 6)] == pytest.approx([-c for c, _ in near], abs=1e-14)


def test_more_queries_than_a_tile(spark, monkeypatch):
    r = np.random.default_rng(9)
    rows = [(i, r.integers(-3, 4, 24).astype(float).tolist()) for i in range(2600)]
    rows = [(i, v if any(v) else [1.0] * 24) for i, v in rows]
    got = {}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for g in neighbours.search(df, F.col("id") < 1300, 3).collect():
        got.setdefault(g.query_id, {})[g["rank"]] = round(g.score, 12)
    x = np.array([v for _, v in rows])
    x /= np.sqrt((x * x).sum(1))[:, None]
    c = x[:1300] @ x.T
    c[np.arange(1300), np.arange(1300)] = -2
    assert len(got) == 1300
    for q in range(1300):
        assert [got[q][n] for n in (1, 2, 3)] == pytest.approx(sorted(c[q])[::-1][:3], abs=1e-9)


def test_odd_vectors(spark):
    """Nulls, zeros, non-finite components and huge ones; lengths apart; ties to the smaller id; fewer candidates than k."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [2.0, 0.0]), (3, [3.0, 0.0]), (7, [1e200, 1e200]), (8, [1e-200, 0.0]), (9, [0.0, 0.0]), (10, None), (11, [1.0, None]), (12, [nan, 1.0]), (13, [inf, 1.0]), (14, []), (None, [1.0, 0.0]), (50, [1.0, 1.0, 1.0]), (100, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((g.query_id, g["rank"], g.vec_id, round(g.score, 12)) for g in neighbours.search(df, F.col("id") % 50 == 0, 5).collect())
    assert got == [(0, 1, 3, 1.0), (0, 2, 5, 1.0), (0, 3, 8, 1.0), (0, 4, 7, round(0.5**0.5, 12))]
    assert neighbours.search(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_products_are_exact():
    r = np.random.default_rng(2)
    a, b = (np.where(r.random((9, 5000)) < 0.9, 127, r.integers(-127, 128, (9, 5000))).astype(np.int8) for _ in range(2))
    assert (neighbours.products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()
