"""Every registered query, and the pipeline, over a small table of odd rows, against plain versions in Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperloom.llm import lattice, quality, toxicity
from paperloom.llm.queries import QUERIES, tokenizer_file

from .data import frame, prose
from .test_dedup import shingles
from .test_models import brute_marginal

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
CLASHES = ("text_", "id_", "component_id", "kept", "_kept", "node", "hash", "ids", "n_words", "serial", "y")


def more_rows():
    """Documents with bad words, poor ones, copies, near copies, a repeated doc_id and one without an id."""
    r, out = random.Random(1), []
    shared = prose(70, 500)
    for i in range(100, 190):
        text = prose(r.randrange(30, 90), i)
        if i % 5 == 0:
            text += " scoundrel rotten"
        if i % 7 == 0:
            text = "BUY!! NOW!! " * r.randrange(20, 40)
        if i % 11 == 0:
            text += "\n" + shared
        out.append((i, text, "en", f"s{i % 3}", len(text), 0.0, "w", 1))
    out += [(200, out[1][1], "de", "s1", 5, 0.0, "w", 1), (200, out[2][1], None, None, None, None, None, None), (None, out[3][1], "en", "s1", 5, 0.0, "w", 1), (201, out[8][1].replace("the", "that", 1), "en", "s2", 1, 0.0, "w", 1)]
    return out


@pytest.fixture(scope="module")
def at(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("tables"))
    docs = frame(spark, more_rows())
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit("clash"))
    docs.write.parquet(f"{top}/documents.parquet")
    labels = [(i, int(i % 7 != 0), int(i % 5 == 0)) for i in range(100, 180)] + [(1, 1, None), (None, 0, 1), (3, None, 0), (999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    r = np.random.default_rng(0)
    x = r.integers(-2, 3, (160, 6)).astype(float)
    x[x.sum(1) == 0] = 0
    vectors = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, None), (350, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (400, [float("nan")] * 6)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>").write.parquet(f"{top}/embeddings.parquet")
    for name in ("documents", "labels", "embeddings"):
        spark.read.parquet(f"{top}/{name}.parquet").limit(0).write.parquet(f"{top}/none/{name}.parquet")
    return top


@pytest.fixture(scope="module")
def docs(spark, at):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{at}/documents.parquet").collect()]


def crc(i, n):
    return zlib.crc32(b"" if i is None else str(i).encode()) % n


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, at, name):
    assert QUERIES[name](spark, f"{at}/none").count() == 0


def plain_toxicity(docs, labels, k=24):
    """score and neighbours of every text, by all pairs."""
    by_id = {}
    for i, t in docs:
        by_id[i] = min(by_id.get(i, t), t)
    chosen = {i: y for i, y in labels.items() if i in by_id}
    terms = lambda t: Counter(w.lower().strip(toxicity._TRIM) for w in WORDS(t))
    sets = {i: terms(by_id[i]) for i in chosen}
    df, bad = Counter(w for s in sets.values() for w in s), Counter(w for i, s in sets.items() if chosen[i] for w in s)
    n, share = len(sets), sum(chosen.values()) / len(sets)

    def weight(w):
        if not df[w]:
            return math.log(1 + n)
        spread = df[w] * share * (1 - share) * (1 - df[w] / n)
        return math.log(1 + n / df[w]) * (1 + ((bad[w] - df[w] * share) ** 2 / spread if spread else 0))

    def unit(s):
        v = {w: (1 + math.log(c)) * weight(w) for w, c in s.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    examples = {i: unit(s) for i, s in sets.items()}

    def near(v, skip=None):
        cos = [(sum(x * e.get(w, 0) for w, x in v.items()), i) for i, e in examples.items() if i != skip]
        return [(c, i) for c, i in sorted(cos, key=lambda x: (-round(x[0], 10), x[1]))[:k] if c > 0]

    def vote(found):
        w = [c * c / (1.02 - min(c, 1)) for c, _ in found]
        return sum(x for x, (_, i) in zip(w, found) if chosen[i]) / max(sum(w), 1e-12) if found else 0.0

    raw = {i: vote(near(v, i)) for i, v in examples.items()}
    natural = sum(labels.values()) / len(labels)
    each = np.array([natural / share if chosen[i] else (1 - natural) / (1 - share) for i in raw])
    a, b = toxicity.logistic(np.array(list(raw.values())), np.array([float(chosen[i]) for i in raw]), each)
    out = []
    for i, t in docs:
        found = near(unit(terms(t)))
        out.append((i, 1 / (1 + math.exp(-(a * vote(found) + b))), [j for _, j in found]))
    return out


def test_op1(spark, at, docs):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{at}/labels.parquet").dropna(subset=["doc_id", "toxic"]).collect() if crc(r.doc_id, 5)}
    got = sorted(((r.doc_id or -1, round(r.score, 8), r.held_out, r.predicted, r.neighbours) for r in QUERIES["op1_toxicity"](spark, at).collect()), key=str)
    want = sorted(((i or -1, round(s, 8), crc(i, 5) == 0, int(s >= 0.5), near) for i, s, near in plain_toxicity(docs, labels)), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == [w[4] for w in want]


def plain_quality(spark, at, learn=lambda i: True):
    """Scores of rows by the same co-training, with rows chosen by sorting all of them."""
    every = quality._columns(spark.read.parquet(f"{at}/documents.parquet")).collect()
    labels = spark.read.parquet(f"{at}/labels.parquet").collect()
    named = {r.doc_id for r in labels if r.doc_id is not None}
    y = {r.doc_id: r.quality for r in labels if r.doc_id is not None and r.quality is not None and learn(r.doc_id)}
    text = quality.text_view(pa.array([r.text for r in every]))
    meta = quality.meta_view(*([r[c] for r in every] for c in ("lang", "source", "n_chars")))
    place = {}
    for n, r in enumerate(every):
        place.setdefault(r.doc_id, n)
    ids = sorted(i for i in y if i in place)
    free = {(r.doc_id, text[n].tobytes(), meta[n].tobytes()): n for n, r in enumerate(every) if r.doc_id is not None and r.doc_id not in named}

    def surest(models, given, most):
        out = {}
        for v, x in (("text", text), ("meta", meta)):
            logit = {key: float(models[v].logit(x[n][None])[0]) for key, n in free.items() if key not in given[v]}
            sure = {c: sorted((-abs(q), key) for key, q in logit.items() if abs(q) >= math.log(19) and (q > 0) == c)[: most[c]] for c in (0, 1)}
            out[v] = [(key, c, {"text": text[free[key]], "meta": meta[free[key]]}) for c in (0, 1) for _, key in sure[c]]
        return out

    rows = [place[i] for i in ids]
    model = quality.co_train(text[rows], meta[rows], np.array([float(y[i]) for i in ids]), surest, np.arange(len(ids)) % 4 == 0)

    def scores(rows):
        return model.score(quality.text_view(pa.array([r.text or "" for r in rows])), quality.meta_view(*([r[c] for r in rows] for c in ("lang", "source", "n_chars"))))[2].tolist()

    return scores


def test_op2(spark, at):
    rows = spark.read.parquet(f"{at}/documents.parquet").collect()
    got = sorted((r.doc_id or -1, round(r.score, 6), r.held_out, r.predicted) for r in QUERIES["op2_quality_classifier"](spark, at).collect())
    want = sorted((i or -1, round(s, 6), crc(i, 5) == 0, int(s >= 0.5)) for i, s in zip([r.doc_id for r in rows], plain_quality(spark, at, lambda i: crc(i, 5))(rows)))
    assert [(g[0], *g[2:]) for g in got] == [(w[0], *w[2:]) for w in want] and [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-5)


def test_op3(spark, at, docs):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    lib, v = sentencepiece.SentencePieceProcessor(model_file=path), lattice.load(path)
    entries = {lib.id_to_piece(i): i for i in v.entry.tolist()}
    low = lambda t: WORDS("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    learn = [low(t) for i, t in docs if crc(i, 7) != 2]
    count = Counter(w for t in learn for w in t)
    n, size = sum(count.values()) + len(learn), len(count) + 1
    mass = {w: brute_marginal(v, entries, w) for w in {w for _, t in docs for w in low(t)}}
    base = lambda c: math.log10((c + 1) / (n + size + 1))
    want = sorted((i or -1, crc(i, 7) == 2, len(low(t)) + 1, sum(w in count for w in low(t)) + 1, n, round(sum(base(count[w]) for w in low(t)) + base(len(learn)), 6), round((sum(mass[w] for w in low(t)) + v.end) / math.log(10), 6)) for i, t in docs)
    got = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in QUERIES["op3_lattice_score"](spark, at).collect())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], abs=1e-5)


def plain_components(docs, size, percent=80):
    """doc_id to the smallest doc_id that links reach; texts of one doc_id are together."""
    sets = [(i, shingles(t, size)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def top(i):
        return i if root[i] == i else top(root[i])

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in sets}


def test_op4(spark, at, docs):
    of = plain_components(docs, 4)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in QUERIES["op4_minhash_neardup"](spark, at).collect())
    assert got == sorted((i or -1, len(shingles(t, 4)), of.get(i, -1), i is None or of[i] == i) for i, t in docs)


def kept_of(docs, units, key, window):
    """(doc_id, units, marks) of each row; rows of one doc_id take nothing from each other."""
    firsts = {}
    for i, t in docs:
        u = units(t)
        for p in range(len(u) - window + 1):
            w = key(u[p : p + window])
            if i is not None:
                firsts[w] = min(firsts.get(w, i), i)
    out = []
    for i, t in docs:
        u = units(t)
        marks = [False] * len(u)
        for p in range(len(u) - window + 1):
            if i is not None and firsts[key(u[p : p + window])] < i:
                marks[p : p + window] = [True] * window
        out.append((i, u, marks))
    return out


def test_op5(spark, at, docs):
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_dedup"](spark, at).collect())
    runs = lambda m: sum(b and not a for a, b in zip([False, *m], m))
    assert got == sorted((i or -1, len(u), sum(m), runs(m), sha(bytes(x for x, g in zip(u, m) if not g))) for i, u, m in kept_of(docs, str.encode, bytes, 50))


def test_op9(spark, at, docs):
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op9_substring_dedup"](spark, at).collect())
    assert got == sorted((i or -1, len(u), sum(m), sha(" ".join(x for x, g in zip(u, m) if not g))) for i, u, m in kept_of(docs, WORDS, tuple, 50))


def test_op6(spark, at):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{at}/embeddings.parquet").collect()]
    rows = [(i, np.array(v)) for i, v in rows if v and None not in v and all(map(math.isfinite, v)) and any(v)]
    cos = lambda a, b: float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
    want = [(i, n + 1, j, -c) for i, v in rows if i % 50 == 0 for n, (c, j) in enumerate(sorted((-cos(v, w), j) for j, w in rows if j != i)[:5])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in QUERIES["op6_nearest_neighbours"](spark, at).collect()) == want


def test_op7(spark, at, docs):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want, total = Counter(), 0
    for i, t in docs:
        ids = np.array(tk.encode(t, add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        want.update((i, n, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for n, a in enumerate(range(0, len(ids), 2048)))
    rows = QUERIES["op7_best_fit_packing"](spark, at).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(bins) <= -(-total // 2048) + 1


def test_op8(spark, at, docs):
    import regex

    want = []
    for i, t in docs:
        w, lines = WORDS(t), t.split("\n")
        grams = Counter(zip(w, w[1:], w[2:]))
        again = {p + k for p in range(len(w) - 2) if grams[tuple(w[p : p + 3])] > 1 for k in range(3)}
        full = [x for x in lines if WORDS(x)]
        n, chars, symbols, twice = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full))
        failed = n < 50 or 100 * len(again) > 50 * n
        bad = (
            10 * symbols > n or chars < 2 * n or chars > 20 * n or (twice >= 2 and 10 * twice > 3 * len(lines)) or len(t) - len(t.replace("!!", "!")) > 0.3 * n
            or 10 * len(regex.findall(r"[\p{L}\p{M}]", t)) < 5 * chars or 2 * len(regex.findall(r"\p{Lu}", t)) > chars
        )
        want.append((i or -1, n, chars, symbols, twice, len(again), failed, not (failed or bad)))
    got = QUERIES["op8_quality_rules"](spark, at).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == sorted(want)


def test_op10(spark, at, docs):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    want = sorted((i or -1, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))) for i, t in docs for ids in [lib.encode(t)])
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op10_sentencepiece"](spark, at).collect()) == want


def test_pipeline_stage_by_stage(spark, at):
    """What each stage keeps of its own input, against plain versions; the last one packs what is left."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "substrings", "packing"]
    table = spark.read.parquet(f"{at}/documents.parquet")
    whole = lambda rows: Counter(tuple(r) for r in rows)
    texts = lambda rows: [(r.doc_id, r.text or "") for r in rows]
    tox, qual, near, sub, pack = (f for _, f in corpus_pipeline.STAGES)

    given = table.collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{at}/labels.parquet").dropna(subset=["doc_id", "toxic"]).collect()}
    kept = tox(spark, table, at)
    assert kept.schema == table.schema
    clean = [r for r, (_, s, _) in zip(given, plain_toxicity(texts(given), labels)) if s < 0.5]
    assert whole(kept.collect()) == whole(clean) and len(clean) < len(given)

    kept = spark.createDataFrame(clean, table.schema)
    good = qual(spark, kept, at)
    assert good.schema == table.schema
    rows = good.collect()
    assert whole(rows) == whole([r for r, q in zip(clean, plain_quality(spark, at)(clean)) if q >= 0.5]) and 60 < len(rows) < len(clean)

    of = plain_components(texts(rows), 5)
    single = near(spark, spark.createDataFrame(rows, table.schema), at)
    assert single.schema == table.schema
    assert whole(single.collect()) == whole({tuple(r) for r in rows if r.doc_id is not None and of[r.doc_id] == r.doc_id}) + whole([r for r in rows if r.doc_id is None])

    rows = single.collect()
    cut = sub(spark, spark.createDataFrame(rows, table.schema), at)
    assert cut.schema == table.schema
    want = Counter((i, tuple(x for x, g in zip(u, m) if not g)) for i, u, m in kept_of(texts(rows), WORDS, tuple, 50))
    assert Counter((r.doc_id, tuple(WORDS(r.text or ""))) for r in cut.collect()) == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    packed = pack(spark, cut, at).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows} and max(r.offset + r.length for r in packed) <= 2048


def test_pipeline_runs(spark, at):
    rows = corpus_pipeline.run(spark, at).collect()
    assert len(rows) > 40 and not {i for i in range(100, 190) if i % 5 == 0 or i % 7 == 0 and i % 11} & {r.doc_id for r in rows}
    assert corpus_pipeline.run(spark, f"{at}/none").count() == 0


def test_held_out_labels_change_nothing(spark, at, tmp_path):
    docs = spark.read.parquet(f"{at}/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r.doc_id, r.quality if crc(r.doc_id, 5) else 1 - (r.quality or 0), r.toxic if crc(r.doc_id, 5) else 1 - (r.toxic or 0)) for r in spark.read.parquet(f"{at}/labels.parquet").collect()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op1_toxicity", "op2_quality_classifier"):
        a, b = (sorted((r.doc_id or -1, round(r.score, 9)) for r in QUERIES[name](spark, x).collect()) for x in (at, str(tmp_path)))
        assert a == b


def test_expensive_rules_go_last(spark):
    from paperloom.llm import rules

    df = rules.with_counts(spark.createDataFrame([(i, prose(60, i)) for i in range(400)], "doc_id long, text string"))
    dear = F.length(F.sha2(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.sha2(F.concat("text", i.cast("string")), 512))), 512)) > 0
    found = rules.cascade_order(df, [rules.Rule("dear", dear & (F.col("n_words") > 0)), rules.Rule("cheap", F.expr("n_words > 0")), rules.Rule("never", F.expr("n_words < 0"))])
    assert [r.name for r, _, _ in found][0] == "cheap" and {r.name: round(x, 3) for r, _, x in found} == {"dear": 1.0, "cheap": 1.0, "never": 0.0}
    cost = {r.name: s for r, s, _ in found}
    assert cost["dear"] > 5 * cost["cheap"]
