"""The lattice score learns: it is held against the word-count base on rows that training has not seen."""

import math

from pyspark.sql import functions as F

from paperloom.llm import lattice
from paperloom.llm.queries import QUERIES, tokenizer_file


def test_held_out_scores_are_not_far_below_the_base(spark, sf):
    rows = QUERIES["op3_lattice_score"](spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert held and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    # New words have to be spelt out, which the base has for one word's price; so not above it, but near.
    assert sum(r.score for r in held) > 1.5 * sum(r.base_score for r in held)
    assert all(r.score > r.adapted_score for r in held if r.n_known > r.n_tokens / 2)


def test_known_and_new_words_share_all_probability(spark):
    docs = spark.createDataFrame([(1, "roe roe poe"), (2, "poe coe"), (3, "roe new")], "doc_id long, text string")
    rows = {r.doc_id: r for r in lattice.score(docs, F.col("doc_id") < 3, tokenizer_file("piece_bpe_32k.model"), rounds=1).collect()}
    n, types, discount = 7, 4, (1 + 1) / (1 + 2 * 2 + 2)
    left = discount * types / n
    entries = {w: x / math.log(10) for w, x in zip(("roe", "new"), _adapted(spark, docs))}
    known = math.log10((2 - discount) / n + left * 10 ** entries["roe"])
    end = math.log10((2 - discount) / n + left * 10 ** (rows[3].adapted_score - entries["roe"] - entries["new"]))
    assert math.isclose(rows[3].lexicon_score, known + math.log10(left) + entries["new"] + end, abs_tol=1e-9)


def _adapted(spark, docs):
    counts = lattice.word_counts(docs, F.col("doc_id") < 3).filter("c > 0")
    return lattice.marginals(lattice.learn(counts, 2, lattice.load(tokenizer_file("piece_bpe_32k.model")), 1), ["roe", "new"])


def test_untrained_scores_are_finite(spark):
    docs = spark.createDataFrame([(1, "roe " + "\ufdfd" * 300), (2, None)], "doc_id long, text string")
    for train in (F.lit(False), F.col("doc_id") == 2):
        assert all(math.isfinite(r.lexicon_score) for r in lattice.score(docs, train, tokenizer_file("piece_bpe_32k.model"), rounds=1).collect())
