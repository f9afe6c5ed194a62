"""The thin queries over the training-data operators: fixed tables, splits and digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, factors, lattice, neardup, neighbours, packing, quality, rules, secret_scan, sentencepieces, spelling, suffixes, toxicity
from .common import hash_mod, table
from .oracles import ORACLE_SQL  # noqa: F401  part of what this module offers


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, key = table(spark, sf_dir, "documents"), F.col("doc_id")
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"), hash_mod(key, 5) != 0)
    held_out, predicted = (hash_mod(key, 5) == 0).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted")
    return toxicity.score(docs, index).select("doc_id", held_out, "score", predicted, "neighbours")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, key = table(spark, sf_dir, "documents"), F.col("doc_id")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), hash_mod(key, 5) != 0)
    held_out, predicted = (hash_mod(key, 5) == 0).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted")
    return quality.score(docs, model).select("doc_id", held_out, "score", predicted, "text_score", "meta_score")


def op3_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, key = table(spark, sf_dir, "documents"), F.col("doc_id")
    found = lattice.score(docs, hash_mod(key, 7) != 2, tokenizer_file("piece_bpe_32k.model"))
    shown = "doc_id", (hash_mod(key, 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", F.col("lexicon_score").alias("score")
    return found.select(*shown, "adapted_score", F.col("score").alias("vocabulary_score"))


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.suffix_dedup(table(spark, sf_dir, "documents"), window=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), length=2048)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = factors.factor_dedup(table(spark, sf_dir, "documents"), window=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepieces.encode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return found.select("doc_id", "n_tokens", F.sha2(F.encode("ids", "utf-8"), 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_quality_classifier, op3_lattice_score, op4_minhash_neardup, op5_suffix_dedup, op6_nearest_neighbours, op7_best_fit_packing, op8_quality_rules, op9_substring_dedup, op10_sentencepiece,
    op11_spelling_variants, op12_collocations, op13_secret_scan,
)}
