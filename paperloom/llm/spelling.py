"""Spelling variant grouping: each word's whole neighbourhood at one edit, met with the vocabulary by a hash join.

All distinct deletions, replacements and insertions over the alphabet that the vocabulary shows are generated, so whatever
meets a word of the vocabulary is near it, and no distance is worked out. A filter over the vocabulary's hashes sifts the
generated strings first: their hashes follow from prefix sums of the word's own, and only those that pass are spelled out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import filters
from .common import documents, lean, materialise

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hashes that one numpy step works out.
STEP = 1 << 20


def runs(docs: DataFrame) -> DataFrame:
    """doc_id and each maximal run of letters, A-Z lower-cased. Null and empty texts have none."""
    return documents(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def slipped(run: Column, doc_id: Column, one_in: int = 97) -> Column:
    """The run without one of its code points where ``one_in`` divides the crc32 of "<doc_id>:<run>" (a null doc_id counts as ''); else the run."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """word and n of the distinct words of ``least_length`` code points or more with ``least_count`` occurrences or more. words: word."""
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _latin(word: str) -> Column:
    """One byte for each code point; none is above U+00FF."""
    return F.encode(word, "ISO-8859-1")


def neighbourhood(batch: np.ndarray, alphabet: np.ndarray, kept, least: int):
    """(places of words, matrix of strings) for all distinct strings at one edit from the words, of one length, in the rows of ``batch``, that ``kept`` lets through.

    ``kept`` gives the places in an array of hashes that may stay; strings shorter than ``least`` are left out. The same
    string never comes twice for a word: of equal neighbours only the first is deleted, and no letter is put after its like.
    """
    m, size = batch.shape
    power = filters.powers(size + 1)
    terms = (batch.astype(np.uint64) + np.uint64(1)) * power[:size]
    before = np.zeros((m, size + 1), np.uint64)
    np.add.accumulate(terms, axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    differs = np.ones((m, size), bool)
    differs[:, 1:] = batch[:, 1:] != batch[:, :-1]
    place = np.arange(size + 1)
    if size - 1 >= least:
        shorter = before[:, :-1] + (whole - before[:, 1:]) * np.uint64(filters.INVERSE)
        word, at = _chosen(shorter, differs, kept)
        if len(word):
            yield word, np.take_along_axis(batch[word], place[None, : size - 1] + (place[None, : size - 1] >= at[:, None]), 1)
    moved = before + (whole - before) * np.uint64(filters.BASE)
    for letter in alphabet:
        if size >= least:
            word, at = _chosen(whole + (np.uint64(letter) + np.uint64(1)) * power[:size] - terms, batch != letter, kept)
            if len(word):
                out = batch[word]
                out[np.arange(len(word)), at] = letter
                yield word, out
        fresh = np.ones((m, size + 1), bool)
        fresh[:, 1:] = batch != letter
        word, at = _chosen(moved + (np.uint64(letter) + np.uint64(1)) * power, fresh, kept)
        if len(word):
            out = np.take_along_axis(batch[word], np.minimum(place[None, :] - (place[None, :] > at[:, None]), size - 1), 1)
            out[np.arange(len(word)), at] = letter
            yield word, out


def _chosen(hashed: np.ndarray, allowed: np.ndarray, kept) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the allowed hashes that ``kept`` lets through."""
    found = kept(hashed.ravel())
    found = found[allowed.ravel()[found]]
    return found // hashed.shape[1], found % hashed.shape[1]


def near(words: DataFrame, least_length: int = 5) -> DataFrame:
    """word, near and near_n for all pairs of words that differ by one inserted, deleted or replaced code point. words: word (distinct), n, written down.

    The alphabet is that of the words themselves (at most 154 code points, by the shape of a run); the filter's bound is
    that of ``filters``. Each pair comes once in each direction.
    """
    spark = words.sparkSession
    own = words.select("word", _latin("word").alias("key"))
    letters = own.mapInArrow(_letters, "letter int").distinct().collect()
    alphabet = np.array(sorted(r.letter for r in letters), np.uint8)

    def hashed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(filters.hashes(batch.column(0)).view(np.int64))], names=["h"])

    words_of, shift = filters.build(own.select("key").mapInArrow(hashed, "h long"), "h")
    shared = spark.sparkContext.broadcast(words_of)

    def run(batches):
        kept = lambda h: filters.maybe(shared.value, shift, h)
        for batch in batches:
            flat, offsets = filters.parts(batch.column(1))
            sizes = np.diff(offsets)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                step = max(1, STEP // int(size + 1))
                for a in range(0, len(rows), step):
                    part = rows[a : a + step]
                    matrix = flat[offsets[part][:, None] + np.arange(size)[None, :]]
                    for word, strings in neighbourhood(matrix, alphabet, kept, least_length):
                        ends = np.arange(len(word) + 1, dtype=np.int32) * strings.shape[1]
                        keys = pa.Array.from_buffers(pa.binary(), len(word), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(strings))])
                        yield pa.RecordBatch.from_arrays([keys, batch.column(0).take(pa.array(part[word]))], names=["key", "word"])

    # Words lie side by side in few files; their neighbourhoods are the work, so they are dealt out.
    dealt = own.repartition(max(spark.sparkContext.defaultParallelism * 2, int(spark.conf.get("spark.sql.shuffle.partitions"))), "word")
    made = dealt.mapInArrow(lean(run), "key binary, word string")
    return made.join(words.select(_latin("word").alias("key"), F.col("word").alias("near"), F.col("n").alias("near_n")), "key").select("word", "near", "near_n")


def _letters(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(filters.parts(batch.column(1))[0]).astype(np.int32))], names=["letter"])


def forms(words: DataFrame, pairs: DataFrame, times: int = 2) -> DataFrame:
    """word, n, n_near, form and form_n: the near word of the largest n (ties: the smallest in code-point order) if it is at least ``times`` the word's n."""
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    d = words.join(best, "word", "left").withColumn("form_n", -F.col("best.m")).withColumn("ok", F.col("form_n") >= times * F.col("n"))
    return d.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("ok"), F.col("best.near")).alias("form"), F.when(F.col("ok"), F.col("form_n")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """Adds root: from a word, follow forms to the last; the word itself if it has none. found: word, form, written down.

    n at least doubles with each form, so a chain is no longer than the binary logarithm of the largest n; steps double too.
    """
    links = found.filter("form is not null").select("word", F.col("form").alias("to"))
    while True:
        ahead = links.select(F.col("word").alias("to"), F.col("to").alias("further"))
        step = materialise(links.join(ahead, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        links = step.select("word", "to")
        if step.filter("moved").isEmpty():
            break
    return found.join(links, "word", "left").withColumn("root", F.coalesce("to", "word")).drop("to")


def variants(docs: DataFrame, one_in: int = 97, least_length: int = 5, least_count: int = 3, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of the texts' runs of letters.

    Null and empty texts have no words, empty tables give no rows, repeated rows count as often as they come, a null doc_id
    counts as '' in the checksum; other columns are ignored. A run of any length is a word; one of L code points has about
    2 * L * (letters of the alphabet) neighbours, worked out letter by letter.
    """
    words = materialise(vocabulary(runs(docs).select(slipped(F.col("run"), F.col("doc_id"), one_in).alias("word")), least_length, least_count))
    found = materialise(forms(words, near(words, least_length), times))
    return roots(found).select("word", "form", "root", "n", "n_near", "form_n")
