"""Shared plumbing of the training-data operators: tables, the shared work folder, Arrow batches of text."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Bytes of text that one numpy step handles; larger Arrow batches are cut, single longer texts are not.
STEP_BYTES = 4_000_000
#: Bytes of an Arrow batch between Spark and Python: both hold a few at a time, beside all else that a task needs.
BATCH_BYTES = 8_000_000
#: Bytes of a row group of tables with large rows.
GROUP_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``. Where it is unset, a session on one machine gets a temporary one; a cluster is refused."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "PAPERLOOM_WORK" not in os.environ:
        os.environ["PAPERLOOM_WORK"] = tempfile.mkdtemp(prefix="paperloom-")
        atexit.register(shutil.rmtree, os.environ["PAPERLOOM_WORK"], True)
    return os.environ["PAPERLOOM_WORK"]


def materialise(df: DataFrame, codec: str = "none", large: bool = False) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there, and lost executors lose nothing.

    Many small tables are written as they are: a codec's native buffers for each file would wait for the collector of a heap that
    is hardly used. ``large``: rows may hold MBs, so that a row group is closed by its bytes, looked at after each row; writers and
    readers hold one at a time.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/stage-{uuid.uuid4().hex}"
    to = df.write.option("compression", codec)
    if large:
        to = to.option("parquet.block.size", GROUP_BYTES).option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 1)
    to.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_mod(key: Column, n: int) -> Column:
    """crc32 of the key's decimal text, modulo n; null keys count as the text ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % n


def small_batches(spark: SparkSession, most: int) -> None:
    """Arrow batches of ``most`` bytes at most in the queries that follow, unless the session was started with a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(most))


def documents(docs: DataFrame, *more: str, batch: int = BATCH_BYTES) -> DataFrame:
    """doc_id and text (null: empty), with ``more`` columns where they exist; other columns go, so names can't clash. ``batch``: see ``small_batches``."""
    small_batches(docs.sparkSession, batch)
    keep = [F.col(c) for c in more if c in docs.columns]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *keep)


def free_name(columns: list[str], name: str) -> str:
    """``name`` with underscores in front until no column is called so, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Gives memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run):
    """``run``, a function of Arrow batches, that gives memory back to the system after each batch and at its end: workers live on and their memory adds up."""

    def wrapped(batches):
        try:
            for out in run(batches):
                yield out
                pa.default_memory_pool().release_unused()
        finally:
            give_back()

    return wrapped


def lean_group(run):
    """As ``lean``, for a function of a group's table or of two tables; by the number of parameters Spark knows what to hand it."""

    def one(table):
        try:
            return run(table)
        finally:
            give_back()

    def two(left, right):
        try:
            return run(left, right)
        finally:
            give_back()

    return one if run.__code__.co_argcount == 1 else two


def keep_rows(docs: DataFrame, keep) -> DataFrame:
    """The rows of ``docs``, all columns, that ``keep(batch, texts)`` marks; ``texts`` are never null."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    at, text = len(docs.columns), "text"
    texts = docs
    if docs.schema["text"].dataType != StringType():  # a text column that numpy steps can measure, whatever the table holds
        text = free_name(docs.columns, "text_")
        texts = docs.withColumn(text, F.col("text").cast("string"))
    place = texts.columns.index(text)

    def run(batches):
        for batch in steps(batches, text):
            yield batch.select(list(range(at))).filter(pa.array(keep(batch, pc.fill_null(batch.column(place), "")), pa.bool_()))

    return texts.mapInArrow(lean(run), docs.schema)


def steps(batches, column: str = "text", limit: int = STEP_BYTES):
    """The record batches, cut so that ``column`` holds about ``limit`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ASCII-white-space-separated words of all texts in a row, and each text's first word (one more entry at the end)."""
    texts = texts.cast(pa.large_string())
    lists = pc.ascii_split_whitespace(texts)
    flat, offsets = lists.flatten(), np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=offsets[1:])
    full = pc.not_equal(flat, pa.scalar("", flat.type)).to_numpy(zero_copy_only=False)
    if len(flat) and not full.all():  # leading and trailing blanks leave empty pieces
        counted = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(full, out=counted[1:])
        flat, offsets = flat.filter(pa.array(full)), counted[offsets]
    return flat, offsets


def word_codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the code of every word, and each text's first word."""
    flat, offsets = split_words(texts)
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), offsets


def gather(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenates values[offsets[c]:offsets[c + 1]] for c in codes; also where each begins (one more entry at the end)."""
    size = np.diff(offsets)[codes]
    begin = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(size, out=begin[1:])
    return values[np.repeat(offsets[codes] - begin[:-1], size) + np.arange(begin[-1])], begin


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; wraps around."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
