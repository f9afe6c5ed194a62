"""Writers: a file for each document, one for all, CSV with a byte-order mark, several views, templates, and increments.

All of them leave the work to Spark's committers; a job that is run again replaces what it wrote.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Tries and seconds between them when a target is locked.
TRIES, WAIT = 5, 1.0
MARK = "﻿"


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared one of ``spark.checkpoint.dir``; where that is unset, a session on one machine gets a temporary one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = tempfile.mkdtemp(prefix="paperloom-sink-")
        atexit.register(shutil.rmtree, top, True)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def extracted_name(document: Column) -> Column:
    """The name of a document's output: its own without the ending, and "_extracted"."""
    return F.concat(F.regexp_replace(T.text(document), r"\.[^./]+$", ""), F.lit("_extracted"))


#: Folders into which the outputs of all documents are dealt, and rows of a file at most.
BUCKETS, ROWS = 64, 1_000_000


def _bucket(file: Column) -> Column:
    return F.pmod(F.xxhash64(file), F.lit(BUCKETS)).cast("int")


def per_document(df: DataFrame, folder: str, document: str = "doc_id") -> DataFrame:
    """Writes the rows of each document as an output of its own, file=<its name>, and reads all of them back.

    Outputs are dealt to ``BUCKETS`` folders and lie sorted in them, so there are as many files as the data ask for and not
    as there are documents; a folder with much more than others, as one huge document makes it, is split among tasks, and
    files end after ``ROWS`` rows. ``manifest`` lists the outputs, ``output`` reads one.
    """
    out = df.withColumn("file", extracted_name(F.col(document))).withColumn("bucket", _bucket(F.col("file")))
    out.hint("rebalance", "bucket").sortWithinPartitions("bucket", "file").write.mode("overwrite").option("maxRecordsPerFile", ROWS).partitionBy("bucket").parquet(folder)
    return df.sparkSession.read.schema(out.schema).parquet(folder).drop("bucket")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """file, bucket, rows and parts (files that hold some of them) of each output that ``per_document`` wrote."""
    return spark.read.parquet(folder).groupBy("file", "bucket").agg(F.count("*").alias("rows"), F.countDistinct("_metadata.file_path").alias("parts"))


def output(spark: SparkSession, folder: str, file: str) -> DataFrame:
    """The rows of one output; only its folder is read."""
    return spark.read.parquet(folder).filter((F.col("bucket") == _bucket(F.lit(file))) & (F.col("file") == file)).drop("bucket")


def combined(df: DataFrame, folder: str, document: str = "doc_id", name: str = "Document ID") -> DataFrame:
    """Writes the rows of all documents with their id in front, under ``name``."""
    out = df.select(F.col(document).alias(name), *[c for c in df.columns if c != document])
    out.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(out.schema).parquet(folder)


def dump(lines: DataFrame | None, tables: DataFrame | None, at: str, folder: str, day: str, day_first: bool = False) -> dict[str, DataFrame]:
    """Text lines (doc_id, page, ord, text), table rows (doc_id, page, ord, cells) or both, written below ``at`` in <folder>_<date>, and read back.

    ``folder`` is the folder that was read, ``day`` an ISO date; the date is MMDDYYYY, or DDMMYYYY with ``day_first``. Lines
    lose trailing blanks; cells are cleaned and go to Col_1 ... Col_n, n being the most that a row has.
    """
    y, m, d = day.split("-")
    name = f"{folder.rstrip('/').rsplit('/', 1)[-1]}_{d + m if day_first else m + d}{y}"
    own = {}
    if lines is not None:
        own["text"] = lines.select(F.col("doc_id").alias("File Name"), F.col("page").alias("Page Number"), "ord", F.rtrim(T.printable(F.col("text"))).alias("Extracted Text"))
    if tables is not None:
        most = tables.agg(F.coalesce(F.max(F.size("cells")), F.lit(0)).alias("n")).first()["n"]
        own["tables"] = tables.select(F.col("doc_id").alias("File Name"), F.col("page").alias("Page Number"), "ord", *[T.printable(T.text(F.get("cells", F.lit(i)))).alias(f"Col_{i + 1}") for i in range(most)])
    return views(own, f"{at}/{name}")


def csv(df: DataFrame, folder: str, mark: bool = False) -> DataFrame:
    """Writes CSV files with a header each; with ``mark`` each begins with a byte-order mark. Formulas are made harmless. Reads them back as text."""
    out = df.select(*[T.formula_safe(F.col(c)).alias(c) for c in df.columns])
    first = df.columns[0]
    marked = out.withColumnRenamed(first, MARK + first) if mark else out
    marked.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(folder)
    back = df.sparkSession.read.option("header", True).option("escape", '"').option("multiLine", True).csv(folder)
    back = back.toDF(*[c.removeprefix(MARK) for c in back.columns])
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


def views(named: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Writes several views of one set of rows, each in a folder of its name."""
    out = {}
    for name, df in named.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        out[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
    return out


def template(df: DataFrame, columns: tuple[str, ...], values: dict[str, Column], heads: tuple[tuple[str, ...], ...], document: str = "doc_id", order: str = "ord") -> DataFrame:
    """The rows of a template sheet: document, row (from 1) and cells; the heading rows first, then the records in order, each value at its column's place."""
    cells = F.array(*[T.text(values[c]) if c in values else F.lit("") for c in columns])
    body = df.select(document, (F.row_number().over(Window.partitionBy(document).orderBy(order)) + len(heads)).alias("row"), cells.alias("cells"))
    rows = F.array(*[F.struct(F.lit(i + 1).alias("row"), F.array(*[F.lit(x) for x in [*h, *[""] * (len(columns) - len(h))]]).alias("cells")) for i, h in enumerate(heads)])
    top = df.select(document).distinct().select(document, F.explode(rows).alias("h")).select(document, "h.row", "h.cells")
    return top.unionByName(body)


def increment(df: DataFrame, folder: str, document: str = "doc_id") -> DataFrame:
    """Replaces the output of the documents at hand and leaves that of others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(document).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def replace(spark: SparkSession, written: str, target: str, tries: int = TRIES, wait: float = WAIT) -> bool:
    """Puts what was written aside in the target's place; a locked target is tried again and then left alone (False)."""
    jvm = spark._jvm
    here, there = (jvm.org.apache.hadoop.fs.Path(p) for p in (written, target))
    fs = there.getFileSystem(spark._jsc.hadoopConfiguration())
    for n in range(tries):
        try:
            if (not fs.exists(there) or fs.delete(there, True)) and fs.rename(here, there):
                return True
        except Exception:  # noqa: BLE001  the file system says that it is in use
            pass
        if n + 1 < tries:
            time.sleep(wait)
    return False


def widths(df: DataFrame, most: int = 60) -> DataFrame:
    """column and width (its longest value or name and two more, ``most`` at most): what a sheet needs to show all of it."""
    longest = df.agg(*[F.max(F.length(T.text(F.col(f"`{c}`")))).alias(str(i)) for i, c in enumerate(df.columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.least(F.greatest(F.coalesce(F.col(str(i)), F.lit(0)), F.lit(len(c))) + 2, F.lit(most)).alias("width")) for i, c in enumerate(df.columns)])
    return longest.select(F.inline(each))


def file_bytes(folder: str, n: int = 3) -> list[bytes]:
    """The first bytes of each data file in a local folder."""
    return [open(f"{folder}/{f}", "rb").read(n) for f in sorted(os.listdir(folder)) if f.startswith("part-") and os.path.getsize(f"{folder}/{f}")]
