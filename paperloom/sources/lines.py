"""Line and page sources: text lines, line files, the cascade over text engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..sinks.files import extracted_name
from .files import page_ranges, range_texts


def layout_lines(texts: DataFrame) -> DataFrame:
    """doc_id, line_no (from 1) and text of each line; leading blanks stay, trailing ones go."""
    return texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "l")).select("doc_id", (F.col("p") + 1).cast("long").alias("line_no"), F.rtrim("l").alias("text"))


def pages_of_lines(lines: DataFrame) -> DataFrame:
    """doc_id, page and the page's lines in order."""
    return lines.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n").alias("text"))


def laid_out_words(pages: DataFrame, width: float = 8.0, height: float = 20.0) -> DataFrame:
    """doc_id, page, ord, box and text of the words of pages whose text keeps its layout: a character's column and line are its place."""
    lines = pages.select("doc_id", "page", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    # Single blanks part the words, so that those between two of them add up to the columns that lie between.
    parts = lines.select("doc_id", "page", "line", F.split("text", " ").alias("parts"))
    each = parts.select("doc_id", "page", "line", F.posexplode("parts").alias("i", "text"), F.col("parts")).filter("text <> ''").withColumn("col", F.expr("length(array_join(slice(parts, 1, i), ' ')) + if(i > 0, 1, 0)"))
    order = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("line", "col")) - 1
    x, y = F.col("col") * width, F.col("line") * height
    return each.select("doc_id", "page", order.alias("ord"), x.alias("x0"), y.alias("y0"), (x + F.length("text") * width).alias("x1"), (y + height / 2).alias("y1"), "text")


def write_page_files(pages: DataFrame, folder: str) -> None:
    """A text file for each document, under file=<its output's name>, its pages in order and parted by form feeds; form feeds in a page become blanks."""
    out = pages.select(extracted_name(F.col("doc_id")).alias("file"), "page", F.translate(F.coalesce("text", F.lit("")), "\f", " ").alias("value"))
    # By number, as a task's work follows the files; these are put in place by tasks, not one by one by the driver.
    dealt = out.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file").sortWithinPartitions("file", "page").drop("page")
    dealt.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").option("lineSep", "\f").partitionBy("file").text(folder)


def read_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """file, page (from 1) and text of the pages of all text files below a folder; form feeds part pages, so no file is held whole.

    A page's number is its place among the file's parts and, within these, in the order in which they are read.
    """
    read = spark.read.schema("value string, file string").option("lineSep", "\f").text(folder)
    each = read.select("file", F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    return each.select("file", F.row_number().over(Window.partitionBy("path").orderBy("start", "n")).alias("page"), "text")


def read_line_csv(spark: SparkSession, path: str) -> DataFrame:
    """A file of File Name, Page Number, Extracted Text; nothing is inferred and blanks stay ''. Raises if a column is missing."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', nullValue="\u0000", emptyValue="")
    missing = {"File Name", "Page Number", "Extracted Text"} - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    return df.select(F.col("File Name").alias("doc_id"), F.col("Page Number").try_cast("int").alias("page"), F.monotonically_increasing_id().alias("ord"), F.coalesce("Extracted Text", F.lit("")).alias("text"))


def open_pages(spark: SparkSession, path: str, kind: str = "auto") -> DataFrame:
    """Pages of a line file, of parquet lines or (with an engine installed) of PDF files, by extension."""
    kind = path.rsplit(".", 1)[-1].lower() if kind == "auto" else kind
    if kind == "csv":
        return pages_of_lines(read_line_csv(spark, path))
    if kind == "parquet":
        return pages_of_lines(spark.read.parquet(path))
    texts = range_texts(page_ranges(spark, path, pattern="*.[pP][dD][fF]"))
    return texts.filter("error is null").select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("doc_id"), "page", "text")


def cascade(texts: DataFrame) -> DataFrame:
    """The first engine whose text isn't blank: native, then pdfium, then ocr; and which it was."""
    filled = lambda c: F.when(strip(F.col(c)) != "", F.struct(F.col(c).alias("text"), F.lit(c).alias("method")))
    return texts.select("doc_id", F.coalesce(filled("native"), filled("pdfium"), F.struct(F.col("ocr").alias("text"), F.lit("ocr").alias("method"))).alias("x")).select("doc_id", "x.text", "x.method")
