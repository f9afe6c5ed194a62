"""How work is spread: broadcasts by measured sizes, and tasks whose number follows the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rows that a task is meant to hold, and bytes of a shuffle that one task is meant to read.
ROWS, BYTES = 100_000, 16 << 20
#: Rows of a task at least, while there are fewer tasks than cores.
LEAST = 5_000
#: Partitions that a shuffle is dealt into at most; small ones are put together again at run time.
MOST = 2000
_STATIC, _ADAPTIVE = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
_READ, _PARTS = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"


def measured(spark: SparkSession) -> None:
    """From now on joins are broadcast by the size that a shuffle measured, not by an estimate from the sizes of files.

    Files hold repeated texts once and rows that a row is rendered into not at all, so a table of a few MB can be GB of rows,
    which a broadcast would bring to the driver. The bound is the session's own.
    """
    if spark.conf.get(_STATIC) != "-1":
        spark.conf.set(_ADAPTIVE, spark.conf.get(_ADAPTIVE, None) or spark.conf.get(_STATIC))
        spark.conf.set(_STATIC, "-1")
    if not spark.sparkContext.getConf().contains(_READ):
        spark.conf.set(_READ, str(BYTES))


def parts(rows: int, cores: int = 1) -> int:
    """Tasks for so many rows: ``ROWS`` each, fewer if cores would be idle."""
    return max(1, -(-rows // ROWS), min(cores, rows // LEAST))


def dealt(df: DataFrame, key: str, each: int) -> DataFrame:
    """``df`` dealt out by ``key`` for rows that make ``each`` rows apiece; a few columns travel, and what is made of a row is in its task."""
    return df.repartition(parts(df.count() * each, df.sparkSession.sparkContext.defaultParallelism), key)


def enough(spark: SparkSession, rows: int) -> None:
    """Shuffles that follow have partitions for so many rows at least, ``MOST`` at most."""
    if (n := min(parts(rows), MOST)) > int(spark.conf.get(_PARTS)):
        spark.conf.set(_PARTS, str(n))
