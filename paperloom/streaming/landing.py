"""An extension: a stream over a landing folder of line files, with state for one document at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

LINES = "doc_id long, page int, ord int, text string"


def watch(spark: SparkSession, folder: str, extract: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Extracts each file's documents as it lands and appends them to a parquet folder.

    A document comes in one file, so a batch holds it whole. A batch that is run again replaces its own folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        extract(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    lines = spark.readStream.schema(LINES).parquet(folder)
    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
