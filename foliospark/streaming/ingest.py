"""Incremental ingest: documents that arrive as files become chunks, each batch committed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relations import chunks_of


def arriving_documents(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """A stream of document rows from Parquet files that land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def write_chunks(docs: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Writes the chunks of arriving documents below target, a folder for each batch.

    A batch that is run again after a failure replaces its own folder, so no chunk is written twice.
    """

    def put(batch: DataFrame, number: int) -> None:
        chunks_of(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return docs.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_by_key(batch: DataFrame, key: str, version: str) -> DataFrame:
    """The last row of each key, for idempotent writes by id."""
    return batch.groupBy(key).agg(F.max_by(F.struct("*"), version).alias("r")).select("r.*")


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events and their values by type in windows of event time; rows later than the watermark are left out."""
    windows = events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type")
    return windows.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("window.start", "event_type", "n", "total")
