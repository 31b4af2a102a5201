"""Metadata and page elements as they arrive: the same tables kept up to date by small batches.

The reference works in batches only; here the same upserts run on streams of landed files. Each batch is written to a
path of its own, so that a batch that is tried again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuscle.operators import metadata, sections


def files(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Parquet files that land in ``path``, of the columns of ``like``."""
    return spark.readStream.schema(like.schema).parquet(path)


def keep_latest(arrivals: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The latest version of each id in each batch, under ``out``/batch=N; ``current`` reads the whole."""

    def write(batch: DataFrame, number: int) -> None:
        metadata.latest_versions(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out: str) -> DataFrame:
    """The latest version of each id over all batches."""
    return metadata.latest_versions(spark.read.parquet(out).drop("batch", "modified"))


def chunk_arrivals(arrivals: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The chunks of each batch's documents, which come whole; under ``out``/batch=N."""

    def write(batch: DataFrame, number: int) -> None:
        sections.chunks(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_chunks(spark: SparkSession, out: str) -> DataFrame:
    """Of each document the chunks of its latest batch."""
    stored = spark.read.parquet(out)
    last = stored.groupBy("doc_id").agg(F.max("batch").alias("batch"))
    return stored.join(last, ["doc_id", "batch"]).drop("batch")
