"""Structured Streaming: files that arrive in a folder, as contracts; and the value-count profile kept up to date by them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from leasemill.operators import profile
from leasemill.schema import CONTRACTS
from leasemill.sources.contracts import CSV_OPTIONS, as_strings, header, typed


def contracts_stream(spark: SparkSession, folder: str, schema: T.StructType = CONTRACTS, files_per_batch: int = 1000) -> DataFrame:
    """New CSV files of a folder as typed contracts, by the names in the header of the first file that is there, or in the order
    of ``schema`` where there is none yet. A file with another header stops the stream."""
    try:
        names = header(spark, folder)
    except AnalysisException:
        names = []
    raw = spark.readStream.schema(as_strings(names or schema.names)).options(**CSV_OPTIONS).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    return typed(raw, schema)


def ingest_new_files(spark: SparkSession, folder: str, target: str, checkpoint: str, schema: T.StructType = CONTRACTS) -> StreamingQuery:
    """Append what has arrived since the last run to a Parquet table, exactly once, then stop."""
    return (
        contracts_stream(spark, folder, schema)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def usage_counts(stream: DataFrame, event_time: str, window: str = "30 days", late_by: str = "60 days") -> DataFrame:
    """Contracts and rents by usage in tumbling windows of an event time; rows later than the watermark are dropped by
    the stream's contract, not by a cap."""
    return (
        stream.withWatermark(event_time, late_by)
        .groupBy(F.window(event_time, window), "property_usage_en")
        .agg(F.count("*").alias("n"), F.sum("annual_amount").alias("rent"))
        .select(F.col("window.start").alias("window_start"), "property_usage_en", "n", "rent")
    )


def keep_profile(stream: DataFrame, store: profile.CountStore, rules: list[profile.ColumnRule], group: str | Column, checkpoint: str) -> StreamingQuery:
    """Each micro-batch becomes a delta in the store's log. A batch that is replayed after a failure, of this driver or a new
    one, counts once. The store belongs to the stream: it starts empty with it, at a path that a restart names again."""

    def apply(batch: DataFrame, number: int) -> None:
        store.apply(profile.delta(batch, rules, group), batch=number)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
