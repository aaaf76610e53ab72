"""Ledgers as streams: urls deduplicated and queued batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import LEDGER_DDL


def ledger_stream(spark: SparkSession, path: str, ddl: str = LEDGER_DDL, files_per_batch: int = 100) -> DataFrame:
    """New files of a folder of Parquet or JSON ledgers."""
    kind = "json" if path.rstrip("/").endswith("json") else "parquet"
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", files_per_batch).format(kind).load(path)


def first_seen(stream: DataFrame, late: str = "14 days") -> DataFrame:
    """Each url once; state is kept for as long as rows may come late."""
    timed = stream.withColumn("seen_at", F.try_to_timestamp("discovered_at")).where("seen_at is not null and url is not null")
    return timed.withWatermark("seen_at", late).dropDuplicatesWithinWatermark(["url"])


def append_batches(stream: DataFrame, out: str, checkpoint: str):
    """Write a stream's batches each to its own folder, so that a repeated batch replaces itself; returns the running query."""

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def listings_per_window(stream: DataFrame, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Listings per vendor and time window, given out once a window can no longer change."""
    timed = stream.withColumn("seen_at", F.try_to_timestamp("discovered_at")).where("seen_at is not null").withWatermark("seen_at", late)
    return timed.groupBy(F.window("seen_at", window), "vendor").agg(F.count("*").alias("listings"))
