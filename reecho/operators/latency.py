"""Worker and system latency statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reecho.operators.runs import running_total

# Fixed value: length of a worker's reporting interval.
INTERVAL_SECONDS = 10


def _latency_aggregates() -> list:
    latency = F.col("latency_ms")
    return [
        F.coalesce(F.avg(latency), F.lit(0.0)).alias("avg_latency_ms"),
        F.coalesce(F.min(latency), F.lit(0.0)).alias("min_latency_ms"),
        F.coalesce(F.max(latency), F.lit(0.0)).alias("max_latency_ms"),
        F.coalesce(F.sum(latency), F.lit(0.0)).alias("total_latency_ms"),
        F.count(latency).alias("latency_count"),
    ]


def interval_stats(seen: DataFrame, seconds: int = INTERVAL_SECONDS) -> DataFrame:
    """Per worker and tumbling interval: throughput and latency of ``seen(worker, ts, latency_ms)``.

    Also valid on a stream; set a watermark on ``ts`` first.
    """
    grouped = seen.groupBy(F.window("ts", f"{seconds} seconds").alias("span"), "worker").agg(
        F.count(F.lit(1)).alias("interval_processed"), *_latency_aggregates()
    )
    return grouped.select(
        "worker",
        F.col("span.start").alias("interval_start"),
        (F.col("interval_processed") / F.lit(seconds)).alias("throughput"),
        "interval_processed",
        "avg_latency_ms",
        "min_latency_ms",
        "max_latency_ms",
        "total_latency_ms",
        "latency_count",
    )


def with_processed_count(intervals: DataFrame, seconds: int = INTERVAL_SECONDS) -> DataFrame:
    """Adds the worker's running number of processed messages and the interval's end in epoch seconds."""
    numbered = intervals.withColumn(
        "timestamp", F.unix_timestamp(F.col("interval_start").cast("timestamp")) + F.lit(seconds)
    ).withColumn("interval_no", F.floor(F.col("timestamp") / seconds))
    return running_total(numbered, "worker", "interval_no", "interval_processed", "processed_count").drop("interval_no")


def system_latency(seen: DataFrame) -> DataFrame:
    """One row over all messages; zeros if there is none."""
    return seen.agg(*_latency_aggregates())


def latency_report(record: DataFrame) -> DataFrame:
    """Latency record with the average rounded for display, zeros if nothing was counted."""
    filled = F.col("latency_count") > 0
    average = F.when(filled, F.round(F.col("total_latency_ms") / F.col("latency_count"), 2)).otherwise(F.lit(0.0))
    return record.select(
        average.alias("avg_latency_ms"),
        *[
            F.when(filled, F.col(c)).otherwise(F.lit(0.0)).alias(c)
            for c in ("min_latency_ms", "max_latency_ms", "total_latency_ms")
        ],
        "latency_count",
    )
