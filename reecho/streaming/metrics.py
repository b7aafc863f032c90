"""Counters, latency and progress of streams."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reecho.functions.scores import latency_ms
from reecho.operators.latency import INTERVAL_SECONDS, interval_stats
from reecho.schemas import BIGINT, DOUBLE, STRING, record
from reecho.sources.tables import BatchTable


def observed_latency(messages: DataFrame) -> DataFrame:
    """Adds ``latency_ms`` from production to now."""
    now = F.current_timestamp().cast("double")
    return messages.withColumn("latency_ms", latency_ms(now, F.col("produced_at")))


def worker_windows(seen: DataFrame, lateness: str = "1 minute", seconds: int = INTERVAL_SECONDS) -> DataFrame:
    """Tumbling worker statistics of a stream ``(worker, ts, latency_ms)``; the watermark closes intervals."""
    return interval_stats(seen.withWatermark("ts", lateness), seconds)


class WorkerWindows:
    """Worker windows as they stand, open ones too: each batch leaves the windows it changed, the last state counts."""

    def __init__(self, spark: SparkSession, path: str, windows: DataFrame):
        self.windows = windows
        self.changes = BatchTable(spark, path, T.StructType([*windows.schema.fields, T.StructField("batch", T.LongType())]))

    def process(self, changed: DataFrame, batch_id: int) -> None:
        self.changes.write(changed.withColumn("batch", F.lit(batch_id)), batch_id)

    def start(self, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
        return (
            self.windows.writeStream.outputMode("update")
            .foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    def current(self) -> DataFrame:
        keys = ["worker", "interval_start"]
        others = [c for c in self.windows.columns if c not in keys]
        last = self.changes.read().groupBy(*keys).agg(F.max(F.struct("batch", *others)).alias("last"))
        return last.select(*[c if c in keys else F.col(f"last.{c}").alias(c) for c in self.windows.columns])


def running_counts(messages: DataFrame) -> DataFrame:
    """Comments per author so far; for update or complete output mode."""
    return messages.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_comments"))


class AuthorCounters:
    """Author counters as one delta per batch, summed on reading, so replays do not count twice."""

    def __init__(self, spark: SparkSession, path: str):
        self.deltas = BatchTable(spark, path, record(user_id=STRING, added=BIGINT))

    def process(self, messages: DataFrame, batch_id: int) -> None:
        counted = messages.groupBy("user_id").agg(F.count(F.lit(1)).alias("added"))
        self.deltas.write(counted, batch_id)

    def totals(self) -> DataFrame:
        return self.deltas.read().groupBy("user_id").agg(F.sum("added").alias("total_comments"))

    def start(self, messages: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
        return (
            messages.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


PROGRESS = "progress"
COUNTERS = record(messages=BIGINT, with_text=BIGINT, seconds=DOUBLE)


def _counters() -> list:
    return [F.count(F.lit(1)).alias("messages"), F.count("text").alias("with_text")]


def with_progress(messages: DataFrame) -> DataFrame:
    """Counts each batch's messages while it runs; read the totals with ``progress_counts``."""
    return messages.observe(PROGRESS, *_counters())


def progress_counts(query: StreamingQuery) -> dict[str, int]:
    """Totals of the observed counters over the batches the query still remembers."""
    totals = {"messages": 0, "with_text": 0}
    for progress in query.recentProgress:
        observed = progress.observedMetrics.get(PROGRESS)
        if observed is not None:
            for name in totals:
                totals[name] += observed[name] or 0
    return totals


class ProgressLog:
    """Progress counters that outlive the query: one row per batch, replaced when the batch runs again.

    ``logged(process)`` wraps what a query does with a batch. The batch is counted while ``process`` reads it, and the row is written after it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.batches = BatchTable(spark, path, COUNTERS)

    def logged(self, process: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        def run(messages: DataFrame, batch_id: int) -> None:
            counted, began = Observation(f"{PROGRESS}-{batch_id}"), time.monotonic()
            process(messages.observe(counted, *_counters()), batch_id)
            seen = counted.get
            row = (seen["messages"], seen["with_text"], time.monotonic() - began)
            self.batches.write(self.spark.createDataFrame([row], COUNTERS), batch_id)

        return run

    def totals(self) -> DataFrame:
        """One row: ``batches``, ``messages``, ``with_text``, ``seconds``, and ``messages_per_second`` while batches ran."""
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS.fieldNames()]
        total = self.batches.read().agg(F.count(F.lit(1)).alias("batches"), *sums)
        return total.withColumn("messages_per_second", F.when(F.col("seconds") > 0, F.col("messages") / F.col("seconds")))
