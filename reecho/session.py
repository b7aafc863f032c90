"""Session settings that suit the operators of this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. Joins start as shuffles; adaptive
# execution turns them into broadcast or hash joins where the sizes it has measured
# allow. Estimates made before execution are not used: they miss what explode adds.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}

AT_START = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to an existing session."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "reecho", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with these settings; the number of shuffle partitions is left to the cluster or ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **AT_START, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
