"""Maintenance of the result tables.

Plain Parquet has no MERGE, so each operator takes the stored table and a delta and
returns the new table. Names follow the tables they maintain:

- ``doc_users(doc_id, user_id)``
- ``similarities(doc_id_1, doc_id_2, similarity)``
- ``user_stats(user_id, total_comments, similar_pairs, similarity_rate)``
- ``worker_stats(worker, timestamp, throughput, processed_count, avg/min/max/total_latency_ms, latency_count)``
- ``system_latency(total_latency_ms, latency_count, min_latency_ms, max_latency_ms)``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reecho.functions.scores import similarity_rate

PAIR_KEYS = ["doc_id_1", "doc_id_2"]


def comment_counts(doc_users: DataFrame) -> DataFrame:
    """Comments per author."""
    return doc_users.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_comments"))


def author_pair_counts(pairs: DataFrame, doc_users: DataFrame) -> DataFrame:
    """Pairs per author, counting pairs whose documents are both known and of one author."""
    def side(n: int) -> DataFrame:
        return doc_users.select(F.col("doc_id").alias(f"doc_id_{n}"), F.col("user_id").alias(f"user_id_{n}"))

    known = pairs.select(*PAIR_KEYS).join(side(1), "doc_id_1").join(side(2), "doc_id_2")
    own = known.where(F.col("user_id_1") == F.col("user_id_2"))
    return own.groupBy(F.col("user_id_1").alias("user_id")).agg(F.count(F.lit(1)).alias("similar_pairs"))


def look_up_authors(doc_ids: DataFrame, doc_users: DataFrame) -> DataFrame:
    """Author of each given ``doc_id``, null if unknown."""
    return doc_ids.join(doc_users.select("doc_id", "user_id"), "doc_id", "left")


def first_writer_wins(stored: DataFrame, incoming: DataFrame, order: str = "seq") -> DataFrame:
    """``doc_users`` after inserting new documents; the first author of a document stays."""
    first = incoming.groupBy("doc_id").agg(F.min_by("user_id", F.struct(order, "user_id")).alias("user_id"))
    new = first.join(stored.select("doc_id"), "doc_id", "left_anti")
    return stored.select("doc_id", "user_id").unionByName(new)


def canonical_pairs(pairs: DataFrame) -> DataFrame:
    """Smaller document id first."""
    return pairs.withColumns({"doc_id_1": F.least(*PAIR_KEYS), "doc_id_2": F.greatest(*PAIR_KEYS)})


def insert_new_pairs(stored: DataFrame, incoming: DataFrame, order: str = "seq") -> DataFrame:
    """``similarities`` after inserting pairs in either orientation; known pairs are ignored."""
    proper = canonical_pairs(incoming).where(F.col("doc_id_1") < F.col("doc_id_2"))
    first = proper.groupBy(*PAIR_KEYS).agg(
        F.min_by("similarity", F.struct(order, "similarity")).alias("similarity")
    )
    new = first.join(stored.select(*PAIR_KEYS), PAIR_KEYS, "left_anti")
    return stored.select(*PAIR_KEYS, "similarity").unionByName(new)


def add_comment_counts(stats: DataFrame, new_docs: DataFrame) -> DataFrame:
    """Adds the new documents' counts; new authors start with no pairs and rate 0."""
    delta = new_docs.groupBy("user_id").agg(F.count(F.lit(1)).alias("added"))
    return _with_new_authors(stats, delta).select(
        "user_id",
        (F.coalesce("total_comments", F.lit(0)) + F.coalesce("added", F.lit(0))).cast("bigint").alias("total_comments"),
        "similar_pairs",
        "similarity_rate",
    )


def sync_totals(stats: DataFrame, doc_users: DataFrame) -> DataFrame:
    """Replaces totals by the counts in ``doc_users``; pairs and rates stay."""
    facts = doc_users.groupBy("user_id").agg(F.count(F.lit(1)).alias("added"))
    return _with_new_authors(stats, facts).select(
        "user_id", F.coalesce("added", "total_comments").alias("total_comments"), "similar_pairs", "similarity_rate"
    )


def _with_new_authors(stats: DataFrame, counts: DataFrame) -> DataFrame:
    is_new = F.col("known").isNull()
    return (
        stats.withColumn("known", F.lit(True))
        .join(counts, "user_id", "full_outer")
        .withColumn("similar_pairs", F.when(is_new, F.lit(0).cast("bigint")).otherwise(F.col("similar_pairs")))
        .withColumn("similarity_rate", F.when(is_new, F.lit(0.0)).otherwise(F.col("similarity_rate")))
    )


def rebuild_stats(doc_users: DataFrame) -> DataFrame:
    """Totals from scratch, pairs and rates reset to zero."""
    return comment_counts(doc_users).select(
        "user_id",
        "total_comments",
        F.lit(0).cast("bigint").alias("similar_pairs"),
        F.lit(0.0).alias("similarity_rate"),
    )


def add_pair_counts(stats: DataFrame, pair_counts: DataFrame) -> DataFrame:
    """Adds pair counts, as decimal(38,0), and refreshes the rate of the authors touched; unknown authors are skipped."""
    added = pair_counts.select("user_id", F.col("similar_pairs").cast("decimal(38,0)").alias("added"))
    pairs = (F.col("similar_pairs").cast("decimal(37,0)") + F.col("added")).cast("decimal(38,0)")
    touched = F.col("added").isNotNull()
    return stats.join(added, "user_id", "left").select(
        "user_id",
        "total_comments",
        F.when(touched, pairs).otherwise(F.col("similar_pairs").cast("decimal(38,0)")).alias("similar_pairs"),
        F.when(touched, similarity_rate(pairs, F.col("total_comments")))
        .otherwise(F.col("similarity_rate"))
        .alias("similarity_rate"),
    )


def refresh_rates(stats: DataFrame) -> DataFrame:
    """Recomputes every author's rate from the counts."""
    return stats.withColumn("similarity_rate", similarity_rate(F.col("similar_pairs"), F.col("total_comments")))


def user_stats(doc_users: DataFrame, pair_counts: DataFrame) -> DataFrame:
    """``user_stats`` derived from facts in one go."""
    return refresh_rates(add_pair_counts(rebuild_stats(doc_users), pair_counts))


def latest_snapshots(stored: DataFrame, incoming: DataFrame, key: str = "worker", order: str = "timestamp") -> DataFrame:
    """Last write per worker wins."""
    columns = [c for c in stored.columns if c != key]
    rows = stored.unionByName(incoming.select(*stored.columns))
    last = rows.groupBy(key).agg(F.max(F.struct(order, *[c for c in columns if c != order])).alias("last"))
    return last.select(key, *[F.col(f"last.{c}").alias(c) for c in columns])


def worker_listing(worker_stats: DataFrame) -> DataFrame:
    """The seven columns of the worker report."""
    return worker_stats.select(
        "worker", "throughput", "processed_count", "timestamp", "avg_latency_ms", "min_latency_ms", "max_latency_ms"
    )


def merge_latency(*partials: DataFrame) -> DataFrame:
    """Merges latency records; those with count 0 do not touch minimum and maximum."""
    columns = ["total_latency_ms", "latency_count", "min_latency_ms", "max_latency_ms"]
    rows = partials[0].select(*columns)
    for partial in partials[1:]:
        rows = rows.unionByName(partial.select(*columns))
    filled = F.col("latency_count") > 0
    return rows.agg(
        F.coalesce(F.sum("total_latency_ms"), F.lit(0.0)).alias("total_latency_ms"),
        F.coalesce(F.sum("latency_count"), F.lit(0).cast("bigint")).alias("latency_count"),
        F.coalesce(F.min(F.when(filled, F.col("min_latency_ms"))), F.lit(0.0)).alias("min_latency_ms"),
        F.coalesce(F.max(F.when(filled, F.col("max_latency_ms"))), F.lit(0.0)).alias("max_latency_ms"),
    )


def integrity_violations(
    doc_users: DataFrame, similarities: DataFrame, stats: DataFrame, threshold: float
) -> DataFrame:
    """``(rule, violations)`` for the tables' keys, nulls, pair order and score range."""
    def duplicates(frame: DataFrame, keys: list[str], rule: str) -> DataFrame:
        extra = frame.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra"))
        return extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("violations")).select(
            F.lit(rule).alias("rule"), "violations"
        )

    def count_rules(frame: DataFrame, **rules) -> DataFrame:
        """One scan counts all row-level rules of a table."""
        counted = frame.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
        return counted.unpivot([], list(rules), "rule", "violations")

    pair_nulls = F.col("doc_id_1").isNull() | F.col("doc_id_2").isNull() | F.col("similarity").isNull()
    checks = [
        duplicates(doc_users, ["doc_id"], "doc_users_duplicate_key"),
        duplicates(similarities, PAIR_KEYS, "similarities_duplicate_key"),
        duplicates(stats, ["user_id"], "user_stats_duplicate_key"),
        count_rules(doc_users, doc_users_null=F.col("doc_id").isNull() | F.col("user_id").isNull()),
        count_rules(
            similarities,
            similarities_null=pair_nulls,
            similarities_order=F.col("doc_id_1") >= F.col("doc_id_2"),
            similarities_range=~F.col("similarity").between(threshold, 1.0),
        ),
        count_rules(stats, user_stats_null=F.col("user_id").isNull()),
    ]
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report
