"""Exact check of candidate pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reecho.functions.scores import jaccard


def verify_pairs(candidates: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Candidates ``(rep_id_1, rep_id_2)`` of one author with Jaccard >= threshold.

    Returns ``(user_id, rep_id_1, rep_id_2, copies_1, copies_2, similarity)``. Each
    row stands for ``copies_1 * copies_2`` document pairs.
    """
    def side(n: int) -> DataFrame:
        return sets.select(
            F.col("rep_id").alias(f"rep_id_{n}"),
            F.col("user_id").alias(f"user_{n}"),
            F.col("shingles").alias(f"shingles_{n}"),
            F.col("copies").alias(f"copies_{n}"),
        )

    joined = candidates.join(side(1), "rep_id_1").join(side(2), "rep_id_2").where("user_1 = user_2")
    scored = joined.withColumn("similarity", jaccard(F.col("shingles_1"), F.col("shingles_2")))
    return scored.where(F.col("similarity") >= threshold).select(
        F.col("user_1").alias("user_id"), "rep_id_1", "rep_id_2", "copies_1", "copies_2", "similarity"
    )
