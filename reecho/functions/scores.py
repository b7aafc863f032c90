"""Similarity, rate and latency expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(left: Column, right: Column) -> Column:
    """Exact Jaccard similarity of two sets; 0 if either is empty or null."""
    shared = F.size(F.array_intersect(left, right)).cast("double")
    union = F.size(left) + F.size(right) - shared
    return F.when((F.size(left) > 0) & (F.size(right) > 0), shared / union).otherwise(F.lit(0.0))


def wide(count: Column) -> Column:
    """Exact integer wide enough for pair counts: n*(n-1)/2 leaves 64 bits at n = 4.3 billion."""
    return count.cast("decimal(19,0)")


def possible_pairs(total: Column) -> Column:
    return (wide(total) * (wide(total) - 1) / 2).cast("decimal(38,0)")


def similarity_rate(pairs: Column, total: Column) -> Column:
    """Share of an author's possible pairs that are similar; null below two comments."""
    return F.when(total > 1, pairs.cast("double") / possible_pairs(total).cast("double"))


def latency_ms(seen_at: Column, produced_at: Column) -> Column:
    """Milliseconds from production to sight, both in epoch seconds; null if unstamped."""
    return F.when(produced_at != 0, (seen_at - produced_at) * 1000)


def same_author(left: Column, right: Column) -> Column:
    return left == right


def percent(fraction: Column, digits: int) -> Column:
    return F.round(fraction * 100, digits)


def pair_percent(similarity: Column) -> Column:
    return percent(similarity, 1)


def author_percent(rate: Column) -> Column:
    return percent(rate, 2)
