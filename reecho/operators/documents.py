"""From messages to shingle sets, with equal sets of an author merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reecho.functions import text as tx
from reecho.operators.skew import FEW_ROWS, look_up_group, salts_seen
from reecho.params import MatchParams

SET_KEYS = ("user_id", "set_hi", "set_lo")


def first_delivery(docs: DataFrame, order: str | None = None) -> DataFrame:
    """One row per ``doc_id``; the earliest by ``order`` if given, else the least row."""
    others = [c for c in docs.columns if c != "doc_id"]
    ranked = [order, *[c for c in others if c != order]] if order else others
    kept = docs.groupBy("doc_id").agg(F.min(F.struct(*ranked)).alias("kept"))
    return kept.select(*[("doc_id" if c == "doc_id" else F.col(f"kept.{c}").alias(c)) for c in docs.columns])


def deliver_once(docs: DataFrame, order: str | None = None) -> DataFrame:
    """``docs`` without redelivered ids; texts move only for ids that occur twice.

    Which delivery counts is settled without the texts, which are asked only where several of an id are the earliest. If no id
    repeats, the rows pass as they are; if few do, the others stay in place.
    """
    if order:
        times = docs.groupBy("doc_id", F.col(order).alias("at")).agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id")
        marked = times.agg(F.sum("n").alias("total"), F.min(F.struct("at", "n")).alias("_least"))
    else:
        counted = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total"))
        marked = counted.withColumn("_least", F.struct(F.lit(None).alias("at"), F.col("total").alias("n")))
    marked = marked.where("total > 1 AND doc_id IS NOT NULL").select("doc_id", "_least")
    found = marked.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_least.n") > 1).alias("tied")).first()
    if not found.rows:
        return docs
    named = docs.join(F.broadcast(marked) if found.rows <= FEW_ROWS else marked, "doc_id", "left")
    earliest = F.col(order).eqNullSafe(F.col("_least.at")) if order else F.lit(True)
    once = named.where(F.col("_least").isNull() | (earliest & (F.col("_least.n") == 1))).select(*docs.columns)
    if not found.tied:
        return once
    tied = named.where(F.col("_least").isNotNull() & earliest & (F.col("_least.n") > 1)).select(*docs.columns)
    return once.unionByName(first_delivery(tied, order).select(*docs.columns))


def computed_once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds an expensive column that later filters and columns may use freely.

    Catalyst moves a filter below a projection by repeating its expressions, which
    would clean every text twice. It does not do that across a generator.
    """
    return frame.select("*", F.explode(F.array(value)).alias(name))


def clean_documents(docs: DataFrame, k: int) -> DataFrame:
    """Adds ``clean``, ``words`` and ``long_enough``; keeps every document, short ones too."""
    cleaned = computed_once(docs, "clean", tx.clean_text(F.col("text")))
    tokens = computed_once(cleaned, "words", tx.words(F.col("clean")))
    return tokens.withColumn("long_enough", F.coalesce(F.size("words") >= k, F.lit(False)))


def shingle_documents(docs: DataFrame, params: MatchParams) -> DataFrame:
    """``(doc_id, user_id, set_hi, set_lo, shingles)`` of documents with at least k words.

    ``set_hi`` and ``set_lo`` are a 128-bit fingerprint of the shingle set.
    """
    tokens = computed_once(docs.select("doc_id", "user_id", "text"), "words", tx.words(tx.clean_text(F.col("text"))))
    shingled = computed_once(
        tokens.where(F.size("words") >= params.shingle_size).drop("text"),
        "shingles",
        tx.shingle_set(F.col("words"), params.shingle_size),
    )
    return shingled.select(
        "doc_id",
        "user_id",
        F.xxhash64(F.col("shingles")).alias("set_hi"),
        F.xxhash64(F.lit("lo"), F.col("shingles")).alias("set_lo"),
        "shingles",
    )


def distinct_sets(shingled: DataFrame) -> DataFrame:
    """One row per (author, shingle set): ``rep_id`` (least doc id), ``copies`` and the set.

    Copies are merged on the map side, before any pair work, so a flood of equal
    comments costs one row per task here and one set afterwards.
    """
    return (
        shingled.groupBy(*SET_KEYS, "shingles")
        .agg(
            F.min("doc_id").alias("rep_id"),
            F.count(F.lit(1)).alias("copies"),
            salts_seen(F.col("doc_id")).alias("salt_mask"),
        )
        .withColumn("n_shingles", F.size("shingles"))
    )


def set_facts(shingled: DataFrame) -> DataFrame:
    """``distinct_sets`` without the shingles, which stay in ``shingled``: in the row whose ``doc_id`` is ``rep_id``, if ids are unique."""
    named = shingled.select("doc_id", *SET_KEYS, F.size("shingles").alias("n_shingles"))
    return named.groupBy(*SET_KEYS, "n_shingles").agg(
        F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"), salts_seen(F.col("doc_id")).alias("salt_mask")
    )


def members(shingled: DataFrame, sets: DataFrame, keys: Sequence[str] = SET_KEYS) -> DataFrame:
    """``(doc_id, user_id, rep_id, copies)``: which set each document belongs to.

    ``keys`` identify a set in both tables.
    """
    found = look_up_group(
        shingled.select("doc_id", *dict.fromkeys(["user_id", *keys])),
        sets.select(*dict.fromkeys([*keys, "rep_id"]), "copies", "salt_mask"),
        keys,
        "doc_id",
    )
    return found.select("doc_id", "user_id", "rep_id", "copies")
