"""From pairs of sets to pairs of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reecho.functions.scores import possible_pairs, wide
from reecho.operators.skew import BLOCK_ROWS, block_of, block_pairs, blocks_of, broadcast_if_bounded


def _documents_of(pairs: DataFrame, copied: DataFrame, n: int, block_rows: int) -> DataFrame:
    """Replace ``rep_id_n`` by every document of that set, as ``doc_n``.

    A set of many copies is met block by block, so its documents are spread over
    as many tasks as it has blocks.
    """
    rep, copies = f"rep_id_{n}", f"copies_{n}"
    single = pairs.where(F.col(copies) == 1).withColumn(f"doc_{n}", F.col(rep)).drop(rep, copies)
    blocks = F.sequence(F.lit(0), blocks_of(F.col(copies), block_rows) - 1)
    spread = pairs.where(F.col(copies) > 1).withColumn("block", F.explode(blocks))
    docs = copied.select(
        F.col("rep_id").alias(rep),
        F.col("doc_id").alias(f"doc_{n}"),
        block_of(F.col("doc_id"), F.col("copies"), block_rows).alias("block"),
    )
    repeated = spread.join(docs, [rep, "block"]).drop(rep, copies, "block")
    return single.unionByName(repeated)


def expand_pairs(set_pairs: DataFrame, members: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All similar document pairs: ``(user_id, doc_id_1, doc_id_2, similarity)``, least id first.

    The work is proportional to the pairs returned.
    """
    copied = members.where(F.col("copies") > 1)
    across = _documents_of(_documents_of(set_pairs, copied, 1, block_rows), copied, 2, block_rows)
    across = across.select(
        "user_id",
        F.least("doc_1", "doc_2").alias("doc_id_1"),
        F.greatest("doc_1", "doc_2").alias("doc_id_2"),
        "similarity",
    )
    inside = block_pairs(
        copied.withColumnRenamed("copies", "group_size"), ("user_id", "rep_id"), "doc_id", block_rows=block_rows
    ).select("user_id", "doc_id_1", "doc_id_2", F.lit(1.0).alias("similarity"))
    return across.unionByName(inside)


def top_pairs(set_pairs: DataFrame, members: DataFrame, limit: int, largest: int | None = None) -> DataFrame:
    """The first ``limit`` rows of ``expand_pairs`` by similarity, then doc ids.

    ``rep_id`` must be the least document of its set. What cannot occur in the answer is
    left out before anything is expanded:

    - a pair of sets with ``limit`` others before it: the least document pair of each of
      those sorts before all of its own. Copied sets are ranked by themselves likewise;
    - a document with more than ``limit`` lesser ones in its set: replacing it by one of
      those gives ``limit`` pairs of the same similarity that sort first.

    ``largest`` is the number of documents of the largest set, if it is known; it is looked up otherwise.
    """
    copied = members.where(F.col("copies") > 1)
    first_pairs = set_pairs.orderBy(F.desc("similarity"), "rep_id_1", "rep_id_2").limit(limit)
    first_copied = copied.select("rep_id").distinct().orderBy("rep_id").limit(limit)
    named = first_pairs.select(F.explode(F.array("rep_id_1", "rep_id_2")).alias("rep_id"))
    needed = first_copied.unionByName(named).distinct()
    wanted = copied.join(broadcast_if_bounded(needed, 3 * limit), "rep_id", "left_semi")
    if largest is None:
        largest = members.agg(F.max("copies").alias("n")).first().n or 0
    least = _least_documents(wanted, limit + 1, largest)

    def cut(copies: str) -> Column:
        return F.least(F.col(copies), F.lit(limit + 1).cast("bigint"))

    cut_pairs = first_pairs.withColumn("copies_1", cut("copies_1")).withColumn("copies_2", cut("copies_2"))
    pairs = expand_pairs(cut_pairs, least.withColumn("copies", cut("copies")).drop("place"))
    return pairs.orderBy(F.desc("similarity"), "doc_id_1", "doc_id_2").limit(limit)


def _least_documents(copied: DataFrame, most: int, largest: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``most`` least documents of each set, and their ``place``. No set has more than ``largest``.

    A set's documents are cut to the least ones of each block, level by level, until what can be left of the largest set is
    one block: no task meets a hot set. A level leaves at most a quarter.
    """
    block_rows = max(block_rows, 4 * most)
    rows, size = copied, largest
    while size > block_rows:
        blocks = -(-size // block_rows)
        dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(blocks), "doc_id"), F.least(F.lit(blocks), F.ceil(F.col("copies") / block_rows))))
        in_block = W.partitionBy("rep_id", "block").orderBy("doc_id")
        rows = dealt.withColumn("place", F.row_number().over(in_block)).where(F.col("place") <= most).drop("block", "place")
        size = blocks * most
    in_set = W.partitionBy("rep_id").orderBy("doc_id")
    return rows.withColumn("place", F.row_number().over(in_set)).where(F.col("place") <= most)


def author_pair_counts(set_pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(user_id, similar_pairs)`` without building the pairs: copies are multiplied out.

    ``similar_pairs`` is decimal(38,0), since one author can own more than 2**63 pairs.
    """
    across = set_pairs.select("user_id", (wide(F.col("copies_1")) * wide(F.col("copies_2"))).alias("pairs"))
    inside = sets.where(F.col("copies") > 1).select(
        "user_id", (wide(F.col("copies")) * (wide(F.col("copies")) - 1) / 2).cast("decimal(38,0)").alias("pairs")
    )
    both = across.unionByName(inside)
    return both.groupBy("user_id").agg(F.sum("pairs").cast("decimal(38,0)").alias("similar_pairs"))


def own_pair_counts(set_pairs: DataFrame, members: DataFrame, doc_users: DataFrame) -> DataFrame:
    """``(user_id, similar_pairs)``: pairs whose documents are both in ``doc_users``, there of one author, without building them.

    Sets and pairs may be of a wider scope than an author. An author's documents are counted by set; a pair of sets
    stands for the products of these counts, a set for the pairs among its own copies.
    """
    held = members.select("doc_id", "rep_id").join(doc_users.select("doc_id", "user_id"), "doc_id")
    counts = held.groupBy("rep_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    side = lambda n: counts.select(F.col("rep_id").alias(f"rep_id_{n}"), "user_id", wide(F.col("n")).alias(f"n_{n}"))
    met = set_pairs.select("rep_id_1", "rep_id_2").join(side(1), "rep_id_1").join(side(2), ["rep_id_2", "user_id"])
    across = met.select("user_id", (F.col("n_1") * F.col("n_2")).alias("pairs"))
    inside = counts.where("n > 1").select("user_id", possible_pairs(F.col("n")).alias("pairs"))
    both = across.unionByName(inside)
    return both.groupBy("user_id").agg(F.sum("pairs").cast("decimal(38,0)").alias("similar_pairs"))


def paired_sets(set_pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``rep_id`` of every set with a similar partner, another set or a copy."""
    partners = set_pairs.select(F.explode(F.array("rep_id_1", "rep_id_2")).alias("rep_id"))
    return partners.unionByName(sets.where(F.col("copies") > 1).select("rep_id")).distinct()
