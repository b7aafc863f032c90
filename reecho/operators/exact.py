"""Exact set-similarity self-join per author.

Two ways, by the threshold alone. From one half on, order every set by how few of the author's sets hold a shingle. By the prefix filter
(Chaudhuri et al. 2006; Bayardo et al. 2007), extended to several witnesses as in
AdaptJoin (Wang et al. 2012), two sets with Jaccard >= t share at least w shingles among
the first n - ceil(t*n) + w of each, or all they need if that is fewer. The positional
filter of PPJoin (Xiao et al. 2008) drops a shared shingle after which too few are left.

Below one half that prefix is most of a set, and nearly every pair of an author shares many of its shingles: the join would make
each pair several times. There the author's sets meet in cells of two blocks, each pair once, and a bitmap of each set decides
inside the join (Sandes et al. 2017): bits that differ come from shingles that only one set holds, so they bound the overlap from above.
Only what passes leaves the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reecho.operators.lsh import size_compatible
from reecho.operators.skew import block_pairs, keep_shared

# How many shared prefix shingles make a candidate. More witnesses lengthen the index
# slightly and cut the false candidates, whose full sets have to be compared, a lot.
WITNESSES = 8

# Longs of a bitmap, a power of two.
BITMAP_WORDS = 16

# Guards ceil() against products such as 0.15 * 20 = 3.0000000000000004.
_EPS = 1e-6


def prefix_index(sets: DataFrame, threshold: float) -> DataFrame:
    """``(x, rep_id, n_shingles, pos, group_size)``: the prefix shingles of each set.

    ``x`` is a 64-bit hash of author and shingle. Should two collide, a false candidate
    may arise, which verification drops; no pair is lost.

    Shingles that occur in one set only cannot join; they are left out, though they
    still take up the first places of the prefix.
    """
    shingles = sets.select("user_id", "rep_id", "n_shingles", F.explode("shingles").alias("shingle")).select(
        F.xxhash64("user_id", "shingle").alias("x"), "rep_id", "n_shingles"
    )
    shared = keep_shared(shingles, ("x",), "rep_id")
    rarest_first = W.partitionBy("rep_id").orderBy("group_size", "x")
    whole_set = rarest_first.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    placed = shared.withColumn(
        "pos",
        F.col("n_shingles") - F.count(F.lit(1)).over(whole_set) + F.row_number().over(rarest_first),
    )
    prefix_length = F.col("n_shingles") - F.ceil(F.lit(threshold) * F.col("n_shingles") - _EPS) + WITNESSES
    return placed.where(F.col("pos") <= prefix_length)


def bitmaps(sets: DataFrame) -> DataFrame:
    """``(rep_id, bits)``: which of ``BITMAP_WORDS`` times 64 places the shingles of a set fall on."""
    shingles = sets.select("rep_id", F.explode("shingles").alias("x"))
    words = [
        F.expr(f"bit_or(IF((x >> 6) & {BITMAP_WORDS - 1} = {w}, shiftleft(1L, int(x & 63)), 0L)) AS w{w}") for w in range(BITMAP_WORDS)
    ]
    marked = shingles.groupBy("rep_id").agg(*words)
    return marked.select("rep_id", F.array(*[f"w{w}" for w in range(BITMAP_WORDS)]).alias("bits"))


def _needed(threshold: float) -> Column:
    """How many shingles two sets must share."""
    return F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("n_shingles_1") + F.col("n_shingles_2")) - _EPS)


def cell_candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of an author's sets that bitmaps leave possible."""
    described = sets.select("user_id", "rep_id", "n_shingles").join(bitmaps(sets), "rep_id")
    rows = keep_shared(described, ("user_id",), "rep_id")
    differ = F.expr(" + ".join(f"bit_count(bits_1[{w}] ^ bits_2[{w}])" for w in range(BITMAP_WORDS)))
    enough = F.col("n_shingles_1") + F.col("n_shingles_2") - differ >= 2 * _needed(threshold)
    pairs = block_pairs(rows, ("user_id",), "rep_id", carry=("n_shingles", "bits"), condition=size_compatible(threshold) & enough)
    return pairs.select("rep_id_1", "rep_id_2")


def exact_candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """Every ``(rep_id_1, rep_id_2)`` of one author that could reach the threshold."""
    return cell_candidates(sets, threshold) if threshold < 0.5 else prefix_candidates(sets, threshold)


def prefix_candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs that share enough of their rarest shingles."""
    remaining = F.least(F.col("n_shingles_1") - F.col("pos_1"), F.col("n_shingles_2") - F.col("pos_2"))
    needed = _needed(threshold)
    witnesses = block_pairs(
        prefix_index(sets, threshold),
        ("x",),
        "rep_id",
        carry=("n_shingles", "pos"),
        condition=size_compatible(threshold) & (remaining + WITNESSES >= needed),
    )
    counted = witnesses.groupBy("rep_id_1", "rep_id_2").agg(
        F.count(F.lit(1)).alias("found"), F.min(F.least(needed, F.lit(WITNESSES))).alias("wanted")
    )
    return counted.where(F.col("found") >= F.col("wanted")).select("rep_id_1", "rep_id_2")
