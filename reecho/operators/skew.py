"""Grouping helpers that stay balanced when one group holds much of the data.

Three rules hold throughout the package: sizes are counted with partial
aggregation, a group's facts are looked up on (key, salt), and pairs inside a
group are built in cells of bounded size. No rows are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64
BLOCK_ROWS = 2048
BROADCAST_ROWS = 10_000
# Counted rows, and bytes of one of their columns, that are still sent to every task.
FEW_ROWS = 200_000
FEW_BYTES = 16 << 20


def broadcast_if_bounded(rows: DataFrame, bound: int | None) -> DataFrame:
    """Marks rows for broadcast if a limit proves that there are few; leaves them alone otherwise."""
    return F.broadcast(rows) if bound is not None and bound <= BROADCAST_ROWS else rows


def counted_few(rows: DataFrame, text: str | None = None) -> bool:
    """Whether the rows are few enough for a broadcast. They are counted, and so are the bytes of the column ``text``."""
    size = F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) if text else F.lit(0)
    found = rows.agg(F.count(F.lit(1)).alias("rows"), size.alias("size")).first()
    return found.rows <= FEW_ROWS and found.size <= FEW_BYTES


def salt_of(row_id: Column) -> Column:
    return F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int")


def salts_seen(row_id: Column) -> Column:
    """Aggregate: 64-bit mask of the salts that occur in a group."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), salt_of(row_id)))


def group_sizes(rows: DataFrame, keys: Sequence[str], row_id: str, *extra: Column) -> DataFrame:
    """One row per group: the keys, ``group_size``, ``salt_mask`` and ``extra`` aggregates."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_size"), salts_seen(F.col(row_id)).alias("salt_mask"), *extra
    )


def look_up_group(rows: DataFrame, groups: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Join rows to their group's facts (one row per group, with ``salt_mask``).

    The join key includes a salt, so a hot group is spread over up to 64 tasks.
    A group's facts are repeated only for salts that occur in it: at most as often
    as it has rows.
    """
    every_salt = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted_groups = (
        groups.withColumn("salt", F.explode(every_salt))
        .where(F.getbit(F.col("salt_mask"), F.col("salt")) == 1)
        .drop("salt_mask")
    )
    salted_rows = rows.withColumn("salt", salt_of(F.col(row_id)))
    return salted_rows.join(salted_groups, [*keys, "salt"]).drop("salt")


def keep_shared(rows: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Rows whose group has at least two rows, with ``group_size`` added."""
    groups = group_sizes(rows, keys, row_id).where(F.col("group_size") > 1)
    return look_up_group(rows, groups, keys, row_id)


def blocks_of(size: Column, block_rows: int = BLOCK_ROWS) -> Column:
    return F.ceil(size / F.lit(block_rows)).cast("int")


def block_of(row_id: Column, size: Column, block_rows: int = BLOCK_ROWS) -> Column:
    """Which of a group's blocks a row belongs to."""
    return F.pmod(F.xxhash64(row_id), blocks_of(size, block_rows)).cast("int")


def block_pairs(
    rows: DataFrame,
    keys: Sequence[str],
    row_id: str,
    carry: Sequence[str] = (),
    condition: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs ``<id>_1 < <id>_2`` of rows that share all ``keys``, each exactly once per group.

    ``rows`` needs ``group_size``. A group of g blocks becomes g*(g+1)/2 cells of at
    most two blocks each, joined independently, so no task meets a whole hot group.
    ``condition`` may use the carried columns (suffixes ``_1`` and ``_2``) and is
    evaluated inside the join.
    """
    blocked = rows.withColumn("block", block_of(F.col(row_id), F.col("group_size"), block_rows))
    celled = blocked.select(
        *keys,
        row_id,
        *carry,
        "block",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), blocks_of(F.col("group_size"), block_rows) - 1),
                lambda other: F.struct(
                    F.least(F.col("block"), other).alias("low"), F.greatest(F.col("block"), other).alias("high")
                ),
            )
        ).alias("cell"),
    ).select(*keys, row_id, *carry, "block", "cell.low", "cell.high")

    def side(n: int) -> DataFrame:
        renamed = [F.col(c).alias(f"{c}_{n}") for c in (row_id, *carry, "block")]
        return celled.select(*keys, "low", "high", *renamed)

    paired = (F.col(f"{row_id}_1") < F.col(f"{row_id}_2")) & (
        (F.col("low") == F.col("high")) | (F.col("block_1") != F.col("block_2"))
    )
    if condition is not None:
        paired = paired & condition
    return side(1).join(side(2), [*keys, "low", "high"]).where(paired).drop("low", "high", "block_1", "block_2")


def block_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_id: str,
    carry: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """All combinations of a left and a right row that share ``keys``, in cells of one block each.

    Columns get the suffixes ``_1`` (left) and ``_2`` (right).
    """
    def sizes(rows: DataFrame, n: int) -> DataFrame:
        return group_sizes(rows, keys, row_id).select(
            *keys, F.col("group_size").alias(f"size_{n}"), F.col("salt_mask").alias(f"mask_{n}")
        )

    both = sizes(left, 1).join(sizes(right, 2), list(keys))

    def side(rows: DataFrame, n: int) -> DataFrame:
        other = 3 - n
        facts = both.select(*keys, "size_1", "size_2", F.col(f"mask_{n}").alias("salt_mask"))
        met = look_up_group(rows, facts, keys, row_id)
        renamed = [F.col(c).alias(f"{c}_{n}") for c in (row_id, *carry)]
        return met.select(
            *keys,
            *renamed,
            block_of(F.col(row_id), F.col(f"size_{n}"), block_rows).alias(f"block_{n}"),
            F.explode(F.sequence(F.lit(0), blocks_of(F.col(f"size_{other}"), block_rows) - 1)).alias(f"block_{other}"),
        )

    return side(left, 1).join(side(right, 2), [*keys, "block_1", "block_2"]).drop("block_1", "block_2")
