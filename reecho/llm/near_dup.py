"""Near-duplicate documents by SetSketch registers (Ertl 2021).

Each distinct shingle set gets registers of exponentially spaced truncated minima: register i
holds floor(1 - log_b of the least Exp(a) value) under hash function i, cut to 0..q+1. Sketches of
parts merge by the larger register. Equal registers are locality-sensitive, so bands of them
name candidates; the joint likelihood of two sketches gives an estimate that drops hopeless
candidates; the rest is confirmed on full sets.

Copies are merged first. Inside a band, sets are compared with one hub at a time, and
a band whose sets have all met in one component is finished; only sets still apart are
compared pair by pair. So a large group of near copies costs rows in proportion to its size,
and no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reecho.llm.common import free_name, groups_in_bands, known_small, mixed, shingle_set, ship, text_key, with_row_id
from reecho.workspace import Workspace


@dataclass(frozen=True)
class NearDupParams:
    """At 80 % similarity 32 bands of 4 registers miss a link with probability 5e-8. Estimates use all registers."""

    shingle_words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    registers: int = 512
    base: float = 1.001
    rate: float = 20.0
    limit: int = 65534
    seed: int = 7


_CHUNK = 1 << 15


def _family(params: NearDupParams) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(params.seed)
    draw = lambda: rng.integers(0, 2**63, params.registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(), draw()


def registers_of(sets: list[np.ndarray], params: NearDupParams) -> np.ndarray:
    """Registers (uint16), one row per non-empty set of 64-bit hashes. Merge sketches with ``np.maximum``."""
    xors, factors = _family(params)
    least = np.empty((len(sets), params.registers), np.uint64)
    sizes = np.array([len(x) for x in sets])
    chunk = np.cumsum(sizes) // _CHUNK
    for at in np.split(np.arange(len(sets)), np.flatnonzero(np.diff(chunk)) + 1):
        hashes = np.concatenate([sets[k] for k in at])
        starts = np.concatenate([[0], np.cumsum(sizes[at])[:-1]])
        for i in range(params.registers):
            least[at, i] = np.minimum.reduceat((hashes ^ xors[i]) * factors[i], starts)
    uniform = (least.astype(np.float64) + 1.0) / 2.0**64
    drawn = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / params.rate
    level = np.floor(1.0 - np.log(drawn) / np.log(params.base))
    return np.clip(level, 0, params.limit + 1).astype(np.uint16)


def _set(text: object, params: NearDupParams) -> np.ndarray:
    return shingle_set(text if isinstance(text, str) else None, params.shingle_words)


def _key(hashes: np.ndarray) -> str | None:
    """128-bit name of a set, null for the empty one."""
    if not len(hashes):
        return None
    halves = (mixed(hashes).sum(dtype=np.uint64), mixed(hashes ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64))
    return f"{int(halves[0]):016x}{int(halves[1]):016x}"


def low_bits(registers: np.ndarray) -> np.ndarray:
    """The lowest bit of each sketch's registers, 64 registers to a number."""
    return np.packbits((registers & 1).astype(np.uint8), axis=1).view(np.int64)


def sketch_documents(docs: DataFrame, params: NearDupParams) -> DataFrame:
    """``(row_id, doc_id, text_key, n_shingles, set_key, registers, bits)``; the last three are null for empty sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sets = [_set(text, params) for text in batch["text"]]
            full = [x for x in sets if len(x)]
            sketched = registers_of(full, params) if full else np.zeros((0, params.registers), np.uint16)
            regs, bits = iter(sketched), iter(low_bits(sketched))
            yield pd.DataFrame({
                "row_id": batch["row_id"],
                "doc_id": batch["doc_id"].astype("Int64"),
                "text_key": batch["text_key"],
                "n_shingles": [len(x) for x in sets],
                "set_key": [_key(x) for x in sets],
                "registers": [next(regs).tobytes() if len(x) else None for x in sets],
                "bits": [next(bits) if len(x) else None for x in sets],
            })

    rows = with_row_id(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_key().alias("text_key")))
    return rows.mapInPandas(
        run, "row_id bigint, doc_id bigint, text_key string, n_shingles bigint, set_key string, registers binary, bits array<bigint>"
    )


def band_ids(registers: Column, params: NearDupParams) -> Column:
    width = 2 * params.rows
    parts = [F.xxhash64(F.lit(i), F.substring(registers, 1 + width * i, width)) for i in range(params.bands)]
    return F.array(*parts)


def could_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, params: NearDupParams) -> np.ndarray:
    """Whether the joint likelihood leaves the threshold possible. Rows are pairs of sketches.

    With known sizes the numbers of larger, smaller and equal registers have a likelihood in
    the similarity alone; a pair goes only if every similarity from the threshold on is e^20 times
    less likely than the best one.
    """
    base = params.base
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = params.registers - more - less
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    j = np.minimum(np.linspace(0.0, 1.0, 101)[None, :], np.minimum(u / v, v / u) - 1e-9)
    chance = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (base - 1) / base) / np.log(base)
    up, down = chance(u - v * j), chance(v - u * j)
    logs = more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-12, 1))
    wanted = np.where(j >= params.percent / 100 - 0.005, logs, -np.inf)
    return wanted.max(axis=1) >= logs.max(axis=1) - 20


def _estimated(pairs: DataFrame, reps: DataFrame, params: NearDupParams) -> DataFrame:
    """Candidate pairs that survive the sizes and the likelihood estimate."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                regs = [np.frombuffer(b"".join(batch[c]), np.uint16).reshape(len(batch), -1) for c in ("reg_a", "reg_b")]
                sizes = [batch[c].to_numpy(np.float64) for c in ("n_a", "n_b")]
                yield batch.loc[could_link(*regs, *sizes, params), ["a", "b"]]

    def side(n: str) -> DataFrame:
        return reps.select(
            F.col("set_key").alias(n), F.col("registers").alias(f"reg_{n}"), F.col("n_shingles").alias(f"n_{n}")
        )

    met = pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes_allow(params))
    return met.mapInPandas(run, "a string, b string")


def _sizes_allow(params: NearDupParams) -> Column:
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * params.percent


def _confirmed(pairs: DataFrame, full: DataFrame, params: NearDupParams) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    side = lambda n: full.select(F.col("set_key").alias(n), F.col("hashes").alias(f"set_{n}"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return met.where(shared * 100 >= union * params.percent).select("a", "b")


def _full_sets(docs: DataFrame, sketches: DataFrame, wanted: DataFrame, params: NearDupParams, space: Workspace) -> DataFrame:
    """``(set_key, hashes)`` of the wanted keys, from one document of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sets = [_set(text, params) for text in batch["text"]]
            yield pd.DataFrame({"set_key": [_key(x) for x in sets], "hashes": [x.view(np.int64) for x in sets]})

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    held = wanted.join(sketches, "set_key").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    ids = known_small(space.save(held.select(F.col("doc_id").alias("held")).distinct(), "held")).hint("shuffle_hash")
    found = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("held")), "left_semi").select("text")
    sets = found.mapInPandas(run, "set_key string, hashes array<bigint>").where("set_key is not null")
    # a doc_id that rows repeat, or a null one, may bring in more sets, or one of them twice
    return sets.join(wanted, "set_key", "left_semi").groupBy("set_key").agg(F.first("hashes").alias("hashes"))


def near_duplicates(docs: DataFrame, params: NearDupParams = NearDupParams(), space: Workspace | None = None) -> DataFrame:
    """``(row_id, doc_id, text_key, n_shingles, component_id, kept, representative)``, one row per input row.

    Links join documents whose shingle sets have ``100 * intersection >= percent * union``.
    ``component_id`` is the least doc_id reachable, ``kept`` says that it is the row's own; rows
    that repeat a doc_id are all marked so, ``representative`` marks exactly one row of a group. Null and empty
    texts have an empty set and stand alone. A null doc_id comes after all others; a group of
    only such rows has a null component. Other columns of ``docs`` are not looked at.
    """
    ship(docs.sparkSession)
    space = space or Workspace.of(docs.sparkSession, "near-dup")
    sketches = space.save(sketch_documents(docs, params), "sketches")
    sets = sketches.where("set_key is not null").select("set_key", "n_shingles", "registers", "bits")
    first = [F.first(c).alias(c) for c in ("registers", "bits")]
    reps = space.save(sets.groupBy("set_key", "n_shingles").agg(*first), "reps")
    found = _groups(docs, sketches, reps, params, space)
    named = (
        sketches.drop("registers", "bits")
        .join(found.withColumnRenamed("node", "set_key"), "set_key", "left")
        .withColumn("group", F.coalesce("component", "set_key", F.concat(F.lit("row "), F.col("row_id").cast("string"))))
    )
    first = named.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id")).alias("first")
    )
    return named.join(first, "group").select(
        "row_id",
        "doc_id",
        "text_key",
        "n_shingles",
        F.col("first.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("kept"),
        (F.col("row_id") == F.col("first.row_id")).alias("representative"),
    )


def keep_representatives(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """The rows of ``docs``, all columns, that represent their group.

    Rows that repeat both doc_id and text, null and empty text being the same, count as one document: one of them stays.
    """
    space = Workspace.of(docs.sparkSession, "near-dedup")
    found = space.save(near_duplicates(docs, params, space), "found")
    key, own_id, times = free_name(docs, "text_key"), free_name(docs, "own_id"), free_name(docs, "times")
    chosen = found.groupBy("doc_id", "text_key").agg(
        F.count(F.lit(1)).alias(times), F.bool_or("representative").alias("representative")
    )
    chosen = chosen.where("representative").select(F.col("doc_id").alias(own_id), F.col("text_key").alias(key), times)
    keyed = docs.withColumn(free_name(docs, "key_of_row"), text_key())
    same = (F.col("doc_id").cast("bigint").eqNullSafe(F.col(own_id))) & (F.col(free_name(docs, "key_of_row")) == F.col(key))
    kept = keyed.join(chosen.hint("shuffle_hash"), same)
    once = kept.where(F.col(times) == 1).unionByName(kept.where(F.col(times) > 1).dropDuplicates([own_id, key]))
    return once.select(*docs.columns)


def _groups(docs: DataFrame, sketches: DataFrame, reps: DataFrame, params: NearDupParams, space: Workspace) -> DataFrame:
    """Connected components ``(node, component)`` of set keys with links."""
    banded = reps.select("set_key", F.explode(band_ids(F.col("registers"), params)).alias("band"))
    crowded = banded.groupBy("band").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low < high")
    bands = space.save(banded.join(crowded.select("band"), "band").withColumnRenamed("set_key", "node"), "bands")

    def prepare(nodes: DataFrame):
        full = space.save(_full_sets(docs, sketches, nodes.select(F.col("node").alias("set_key")), params, space), "full")

        def confirm(pairs: DataFrame, name: str) -> DataFrame:
            possible = space.save(_estimated(pairs, reps, params), f"{name}-close")
            return space.save(_confirmed(possible, full, params), f"{name}-found")

        return confirm

    described = reps.select(F.col("set_key").alias("node"), "n_shingles", band_ids(F.col("registers"), params).alias("bands"), "bits")
    return groups_in_bands(
        space, bands, lambda rows: rows.join(described, "node"), ("n_shingles", "bands", "bits"), _could_be_alike(params), prepare
    )


def _could_be_alike(params: NearDupParams) -> Column:
    """Whether sizes and the lowest bits of the registers leave a pair possible, asked in the pair's first common band only.

    The lowest bits of two registers agree if the registers do, else in one case of two. Six standard deviations
    less than what the threshold leads to are asked for: of links at the threshold one in 10^9 is missed. The test is short, as
    the JVM does not compile long methods.
    """
    agree = params.percent / 100 / 2 + 1 / 2
    most = int(params.registers * (1 - agree) + 6 * (params.registers * agree * (1 - agree)) ** 0.5)
    differ = [f"bit_count(bits_1[{i}] ^ bits_2[{i}])" for i in range(params.registers // 64)]
    sizes = F.least("n_shingles_1", "n_shingles_2") * 100 >= F.greatest("n_shingles_1", "n_shingles_2") * params.percent
    common = F.filter(F.zip_with("bands_1", "bands_2", lambda x, y: F.when(x == y, x)), lambda band: band.isNotNull())
    return sizes & F.expr(f"{' + '.join(differ)} <= {most}") & (F.get(common, F.lit(0)) == F.col("band"))
