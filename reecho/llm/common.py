"""What the training-data operators share: stable row ids, text hashes and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reecho.operators.skew import block_pairs
from reecho.workspace import Workspace

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20240131).integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, through Spark's file server."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "reecho_workers.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                packed.write(file, os.path.relpath(file, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_id(frame: DataFrame, name: str = "row_id") -> DataFrame:
    """Adds a row id. It is stable once the result is written; do so before using it twice."""
    return frame.withColumn(name, F.monotonically_increasing_id())


def text_key(text: str = "text") -> Column:
    """Name of a text; null counts as empty."""
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def free_name(frame: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name where the frame has a column of that name."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted = f"{wanted}_"
    return wanted


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 14)
        step = np.full(size, _ODD)
        step[0] = 1
        back = np.full(size, np.uint64(pow(int(_ODD), -1, 1 << 64)))
        back[0] = 1
        _powers, _inverses = np.cumprod(step), np.cumprod(back)
    return _powers, _inverses


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``data[start:end]``; equal spans hash equally wherever they stand."""
    powers, inverses = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts])


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+``, in order."""
    data = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    return span_hashes(data, np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles, A-Z in lower case.

    A text of fewer words is one shingle as a whole; without words the set is empty.
    """
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(words):
        return words
    width = min(k, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        total = mixed(total + words[i : len(words) - width + 1 + i] + np.uint64(i + 1 + 16 * width))
    return np.unique(total)


def components(space: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``, named by the least node.

    Distributed union-find by contraction: every node joins the neighbour that comes
    first in an order drawn anew each round, links inside a merged group vanish, and the
    rest goes on. The number of links falls by a constant factor each round. A node with
    many links costs one row per link; rows are pre-aggregated and joins can be split.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    links = space.save(edges.where("a <> b").select(*pair, F.lit(0).alias("turn")).distinct(), f"{name}-links-0")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots, step = nodes.select("node", F.col("node").alias("root")), 0
    while not links.isEmpty():
        # the number of the round is a column: the code that Spark generates is then the same in all rounds, and is compiled once
        rank = lambda node: F.struct(F.xxhash64("turn", node).alias("order"), F.col(node).alias("id"))
        both = links.select("a", "b", "turn").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "turn"))
        first = both.groupBy("a", "turn").agg(F.min(rank("b")).alias("first"))
        parent = space.save(first.select("a", F.least("first", rank("a"))["id"].alias("parent")), f"{name}-parent-{step}")
        as_root = parent.select(F.col("a").alias("root"), "parent")
        roots = roots.join(as_root, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
        if step % 4 == 3:
            roots = space.save(roots, f"{name}-roots-{step}")
        moved = links.join(parent.withColumnRenamed("parent", "pa"), "a").join(
            parent.select(F.col("a").alias("b"), F.col("parent").alias("pb")), "b"
        )
        step += 1
        merged = moved.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"), (F.col("turn") + 1).alias("turn"))
        links = space.save(merged.distinct(), f"{name}-links-{step}")
    names = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(names, "root").select("node", "component")


def _bytes_of(frame: DataFrame) -> Column:
    """Bytes that a row's values take, for columns of plain types, structs of these and arrays of eight-byte values."""
    sizes = []
    for field in frame.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            sizes.append(F.octet_length(field.name))
        elif kind == "array":
            sizes.append(8 * F.greatest(F.size(field.name), F.lit(0)))
        else:
            sizes.append(F.lit(8 * len(getattr(field.dataType, "fields", [0]))))
    return sum((F.coalesce(x, F.lit(0)).cast("bigint") for x in sizes), F.lit(0).cast("bigint"))


def known_small(frame: DataFrame, rows: int = 200_000, size: int = 32 << 20) -> DataFrame:
    """Marks a stored frame for broadcast if its rows and their bytes, counted, are few; leaves it to a shuffle otherwise."""
    found = frame.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_bytes_of(frame)), F.lit(0)).alias("size")).first()
    return F.broadcast(frame) if found.rows <= rows and found.size <= size else frame


def _open_bands(rows: DataFrame, turn: int, hubs: int) -> DataFrame:
    """``(band, group_size, label, hubs)`` of the bands with more than one label: the largest label and nodes of it."""
    orders = [F.min(F.struct(F.xxhash64(F.lit(turn * hubs + i), "node").alias("order"), "node")) for i in range(hubs)]
    counted = rows.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"), F.array(*[o["node"] for o in orders]).alias("hubs"))
    found = counted.groupBy("band").agg(F.sum("n").alias("group_size"), F.max(F.struct("n", "label", "hubs")).alias("main"))
    return found.where("group_size > main.n").select("band", "group_size", "main.label", "main.hubs")


def _with_links(space: Workspace, groups: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``groups(node, component)`` after further links between their nodes, which are few: only the groups that these name are merged."""
    of = lambda n: groups.select(F.col("node").alias(n), F.col("component").alias(f"group_{n}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("group_a").alias("a"), F.col("group_b").alias("b"))
    merged = components(space, between, name).select(F.col("node").alias("component"), F.col("component").alias("into"))
    found = groups.join(merged, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return space.save(found, f"{name}-groups")


def groups_in_bands(
    space: Workspace,
    bands: DataFrame,
    sketched: Callable[[DataFrame], DataFrame],
    sketch: tuple[str, ...],
    alike: Column,
    prepare: Callable[[DataFrame], Callable[[DataFrame, str], DataFrame]],
    small: int = 64,
    hubs: int = 4,
    last: tuple[Callable[[DataFrame], DataFrame], tuple[str, ...], Column] | None = None,
) -> DataFrame:
    """Connected components ``(node, component)`` of nodes that share a band and are linked; nodes that may stand alone can be missing.

    ``sketched(rows)`` adds the columns ``sketch`` to rows with ``node`` and ``band``; ``alike`` says of their values ``_1`` and ``_2`` whether a
    pair could link. ``prepare(nodes)`` readies the nodes that may occur in pairs and gives ``confirm(pairs, name)``, which
    finds the links among pairs. Bands of at most ``small`` nodes give all their pairs that could link. In larger ones, rounds of hubs come first:
    in every band that holds more than one component yet, nodes of its largest one are compared with those of the others.
    Hubs are first in orders of all nodes, so bands of one group mostly agree on them. Rounds go on until nothing is
    apart or a round links less than a fiftieth of the rows it met. What is apart then gives all its pairs that could link, met in
    cells: rounds leave few of them. There ``last`` may stand for ``sketched``, ``sketch`` and ``alike``.
    """
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    sizes = space.save(sizes, "band-sizes")
    few = known_small(sizes.where(F.col("group_size") <= small).select("band"), 1_000_000)
    rows = sketched(bands.join(few, "band"))
    one, two = (rows.select("band", *[F.col(c).alias(f"{c}_{n}") for c in ("node", *sketch)]) for n in (1, 2))
    met = one.join(two, "band").where((F.col("node_1") < F.col("node_2")) & alike)
    few = space.save(met.select(F.col("node_1").alias("a"), F.col("node_2").alias("b")).distinct(), "close-few")
    large = sizes.where(F.col("group_size") > small).select("band")
    rows = space.save(bands.join(known_small(large), "band").select("band", "node"), "rows-large")
    nodes = few.select(F.explode(F.array("a", "b")).alias("node")).unionByName(rows.select("node")).distinct()
    nodes = space.save(nodes, "nodes")
    confirm = prepare(nodes)
    linked = components(space, confirm(few, "few"), "few")
    groups = space.save(nodes.join(linked, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "few-groups")
    turn, more = 0, not rows.isEmpty()
    while more:
        labelled = rows.select("band", "node").join(groups.withColumnRenamed("component", "label"), "node")
        labelled = space.save(labelled, f"labelled-{turn}")
        state = space.save(_open_bands(labelled, turn, hubs if turn else 1), f"open-{turn}")
        met = labelled.join(state.select("band", F.col("label").alias("main"), "hubs"), "band").where("label <> main")
        pairs = met.select("node", F.explode(F.array_distinct("hubs")).alias("hub"))
        pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        new = confirm(pairs, f"turn-{turn}")
        found = new.count()
        if found:
            groups = _with_links(space, groups, new, f"turn-{turn}")
        rows = space.save(labelled.join(state.select("band", "group_size"), "band").select("band", "node", "group_size"), f"rows-{turn}")
        left = rows.count()
        more = left > 0 and found * 50 >= left
        turn += 1
        if left and not more:
            sketched, sketch, alike = last or (sketched, sketch, alike)
            still = sketched(rows.join(groups.withColumnRenamed("component", "label"), "node"))
            differ = (F.col("label_1") != F.col("label_2")) & alike
            pairs = block_pairs(still, ("band",), "node", carry=("label", *sketch), condition=differ)
            pairs = space.save(pairs.select(F.col("node_1").alias("a"), F.col("node_2").alias("b")).distinct(), "close-last")
            groups = _with_links(space, groups, confirm(pairs, "last"), "last")
    return groups
