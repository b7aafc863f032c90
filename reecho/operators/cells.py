"""Similar pairs of an author's sets, found and confirmed where two blocks of sets meet.

A pair of sets costs nothing outside the task that compares it: only pairs that reach the threshold leave. What moves are the
sets, once for each block that theirs is met with. An author has at most ``SPREAD`` blocks as long as these stay within
a number of shingles, so that what moves grows in proportion to the sets; beyond, blocks stay bounded and their number grows.
Of the two blocks of a cell one is held, as four bytes a shingle, and the other passes by in parts. Small authors are compared many at a time.

Two ways to choose what is compared. With ``buckets`` or ``banding``, the pairs that share a band. Without, all: for each set, the others are
counted through the words that they share, the set's most frequent words left out, as many as no similar pair needs (Chaudhuri
et al. 2006); who could still reach the threshold is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reecho.operators.documents import SET_KEYS
from reecho.operators.skew import block_of, blocks_of, counted_few, group_sizes, look_up_group
from reecho.params import MERSENNE_PRIME, MatchParams

# Blocks of an author within the bound on shingles, and how many sets make it worth a further one.
SPREAD = 4
FEW_ROWS = 1024
# Most shingles of a block, 64 MB; without the inverted index, which takes several times the room, 256 MB.
ELEMENTS = 1 << 24
BANDED_ELEMENTS = 1 << 26
# Entries of the arrays that are built for a part of a cell.
PART = 1 << 21
# Sets of small authors that are compared at a time, and rows of a result batch.
BUNDLE_ROWS = 4096
OUT_ROWS = 1 << 16

_EPS = 1e-6
PAIRS = "user_id string, rep_id_1 bigint, rep_id_2 bigint, copies_1 bigint, copies_2 bigint, similarity double"


def similar_pairs(
    sets: DataFrame,
    threshold: float,
    buckets: DataFrame | None = None,
    spread: int = SPREAD,
    elements: int | None = None,
    shingled: DataFrame | None = None,
    banding: MatchParams | None = None,
) -> DataFrame:
    """``(user_id, rep_id_1, rep_id_2, copies_1, copies_2, similarity)`` of one author's sets with Jaccard >= threshold.

    ``buckets(rep_id, buckets)`` narrows the pairs to those with an equal bucket; ``banding`` to those with an equal band, which is found
    where the sets meet. If ``sets`` has a column ``fresh``, one set of a pair is fresh. ``shingled`` holds the shingles if ``sets`` does not.
    """
    cell = ["user_id", "low", "high"]
    elements = elements or (ELEMENTS if buckets is None and banding is None else BANDED_ELEMENTS)
    rows, tasks = dealt(sets, buckets, spread, elements, shingled), tasks_for(sets, spread, elements)
    usual = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # more tasks than usual if these would have to read more than a block each
    spread_out = rows.repartition(tasks, *cell) if tasks > usual else rows.repartition(*cell)
    # of a cell, the block that is held comes first, its sets by size
    ordered = spread_out.sortWithinPartitions(*cell, F.col("block") != F.col("low"), F.size("words"))
    return ordered.mapInArrow(_comparer(threshold, _Banding.of(banding)), PAIRS)


def _authors(facts: DataFrame, spread: int, elements: int) -> DataFrame:
    """Authors of several sets, with their number of blocks."""
    groups = group_sizes(facts, ["user_id"], "rep_id", F.sum("n_shingles").alias("weight")).where("group_size > 1")
    blocks = F.greatest(F.least(blocks_of(F.col("group_size"), FEW_ROWS), F.lit(spread)), blocks_of(F.col("weight"), elements))
    return groups.withColumn("blocks", blocks)


def tasks_for(sets: DataFrame, spread: int = SPREAD, elements: int = ELEMENTS) -> int:
    """How many tasks of a block of shingles each all dealt sets make."""
    moved = _authors(sets.where("n_shingles > 0"), spread, elements).agg(F.sum(F.col("weight") * F.col("blocks")).alias("n")).first().n
    return -(-(moved or 0) // elements)


def dealt(
    sets: DataFrame, buckets: DataFrame | None, spread: int = SPREAD, elements: int = ELEMENTS, shingled: DataFrame | None = None
) -> DataFrame:
    """Each set once for each of its author's blocks, with the cell where the two blocks meet."""
    known = sets.where(F.col("user_id").isNotNull() & F.col("rep_id").isNotNull() & (F.col("n_shingles") > 0))
    rows = _placed(known, buckets, spread, elements) if shingled is None else _in_place(known, shingled, spread, elements)
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    return rows.withColumn("other", F.explode(others)).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    ).drop("other")


def _narrow() -> Column:
    # ids have 32 bits: as signed ones they take half the room
    return F.transform("shingles", lambda x: (x - F.lit(1 << 31)).cast("int")).alias("words")


def _block() -> Column:
    return block_of(F.col("rep_id"), F.col("blocks"), 1).alias("block")


def _placed(known: DataFrame, buckets: DataFrame | None, spread: int, elements: int) -> DataFrame:
    """Sets that hold their shingles, with their blocks."""
    facts = known.select("user_id", "rep_id", "n_shingles")
    if buckets is not None:
        facts = facts.join(buckets.select("rep_id", "buckets"), "rep_id")
    placed = look_up_group(facts, _authors(facts, spread, elements), ["user_id"], "rep_id").select(
        "rep_id", "blocks", _block(), *(["buckets"] if buckets is not None else [])
    )
    marks = ["fresh"] if "fresh" in known.columns else []
    return known.select("user_id", "rep_id", F.col("copies").cast("bigint").alias("copies"), _narrow(), *marks).join(placed, "rep_id")


def _in_place(known: DataFrame, shingled: DataFrame, spread: int, elements: int) -> DataFrame:
    """The same for sets whose shingles lie with their documents: these stay where they are if copied sets and authors are few."""
    authors = _authors(known, spread, elements)
    copied = known.where("copies > 1").select(*SET_KEYS, "rep_id", "copies")
    texts = shingled.where(F.col("user_id").isNotNull() & F.col("doc_id").isNotNull() & (F.size("shingles") > 0))
    if counted_few(authors, "user_id") and counted_few(copied, "user_id"):
        named = texts.join(F.broadcast(copied), list(SET_KEYS), "left").where("rep_id IS NULL OR rep_id = doc_id")
        copies = F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies")
        rows = named.select("user_id", F.col("doc_id").alias("rep_id"), copies, "shingles")
        met = rows.join(F.broadcast(authors.select("user_id", "blocks")), "user_id")
        return met.select("user_id", "rep_id", "copies", _narrow(), "blocks", _block())
    facts = known.select("user_id", "rep_id", F.col("copies").cast("bigint").alias("copies"))
    placed = look_up_group(facts, authors.select("user_id", "blocks", "salt_mask"), ["user_id"], "rep_id")
    words = texts.select(F.col("doc_id").alias("rep_id"), _narrow())
    return placed.select("user_id", "rep_id", "copies", "blocks", _block()).join(words, "rep_id")


@dataclass(frozen=True)
class _Banding:
    """Bands of MinHash values, computed from the words of a cell."""

    family: tuple[tuple[int, int], ...]
    prime: int
    width: int

    @classmethod
    def of(cls, params: MatchParams | None) -> "_Banding | None":
        return params and cls(tuple(params.hash_family()), params.prime, params.rows_per_band)

    def buckets(self, words: np.ndarray, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The bucket ids of each set, one per band: hashes of its author's number, the band and its values."""
        least = np.empty((len(self.family), len(start) - 1), np.int64)
        for first, last in _parts(np.diff(start), 1 << 15):
            part, starts = words[start[first] : start[last]].astype(np.int64) + (1 << 31), start[first:last] - start[first]
            for i, (a, b) in enumerate(self.family):
                least[i, first:last] = np.minimum.reduceat(self._reduced(a * part + b), starts)
        found = np.empty((len(start) - 1, len(self.family) // self.width), np.int64)
        for band in range(found.shape[1]):
            key = _mixed(group.astype(np.uint64) * np.uint64(len(self.family)) + np.uint64(band))
            for values in least[band * self.width : (band + 1) * self.width]:
                key = _mixed(key + values.astype(np.uint64))
            found[:, band] = key.view(np.int64)
        return found

    def _reduced(self, x: np.ndarray) -> np.ndarray:
        """``x`` modulo the prime; overwrites ``x``."""
        if self.prime != MERSENNE_PRIME:
            return x % self.prime
        for _ in range(2):
            high = x >> 31
            x &= MERSENNE_PRIME
            x += high
        if x.max() >= MERSENNE_PRIME:
            x[x >= MERSENNE_PRIME] -= MERSENNE_PRIME
        return x


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _comparer(threshold: float, banding: _Banding | None):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = None
        for second, cell, pieces in _portions(batches):
            if second:
                if held is not None and held.cell == cell:
                    side = _Side.of(pieces, banding)
                    yield from _similar(side, *held.numbered(side), held, threshold)
            else:
                held = None
                held = _Held.of(pieces, cell, banding)
                if held.diagonal:
                    yield from _similar(held.side, held.words, held.side.start, held, threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _out(found(batches))

    return compare


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, int, list[_Piece]]]:
    """Whether it is a cell's second block, the cell's number, rows. A first block, or several small authors, come whole, a second one in parts.

    ``group`` numbers the cells. The list is the receiver's, who may empty it.
    """
    held, rows, size, last, single, number, second, cell = [], 0, 0, None, False, 0, False, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        key = [table.column(c).combine_chunks() for c in ("user_id", "low", "high")]
        changed = np.zeros(len(table), dtype=bool)
        changed[0] = [column[0].as_py() for column in key] != last
        for column in key:
            changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        last = [column[-1].as_py() for column in key]
        groups = number + np.cumsum(changed)
        number = int(groups[-1])
        table = table.append_column("group", pa.array(groups.astype(np.int64)))
        later = table.column("block").to_numpy() != table.column("low").to_numpy()
        changed |= np.diff(later, prepend=second)
        lone = table.column("blocks").to_numpy() == 1
        total = np.append(0, np.cumsum(pc.list_value_length(table.column("words")).to_numpy()))
        begun = 0
        for start in np.flatnonzero(changed).tolist():
            few = rows + start - begun < BUNDLE_ROWS and size + total[start] - total[begun] < PART
            if (held or start > begun) and not (single and lone[start] and few):
                if start > begun:
                    held.append(_Piece.of(table.slice(begun, start - begun)))
                pieces, held, rows, size, begun = held, [], 0, 0, start
                yield second, cell, pieces
            single, second, cell = bool(lone[start]), bool(later[start]), int(groups[start])
        held.append(_Piece.of(table.slice(begun)))
        rows, size = rows + len(table) - begun, size + total[-1] - total[begun]
        if second and size >= PART:
            pieces, held, rows, size = held, [], 0, 0
            yield second, cell, pieces
    if held:
        yield second, cell, held


@dataclass
class _Piece:
    """Rows of a batch, copied, so that the batch's memory serves the next one."""

    diagonal: bool
    user: pa.Array
    rep: np.ndarray
    copies: np.ndarray
    group: np.ndarray
    n: np.ndarray
    words: np.ndarray
    bucket_n: np.ndarray | None
    buckets: np.ndarray | None
    fresh: np.ndarray | None

    @classmethod
    def of(cls, table: pa.Table) -> "_Piece":
        def values(name: str) -> np.ndarray | None:
            return np.array(table.column(name).to_numpy()) if name in table.column_names else None

        def lists(name: str) -> tuple[np.ndarray | None, np.ndarray | None]:
            if name not in table.column_names:
                return None, None
            given = table.column(name).combine_chunks()
            return pc.list_value_length(given).to_numpy().astype(np.int64), np.array(given.flatten().to_numpy())

        diagonal = table.column("low")[0] == table.column("high")[0]
        user = pa.concat_arrays(table.column("user_id").chunks)
        return cls(diagonal, user, values("rep_id"), values("copies"), values("group"), *lists("words"), *lists("buckets"), values("fresh"))


@dataclass
class _Side:
    """Sets by size: ids, copies, sizes, and words, which lie in several arrays, from ``start[i]`` to ``start[i + 1]``."""

    user: pa.Array
    rep: np.ndarray
    copies: np.ndarray
    n: np.ndarray
    start: np.ndarray
    words: list[np.ndarray]
    buckets: np.ndarray | None
    bucket_start: np.ndarray | None
    fresh: np.ndarray | None

    @classmethod
    def of(cls, pieces: list[_Piece], banding: _Banding | None) -> "_Side":
        """A block's sets arrive by size, and their words are not copied; those of several authors are put in order."""
        if banding is not None:
            for piece in pieces:
                piece.buckets = banding.buckets(piece.words, np.append(0, np.cumsum(piece.n)), piece.group)
                piece.bucket_n = np.full(len(piece.n), piece.buckets.shape[1])
                piece.buckets = piece.buckets.ravel()

        def joined(name: str) -> np.ndarray | None:
            parts = [getattr(piece, name) for piece in pieces]
            return None if parts[0] is None else np.concatenate(parts)

        n, group = joined("n"), joined("group")
        user, rep, copies, fresh = pa.concat_arrays([piece.user for piece in pieces]), joined("rep"), joined("copies"), joined("fresh")
        buckets, bucket_n = joined("buckets"), joined("bucket_n")
        words = [piece.words for piece in pieces]
        if (group != group[0]).any():
            # the words of different authors are different words
            words = [(np.repeat(group - group.min(), n) << 32) + np.concatenate(words)]
        if (np.diff(n) < 0).any():
            order = np.argsort(n, kind="stable")
            words = [np.concatenate(words)[_ranges((np.cumsum(n) - n)[order], n[order])]]
            if buckets is not None:
                buckets = buckets[_ranges((np.cumsum(bucket_n) - bucket_n)[order], bucket_n[order])]
                bucket_n = bucket_n[order]
            user, n, rep, copies = user.take(pa.array(order)), n[order], rep[order], copies[order]
            fresh = None if fresh is None else fresh[order]
        bucket_start = None if buckets is None else np.append(0, np.cumsum(bucket_n))
        return cls(user, rep, copies, n, np.append(0, np.cumsum(n)), words, buckets, bucket_start, fresh)


@dataclass
class _Held:
    """The block of a cell that the other one is compared with, its words as numbers in a vocabulary."""

    cell: int
    diagonal: bool
    side: _Side
    vocabulary: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, pieces: list[_Piece], cell: int, banding: _Banding | None) -> "_Held":
        diagonal, side = pieces[0].diagonal, _Side.of(pieces, banding)
        pieces.clear()
        vocabulary = np.unique(np.concatenate([np.unique(words) for words in side.words]))
        numbers, at = np.empty(int(side.start[-1]), dtype=np.int32), 0
        while side.words:
            # a part of the words goes as soon as it is numbered
            words = side.words.pop(0)
            numbers[at : at + len(words)] = np.searchsorted(vocabulary, words)
            at += len(words)
            del words
        return cls(cell, diagonal, side, vocabulary, numbers)

    def numbered(self, other: _Side) -> tuple[np.ndarray, np.ndarray]:
        """The words of another block's sets that occur in this one, as numbers, and where those of each set start."""
        words = np.concatenate(other.words)
        at = np.searchsorted(self.vocabulary, words).astype(np.int32)
        at[at == len(self.vocabulary)] = 0
        met = self.vocabulary[at] == words
        return at[met], np.append(0, np.cumsum(met))[other.start]

    @cached_property
    def by_bucket(self) -> tuple[np.ndarray, np.ndarray]:
        """The buckets in order, and whose each is."""
        order = np.argsort(self.side.buckets, kind="stable")
        return self.side.buckets[order], np.repeat(np.arange(len(self.side.n), dtype=np.int32), np.diff(self.side.bucket_start))[order]

    @cached_property
    def by_word(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whose the words are, in order, how many hold each, and where its holders start."""
        holders = np.repeat(np.arange(len(self.side.n), dtype=np.int32), self.side.n)[np.argsort(self.words, kind="stable")]
        held_by = np.bincount(self.words, minlength=len(self.vocabulary))
        return holders, held_by, np.cumsum(held_by) - held_by


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def _parts(weights: np.ndarray, most: int = PART) -> Iterator[tuple[int, int]]:
    """Stretches of at most ``most`` in total, or one entry."""
    total, at = np.cumsum(weights), 0
    while at < len(weights):
        end = int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right"))
        yield at, (at := max(end, at + 1))


def _similar(left: _Side, left_words: np.ndarray, left_start: np.ndarray, held: _Held, threshold: float) -> Iterator[dict]:
    """The similar pairs of sets and those of the block that is held, in parts."""
    right, right_words = held.side, held.words
    if left.buckets is None:
        chosen = _all(left, left_words, left_start, held, threshold)
    else:
        chosen = _banded(left, held, threshold)
    flags = np.zeros(len(held.vocabulary), dtype=np.uint8)
    for i, others in chosen:
        mine = left_words[left_start[i] : left_start[i + 1]]
        flags[mine] = 1
        for a, b in _parts(right.n[others]):
            some = others[a:b]
            sizes = right.n[some]
            found = flags[right_words[_ranges(right.start[some], sizes)]]
            shared = np.add.reduceat(found, np.cumsum(sizes) - sizes, dtype=np.int64)
            similarity = shared / (left.n[i] + sizes - shared)
            hit = (similarity >= threshold) & (right.rep[some] != left.rep[i])
            if left.fresh is not None:
                hit &= left.fresh[i] | right.fresh[some]
            if hit.any():
                j, mirrored = some[hit], right.rep[some[hit]] < left.rep[i]
                yield {
                    "user_id": (left.user[i], len(j)),
                    "rep_id_1": np.where(mirrored, right.rep[j], left.rep[i]),
                    "rep_id_2": np.where(mirrored, left.rep[i], right.rep[j]),
                    "copies_1": np.where(mirrored, right.copies[j], left.copies[i]),
                    "copies_2": np.where(mirrored, left.copies[i], right.copies[j]),
                    "similarity": similarity[hit],
                }
        flags[mine] = 0


def _compatible(left: _Side, right: _Side, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each left set the stretch of right sets, which lie by size, that are neither too small nor too large."""
    least = np.searchsorted(right.n, threshold * left.n - _EPS, side="left")
    return least, np.searchsorted(right.n, (left.n + _EPS) / threshold, side="right")


def _banded(left: _Side, held: _Held, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """Each left set with the sets of the held block that share a bucket."""
    right, (ordered, holders) = held.side, held.by_bucket
    least, most = _compatible(left, right, threshold)
    for begin, end in _parts(np.diff(left.bucket_start)):
        starts = left.bucket_start[begin : end + 1]
        own = left.buckets[starts[0] : starts[-1]]
        first = np.searchsorted(ordered, own, side="left")
        count = np.searchsorted(ordered, own, side="right") - first
        holder = np.repeat(np.arange(begin, end), np.diff(starts))
        starts = starts - starts[0]
        for a, b in _parts(np.diff(np.append(0, np.cumsum(count))[starts])):
            part = slice(starts[a], starts[b])
            i = np.repeat(holder[part], count[part])
            j = holders[_ranges(first[part], count[part])]
            fits = (j >= least[i]) & (j < most[i])
            if held.diagonal:
                fits &= j > i
            if left.fresh is not None:
                fits &= left.fresh[i] | right.fresh[j]
            i, j = np.divmod(np.unique(i[fits] * len(right.n) + j[fits]), len(right.n))
            bounds = np.append(np.flatnonzero(np.diff(i, prepend=-1)), len(i))
            for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                yield i[start], j[start:stop]


def _all(left: _Side, left_words: np.ndarray, left_start: np.ndarray, held: _Held, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """Each left set with all sets of the held block that could reach the threshold."""
    right, (holders, held_by, first) = held.side, held.by_word
    least, most = _compatible(left, right, threshold)
    share = threshold / (1 + threshold)
    needed = share * right.n - _EPS
    for i in range(len(left.n)):
        a, b = max(least[i], i + 1) if held.diagonal else least[i], most[i]
        if a >= b:
            continue
        mine = left_words[left_start[i] : left_start[i + 1]]
        # a similar pair shares at least this share of the left set: one word more than are left out
        spare = min(int(np.ceil(threshold * left.n[i] - _EPS)) - 1, len(mine))
        if spare > 0:
            mine = mine[np.argsort(held_by[mine], kind="stable")[: len(mine) - spare]]
        spare = max(spare, 0)
        counted = np.bincount(holders[_ranges(first[mine], held_by[mine])], minlength=len(right.n))
        others = a + np.flatnonzero(counted[a:b] + spare >= needed[a:b] + share * left.n[i])
        others = others[counted[others] > 0]
        if len(others):
            yield i, others


def _out(found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for part in found:
        held.append(part)
        rows += part["user_id"][1]
        if rows >= OUT_ROWS:
            yield _batch(held)
            held, rows = [], 0
    if held:
        yield _batch(held)


def _batch(held: list[dict]) -> pa.RecordBatch:
    users = pa.concat_arrays([pa.repeat(user, n).cast(pa.string()) for user, n in (part["user_id"] for part in held)])
    columns = {name: np.concatenate([part[name] for part in held]) for name in held[0] if name != "user_id"}
    return pa.RecordBatch.from_pydict({"user_id": users, **columns})
