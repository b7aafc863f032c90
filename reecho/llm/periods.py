"""Periodic runs of words: the maximal stretches that repeat a shorter one at least three times.

Longest common extensions (LCE) come from a difference cover (Puglisi and Turpin 2008): of every seven places three are
sampled so that any two places reach samples together within six steps. Only sampled suffixes are sorted; an
LCE compares the words up to the synchronised samples and then takes a range minimum, by a sparse table, over the
common prefixes of neighbours in that order. For each period q the grid places 0, q, 2q, ... are compared with those q
further on, n/1 + n/2 + ... comparisons in all: a run of three periods or more always holds a whole grid step.

Texts of a batch are laid out one after the other, each with an end of its own that equals nothing, and are worked on
together; no stretch crosses an end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reecho.llm.common import free_name, ship

# The residues 1, 2, 4 have every difference modulo 7.
COVER, MODULUS = (1, 2, 4), 7
# Steps from places with residues i and j to the next pair of sampled places.
STEPS = np.array([[min(d for d in range(7) if (i + d) % 7 in COVER and (j + d) % 7 in COVER) for j in range(7)] for i in range(7)])

BYTES_A_WORD = 8
RUN = "struct<start:bigint,length:bigint,period:bigint>"


@dataclass(frozen=True)
class RunParams:
    """A run has at least ``min_words`` words and ``min_times`` (3 or more) periods. Texts are worked on ``words_at_once`` together."""

    min_words: int = 24
    min_times: int = 3
    words_at_once: int = 1 << 16


class CommonExtensions:
    """LCE of places of ``ids``, whose last word of each text occurs once."""

    def __init__(self, ids: np.ndarray):
        self.size = len(ids)
        # beyond the end stand numbers that occur once, so that windows may reach over it
        self.ids = np.concatenate([ids, ids.max(initial=0) + 1 + np.arange(2 * MODULUS)]).astype(np.int64)
        places = np.arange(self.size)
        sampled = places[np.isin(places % MODULUS, COVER)]
        self.rank = np.full(len(self.ids), -1)
        levels = self._sort(sampled)
        order = sampled[np.argsort(levels[-1])] if len(sampled) else sampled
        self.rank[order] = np.arange(len(order))
        self._table(self._neighbours(order, levels, sampled))

    def _sort(self, sampled: np.ndarray) -> list[np.ndarray]:
        """Names of sampled places' windows of 7, 14, 28, ... words, equal for equal windows and in their order."""
        self.slot = np.full(len(self.ids) + MODULUS, -1)
        self.slot[sampled] = np.arange(len(sampled))
        bits = max(1, int(self.ids.max()).bit_length())
        at_once = 62 // bits
        windows = self.ids[sampled[:, None] + np.arange(MODULUS)] if len(sampled) else np.zeros((0, MODULUS), np.int64)
        keys = []
        for at in range(0, MODULUS, at_once):
            key = np.zeros(len(sampled), np.int64)
            for k in range(at, min(at + at_once, MODULUS)):
                key = (key << bits) | windows[:, k]
            keys.append(key)
        levels, width = [_names(keys)], MODULUS
        while len(sampled) and levels[-1].max() + 1 < len(sampled):
            # the place a window further on is sampled too; beyond the end comes first
            further = self.slot[np.minimum(sampled + width, len(self.slot) - 1)]
            after = np.where(further >= 0, levels[-1][further], -1) + 1
            levels.append(_names([levels[-1] * (len(sampled) + 1) + after]))
            width *= 2
        return levels

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray], sampled: np.ndarray) -> np.ndarray:
        """Common prefixes of neighbours in the order, by descending the levels and then word by word."""
        one, two = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(one), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = (one < self.size) & (two < self.size)
            slots = self.slot[np.where(inside, one, 0)], self.slot[np.where(inside, two, 0)]
            same = inside & (slots[0] >= 0) & (slots[1] >= 0) & (levels[level][slots[0]] == levels[level][slots[1]])
            step = np.where(same, MODULUS << level, 0)
            one, two, common = one + step, two + step, common + step
        return common + self._by_word(one, two, np.full(len(one), MODULUS))

    def _by_word(self, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from both places on, ``most`` of them at most (up to 7)."""
        found, going = np.zeros(len(one), np.int64), np.arange(len(one))
        last = len(self.ids) - 1
        for k in range(MODULUS):
            going = going[most[going] > k]
            # the greater place only can be near the end, where each number occurs once
            equal = self.ids[np.minimum(one[going] + k, last)] == self.ids[np.minimum(two[going] + k, last)]
            going = going[equal]
            found[going] = k + 1
        return found

    def _table(self, common: np.ndarray) -> None:
        self.table = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            row = self.table[-1]
            self.table.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """LCE of pairs of different places."""
        steps = STEPS[one % MODULUS, two % MODULUS]
        found = self._by_word(one, two, steps)
        far = np.flatnonzero(found == steps)
        if not len(far):
            return found
        ends = np.minimum(one[far], two[far]) + steps[far], np.maximum(one[far], two[far]) + steps[far]
        inside = ends[1] < self.size
        far, ends = far[inside], (ends[0][inside], ends[1][inside])
        ranks = self.rank[ends[0]], self.rank[ends[1]]
        low, high = np.minimum(*ranks), np.maximum(*ranks)
        # the least of common[low .. high - 1], from two rows that overlap
        height = np.frexp((high - low).astype(np.float64))[1] - 1
        least = np.empty(len(far), np.int64)
        for h in np.unique(height):
            at = np.flatnonzero(height == h)
            row = self.table[h]
            least[at] = np.minimum(row[low[at]], row[high[at] - (1 << h)])
        found[far] += least
        return found


def _names(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows by their keys, first key first."""
    if len(keys) == 1:
        return np.unique(keys[0], return_inverse=True)[1]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        own = key[order]
        new[1:] |= own[1:] != own[:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    return names


def find_runs(ids: np.ndarray, longest: int, params: RunParams = RunParams()) -> np.ndarray:
    """``(start, length, period)`` rows of all runs, by start, then period. ``longest`` bounds a text's words."""
    extensions = None
    firsts, periods = [], []
    for q in range(1, longest // params.min_times + 1):
        here, there = ids[: len(ids) - q : q], ids[q::q]
        at = np.flatnonzero(here[: len(there)] == there)
        if len(at):
            firsts.append(at * q)
            periods.append(np.full(len(at), q))
    if not firsts:
        return np.zeros((0, 3), np.int64)
    at, period = np.concatenate(firsts), np.concatenate(periods)
    extensions = CommonExtensions(ids)
    ahead = extensions.of(at, at + period)
    # of the grid places in a stretch the first one counts: where the place before reaches this one, the stretch holds it too
    step = (ahead >= period) & ~np.concatenate([[False], (period[1:] == period[:-1]) & (at[1:] - at[:-1] == period[1:]) & (ahead[:-1] >= period[:-1])])
    at, period, ahead = at[step], period[step], ahead[step]
    # the stretch's own start lies less than a period back: the least place that still reaches this one
    low, high = np.maximum(at - period + 1, 0), at.copy()
    while (low < high).any():
        middle = (low + high) // 2
        reaches = extensions.of(middle, middle + period) >= at - middle
        high = np.where(reaches, middle, high)
        low = np.where(reaches, low, np.minimum(middle + 1, high))
    length = at + ahead + period - high
    runs = np.stack([high, length, period], axis=1)
    runs = runs[(length >= params.min_times * period) & (length >= params.min_words)]
    # a multiple of the smallest period has the same stretch
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def parts_of_like_length(sizes: np.ndarray, at_once: int) -> Iterator[np.ndarray]:
    """Places of ``sizes`` in parts of like sizes that add up to ``at_once`` or are one alone."""
    order = np.argsort(sizes, kind="stable")
    first, held = 0, 0
    for k, size in enumerate(sizes[order]):
        if k > first and held + size > at_once:
            yield order[first:k]
            first, held = k, 0
        held += size
    if first < len(order):
        yield order[first:]


def runs_of_texts(texts: list[list[bytes]], params: RunParams = RunParams()) -> list[np.ndarray]:
    """Runs of each text, given as words; texts of like length are worked on together."""
    found = [np.zeros((0, 3), np.int64)] * len(texts)
    sizes = np.array([len(words) for words in texts], np.int64)
    long = np.flatnonzero(sizes >= params.min_words)
    for part in parts_of_like_length(sizes[long], params.words_at_once):
        _together(texts, long[part].tolist(), found, params)
    return found


def _together(texts: list[list[bytes]], part: list[int], found: list[np.ndarray], params: RunParams) -> None:
    laid: list[bytes] = []
    for k in part:
        laid += texts[k]
    words, _ = pd.factorize(np.array(laid, dtype=object))
    sizes = np.array([len(texts[k]) for k in part])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    ids = np.empty(int(sizes.sum()) + len(part), np.int64)
    ends = starts + sizes
    is_end = np.zeros(len(ids), bool)
    is_end[ends] = True
    ids[~is_end] = words
    ids[ends] = words.max() + 1 + np.arange(len(part))
    runs = find_runs(ids, int(sizes.max()), params)
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    runs[:, 0] -= starts[owner]
    for k in np.unique(owner):
        found[part[k]] = runs[owner == k]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that are in no run after that run's first period."""
    if not len(runs):
        return words
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(covered)[:-1] == 0)]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with most periods, exactly; of several the one that starts first, then the shorter period."""
    if not len(runs):
        return None
    return min((tuple(int(x) for x in r) for r in runs), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def periodic_runs(docs: DataFrame, params: RunParams = RunParams()) -> DataFrame:
    """The rows of ``docs``, all columns, with ``n_words``, ``runs``, ``strongest`` and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` lists each run's start, length and smallest period, by start, then period;
    ``strongest`` is the one with most periods (null without runs); ``collapsed`` joins by one space the words that are in no run after its first
    period. Null and empty texts have no words. Each row stands for itself; names that clash get a trailing underscore.
    """
    ship(docs.sparkSession)

    @F.pandas_udf(f"n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed string")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ("start", "length", "period")
        named = lambda run: dict(zip(names, run, strict=True))
        for batch in batches:
            rows: list = [None] * len(batch)
            texts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in batch]
            # words are cut part by part: a word takes several times its letters
            for part in parts_of_like_length(np.array([len(t) for t in texts], np.int64), BYTES_A_WORD * params.words_at_once):
                cut = [texts[k].split() for k in part]
                for k, words, runs in zip(part, cut, runs_of_texts(cut, params), strict=True):
                    best = strongest(runs)
                    left = b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass")
                    rows[k] = (len(words), [named(r) for r in runs.tolist()], best and named(best), left)
            yield pd.DataFrame(rows, columns=["n_words", "runs", "strongest", "collapsed"])

    name = free_name(docs, "found_runs")
    names = {c: free_name(docs, c) for c in ("n_words", "runs", "strongest", "collapsed")}
    kept = docs.withColumn(name, find("text"))
    return kept.select(*docs.columns, *[F.col(name)[c].alias(n) for c, n in names.items()])
