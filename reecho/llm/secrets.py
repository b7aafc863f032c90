"""Secrets in texts: three fixed patterns, and credential values that are hard to guess.

A value that stands where a password is expected is judged by what it costs to guess: the cheapest
way to cut it into known words, dates, repeats, keyboard walks and brute-force spans, found by
dynamic programming (after Wheeler, zxcvbn, 2016). How common a word is follows from the documents.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reecho.llm.common import ascii_lower, ship
from reecho.workspace import Workspace

# The patterns of the base kinds.
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = re.compile(rf"(?ai)(?:{KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "value")

# Credential contexts beyond the base ones: more names, at a word's start or a camel-case hump, and values of any
# printable characters, as long as they go on.
CONTEXT = re.compile(
    r"(?ai)(?:(?<![a-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))(?:password|passwd|passphrase|passcode|pwd|pass|pin|secret|client_secret|token|auth"
    r"|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?[\"']?(?:\x20*[:=]{1,2}>?\x20*|\x20+is\x20+)[\"']?(?=[\x21\x23-\x26\x28-\x7e]{6})"
)
VALUE = re.compile(r"[\x21\x23-\x26\x28-\x7e]+")
HINTS = ("pass", "pwd", "pin", "secret", "token", "auth", "key", "credential")
COMMON = ("password", "secret", "token", "admin", "welcome", "letmein", "qwerty", "changeme", "default", "example", "none", "null", "true", "false")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop", "abcdefghijklmnopqrstuvwxyz")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?[01]?\d[-/._]?[0-3]?\d|[0-3]?\d[-/._]?[01]?\d[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
LEET = str.maketrans("013457@$", "oleastas")


@dataclass(frozen=True)
class SecretParams:
    """``min_log10``: values that take fewer than 10**8 guesses are words or placeholders, not secrets."""

    min_log10: float = 8.0
    words: int = 20_000
    max_word: int = 24


def guess_cost(value: str, ranks: dict[str, int], max_word: int = 24, enough: float = math.inf) -> float:
    """log10 of the guesses for the cheapest segmentation of ``value``, in time linear in its length.

    Where every segmentation is known to cost ``enough``, the rest is not looked at and a lower bound of at least ``enough`` is given.
    """
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    classes = sum(size for size, kind in ((10, r"[0-9]"), (26, r"[a-z]"), (26, r"[A-Z]"), (33, r"[^0-9A-Za-z]")) if re.search(kind, value))
    one = math.log10(max(classes, 10))
    repeats = re.finditer(r"(.{1,8}?)\1{2,}", low)
    repeat = next(repeats, None)
    rows = [r for keys in ROWS for r in (keys, keys[::-1])]
    resume = [0] * len(rows)
    # costs of the ends reached from the places looked at so far; every segmentation passes one of them
    best = {0: 0.0}
    for start in range(n):
        here = best.pop(start)
        # joining another span costs a doubling: the guesser has to try where the cut is
        joined = here + (math.log10(2) if start else 0.0)
        reached = [(start + 1, here + one)]
        for end in range(start + 3, min(n, start + max_word) + 1):
            rank, extra = ranks.get(low[start:end]), 0.0
            if rank is None:
                rank, extra = ranks.get(plain[start:end]), math.log10(4)
            if rank is not None:
                cased = 0.0 if value[start:end] == low[start:end] else math.log10(2 * (end - start))
                reached.append((end, joined + math.log10(rank + 1) + extra + cased))
        if low[start].isdigit() and (found := DATE.match(low, start)):
            reached.append((found.end(), joined + math.log10(365 * 120)))
        # at least three characters along a keyboard row or the alphabet, either way
        for i, row in enumerate(rows):
            if resume[i] == start:
                end, at = start, row.find(low[start])
                while at >= 0 and end < n and at + end - start < len(row) and row[at + end - start] == low[end]:
                    end += 1
                if end - start >= 3:
                    reached.append((end, joined + math.log10(len(ROWS) * 2 * len(row) * (end - start))))
                resume[i] = max(end, start + 1)
        if repeat and repeat.start() == start:
            unit = len(repeat[1])
            reached.append((repeat.end(), joined + math.log10(95) * unit + math.log10(len(repeat[0]) / unit)))
            repeat = next(repeats, None)
        for end, cost in reached:
            if cost < best.get(end, math.inf):
                best[end] = cost
        if start % 8 == 7 and (least := min(best.values())) >= enough:
            return least
    return best[n]


def find_spans(text: str, ranks: dict[str, int], params: SecretParams) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in the order of start, then kind; base spans and costly values that no base span covers."""
    low = text.lower()
    base = []
    if any(word in low for word in ("passw", "secret", "token", "api")):
        base = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        base += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    base += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    more = []
    if any(word in low for word in HINTS):
        base.sort()
        reach = list(itertools.accumulate((end for _, end, _ in base), max))
        place = run = 0
        while m := CONTEXT.search(text, place):
            start = m.end()
            if start >= run:
                run = VALUE.match(text, start).end()
            first, last = bisect.bisect_right(reach, start), bisect.bisect_left(base, (run, 0, 0))
            # a base assignment ends the value before it, or has it already
            assigned = next((i for i in range(first, last) if base[i][2] == 0 and base[i][1] > start), last)
            if assigned < last and base[assigned][0] <= start:
                place = base[assigned][1]
                continue
            place = stop = base[assigned][0] if assigned < last else run
            value = text[start:stop].rstrip(".,;:)]}>")
            if len(value) < 6 or guess_cost(value, ranks, params.max_word, params.min_log10) < params.min_log10:
                continue
            # what other base spans leave of it
            at = start
            for s, e, _ in [*base[first:assigned], (start + len(value),) * 2 + (0,)]:
                if min(s, start + len(value)) - at >= 6:
                    more.append((at, min(s, start + len(value)), 3))
                at = max(at, e)
    return [(s, e, KINDS[k]) for s, e, k in sorted(base + more, key=lambda x: (x[0], x[2], x[1]))]


def common_words(docs: DataFrame, params: SecretParams) -> dict[str, int]:
    """Rank of the documents' commonest words of three letters or more, all documents counted; at most ``params.words``."""
    words = docs.select(F.explode(F.split(ascii_lower(F.col("text")), r"[^\p{L}]+")).alias("word"))
    sized = words.where(F.length("word").between(3, params.max_word))
    counted = sized.groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    # stored first: collecting a sorted limit would send every partition's candidates to the driver
    top = Workspace.of(docs.sparkSession, "secrets").save(counted.orderBy(F.desc("times"), "word").limit(params.words), "top")
    ranks = {word: i + 1 for i, word in enumerate(COMMON)}
    for row in sorted(top.collect(), key=lambda row: (-row["times"], row["word"])):
        ranks.setdefault(row["word"], len(ranks) + 1)
    return ranks


def find_secrets(docs: DataFrame, params: SecretParams = SecretParams()) -> DataFrame:
    """``(doc_id, spans array<struct<start, end, kind>>)``, one row per input row; offsets are code points.

    Null and empty texts have no spans; repeated rows are searched each for itself; other columns are
    not looked at. Broadcasts ``params.words`` words at most.
    """
    ship(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(common_words(docs, params))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            found = [find_spans(t, ranks.value, params) if isinstance(t, str) else [] for t in batch["text"]]
            spans = [[{"start": s, "end": e, "kind": k} for s, e, k in spans] for spans in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": spans})

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return source.mapInPandas(run, "doc_id bigint, spans array<struct<start:bigint, end:bigint, kind:string>>")
