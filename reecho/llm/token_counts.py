"""Token counts by a map-side lookup in two tiers.

A SentencePiece BPE model whose pieces hold a space only at their front never joins anything across
the place before a run of spaces, nor across a line feed if no longer piece holds one. So a text's count is
the sum over its pre-tokens (spaces and the word after them). Tier one is a hash table of the corpus's
frequent pre-tokens with their lengths, a few hundred KB that every worker gets by broadcast;
tier two is a memory in each worker, bounded in bytes, of the pre-tokens that the table lacks, coded by
the library. No pre-token is shuffled: what tasks send for the table is one bounded summary each.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reecho.llm.common import free_name, ship

SPACE = "▁"  # what the model writes for a space
APART = "\n"  # stands between units that the model never joins
PRE_TOKEN = re.compile(r" *[^ \n]+| +|\n")


@dataclass(frozen=True)
class CountParams:
    """``frequent`` pre-tokens are broadcast; ``remembered`` bounds a worker's own memory in bytes.

    A pre-token of more than ``longest`` characters is coded each time. Neither bound changes a count.
    """

    frequent: int = 100_000
    remembered: int = 64 << 20
    longest: int = 200


def pre_tokens(text: str) -> list[str]:
    """The text's pre-tokens, with the space that the model puts before a text. None for an empty text."""
    return PRE_TOKEN.findall(" " + text.replace(SPACE, " ")) if text else []


class PieceModel:
    """Lengths of pre-tokens in tokens, from the library."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.coder = SentencePieceProcessor(model_proto=model)
        self.before = len(self.coder.encode(APART))

    def lengths(self, words: list[str]) -> list[int]:
        """Coded after a line feed, which nothing joins, as the library puts a space before what it codes."""
        return [len(ids) - self.before for ids in self.coder.encode([APART + word for word in words], num_threads=1)]

    def length(self, word: str) -> int:
        """One word at a time; a list of one would start the library's threads."""
        return len(self.coder.encode(APART + word)) - self.before

    def check(self) -> None:
        """Raises an error for a model whose counts pre-tokens do not add up to."""
        coder = self.coder
        pieces = [coder.id_to_piece(i) for i in range(coder.get_piece_size()) if not (coder.is_control(i) or coder.is_byte(i))]
        inside = any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        joined = any(APART in piece and len(piece) > 1 for piece in pieces)
        probes = ["", " ", "a", " a ", "a  b", "a\nb\n", "ﬁ Ａ é", f"a{SPACE}b", "<s> <unk> <0x0A>"]
        apart = all(sum(self.lengths(pre_tokens(text))) == len(coder.encode(text)) for text in probes)
        if inside or joined or not apart:
            raise ValueError("the model joins pieces across spaces or line feeds, or rewrites texts")


class Lengths(dict):
    """Lengths by pre-token: the frequent ones for good, others as they come, within a bound in bytes."""

    def __init__(self, model: PieceModel, frequent: dict[str, int], params: CountParams):
        super().__init__(frequent)
        self[APART] = model.length(APART)
        self.model, self.params = model, params
        self.own: list[str] = []
        self.held = 0

    def __missing__(self, word: str) -> int:
        n = self.model.length(word)
        if len(word) <= self.params.longest:
            self.held += 150 + 4 * len(word)
            if self.held > self.params.remembered:
                for old in self.own:
                    self.pop(old, None)
                self.own, self.held = [], 150 + 4 * len(word)
            self[word] = n
            self.own.append(word)
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, pre_tokens(text)))


def _cut(counts: Counter, most: int, longest: int) -> Counter:
    """The most frequent words that the table may hold; the line feed needs no place in it."""
    return Counter(dict(Counter({w: n for w, n in counts.items() if len(w) <= longest and w != APART}).most_common(most)))


def _stored(counts: Counter) -> bytes:
    """Words and numbers of a summary in few bytes; no word holds a line feed."""
    numbers = np.array([len(counts), *counts.values()], np.int64).tobytes()
    return zlib.compress(numbers + "\n".join(counts).encode("utf-8", "surrogatepass"), 1)


def _read(stored: bytes) -> Counter:
    data = zlib.decompress(stored)
    n = int(np.frombuffer(data[:8], np.int64)[0])
    numbers = np.frombuffer(data[8 : 8 * (n + 1)], np.int64).tolist()
    words = data[8 * (n + 1) :].decode("utf-8", "surrogatepass").split("\n")
    return Counter(dict(zip(words[:n], numbers, strict=True)))


def frequent_words(docs: DataFrame, params: CountParams) -> dict[str, int]:
    """The corpus's frequent pre-tokens with rough counts, from one bounded summary of each task, merged as a tree.

    A summary that grows past four times its bound loses its rarest words, so a word common to all tasks stays.
    """
    most, longest = params.frequent, params.longest

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                if isinstance(text, str):
                    counts.update(pre_tokens(text))
                    if len(counts) > 4 * most:
                        counts = _cut(counts, most, longest)
        yield pd.DataFrame({"summary": [_stored(_cut(counts, most, longest))]})

    def merged(one: bytes, two: bytes) -> bytes:
        if not one or not two:
            return one or two
        return _stored(_cut(_read(one) + _read(two), most, longest))

    summaries = docs.select("text").mapInPandas(summary, "summary binary").rdd.map(lambda row: bytes(row[0]))
    found = summaries.treeAggregate(b"", merged, merged)
    return dict(_read(found)) if found else {}


def count_tokens(docs: DataFrame, model: bytes, limit: int = 4096, params: CountParams = CountParams()) -> DataFrame:
    """The rows of ``docs``, all columns, with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``model`` is the content of a SentencePiece model file, sent to the workers. Counts are those of the library for the
    whole text, without begin or end; null and empty texts have no token. Every row counts for itself; names that clash get a
    trailing underscore.
    """
    spark = docs.sparkSession
    ship(spark)
    coder = PieceModel(model)
    coder.check()
    words = list(frequent_words(docs, params))
    lengths = np.array(coder.lengths(words), np.uint16) if words else np.zeros(0, np.uint16)
    table = spark.sparkContext.broadcast((uuid.uuid4().hex, model, "\n".join(words), lengths.tobytes()))

    @F.pandas_udf("bigint")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _lengths_of(table.value, params)
        for texts in batches:
            yield pd.Series([known.count(t) if isinstance(t, str) else 0 for t in texts], dtype="int64")

    counted = docs.withColumn(free_name(docs, "n_bytes"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    name = free_name(docs, "n_tokens")
    counted = counted.withColumn(name, n_tokens("text"))
    return counted.withColumn(free_name(docs, "over_limit"), F.col(name) > limit)


_kept: dict[str, Lengths] = {}


def _lengths_of(table: tuple[str, bytes, str, bytes], params: CountParams) -> Lengths:
    """The worker's table, made once and kept for its later tasks."""
    key, model, words, lengths = table
    if key not in _kept:
        known = dict(zip(words.split("\n"), np.frombuffer(lengths, np.uint16).tolist(), strict=False))
        _kept.clear()
        _kept[key] = Lengths(PieceModel(model), known, params)
    return _kept[key]


def whole_counts(texts: Iterable[str | None], model: bytes) -> list[int]:
    """The library's own counts of whole texts."""
    coder = PieceModel(model).coder
    return [len(coder.encode(text)) if text else 0 for text in texts]
