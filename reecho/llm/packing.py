"""Packing by power-of-two decomposition (Pouransari et al. 2024).

A document of n tokens is cut into pieces whose lengths are the powers of two of n's binary
form, none longer than ``max_tokens``. Every piece is a sequence of its own, so no
sequence crosses documents and none needs padding; sequences of one length stand together in a
bucket, ready for batches of equal shape.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reecho.llm.common import ship
from reecho.operators.runs import running_total
from reecho.workspace import Workspace

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, bucket int, row_part bigint, ids binary"
)
CACHED_BYTES = 128 << 20
TEXTS_AT_ONCE = 256
CHUNK_ROWS = 4096


def piece_lengths(n: int, max_tokens: int) -> list[int]:
    """Powers of two that add up to ``n``, longest first, none over ``max_tokens`` (itself a power of two)."""
    rest = n % max_tokens
    return [max_tokens] * (n // max_tokens) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _ends_in_a_letter(word: bytes) -> bool:
    """Whether the last letter stays a letter in lower case. One that gains a mark there, as a capital I with a dot, joins the stop after it."""
    low = word.decode("utf-8", "replace")[-1:].lower()
    return len(low) == 1 and low.isalpha()


class WordEncoder:
    """Token ids of a text, word by word, with a bounded memory of words already seen.

    For tokenizers that never join tokens across white space and keep a run of letters as one unit. Once the memory is
    full, further words are coded anew each time; results do not change.
    """

    def __init__(self, model: bytes, remembered: int = CACHED_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(model)
        self.remembered, self.held = remembered, 0
        self.known: dict[bytes, bytes] = {}

    def _code(self, words: list[bytes]) -> None:
        """Code words and remember them. Words of letters alone are coded many at a time."""
        plain, rest = [], []
        for word in words:
            text = word.decode("utf-8", "replace")
            (plain if text.isalpha() else rest).append((word, text))
        for at in range(0, len(plain), 256):
            part = plain[at : at + 256]
            coded = self.tokenizer.encode(" ".join(text for _, text in part), add_special_tokens=False)
            ids, units = np.array(coded.ids, "<u4").tobytes(), np.array([-1 if u is None else u for u in coded.word_ids])
            starts = (4 * np.flatnonzero(np.diff(units, prepend=-1))).tolist()
            if len(starts) != len(part):
                rest += part
                continue
            for (word, _), start, end in zip(part, starts, [*starts[1:], len(ids)], strict=True):
                self.known[word] = ids[start:end]
        coded = self.tokenizer.encode_batch_fast([text for _, text in rest], add_special_tokens=False)
        for (word, _), code in zip(rest, coded, strict=True):
            self.known[word] = np.array(code.ids, "<u4").tobytes()

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Learn words and return the new entries; one that ends with stops is split there if a letter stands before them."""
        stems: dict[bytes, None] = {}
        cut = []
        for word in words:
            stem = word.rstrip(b".,")
            if len(stem) < len(word) and _ends_in_a_letter(stem):
                cut.append((word, stem, word[len(stem) :]))
                stems[stem] = stems[word[len(stem) :]] = None
            else:
                stems[word] = None
        new = [w for w in stems if w not in self.known]
        self._code(new)
        for word, stem, stops in cut:
            self.known[word] = self.known[stem] + self.known[stops]
        return list({*new, *words})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        plain = [t.encode("utf-8", "replace").lower().replace(b"\n", b" ") for t in texts]
        split = pc.split_pattern(pa.array(plain, pa.large_binary()), b" ")
        # a batch's words are looked up once each, and their ids are gathered by number
        named = split.flatten().dictionary_encode()
        words, which = named.dictionary.to_numpy(zero_copy_only=False).tolist(), named.indices.to_numpy()
        known, full = self.known, self.held >= self.remembered
        codes = list(map(known.get, words))
        unknown = [i for i, code in enumerate(codes) if code is None]
        new = self._learn([words[i] for i in unknown])
        for i in unknown:
            codes[i] = known[words[i]]
        flat, sizes = np.frombuffer(b"".join(codes), "<u4"), np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        n, begin = sizes[which], (np.cumsum(sizes) - sizes)[which]
        total = np.append(0, np.cumsum(n))
        ids = flat[np.repeat(begin - total[:-1], n) + np.arange(total[-1])]
        ends = total[split.offsets.to_numpy()].tolist()
        coded = [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        if full:
            for word in new:
                known.pop(word, None)
        else:
            self.held += sum(200 + len(word) + len(known[word]) for word in new)
        return coded


_encoders: dict[str, WordEncoder] = {}


def _encoder(key: str, model: bytes) -> WordEncoder:
    """The worker's encoder, kept for its later tasks."""
    if key not in _encoders:
        # a task has one core: threads of the tokenizer would only wait for it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders.clear()
        _encoders[key] = WordEncoder(model)
    return _encoders[key]


def document_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, max_tokens: int, with_ids: bool) -> DataFrame:
    """One row per piece; ``ids`` holds its tokens if asked for. The driver reads the tokenizer's file and sends it to the workers."""
    with open(tokenizer_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    model_key = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.array([end_id], "<u4").tobytes()
        encoder = _encoder(model_key, shared.value)
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[at : at + TEXTS_AT_ONCE]
                texts = [t if isinstance(t, str) else "" for t in part["text"]]
                rows = []
                for doc_id, key, ids in zip(part["doc_id"].astype(object), part["row_part"], encoder.encode(texts), strict=True):
                    ids += end
                    tokens, start = len(ids) // 4, 0
                    for length in piece_lengths(tokens, max_tokens):
                        piece = ids[4 * start : 4 * (start + length)]
                        bucket = length.bit_length() - 1
                        rows.append((doc_id, start, length, zlib.crc32(piece), tokens, bucket, key, piece if with_ids else None))
                        start += length
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    ship(docs.sparkSession)
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row_part")
    )
    return source.mapInPandas(run, PIECES)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    max_tokens: int = 4096,
    with_ids: bool = False,
    space: Workspace | None = None,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, bucket, sequence_id, offset[, ids])``, one row per piece.

    ``bucket`` is log2 of the sequence length. Sequence ids count from 0 without a gap, bucket by
    bucket. A null or empty text is the end id alone. Repeated rows are packed each for itself. Other columns are
    not looked at; ids may be null.
    """
    if max_tokens & (max_tokens - 1) or max_tokens < 1:
        raise ValueError("max_tokens must be a power of two")
    space = space or Workspace.of(docs.sparkSession, "packing")
    pieces = space.save(document_pieces(docs, tokenizer_path, end_id, max_tokens, with_ids), "pieces")
    chunks = max(1, -(-pieces.count() // CHUNK_ROWS))
    placed = pieces.withColumn("chunk", F.pmod(F.col("row_part"), F.lit(chunks)))
    # bucket by bucket, chunk by chunk: one row each, a few thousandths of the pieces, and no task meets them all
    counted = placed.groupBy("bucket", "chunk").agg(F.count(F.lit(1)).alias("n"))
    in_order = F.col("bucket").cast("bigint") * chunks + F.col("chunk")
    ordered = counted.select(F.lit(0).alias("part"), in_order.alias("at"), "bucket", F.col("chunk").alias("own"), "n")
    upto = running_total(ordered, "part", "at", "n", "upto")
    bases = upto.select("bucket", F.col("own").alias("chunk"), (F.col("upto") - F.col("n")).alias("base"))
    inside = W.partitionBy("bucket", "chunk").orderBy("doc_id", "row_part", "start", "ids_crc32")
    numbered = placed.withColumn("place", F.row_number().over(inside) - 1).join(bases, ["bucket", "chunk"])
    return numbered.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket",
        (F.col("base") + F.col("place")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
        *(["ids"] if with_ids else []),
    )
