"""How the sources of a language differ in their words, in exact integers.

A CountVectorizer with the largest integer as ``vocabSize`` turns each document into an exact sparse vector of its language's terms;
terms carry their language, so that one model serves all languages. Its ``minDF`` is applied first, by a distributed count of
each term's documents: a fit over whole documents would count them a second time and collect what it has not
measured. The model is then fitted on the kept terms alone, in as many hash blocks as keep each vocabulary, which the
driver and all executors hold, under a stated size. Vectors are summed by (language, source), entry by entry, and everything after reads
these sums. A pair of sources is compared on the terms that either holds: a term that neither holds adds the same value
each time, so it is multiplied out.

Texts are cut into terms on Arrow batches, by whole arrays of bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reecho.llm.common import known_small, ship
from reecho.workspace import Workspace

GROUP = ["lang", "source"]
MARK = ":"  # no term holds it, so what follows the last one is the term

# What a byte of a term becomes, 0 for bytes between terms: letters in lower case, and all of a character beyond ASCII.
_TERM_BYTE = np.arange(256, dtype=np.uint8)
_TERM_BYTE[:128] = [ord(chr(b).lower()) if chr(b).isalpha() else 0 for b in range(128)]


@dataclass(frozen=True)
class DivergenceParams:
    """Terms in ``min_docs`` documents of a language count, ``smoothing`` is added to each count, shares are in ``scale``-ths.

    ``vocabulary`` bounds the terms of one fit, and so what the driver holds and broadcasts at once. About ``entries_at_once``
    entries of a language's sums are compared in one task, for about ``sources_at_once`` of its sources.
    """

    min_docs: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    listed: int = 50
    vocabulary: int = 1_000_000
    entries_at_once: int = 250_000
    sources_at_once: int = 256


@dataclass
class CutTexts:
    """Terms of a batch's texts: ``low[starts:ends]`` spells a term, ``at[k]:at[k + 1]`` are the terms of text k."""

    at: np.ndarray
    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def strings(self) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(self.starts), pa.py_buffer(offsets), pa.py_buffer(self.low[self.low != 0]))

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def cut_terms(texts: pa.Array) -> CutTexts:
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data is not None else np.zeros(0, np.uint8)
    places = places - places[0]
    low = _TERM_BYTE[data]
    inside = low != 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    borders = places[places < len(low)]
    starts[borders] = inside[borders]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | starts[1:]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return CutTexts(np.searchsorted(starts, places), low, starts, ends)


def _over_texts(docs: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, at_once: int) -> DataFrame:
    """``work`` on pieces of batches whose texts take about ``at_once`` bytes. Nulls are empty strings."""
    ship(docs.sparkSession)
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*GROUP, "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            borders = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // at_once)) + 1).tolist(), len(batch)]
            for one, two in zip(borders, borders[1:]):
                if one < two:
                    yield work(batch.slice(one, two - one))

    return filled.mapInArrow(run, schema)


def _named(langs: pa.Array, terms: pa.Array) -> pa.Array:
    named = pc.binary_join_element_wise(langs.cast(pa.large_string()), terms, pa.scalar(MARK, pa.large_string()))
    return named.cast(pa.string())


def with_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, terms)``: the terms of each text with their language in front."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut, langs = cut_terms(batch.column("text")), batch.column("lang")
        named = _named(langs.take(pa.array(cut.owners())), cut.strings())
        lists = pa.ListArray.from_arrays(pa.array(cut.at, pa.int32()), named)
        return pa.RecordBatch.from_arrays([langs, batch.column("source"), lists], [*GROUP, "terms"])

    return _over_texts(docs, work, "lang string, source string, terms array<string>", 4 << 20)


def documents_of_terms(docs: DataFrame) -> DataFrame:
    """``(term, n)``: in how many documents of its language a term is, the language in front; summed by batches before the shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut, langs = cut_terms(batch.column("text")), batch.column("lang").dictionary_encode()
        coded = cut.strings().dictionary_encode()
        own = coded.indices.to_numpy(zero_copy_only=False)
        once = [np.unique(own[cut.at[k] : cut.at[k + 1]]) for k in range(len(batch))]
        lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), [len(x) for x in once])
        n = np.bincount(lang * len(coded.dictionary) + np.concatenate(once))
        pair = np.flatnonzero(n)
        of_lang, of_term = np.divmod(pair, max(len(coded.dictionary), 1))
        named = _named(langs.dictionary.take(pa.array(of_lang)), coded.dictionary.take(pa.array(of_term)))
        return pa.RecordBatch.from_arrays([named, pa.array(n[pair], pa.int64())], ["term", "n"])

    return _over_texts(docs, work, "term string, n bigint", 8 << 20).groupBy("term").agg(F.sum("n").alias("n"))


def kept_terms(docs: DataFrame, params: DivergenceParams, space: Workspace) -> tuple[DataFrame, list[Column]]:
    """The terms in enough documents, and conditions that cut them into blocks of at most ``vocabulary`` terms."""
    kept = space.save(documents_of_terms(docs).where(F.col("n") >= params.min_docs).select("term"), "kept")
    blocks = 1
    while True:
        block = F.pmod(F.xxhash64("term"), F.lit(blocks))
        # as many rows as a vocabulary has blocks
        sizes = dict(kept.groupBy(block.alias("block")).count().collect())
        if max(sizes.values(), default=0) <= params.vocabulary:
            return kept, [block == b for b in sorted(sizes)]
        blocks *= 2


def group_sums(docs: DataFrame, params: DivergenceParams, space: Workspace) -> DataFrame:
    """``(lang, source, term, count)`` of the kept terms, count > 0."""
    from pyspark.ml.feature import CountVectorizer

    kept, blocks = kept_terms(docs, params, space)
    sums = None
    for k, block in enumerate(blocks):
        counter = CountVectorizer(vocabSize=2**31 - 1, inputCol="terms", outputCol="vector")
        model = counter.fit(kept.where(block).select(F.array("term").alias("terms")))
        words = docs.sparkSession.createDataFrame(list(enumerate(model.vocabulary)), "at int, term string")
        vector = F.unwrap_udt("vector")
        # terms of other blocks are not in the model's vocabulary and leave no entry
        entries = model.transform(with_terms(docs)).select(*GROUP, F.explode(F.arrays_zip(vector["indices"], vector["values"])).alias("e"))
        summed = entries.groupBy(*GROUP, F.col("e.indices").alias("at")).agg(F.sum(F.col("e.values").cast("bigint")).alias("count"))
        named_sums = summed.join(words, "at").select(*GROUP, F.substring_index("term", MARK, -1).alias("term"), "count")
        stored = space.save(named_sums, f"sums-{k}")
        sums = stored if sums is None else sums.unionByName(stored)
    if sums is None:
        return docs.sparkSession.createDataFrame([], "lang string, source string, term string, count bigint")
    return sums


def share(count: Column, total: Column, terms: Column, params: DivergenceParams) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * terms)) as a long, exact at any size."""
    wide = lambda c: c.cast("decimal(28,0)")
    above = F.lit(params.scale).cast("decimal(10,0)") * (wide(count) + F.lit(params.smoothing).cast("decimal(9,0)"))
    below = wide(total) + F.lit(params.smoothing).cast("decimal(9,0)") * wide(terms)
    return F.lit(1).cast("bigint") + F.call_function("div", above, below)


def divergence(docs: DataFrame, params: DivergenceParams = DivergenceParams(), space: Workspace | None = None) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair``: the distance of a source's shares to each other source of its language, summed over the language's terms.
    Part ``term``: the terms whose share is above their share in the language, by the difference, ``listed`` of
    them. Ranks count from 1, larger values first, then items by their bytes. Null text, lang and source are empty strings; each
    row is a document; an empty table gives no rows. Other columns are not looked at.
    """
    space = space or Workspace.of(docs.sparkSession, "divergence")
    sums = group_sums(docs, params, space)
    groups, langs, terms = _facts(docs, sums, params, space)
    return _pairs(groups, langs, terms, params).unionByName(_terms(langs, terms, sums, params))


def _facts(docs: DataFrame, sums: DataFrame, params: DivergenceParams, space: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts of groups (with the share of a term that is not there) and of languages, and the terms with their shares.

    Terms meet the facts of their group or language by broadcast if these are counted to be few.
    """
    vocabulary = sums.groupBy("lang", "term").agg(F.lit(1)).groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    totals = sums.groupBy(*GROUP).agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("entries"))
    zero = F.lit(0).cast("bigint")
    groups = (
        docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GROUP])
        .distinct()
        .join(totals, GROUP, "left")
        .join(vocabulary, "lang", "left")
        .select(*GROUP, *[F.coalesce(c, zero).alias(c) for c in ("total", "entries", "vocabulary")])
    )
    unseen = F.when(F.col("vocabulary") > 0, share(zero, F.col("total"), F.col("vocabulary"), params))
    groups = space.save(groups.withColumn("unseen", unseen), "groups")
    langs = groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.sum("entries").alias("entries"), F.count(F.lit(1)).alias("sources")
    )
    langs = known_small(space.save(langs, "langs"))
    shares = share(F.col("count"), F.col("total"), F.col("vocabulary"), params)
    terms = sums.join(known_small(groups), GROUP).select(*GROUP, "term", "count", "vocabulary", "unseen", shares.alias("p"))
    return groups, langs, space.save(terms, "terms")


def _numbered(rows: DataFrame) -> Column:
    return F.row_number().over(W.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))


def _pairs(groups: DataFrame, langs: DataFrame, terms: DataFrame, params: DivergenceParams) -> DataFrame:
    """Distances of all ordered pairs of sources of a language.

    With u, v the shares of a term in neither source, a pair's distance is V*|u-v|, plus |p-v| - |u-v| for each
    term of one side, which depends on the other by v alone and so is taken by distinct shares, plus for terms of both
    sides |p-q| - |p-v| - |u-q| + |u-v|.
    """
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    other = groups.select("lang", F.col("source").alias("item"), F.col("unseen").alias("v"))
    met = groups.select(*GROUP, F.col("unseen").alias("u"), "vocabulary").join(other, "lang").where("source <> item")
    base = met.select(*GROUP, "item", F.coalesce(F.col("vocabulary") * gap("u", "v"), F.lit(0)).cast("bigint").alias("part_value"))
    levels = terms.groupBy(*GROUP, F.col("unseen").alias("u"), "p").agg(F.count(F.lit(1)).alias("n"))
    one_side = levels.join(other, "lang").where("source <> item").select(
        *GROUP, "item", (F.col("n") * (gap("p", "v") - gap("u", "v"))).alias("part_value")
    )
    mirrored = one_side.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "part_value")
    shared = _shared(langs, terms, params)
    sides = F.array(
        F.struct(F.col("source_1").alias("source"), F.col("source_2").alias("item")),
        F.struct(F.col("source_2").alias("source"), F.col("source_1").alias("item")),
    )
    shared = shared.select("lang", F.explode(sides).alias("s"), "part_value").select("lang", "s.*", "part_value")
    parts = base.unionByName(one_side).unionByName(mirrored).unionByName(shared)
    summed = parts.groupBy(*GROUP, "item").agg(F.sum("part_value").alias("value"))
    return summed.select(*GROUP, F.lit("pair").alias("part"), "item", "value", _numbered(summed).alias("rank"))


def _shared(langs: DataFrame, terms: DataFrame, params: DivergenceParams) -> DataFrame:
    """``(lang, source_1, source_2, part_value)`` for terms that both hold, source_1 < source_2.

    A task meets a share of a language's terms, with all their sources, and for each of at most ``sources_at_once`` of these adds up
    its differences to all others over the terms it holds.
    """
    parts = lambda n, most: F.ceil(F.col(n) / F.lit(most)).cast("bigint")
    sizes = terms.join(langs, "lang").withColumn("shares", parts("entries", params.entries_at_once))
    sizes = sizes.withColumn("blocks", parts("sources", params.sources_at_once))
    dealt = sizes.select(
        "lang", "source", "p", "unseen", F.xxhash64("term").alias("term"), "blocks",
        F.pmod(F.xxhash64("term"), F.col("shares")).alias("share"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
    ).withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")) == F.col("block"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        names, source = np.unique(rows["source"].to_numpy(str), return_inverse=True)
        order = np.argsort(source, kind="stable")
        source = source[order]
        _, term = np.unique(rows["term"].to_numpy(np.int64)[order], return_inverse=True)
        p, unseen = (rows[c].to_numpy(np.int64)[order] for c in ("p", "unseen"))
        starts = np.searchsorted(source, np.arange(len(names) + 1))
        found = [np.zeros((0, 3), np.int64)]
        for one in np.unique(source[rows["own"].to_numpy(bool)[order]]):
            own = slice(starts[one], starts[one + 1])
            mine = np.full(term.max() + 1, -1)
            mine[term[own]] = p[own]
            after = np.flatnonzero(mine[term[starts[one + 1] :]] >= 0) + starts[one + 1]
            if len(after):
                a, u, b, v = mine[term[after]], unseen[starts[one]], p[after], unseen[after]
                gaps = np.abs(a - b) - np.abs(a - v) - np.abs(u - b) + np.abs(u - v)
                others, firsts = np.unique(source[after], return_index=True)
                found.append(np.stack([np.full(len(others), one), others, np.add.reduceat(gaps, firsts)], axis=1))
        pairs = np.concatenate(found)
        return pd.DataFrame({
            "lang": rows["lang"].iloc[0], "source_1": names[pairs[:, 0]], "source_2": names[pairs[:, 1]], "part_value": pairs[:, 2],
        })

    compared = dealt.groupBy("lang", "share", "block").applyInPandas(
        compare, "lang string, source_1 string, source_2 string, part_value bigint"
    )
    return compared.groupBy("lang", "source_1", "source_2").agg(F.sum("part_value").alias("part_value"))


def _terms(langs: DataFrame, terms: DataFrame, sums: DataFrame, params: DivergenceParams) -> DataFrame:
    """The terms that a source has more of than its language; each task sends at most ``listed`` of a source."""
    whole = sums.groupBy("lang", "term").agg(F.sum("count").alias("all"))
    met = terms.join(whole, ["lang", "term"]).join(langs, "lang")
    q = share(F.col("all"), F.col("lang_total"), F.col("vocabulary"), params)
    above = met.withColumn("value", F.col("p") - q).where("value > 0").withColumnRenamed("term", "item")
    ranked = above.withColumn("rank", _numbered(above)).where(F.col("rank") <= params.listed)
    return ranked.select(*GROUP, F.lit("term").alias("part"), "item", "value", "rank")
