"""Benchmark passages in documents: a prefix-filtered join with exact verification, in DataFrame functions only.

An item's windows are its runs of 13 words, or the whole of a shorter one. Containing a window
means holding all of its words, so any one of them is a sufficient prefix: the rarest over all
documents is joined, which leaves few candidates. Its place in the window fixes where the window
would start in the document; it must fit between the document's ends, and the run of words there
must be the window itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reecho.llm.common import ascii_lower, free_name, known_small, text_key
from reecho.operators.documents import computed_once
from reecho.workspace import Workspace

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text in lower case; none for null."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), NOT_WORD), "")


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """``(item_id, window)``: each distinct window of each item. Items without words have none."""
    worded = computed_once(items.select(F.col("item_id").cast("string").alias("item_id"), "text"), "words", words_of(F.col("text")))
    width = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - width + 1)
    return (
        worded.where(F.size("words") > 0)
        .select("item_id", "words", width.alias("width"), F.explode(starts).alias("at"))
        .select("item_id", F.slice("words", F.col("at"), F.col("width")).alias("window"))
        .distinct()
    )


def window_prefixes(windows: DataFrame, texts: DataFrame) -> DataFrame:
    """``(word, lead, window)``: each distinct window under its rarest word, with the word's place in it."""
    placed = windows.select("window").distinct().select("window", F.posexplode("window").alias("lead", "word"))
    asked = placed.select("word").distinct()
    seen = texts.select(F.explode("words").alias("word")).join(known_small(asked), "word", "left_semi")
    rarity = seen.groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    ranked = placed.join(rarity, "word", "left").select(
        "window", F.struct(F.coalesce("times", F.lit(0)).alias("times"), "word", "lead").alias("rank")
    )
    # a word that no document has rules its window out
    least = ranked.groupBy("window").agg(F.min("rank").alias("rank")).where("rank.times > 0")
    return least.select("rank.word", "rank.lead", "window")


def covered(spans: Column) -> Column:
    """Number of places in the union of ``(start, end)`` spans, ends exclusive."""
    nothing = F.struct(F.lit(0).alias("total"), F.lit(0).alias("reach"))
    def add(state: Column, span: Column) -> Column:
        start = F.greatest(span["start"], state["reach"])
        return F.struct(
            (state["total"] + F.greatest(span["end"] - start, F.lit(0))).alias("total"),
            F.greatest(span["end"], state["reach"]).alias("reach"),
        )
    return F.aggregate(F.sort_array(spans), nothing, add, lambda state: state["total"]).cast("bigint")


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = 13, space: Workspace | None = None
) -> DataFrame:
    """``(row_id, doc_id, text_key, n_words, n_hit, n_items, item_ids, contaminated)``, one row per input row.

    ``contaminated``: some word is hit and at least a twentieth of the words are. Null and wordless
    texts have no words and are clean; null or repeated item_ids count as one item each (null as none).
    Rows that repeat a doc_id are judged each by its own text; extra columns are not looked at.
    """
    space = space or Workspace.of(docs.sparkSession, "contamination")
    source = docs.select("doc_id", "text", text_key().alias("text_key"))
    worded = computed_once(source, "words", words_of(F.col("text"))).drop("text")
    sized = space.save(
        worded.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text_key", F.size("words").cast("bigint").alias("n_words")),
        "sizes",
    )
    windows = space.save(item_windows(items, window), "windows")
    prefixes = space.save(window_prefixes(windows, worded), "prefixes")
    places = worded.select("text_key", "words", F.posexplode("words").alias("place", "word"))
    start = F.col("place") - F.col("lead")
    met = places.join(known_small(prefixes, 50_000), "word").where(
        (start >= 0)
        & (start + F.size("window") <= F.size("words"))
        & (F.slice("words", start + 1, F.size("window")) == F.col("window"))
    )
    hits = space.save(
        met.select("text_key", start.alias("start"), (start + F.size("window")).alias("end"), "window").distinct(), "hits"
    )
    spans = hits.groupBy("text_key").agg(covered(F.collect_set(F.struct("start", "end"))).alias("n_hit"))
    named = hits.select("text_key", "window").distinct().join(windows, "window").where("item_id is not null")
    listed = named.groupBy("text_key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    found = space.save(spans.join(listed, "text_key", "left"), "found")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return sized.join(found, "text_key", "left").select(
        "row_id", "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(item_ids).cast("bigint").alias("n_items"),
        item_ids.alias("item_ids"), ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts are not contaminated."""
    space = Workspace.of(docs.sparkSession, "decontamination")
    found = find_contamination(docs, items, window, space).where("contaminated")
    key = free_name(docs, "text_key")
    dirty = space.save(found.select(F.col("text_key").alias(key)).distinct(), "dirty")
    return docs.withColumn(key, text_key()).join(dirty, key, "left_anti").drop(key)
