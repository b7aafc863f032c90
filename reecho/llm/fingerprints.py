"""Threshold-scaled document sketches (FracMinHash, Irber et al. 2022), in DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Whether a hash is kept
depends on nothing else, so sketches of parts merge by union, and the containment of a short
document in a very long one is estimated as well as the likeness of equals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reecho.llm.common import free_name
from reecho.operators.documents import computed_once

CHUNK_ROWS = 256
MAX_CHUNKS = 1 << 14


@dataclass(frozen=True)
class SketchParams:
    """Keeps one shingle hash in ``scale``; documents are framed by ``shingle_words - 1`` empty words."""

    shingle_words: int = 5
    scale: int = 4


def with_sketch(docs: DataFrame, text: str, name: str, params: SketchParams) -> DataFrame:
    """Adds the sketch of a text column: the sorted array of its kept 64-bit word-shingle hashes.

    White space is that of ASCII. The frame of empty words gives an n-word text n + k - 1 shingles, so that short
    texts are told apart too. Null and wordless texts have an empty sketch.
    """
    k = params.shingle_words
    frame = F.array_repeat(F.lit(""), k - 1)
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    framed = F.transform(F.concat(frame, words, frame), lambda w: F.xxhash64(w))
    parts, runs = free_name(docs, "hashed_words"), free_name(docs, "runs")
    # every column is made once: a lambda that held them would make them anew for each element
    hashed = computed_once(docs, parts, framed)
    width = F.size(parts) - (k - 1)
    shifted = [F.slice(parts, i + 1, F.greatest(width, F.lit(0))).alias(f"w{i}") for i in range(k)]
    limit = F.lit(-(2**63) + 2**64 // params.scale)
    shingle = lambda run: F.xxhash64(*[run[f"w{i}"] for i in range(k)])
    zipped = computed_once(hashed, runs, F.transform(F.arrays_zip(*shifted), shingle))
    kept = F.sort_array(F.array_distinct(F.filter(runs, lambda h: h < limit)))
    # a frame alone, without a word, is no shingle
    full = F.when(F.size(parts) > 2 * (k - 1), kept).otherwise(F.array().cast("array<bigint>"))
    return computed_once(zipped, name, full).drop(parts, runs)


def merged(left: Column, right: Column) -> Column:
    """Sketch of two documents together."""
    return F.sort_array(F.array_union(left, right))


def likeness(left: Column, right: Column) -> Column:
    """Estimated Jaccard similarity; 1 for two empty sketches, 0 if only one is empty."""
    shared = F.size(F.array_intersect(left, right))
    union = F.size(left) + F.size(right) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of ``part``'s shingles that ``whole`` has; 1 for an empty part."""
    return F.when(F.size(part) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(part, whole)) / F.size(part))


def as_text(hashes: Column) -> Column:
    """Hexadecimal form: 16 digits a hash, in order."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _range_of(value: Column, bounds: Column, count: int) -> Column:
    """How many of the sorted bounds are at most ``value``; binary search."""
    steps = F.array(*[F.lit(1 << b) for b in range(count.bit_length(), -1, -1)])
    reach = lambda at, step: (at + step <= count) & (F.get(bounds, F.least(at + step, F.lit(count)) - 1) <= value)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(reach(at, step), at + step).otherwise(at))


def with_next(docs: DataFrame, columns: dict[str, Column], params: SketchParams) -> DataFrame:
    """Adds sketch ``own`` and, from the row with the next doc_id, the columns named ``next_*``.

    Rows are dealt out by ranges of doc_id, each range is put in order by itself, and a
    copy of a range's first row also stands at the end of the range before it, the very first row's at the end of the
    last. Ranges follow the quantiles of all ids; their bounds, one in 256 rows and at most
    16,384, are all that the driver sees.
    """
    known = docs.select("doc_id").where("doc_id is not null")
    total = known.count()
    wanted = max(1, min(MAX_CHUNKS, total // CHUNK_ROWS))
    shares = [i / wanted for i in range(1, wanted)]
    cuts = []
    if shares:
        quantiles = known.agg(F.percentile_approx("doc_id", shares, 4 * MAX_CHUNKS).alias("q")).first()["q"]
        cuts = sorted(set(quantiles))
    bounds = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    ranged = docs.withColumn(
        "range", F.when(F.col("doc_id").isNull(), 0).otherwise(_range_of(F.col("doc_id"), bounds, len(cuts)))
    )
    # the least row of each range, from its least id
    least = ranged.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id")).alias("id"))
    heads = least.select(
        F.col("range"),
        F.col("id.doc_id").alias("head"),
        F.coalesce(F.lag("range").over(W.orderBy("range")), F.max("range").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("before"),
    )
    first_rows = ranged.join(F.broadcast(heads), "range").where(F.col("doc_id").eqNullSafe(F.col("head")))
    ghosts = first_rows.groupBy("before").agg(F.min("text").alias("least_text"), F.max(F.col("text").isNull()).alias("without"), F.first("head").alias("doc_id"))
    ghosts = ghosts.select(
        F.col("before").alias("range"), "doc_id",
        F.when(~F.col("without"), F.col("least_text")).alias("text"), F.lit(True).alias("ghost"),
    )
    rows = ranged.select("range", "doc_id", "text", F.lit(False).alias("ghost")).unionByName(ghosts.select("range", "doc_id", "text", "ghost"))
    dealt = rows.repartition(F.col("range"))
    sketched = with_sketch(dealt, "text", "own", params)
    in_order = W.partitionBy("range").orderBy("ghost", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ahead = sketched.select("*", *[F.lead(c).over(in_order).alias(n) for n, c in columns.items()])
    return ahead.where(~F.col("ghost")).drop("ghost", "range")


def fingerprint_edits(docs: DataFrame, params: SketchParams = SketchParams()) -> DataFrame:
    """Fingerprints of each text and of its edited form.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    kept_in_edited)``. Edited: the last quarter of the characters gives way to as many first ones of
    the next document, or all of them. Rows are in the order of doc_id, nulls first, equal ids by
    text, null texts first; the first row follows the last. Null texts count as empty; extra columns are not looked at.
    Likeness is Jaccard of the sketches, ``kept_in_edited`` the containment of the text's in the edited one's.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ahead = with_next(source, {"next_text": F.coalesce("text", F.lit("")), "next_own": F.col("own")}, params)
    sized = ahead.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("n_chars", F.length("text").cast("bigint"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = computed_once(
        sized,
        "edited",
        F.concat(
            F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter),
            F.substring(F.col("next_text"), F.lit(1), quarter),
        ),
    )
    both = with_sketch(edited.drop("next_text", "text"), "edited", "other", params)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        containment(F.col("own"), F.col("other")).alias("kept_in_edited"),
    )
