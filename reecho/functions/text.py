"""Text cleaning and shingling as column expressions.

The patterns name Unicode categories instead of using Java's ``(?U)`` flag: the
letter, number and whitespace classes are then the same ones that Python's ``re``
applies to ``str``, and matching is about twice as fast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes of the cleaning rules.
WORD_CHARS = r"[\p{L}\p{N}_]"
SPACE_CHARS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
MENTION = f"@{WORD_CHARS}+"
URL = f"(?:https?://|www\\.)[^{SPACE_CHARS}]+"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SPACES = f"[{SPACE_CHARS}]+"


def lowercase(text: Column) -> Column:
    return F.lower(text)


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, "")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def strip_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def squeeze_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


def clean_text(text: Column) -> Column:
    """Lowercase, then drop mentions, URLs and ASCII punctuation, then squeeze spaces.

    The patterns of mentions and URLs run only on texts that hold what every match begins with.
    """
    low = lowercase(text)
    unnamed = F.when(F.contains(text, F.lit("@")), strip_mentions(low)).otherwise(low)
    linked = F.contains(text, F.lit("://")) | F.contains(low, F.lit("www."))
    return squeeze_spaces(strip_punctuation(F.when(linked, strip_urls(unnamed)).otherwise(unnamed)))


def words(clean: Column) -> Column:
    """Words of a cleaned text; an empty text has none (``split`` alone would give one)."""
    return F.array_remove(F.split(clean, " "), "")


def preprocess(text: Column, k: int) -> Column:
    """Cleaned text, or null if it is null or holds fewer than ``k`` words."""
    clean = clean_text(text)
    return F.when(F.size(words(clean)) >= k, clean)


def word_shingles(tokens: Column, k: int) -> Column:
    """All runs of ``k`` words, repeats included; needs at least ``k`` words."""
    if k == 1:
        return tokens
    return F.transform(
        F.sequence(F.lit(1), F.size(tokens) - (k - 1)),
        lambda start: F.concat_ws(" ", F.slice(tokens, start, F.lit(k))),
    )


def shingle_hash(shingle: Column) -> Column:
    """Unsigned 32-bit id of a shingle: the leading eight hex digits of its MD5."""
    return F.conv(F.substring(F.md5(shingle), 1, 8), 16, 10).cast("bigint")


def shingle_set(tokens: Column, k: int) -> Column:
    """Sorted array of distinct shingle ids, null if there are fewer than ``k`` words."""
    distinct_shingles = F.array_distinct(word_shingles(tokens, k))
    ids = F.sort_array(F.array_distinct(F.transform(distinct_shingles, shingle_hash)))
    return F.when(F.size(tokens) >= k, ids)


def process_text(text: Column, k: int) -> Column:
    """From raw text to its shingle set."""
    return shingle_set(words(clean_text(text)), k)
