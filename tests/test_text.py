import pytest
from pyspark.sql import functions as F

from brute import shingle_set, words
from reecho.functions import text as tx


def run(spark, expression, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.out for r in frame.select("i", expression(F.col("text")).alias("out")).orderBy("i").collect()]


def test_cleaning_rules(spark):
    given = [
        "Green TEA",
        "Ask @maria_7 about lunch",
        "Maps: HTTP://maps.example/a?b=c are old",
        "see WwW.shop.example or call",
        "Stop; wait - really?!",
        "too    many   gaps",
        "she'll",
        "post to@y.org soon",
        "no link://here",
    ]
    assert run(spark, tx.clean_text, *given) == [
        "green tea",
        "ask about lunch",
        "maps are old",
        "see or call",
        "stop wait really",
        "too many gaps",
        "shell",
        "post toorg soon",
        "no linkhere",
    ]


@pytest.mark.parametrize("text, k, kept", [
    ("Tea", 4, False), ("plum pear fig lime", 4, True), ("!!!", 1, False), ("", 1, False), (None, 1, False),
])
def test_short_and_null_texts(spark, text, k, kept):
    (out,) = run(spark, lambda c: tx.preprocess(c, k), text)
    assert (out is not None) == kept


def test_unicode_edges_match_python(spark):
    given = [
        "Hi @jos\u00e9 x", "a\u00a0b c", "HTTP://X.y/z ok www.a.b", "\u0130stanbul \u039f\u0394\u039f\u03a3",
        "a\u2014b \u201cq\u201d don't", "a\u2003b c", "@a@b c", "email me@x.com now", "", "x\u001cy z",
        "x\u00b2 @a\u00b2b", "a\u0085b", "tab\tand\nline", "www.x\u00a0y", "a\u3000b",
    ]
    assert run(spark, lambda c: tx.words(tx.clean_text(c)), *given) == [words(t) for t in given]


def test_shingles_count_and_k(spark):
    text = "seven grey geese crossed slowly"
    for k, count in ((1, 5), (2, 4), (3, 3), (5, 1)):
        (out,) = run(spark, lambda c: tx.process_text(c, k), text)
        assert len(out) == count and set(out) == shingle_set(text, k)


def test_shingle_sets_are_distinct_sorted_unsigned(spark):
    (out,) = run(spark, lambda c: tx.process_text(c, 1), "b a b a c c c")
    assert out == sorted(set(out)) and len(out) == 3 and all(0 <= x < 2**32 for x in out)


def test_too_few_words_give_null(spark):
    assert run(spark, lambda c: tx.process_text(c, 3), "hi", None) == [None, None]
