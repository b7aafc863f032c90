import pytest
from pyspark.sql import functions as F

from reecho import MatchParams
from reecho.functions import minhash as mh
from reecho.functions.scores import jaccard
from reecho.operators import lsh, verify
from reecho.params import MERSENNE_PRIME, hash_family

PARAMS = MatchParams(num_hashes=50, rows_per_band=5)


def sets_of(spark, *sets, user="u"):
    rows = [(user, i, list(s), len(s), 1) for i, s in enumerate(sets)]
    return spark.createDataFrame(
        rows, "user_id string, rep_id bigint, shingles array<bigint>, n_shingles int, copies bigint"
    )


def test_hash_family_ranges_and_determinism():
    family = hash_family(50, MERSENNE_PRIME, 1)
    assert len(family) == 50 and family == hash_family(50, MERSENNE_PRIME, 1) != hash_family(50, MERSENNE_PRIME, 2)
    assert all(1 <= a < MERSENNE_PRIME and 0 <= b < MERSENNE_PRIME for a, b in family)


def test_parameters_are_checked():
    for bad in ({"shingle_size": 0}, {"rows_per_band": 61}, {"threshold": 0.0}, {"prime": 2**32}):
        with pytest.raises(ValueError):
            MatchParams(**bad)
    assert MatchParams().num_bands == 20


def test_signature_is_the_minimum_of_each_function(spark):
    shingles = [1, 2, 3, 2**32 - 1]
    frame = sets_of(spark, shingles, list(reversed(shingles)))
    expected = [min((a * x + b) % PARAMS.prime for x in shingles) for a, b in PARAMS.hash_family()]
    signed = {r.rep_id: r.sig for r in lsh.signatures(frame, PARAMS).collect()}
    assert signed == {0: expected, 1: expected}
    by_row = frame.select(mh.row_signature("shingles", PARAMS).alias("sig")).collect()
    assert [r.sig for r in by_row] == [expected, expected]


def test_prime_argument_is_honoured(spark):
    small = MatchParams(num_hashes=6, rows_per_band=3, prime=101)
    (row,) = lsh.signatures(sets_of(spark, [5, 9]), small).collect()
    assert all(0 <= h < 101 for h in row.sig)


def test_one_bucket_row_per_band(spark):
    bands = lsh.band_rows(lsh.signatures(sets_of(spark, [1, 2, 3]), PARAMS), PARAMS)
    assert bands.count() == 10 and bands.select("bucket").distinct().count() == 10


def test_equal_sets_meet_and_disjoint_sets_do_not(spark):
    frame = sets_of(spark, [1, 2, 3], [1, 2, 3], [1001, 1002, 1003])
    bands = lsh.band_rows(lsh.signatures(frame, PARAMS), PARAMS)
    found = [(r.rep_id_1, r.rep_id_2) for r in lsh.candidate_pairs(bands).collect()]
    assert found == [(0, 1)]


def test_bucket_sizes(spark):
    frame = sets_of(spark, [1, 2, 3], [1, 2, 3])
    sizes = lsh.bucket_sizes(lsh.signatures(frame, PARAMS), frame, PARAMS).collect()
    assert [(r.n_sets, r.n_docs) for r in sizes] == [(2, 2)] * 10


def test_jaccard(spark):
    cases = [([1, 2, 3], [1, 2, 3], 1.0), ([1, 2, 3], [4, 5, 6], 0.0), ([1, 2, 3], [2, 3, 4], 0.5), ([], [], 0.0),
             ([1], [], 0.0), (None, [1], 0.0)]
    frame = spark.createDataFrame([c[:2] for c in cases], "a array<bigint>, b array<bigint>")
    assert [r.j for r in frame.select(jaccard(F.col("a"), F.col("b")).alias("j")).collect()] == [c[2] for c in cases]


def test_verification_keeps_pairs_at_or_above_the_threshold(spark):
    frame = sets_of(spark, [1, 2, 3, 4], [1, 2, 3, 5], [4, 5, 6], [7, 8, 9])
    candidates = spark.createDataFrame([(0, 1), (2, 3)], "rep_id_1 bigint, rep_id_2 bigint")
    found = verify.verify_pairs(candidates, frame, 0.6).collect()
    assert [(r.rep_id_1, r.rep_id_2, r.similarity) for r in found] == [(0, 1, 0.6)]
    assert verify.verify_pairs(candidates, frame, 0.61).count() == 0
