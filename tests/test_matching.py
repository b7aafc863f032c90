import random

import pytest
from pyspark.sql import functions as F

from brute import as_dict, similar_pairs
from reecho import MatchParams, find_pairs
from reecho.functions import minhash as mh
from reecho.operators import cells, documents, exact, expand, lsh, skew, verify
from reecho.plans import reports
from reecho.plans.matching import prepare

WORDS = [f"w{i}" for i in range(60)]


def near_copies(seed=3):
    """One author holds a third of all rows: exact copies and one-word variants; others are mixed."""
    draw = random.Random(seed)
    rows, base = [], WORDS[:12]
    for _ in range(60):
        text = list(base)
        if draw.random() < 0.5:
            text[draw.randrange(12)] = draw.choice(WORDS)
        rows.append(("hot", " ".join(text)))
    for i in range(120):
        rows.append((f"u{i % 9}", " ".join(draw.choice(WORDS) for _ in range(draw.choice([1, 2, 5, 12, 30])))))
    draw.shuffle(rows)
    return [(i, user, text) for i, (user, text) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return near_copies()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, user_id string, text string")


@pytest.mark.parametrize("threshold", [0.15, 0.5, 0.9])
def test_exact_join_finds_every_pair(docs, rows, threshold):
    matching = find_pairs(docs, MatchParams(threshold=threshold), "exact")
    assert as_dict(matching.pairs()) == similar_pairs(rows, threshold)


def test_both_ways_of_the_exact_join_hold_every_pair(spark, docs, rows):
    for threshold in (0.15, 0.5, 0.8):
        _, sets = prepare(docs, MatchParams(threshold=threshold))
        wanted = {(r.rep_id_1, r.rep_id_2) for r in verify.verify_pairs(exact.prefix_candidates(sets, threshold), sets, threshold).collect()}
        cells = exact.cell_candidates(sets, threshold)
        assert wanted and cells.count() == cells.distinct().count()
        assert {(r.rep_id_1, r.rep_id_2) for r in verify.verify_pairs(cells, sets, threshold).collect()} == wanted


def test_least_documents_are_found_in_levels(spark):
    sizes = {1: 1000, 2: 37, 3: 1}
    rows = [(rep, rep * 10_000 + i, n) for rep, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "rep_id bigint, doc_id bigint, copies bigint").repartition(5)
    for most in (1, 3, 40):
        found = expand._least_documents(frame, most, 1000, block_rows=8).collect()
        assert {(r.rep_id, r.doc_id, r.place) for r in found} == {
            (rep, rep * 10_000 + i, i + 1) for rep, n in sizes.items() for i in range(min(n, most))
        }


def test_pairs_of_authors_are_counted_without_them(spark):
    """A hundred thousand copies of one text, five billion pairs, by two authors, and a near copy."""
    copies = spark.range(100_000).select(
        F.col("id").alias("doc_id"), F.lit("wide").alias("user_id"), F.when(F.col("id") == 0, "one two three five").otherwise("one two three four").alias("text")
    )
    doc_users = copies.select("doc_id", F.when(F.col("doc_id") % 10 == 0, "few").otherwise("many").alias("user_id")).where("doc_id <> 20")
    matching = find_pairs(copies, MatchParams(threshold=0.5))
    got = {r.user_id: int(r.similar_pairs) for r in matching.own_pair_counts(doc_users).collect()}
    # 0 is the near copy (3 of 5 words), 20 is unknown
    assert got == {"few": 9_998 * 9_997 // 2 + 9_998, "many": 90_000 * 89_999 // 2}


def test_exact_join_with_two_word_shingles(docs, rows):
    matching = find_pairs(docs, MatchParams(shingle_size=2), "exact")
    assert as_dict(matching.pairs()) == similar_pairs(rows, 0.15, 2)


def test_lsh_pairs_are_exact_pairs_and_hold_all_copies(docs, rows):
    found, exact = as_dict(find_pairs(docs).pairs()), similar_pairs(rows, 0.15)
    assert all(exact[pair] == similarity for pair, similarity in found.items())
    assert {p for p, s in exact.items() if s >= 0.9} <= set(found)


def test_one_row_bands_find_nearly_everything(docs, rows):
    wide = MatchParams(num_hashes=60, rows_per_band=1)
    found, exact = as_dict(find_pairs(docs, wide).pairs()), similar_pairs(rows, 0.15)
    assert len(found) > 0.97 * len(exact)


def test_pair_counts_match_the_listed_pairs(docs):
    matching = find_pairs(docs, method="exact")
    listed = {r.user_id: r["count"] for r in matching.pairs().groupBy("user_id").count().collect()}
    counted = {r.user_id: int(r.similar_pairs) for r in matching.author_pair_counts().collect()}
    assert counted == listed


def test_pair_counts_beyond_64_bits(spark):
    schema = "user_id string, rep_id bigint, copies bigint"
    sets = spark.createDataFrame([("u", 1, 13_000_000_000)], schema)
    none = spark.createDataFrame([], "user_id string, rep_id_1 bigint, rep_id_2 bigint, copies_1 bigint, copies_2 bigint")
    (row,) = expand.author_pair_counts(none, sets).collect()
    assert int(row.similar_pairs) == 13_000_000_000 * 12_999_999_999 // 2
    stats = spark.createDataFrame([("u", 13_000_000_000)], "user_id string, total_comments bigint")
    (report,) = reports.spammers(stats, expand.author_pair_counts(none, sets)).collect()
    assert report.similarity_rate == 1.0


@pytest.mark.parametrize("limit", [1, 7, 40, 5000])
def test_top_pairs_equal_the_head_of_all_pairs(docs, limit):
    matching = find_pairs(docs, method="exact")
    ordered = sorted(matching.pairs().collect(), key=lambda r: (-r.similarity, r.doc_id_1, r.doc_id_2))
    assert matching.top(limit).collect() == ordered[:limit]


def test_paired_documents(docs, rows):
    matching = find_pairs(docs, method="exact")
    expected = {d for pair in similar_pairs(rows, 0.15) for d in pair}
    assert {r.doc_id for r in matching.paired_documents().collect()} == expected
    from_pairs = reports.documents_in_pairs(matching.pairs())
    assert {r.doc_id for r in from_pairs.collect()} == expected


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_block_pairs_list_each_pair_once(spark, block_rows):
    rows = [("a", i) for i in range(20)] + [("b", i) for i in range(100, 103)] + [("c", 500)]
    frame = spark.createDataFrame(rows, "k string, id bigint")
    shared = skew.keep_shared(frame, ["k"], "id")
    pairs = skew.block_pairs(shared, ["k"], "id", block_rows=block_rows).collect()
    expected = {(k, i, j) for k, i in rows for m, j in rows if k == m and i < j}
    assert len(pairs) == len(expected) and {(p.k, p.id_1, p.id_2) for p in pairs} == expected


@pytest.mark.parametrize("block_rows", [1, 4, 1000])
def test_block_join_lists_each_combination_once(spark, block_rows):
    left = spark.createDataFrame([("a", i) for i in range(9)] + [("z", 1)], "k string, id bigint")
    right = spark.createDataFrame([("a", 100 + i) for i in range(7)] + [("y", 2)], "k string, id bigint")
    joined = skew.block_join(left, right, ["k"], "id", block_rows=block_rows).collect()
    assert sorted((r.id_1, r.id_2) for r in joined) == [(i, 100 + j) for i in range(9) for j in range(7)]


@pytest.mark.parametrize("block_rows", [1, 2, 1000])
def test_expansion_in_small_blocks(spark, docs, rows, block_rows):
    matching = find_pairs(docs, method="exact")
    pairs = expand.expand_pairs(matching.set_pairs, matching.members(), block_rows)
    assert as_dict(pairs) == similar_pairs(rows, 0.15)


def test_copies_are_merged(comments):
    shingled = documents.shingle_documents(comments, MatchParams())
    sets = documents.distinct_sets(shingled)
    copied = sets.where("copies > 1").collect()
    assert [(r.user_id, r.rep_id, r.copies) for r in copied] == [("u1", 0, 2)]
    assert documents.members(shingled, sets).count() == 10


def test_replayed_documents_count_once(spark):
    rows = [(1, "u", "late", 2.0), (1, "u", "early", 1.0), (2, "u", "x", 1.0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, user_id string, text string, produced_at double")
    kept = documents.first_delivery(frame, "produced_at").orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in kept] == [(1, "early"), (2, "x")]


def test_plans_stay_in_the_jvm_and_join_on_keys(docs):
    matching = find_pairs(docs, method="exact")
    for frame in (matching.pairs(), matching.author_pair_counts(), matching.paired_documents()):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        for bad in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
            assert bad not in plan


def test_cells_give_the_verified_candidates_whatever_their_size(spark, docs):
    params = MatchParams(threshold=0.2)
    _, sets = prepare(docs, params)
    signed = lsh.signatures(sets, params)
    old = {"lsh": lsh.candidate_pairs(lsh.band_rows(signed, params), params.threshold), "exact": exact.exact_candidates(sets, params.threshold)}
    buckets = {"lsh": signed.select("rep_id", mh.band_buckets("sig", "user_id", params).alias("buckets")), "exact": None}
    for method, candidates in old.items():
        wanted = {tuple(r) for r in verify.verify_pairs(candidates, sets, params.threshold).collect()}
        for elements in (100, cells.ELEMENTS):
            found = cells.similar_pairs(sets, params.threshold, buckets[method], elements=elements).collect()
            assert wanted and len(found) == len(wanted) and {tuple(r) for r in found} == wanted


def test_matching_ships_no_pair_before_it_is_confirmed(spark):
    """Texts of one author that share a tenth of their words: no pair is similar, and none leaves the comparing tasks."""
    draw = random.Random(5)
    common = [f"c{i}" for i in range(4)]
    rows = [(i, "u", " ".join(common + [f"w{draw.randrange(4000)}" for _ in range(36)])) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, user_id string, text string")
    shingled, sets = prepare(frame, MatchParams())
    joined = cells.similar_pairs(sets, 0.15)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    top = plan[: plan.index("MapInArrow")]
    assert joined.count() == len(similar_pairs(rows, 0.15)) and "Join" not in top
    # a set is dealt to each of the author's blocks once
    dealt = cells.dealt(sets, None)
    assert dealt.count() == 300 and dealt.select("rep_id").distinct().count() == 300


def test_tasks_follow_what_is_dealt(spark, docs):
    _, sets = prepare(docs, MatchParams())
    shingles = {r.user_id: r.n for r in sets.groupBy("user_id").agg(F.sum("n_shingles").alias("n"), F.count("*").alias("m")).where("m > 1").collect()}
    wanted = -(-sum(n * -(-n // 50) for n in shingles.values()) // 50)
    assert cells.tasks_for(sets, elements=50) == wanted > 4
    assert cells.similar_pairs(sets, 0.15, elements=50).rdd.getNumPartitions() == wanted
    assert cells.tasks_for(sets) == 1


@pytest.mark.parametrize("few", [0, 1000])
@pytest.mark.parametrize("method", ["lsh", "exact"])
def test_shingles_move_to_the_cells_only(spark, docs, rows, method, few, monkeypatch):
    """With few copied sets the documents' table is dealt as it lies; with many they are looked up. Both give the pairs of sets that hold their shingles."""
    monkeypatch.setattr(skew, "FEW_ROWS", few)
    params = MatchParams(threshold=0.2)
    _, sets = prepare(docs, params)
    signed = lsh.signatures(sets, params)
    buckets = signed.select("rep_id", mh.band_buckets("sig", "user_id", params).alias("buckets")) if method == "lsh" else None
    wanted = {tuple(r) for r in cells.similar_pairs(sets, params.threshold, buckets).collect()}
    matching = find_pairs(docs, params, method)
    assert wanted and {tuple(r) for r in matching.set_pairs.collect()} == wanted
    assert "shingles" not in matching.sets.columns
    for elements in (100, cells.ELEMENTS):
        banding = params if method == "lsh" else None
        found = cells.similar_pairs(matching.sets, params.threshold, elements=elements, shingled=matching.shingled, banding=banding)
        assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)
    exchanges = cells.dealt(matching.sets, None, shingled=matching.shingled)._jdf.queryExecution().executedPlan().toString()
    assert few == 0 or "SortMergeJoin" not in exchanges


def test_a_cell_holds_one_block_and_meets_the_other_in_parts(spark, docs, rows, monkeypatch):
    """Whatever the batches are cut into; and with bands a block may be four times as long, so that sets move less often."""
    import numpy as np
    import pyarrow as pa

    params = MatchParams(threshold=0.2)
    _, sets = prepare(docs, params)
    known = sets.where("user_id IS NOT NULL")
    dealt = cells.dealt(known, None, elements=100)
    ordered = dealt.repartition(1).sortWithinPartitions("user_id", "low", "high", F.col("block") != F.col("low"), F.size("words"))
    table = pa.Table.from_batches([ordered.toArrow().combine_chunks().to_batches()[0]])
    wanted = sorted(tuple(r) for r in cells.similar_pairs(sets, params.threshold, elements=100).collect())
    monkeypatch.setattr(cells, "PART", 64)
    for n in (1, 7, 10_000):
        found = cells._comparer(params.threshold, None)(iter(table.to_batches(n)))
        assert sorted(tuple(r.values()) for batch in found for r in batch.to_pylist()) == wanted
        seconds = [pieces for second, _, pieces in cells._portions(iter(table.to_batches(n))) if second]
        assert all(len(pieces) == 1 or sum(piece.n[:-1].sum() for piece in pieces) < 64 + 60 * n for pieces in seconds)
    wide = spark.createDataFrame([("u", i, 1, 1 << 20) for i in range(16 * 16)], "user_id string, rep_id bigint, copies bigint, n_shingles int")
    assert cells.tasks_for(wide, elements=cells.BANDED_ELEMENTS) * 16 == cells.tasks_for(wide)
    assert np.dtype(cells._Held.of([cells._Piece.of(table.append_column("group", pa.array([0] * len(table))))], 0, None).words.dtype).itemsize == 4


def test_bands_of_a_cell_are_those_of_the_signature(spark, docs):
    """Also for a prime other than the Mersenne one: sets share a bucket exactly if they share a band."""
    import numpy as np

    for params in (MatchParams(), MatchParams(num_hashes=7, rows_per_band=2, prime=65537)):
        _, sets = prepare(docs, params)
        held = sorted(sets.collect(), key=lambda r: r.rep_id)
        texts = {r.rep_id: r.bands for r in lsh.signatures(sets, params).select("rep_id", mh.band_texts("sig", params).alias("bands")).collect()}
        words = np.concatenate([np.array(r.shingles) - (1 << 31) for r in held]).astype(np.int32)
        start = np.append(0, np.cumsum([len(r.shingles) for r in held]))
        found = cells._Banding.of(params).buckets(words, start, np.zeros(len(held), np.int64))
        named = {(i, text) for r in held for i, text in enumerate(texts[r.rep_id])}
        pairs = {(i, text, int(found[at, i])) for at, r in enumerate(held) for i, text in enumerate(texts[r.rep_id])}
        assert len(pairs) == len(named) == len(np.unique(found))


@pytest.mark.parametrize("few", [0, 1000])
def test_deliveries_are_settled_without_texts(spark, few, monkeypatch):
    monkeypatch.setattr(documents, "FEW_ROWS", few)
    rows = [(1, "u", "late", 2), (1, "v", "early", 1), (2, "u", "b", 1), (2, "u", "a", 1), (2, "u", "0", 2), (3, "u", "x", 5), (4, "u", "null", None), (4, "u", "one", 1)]
    nulls = [(None, "u", "n", 1), (None, "u", "n", 1)]
    frame = spark.createDataFrame(rows + nulls, "doc_id bigint, user_id string, text string, seq int")
    kept = [(r.doc_id, r.text) for r in documents.deliver_once(frame, "seq").collect()]
    assert sorted(kept, key=str) == sorted([(1, "early"), (2, "a"), (3, "x"), (4, "null"), (None, "n"), (None, "n")], key=str)
    kept = [(r.doc_id, r.text) for r in documents.deliver_once(frame).where("doc_id IS NOT NULL").collect()]
    assert sorted(kept) == [(1, "late"), (2, "0"), (3, "x"), (4, "null")]
    # without ties nothing but ids is grouped or shuffled
    plan = documents.deliver_once(frame.where("doc_id <> 2"), "seq")._jdf.queryExecution().optimizedPlan().toString()
    assert all("text" not in line for line in plan.splitlines() if "Aggregate" in line)


def test_a_matching_is_matched_again_by_the_other_method(docs, rows):
    matching = find_pairs(docs)
    again = matching.matched(MatchParams(), "exact")
    assert as_dict(again.pairs()) == similar_pairs(rows, 0.15) and again.shingled is matching.shingled
