from reecho.operators import tables

STATS = "user_id string, total_comments bigint, similar_pairs bigint, similarity_rate double"
PAIRS = "doc_id_1 bigint, doc_id_2 bigint, similarity double"


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def result(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_first_author_of_a_document_stays(spark):
    stored = frame(spark, "doc_id bigint, user_id string", (1, "old"))
    incoming = frame(spark, "doc_id bigint, user_id string, seq int", (1, "new", 1), (2, "b", 2), (2, "a", 1))
    assert result(tables.first_writer_wins(stored, incoming), "doc_id") == [(1, "old"), (2, "a")]


def test_pairs_are_ordered_and_inserted_once(spark):
    stored = frame(spark, PAIRS, (1, 2, 0.9))
    incoming = frame(spark, PAIRS + ", seq int", (2, 1, 0.1, 1), (999999, 999998, 0.85, 2), (999998, 999999, 0.9, 3), (5, 5, 1.0, 4))
    merged = tables.insert_new_pairs(stored, incoming)
    assert result(merged, "doc_id_1") == [(1, 2, 0.9), (999998, 999999, 0.85)]


def test_counters(spark):
    stats = frame(spark, STATS, ("a", 2, 1, 1.0), ("gone", 5, 2, 0.2))
    docs = frame(spark, "doc_id bigint, user_id string", (1, "a"), (2, "a"), (3, "a"), (4, "b"))
    assert result(tables.add_comment_counts(stats, docs), "user_id") == [
        ("a", 5, 1, 1.0), ("b", 1, 0, 0.0), ("gone", 5, 2, 0.2)]
    assert result(tables.sync_totals(stats, docs), "user_id") == [
        ("a", 3, 1, 1.0), ("b", 1, 0, 0.0), ("gone", 5, 2, 0.2)]
    assert result(tables.rebuild_stats(docs), "user_id") == [("a", 3, 0, 0.0), ("b", 1, 0, 0.0)]


def test_pair_counts_refresh_touched_authors_only(spark):
    stats = frame(spark, STATS, ("a", 4, 1, 0.9), ("b", 1, 0, 0.7), ("c", 3, 1, 0.8))
    counts = frame(spark, "user_id string, similar_pairs bigint", ("a", 2), ("b", 1), ("unknown", 5))
    added = tables.add_pair_counts(stats, counts)
    assert result(added, "user_id") == [("a", 4, 3, 0.5), ("b", 1, 1, None), ("c", 3, 1, 0.8)]
    assert result(tables.refresh_rates(stats), "user_id") == [("a", 4, 1, 1 / 6), ("b", 1, 0, None), ("c", 3, 1, 1 / 3)]


def test_pair_counts_need_both_documents_of_one_author(spark):
    docs = frame(spark, "doc_id bigint, user_id string", (1, "a"), (2, "a"), (3, "b"))
    pairs = frame(spark, PAIRS, (1, 2, 1.0), (1, 3, 1.0), (2, 9, 1.0))
    assert result(tables.author_pair_counts(pairs, docs), "user_id") == [("a", 1)]


def test_last_snapshot_wins(spark):
    schema = "worker string, timestamp bigint, throughput double"
    merged = tables.latest_snapshots(
        frame(spark, schema, ("1", 10, 1.0), ("2", 30, 2.0)), frame(spark, schema, ("1", 20, 9.0), ("2", 20, 8.0))
    )
    assert result(merged, "worker") == [("1", 20, 9.0), ("2", 30, 2.0)]


def test_latency_merge_ignores_empty_records(spark):
    schema = "total_latency_ms double, latency_count bigint, min_latency_ms double, max_latency_ms double"
    empty, first = frame(spark, schema, (0.0, 0, 0.0, 0.0)), frame(spark, schema, (30.0, 2, 10.0, 20.0))
    assert result(tables.merge_latency(empty, first), "latency_count") == [(30.0, 2, 10.0, 20.0)]
    assert result(tables.merge_latency(empty), "latency_count") == [(0.0, 0, 0.0, 0.0)]


def test_integrity_report(spark):
    docs = frame(spark, "doc_id bigint, user_id string", (1, "a"), (1, "b"), (2, None))
    pairs = frame(spark, PAIRS, (1, 2, 0.5), (1, 2, 0.5), (3, 2, 0.1), (None, 4, 0.5))
    stats = frame(spark, STATS, ("a", 1, 0, 0.0))
    found = dict(result(tables.integrity_violations(docs, pairs, stats, 0.15), "rule"))
    assert {k: v for k, v in found.items() if v} == {
        "doc_users_duplicate_key": 1, "doc_users_null": 1, "similarities_duplicate_key": 1, "similarities_null": 1,
        "similarities_order": 1, "similarities_range": 1,
    }
    assert len(found) == 8


def test_author_lookup_gives_null_for_unknown(spark):
    ids = frame(spark, "doc_id bigint", (0,), (7,))
    docs = frame(spark, "doc_id bigint, user_id string", (0, "zero"))
    assert result(tables.look_up_authors(ids, docs), "doc_id") == [(0, "zero"), (7, None)]
