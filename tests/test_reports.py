from brute import as_dict, similar_pairs
from reecho import find_pairs
from reecho.functions.scores import author_percent, latency_ms, pair_percent
from reecho.operators import latency, runs, tables
from reecho.plans import reports
from pyspark.sql import functions as F


def test_spammer_report_cutoffs_and_order(spark):
    stats = spark.createDataFrame(
        [("a", 10), ("b", 10), ("c", 9), ("d", 10), ("e", 20)], "user_id string, total_comments bigint")
    counts = spark.createDataFrame(
        [("a", 9), ("b", 9), ("c", 36), ("d", 1), ("e", 190)], "user_id string, similar_pairs bigint")
    report = reports.spammers(stats, counts).collect()
    assert [(r.user_id, r.similarity_rate, r.rate_percent) for r in report] == [
        ("e", 1.0, 100.0), ("a", 0.2, 20.0), ("b", 0.2, 20.0)]
    assert [r.user_id for r in reports.spammers(stats, counts, 0.0, 2, 2).collect()] == ["c", "e"]


def test_report_from_matching_equals_report_from_tables(comments):
    matching = find_pairs(comments, method="exact")
    direct = reports.spammer_report(matching, min_rate=0.0, min_comments=2).collect()
    doc_users = comments.select("doc_id", "user_id")
    stored = reports.spammers_from_pairs(
        matching.pairs(), doc_users, tables.comment_counts(doc_users), min_rate=0.0, min_comments=2)
    rows = stored.collect()
    assert [tuple(r) for r in rows] == [(r.user_id, r.total_comments, int(r.similar_pairs), r.similarity_rate, r.rate_percent) for r in direct]
    assert len(rows) == 2


def test_top_users_is_strict(spark):
    schema = "user_id string, total_comments bigint, similar_pairs bigint, similarity_rate double"
    stats = spark.createDataFrame([("a", 10, 0, 0.0), ("c", 11, 0, 0.0), ("b", 11, 0, 0.0)], schema)
    assert [r.user_id for r in reports.top_users(stats).collect()] == ["b", "c"]


def test_listing_with_texts(spark, comments, comment_rows):
    pairs = find_pairs(comments, method="exact").pairs()
    listed = reports.similar_comments(pairs, comments.select("doc_id", "user_id"), 3)
    lake = comments.withColumn("ingested_at", F.lit(1.0)).unionByName(
        comments.where("doc_id = 0").withColumn("text", F.lit("newer")).withColumn("ingested_at", F.lit(2.0))
    ).where("doc_id <> 1")
    rows = reports.with_texts(listed, lake, 3).orderBy(F.desc("similarity"), "doc_id_1", "doc_id_2").collect()
    expected = sorted(similar_pairs(comment_rows, 0.15).items(), key=lambda p: (-p[1], p[0]))[:3]
    assert [((r.doc_id_1, r.doc_id_2), r.similarity) for r in rows] == expected
    assert (rows[0].text_1, rows[0].text_2, rows[0].same_author, rows[0].percent) == ("newer", None, True, 100.0)


def test_author_comments(comments):
    paired = find_pairs(comments, method="exact").paired_documents()
    similar = reports.author_comments(comments, "u3", paired).collect()
    other = reports.author_comments(comments, "u3", paired, similar=False).collect()
    assert [r.doc_id for r in similar] == [7, 8, 9] and [r.doc_id for r in other] == [10]
    assert [r.doc_id for r in reports.author_comments(comments, "u3", paired, limit=2).collect()] == [7, 8]


def test_dashboard_of_nothing_is_zero(spark):
    metrics = reports.dashboard_metrics(
        spark.createDataFrame([], "user_id string, similar_pairs bigint"),
        spark.createDataFrame([], "user_id string, total_comments bigint"),
        spark.createDataFrame([], "doc_id bigint"),
        spark.createDataFrame([], "throughput double"),
    )
    assert [int(x) for x in metrics.first()] == [0, 0, 0, 0]


def test_formats(spark):
    frame = spark.createDataFrame([(0.12345, 10.0, 9.5), (0.5, 10.0, 0.0)], "x double, seen double, made double")
    rows = frame.select(pair_percent(F.col("x")), author_percent(F.col("x")), latency_ms(F.col("seen"), F.col("made"))).collect()
    assert [tuple(r) for r in rows] == [(12.3, 12.35, 500.0), (50.0, 50.0, None)]


def test_worker_intervals_and_running_count(spark):
    rows = [("w1", f"2024-01-01 00:00:{s:02d}", v) for s, v in ((1, 10.0), (2, 30.0), (11, 5.0), (31, None))]
    seen = spark.createDataFrame(rows, "worker string, at string, latency_ms double").withColumn("ts", F.to_timestamp("at"))
    stats = latency.with_processed_count(latency.interval_stats(seen)).orderBy("timestamp").collect()
    assert [(r.throughput, r.avg_latency_ms, r.min_latency_ms, r.max_latency_ms, r.latency_count, r.processed_count) for r in stats] == [
        (0.2, 20.0, 10.0, 30.0, 2, 2), (0.1, 5.0, 5.0, 5.0, 1, 3), (0.1, 0.0, 0.0, 0.0, 0, 4)]


def test_latency_report_of_nothing_is_zero(spark):
    none = spark.createDataFrame([], "latency_ms double")
    assert tuple(latency.latency_report(latency.system_latency(none)).first()) == (0.0, 0.0, 0.0, 0.0, 0)


def test_runs_across_chunks(spark):
    authors = "aabbbacccccab"
    rows = [(part, i * 3, a) for part in (0, 1) for i, a in enumerate(authors if part == 0 else "aaab")]
    frame = spark.createDataFrame(rows, "part int, offset bigint, user_id string")
    for width in (1, 4, 7, 1000):
        found = runs.author_runs(frame, chunk_width=width).orderBy("part", "offset").collect()
        assert [r.run_id for r in found] == [1, 1, 2, 2, 2, 3, 4, 4, 4, 4, 4, 5, 6, 1, 1, 1, 2]


def test_running_total_across_chunks(spark):
    frame = spark.createDataFrame([("p", i, i + 1) for i in range(20)], "part string, offset bigint, v bigint")
    for width in (1, 6, 100):
        found = runs.running_total(frame, "part", "offset", "v", "total", width).orderBy("offset").collect()
        assert [r.total for r in found] == [sum(range(1, i + 2)) for i in range(20)]


def test_matching_inside_runs(spark):
    text = "same words every time"
    rows = [(0, i, a, text) for i, a in enumerate("aabaa")]
    frame = spark.createDataFrame(rows, "part int, offset bigint, user_id string, text string")
    scoped = runs.scope_to_runs(runs.author_runs(frame)).withColumnRenamed("offset", "doc_id")
    assert set(as_dict(find_pairs(scoped).pairs())) == {(0, 1), (3, 4)}
