"""The registered queries: operators bound to the driver's tables.

``documents.source`` plays the author of a document, ``documents.lang`` a second, coarser
author where a query needs pairs across authors. In ``events`` the value plays a latency
in milliseconds and the event type a worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reecho import MatchParams, Workspace, find_pairs, tune
from reecho.functions import minhash as mh
from reecho.functions import text as tx
from reecho.functions.scores import latency_ms
from reecho.operators import documents as docs_op
from reecho.operators import expand, latency, lsh, runs, skew, tables
from reecho.plans import reports
from reecho.plans.matching import Matching, prepare
from reecho.sources import comments, lake, messages
from reecho.sources.tables import SCHEMAS as TABLES
from reecho.sources.tables import SnapshotTables
from reecho.streaming.joins import pair_events, shingle_events
from reecho.streaming.metrics import AuthorCounters, ProgressLog, WorkerWindows, worker_windows
from reecho.streaming.pairs import PairStream
from reecho.streaming.recent import BOUNDED_STORE, STATE_STORE, newest_pairs

PARAMS = MatchParams()
LONG_TEXT_WORDS = 50
SAMPLE_ROWS = 500
LAKE_AUTHOR = "src0"
STATE_NEWEST, STATE_SHARDS = 3, 4
STREAM_FILES = 3
RETENTION_SECONDS = 300.0
# Fixed value: production time of document 0, in epoch seconds.
EPOCH = 1_700_000_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return run


def _documents(spark: SparkSession, sf_dir: str, author: str = "source") -> DataFrame:
    return comments.read_documents(spark, f"{sf_dir}/documents.parquet", author)


def _doc_users(spark: SparkSession, sf_dir: str, author: str = "source") -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.select("doc_id", F.col(author).cast("string").alias("user_id"))


def _labelled(spark: SparkSession, sf_dir: str, author: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    return _doc_users(spark, sf_dir, author).join(labels, "doc_id", "left_semi")


def _match(spark: SparkSession, sf_dir: str, method: str = "lsh", author: str = "source") -> Matching:
    return find_pairs(_documents(spark, sf_dir, author), PARAMS, method)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select(
        F.col("doc_id").alias("id"), "text", "user_id", (F.col("doc_id") + EPOCH).cast("double").alias("produced_at")
    )


def _seen(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("worker"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("latency_ms")
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seen(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(name, 6) for name in names})


# --- text -----------------------------------------------------------------------------


@registered
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1-T7."""
    return _documents(spark, sf_dir).select("doc_id", tx.clean_text(F.col("text")).alias("clean"))


@registered
def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document with their counts."""
    tokens = docs_op.clean_documents(_documents(spark, sf_dir), 1)
    return tokens.select("doc_id", F.explode("words").alias("word")).groupBy("doc_id", "word").agg(
        F.count(F.lit(1)).alias("occurrences")
    )


def _shingles(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    shingled = docs_op.shingle_documents(_documents(spark, sf_dir), replace(PARAMS, shingle_size=k))
    return shingled.select("doc_id", F.explode("shingles").alias("shingle"))


@registered
def shingles_k1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9-T12 with single words."""
    return _shingles(spark, sf_dir, 1)


@registered
def shingles_k4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9-T12 with runs of four words."""
    return _shingles(spark, sf_dir, 4)


@registered
def short_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments and processed comments per author."""
    checked = docs_op.clean_documents(_documents(spark, sf_dir), LONG_TEXT_WORDS)
    return checked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_comments"), F.count_if("long_enough").alias("processed")
    )


# --- MinHash and LSH ------------------------------------------------------------------


def _signed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    _, sets = prepare(_documents(spark, sf_dir), PARAMS)
    return sets, lsh.signatures(sets, PARAMS)


@registered
def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M2: signature of every document, through its distinct set."""
    shingled, sets = prepare(_documents(spark, sf_dir), PARAMS)
    signed = lsh.signatures(sets, PARAMS).select("rep_id", F.posexplode("sig").alias("i", "h"))
    return docs_op.members(shingled, sets).join(signed, "rep_id").select("doc_id", "i", "h")


@registered
def lsh_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: bands of the distinct sets, as text."""
    _, signed = _signed(spark, sf_dir)
    return signed.select("rep_id", F.posexplode(mh.band_texts("sig", PARAMS)).alias("band", "band_values"))


@registered
def bucket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many buckets hold how many documents."""
    sets, signed = _signed(spark, sf_dir)
    sizes = lsh.bucket_sizes(signed, sets, PARAMS)
    return sizes.groupBy("user_id", "band", "n_docs").agg(F.count(F.lit(1)).alias("n_buckets"))


def _set_facts(sets: DataFrame, n: int) -> DataFrame:
    return sets.select(
        F.col("rep_id").alias(f"rep_id_{n}"), F.col("copies").alias(f"copies_{n}"), F.col("user_id").alias(f"user_{n}")
    )


@registered
def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All document pairs that share a bucket."""
    shingled, sets = prepare(_documents(spark, sf_dir), PARAMS)
    pairs = lsh.candidate_pairs(lsh.band_rows(lsh.signatures(sets, PARAMS), PARAMS))
    for n in (1, 2):
        pairs = pairs.join(_set_facts(sets, n), f"rep_id_{n}")
    # bucket ids are hashes of the author and a band; the author is asked for as well
    unscored = pairs.where("user_1 = user_2").select(
        F.col("user_1").alias("user_id"), "rep_id_1", "rep_id_2", "copies_1", "copies_2", F.lit(0.0).alias("similarity")
    )
    return expand.expand_pairs(unscored, docs_op.members(shingled, sets)).select("user_id", "doc_id_1", "doc_id_2")


@registered
def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs found by LSH."""
    return _match(spark, sf_dir).pairs()


@registered
def exact_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All similar pairs."""
    return _match(spark, sf_dir, "exact").pairs()


@registered
def lsh_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact pairs and how many of them LSH finds, by similarity in tenths."""
    keys = ["user_id", "doc_id_1", "doc_id_2"]
    matching = _match(spark, sf_dir)
    found = matching.pairs().select(*keys, F.lit(1).alias("hit"))
    compared = matching.matched(PARAMS, "exact").pairs().join(found, keys, "left")
    return compared.groupBy(F.floor(F.col("similarity") * 10).alias("tenth")).agg(
        F.count(F.lit(1)).alias("exact_pairs"), F.count("hit").alias("lsh_pairs")
    )


# --- author reports -------------------------------------------------------------------


def _plain_counts(report: DataFrame) -> DataFrame:
    return report.withColumn("similar_pairs", F.col("similar_pairs").cast("bigint"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spammer report from exact pairs: no sampling, no missed pair."""
    return _plain_counts(reports.spammer_report(_match(tune(spark), sf_dir, "exact"), min_rate=0.0))


@registered
def spammers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4-A5, R1 over exact pairs."""
    return flagship(spark, sf_dir)


@registered
def spammers_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4-A5, R1 over LSH pairs."""
    return _plain_counts(reports.spammer_report(_match(spark, sf_dir), min_rate=0.0))


@registered
def spammers_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report for authors of a stored document table, from pairs within languages, which are counted and not built."""
    doc_users = _doc_users(spark, sf_dir)
    counts = _match(spark, sf_dir, author="lang").own_pair_counts(doc_users)
    return _plain_counts(reports.spammers(tables.comment_counts(doc_users), counts, min_rate=0.0))


@registered
def spammers_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report when the labelled documents are delivered again under another author; the first delivery counts."""
    first = _documents(spark, sf_dir).withColumn("seq", F.lit(1))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    named = F.broadcast(labels) if skew.counted_few(labels) else labels
    again = first.join(named, "doc_id", "left_semi").withColumns({"seq": F.lit(2), "user_id": F.lit("again")})
    matching = find_pairs(first.unionByName(again), PARAMS, "exact", order="seq")
    return _plain_counts(reports.spammer_report(matching, min_rate=0.0))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_counts(tables.user_stats(_doc_users(spark, sf_dir), _match(spark, sf_dir).author_pair_counts()))


@registered
def user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics rebuilt from documents and pairs."""
    return _stats(spark, sf_dir)


@registered
def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2."""
    return reports.top_users(_stats(spark, sf_dir))


@registered
def user_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs per author where both documents are known and of one author, counted and not built."""
    return _plain_counts(_match(spark, sf_dir, author="lang").own_pair_counts(_labelled(spark, sf_dir, "lang")))


@registered
def pairs_with_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs within a language with their authors."""
    pairs = _match(spark, sf_dir, author="lang").pairs()
    listed = reports.pairs_with_authors(pairs, _doc_users(spark, sf_dir))
    return listed.withColumn("same_author", F.col("user_id_1") == F.col("user_id_2"))


@registered
def pairs_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty most similar pairs within a language, with texts."""
    listed = reports.similar_comments(
        _match(spark, sf_dir, author="lang").top(reports.PAIR_LIMIT), _doc_users(spark, sf_dir)
    )
    return reports.with_texts(listed, _documents(spark, sf_dir), reports.PAIR_LIMIT)


@registered
def author_similar_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that occur in a pair."""
    return _match(spark, sf_dir).paired_documents()


@registered
def author_other_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that occur in no pair."""
    paired = _match(spark, sf_dir).paired_documents().select("doc_id")
    return _doc_users(spark, sf_dir).join(paired, "doc_id", "left_anti")


@registered
def doc_author_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of given ids, most of them unknown."""
    ids = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("doc_id"))
    return tables.look_up_authors(ids, _doc_users(spark, sf_dir))


# --- table maintenance ----------------------------------------------------------------


@registered
def doc_users_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are stored under their language; all are delivered twice."""
    first = _doc_users(spark, sf_dir).withColumn("seq", F.lit(1))
    again = _doc_users(spark, sf_dir, "lang").withColumn("seq", F.lit(2))
    return tables.first_writer_wins(_labelled(spark, sf_dir, "lang"), again.unionByName(first))


@registered
def similarities_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs within a source are stored; pairs within a language arrive reversed and twice."""
    stored = _match(spark, sf_dir).pairs()
    wider = _match(spark, sf_dir, author="lang").pairs()
    reverse = wider.select(
        F.col("doc_id_2").alias("doc_id_1"), F.col("doc_id_1").alias("doc_id_2"), "similarity", F.lit(1).alias("seq")
    )
    halved = reverse.withColumn("similarity", F.col("similarity") / 2).withColumn("seq", F.lit(2))
    return tables.insert_new_pairs(stored, halved.unionByName(reverse))


@registered
def counter_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and pairs are added to the statistics of the labelled ones."""
    stored = tables.rebuild_stats(_labelled(spark, sf_dir, "source"))
    counted = tables.add_comment_counts(stored, _doc_users(spark, sf_dir))
    return _plain_counts(tables.add_pair_counts(counted, _match(spark, sf_dir).author_pair_counts()))


@registered
def stats_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: totals synchronised; authors without documents (the languages) keep theirs."""
    sources = tables.rebuild_stats(_labelled(spark, sf_dir, "source"))
    stored = sources.unionByName(tables.rebuild_stats(_doc_users(spark, sf_dir, "lang")))
    with_pairs = tables.add_pair_counts(stored, _match(spark, sf_dir, author="lang").author_pair_counts())
    return _plain_counts(tables.sync_totals(with_pairs, _doc_users(spark, sf_dir)))


@registered
def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U10 on tables with replayed documents and authors, reversed and repeated pairs, and nulls, so that every rule counts some."""
    labelled = _labelled(spark, sf_dir, "source")
    unknown = labelled.where(F.pmod("doc_id", F.lit(5)) == 0).withColumn("user_id", F.lit(None).cast("string"))
    doc_users = _doc_users(spark, sf_dir).unionByName(labelled).unionByName(unknown)
    pairs = _match(spark, sf_dir, author="lang").pairs().select("doc_id_1", "doc_id_2", "similarity")
    reverse = pairs.select(F.col("doc_id_2").alias("doc_id_1"), F.col("doc_id_1").alias("doc_id_2"), "similarity")
    again = pairs.where(F.pmod("doc_id_1", F.lit(3)) == 0)
    unscored = pairs.where(F.pmod("doc_id_1", F.lit(4)) == 0).withColumn("similarity", F.lit(None).cast("double"))
    stats = tables.rebuild_stats(doc_users)
    twice = stats.where(F.col("user_id") < "src2")
    return tables.integrity_violations(
        doc_users, pairs.unionByName(reverse).unionByName(again).unionByName(unscored), stats.unionByName(twice), 0.5
    )


@registered
def table_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of the labelled documents are stored, read, brought up to date with all documents, stored and read again."""
    workspace = Workspace.of(spark, "tables")
    store = SnapshotTables(spark, workspace.path("store"))
    pairs = workspace.save(_match(spark, sf_dir).pairs().select(*tables.PAIR_KEYS, "similarity"), "pairs")
    known = store.write("doc_users", _labelled(spark, sf_dir, "source"), 1)
    stored = pairs
    for key in tables.PAIR_KEYS:
        stored = stored.join(known.select(F.col("doc_id").alias(key)), key, "left_semi")
    old_pairs = store.write("similarities", stored, 1)
    old_stats = store.write("user_stats", tables.user_stats(known, tables.author_pair_counts(old_pairs, known)), 1)
    doc_users = store.write("doc_users", tables.first_writer_wins(known, _doc_users(spark, sf_dir).withColumn("seq", F.lit(1))), 2)
    new_pairs = store.write("similarities", tables.insert_new_pairs(old_pairs, pairs.withColumn("seq", F.lit(1))), 2).join(
        old_pairs.select(*tables.PAIR_KEYS), tables.PAIR_KEYS, "left_anti"
    )
    counted = tables.add_comment_counts(old_stats, doc_users.join(known.select("doc_id"), "doc_id", "left_anti"))
    added = tables.add_pair_counts(counted, tables.author_pair_counts(new_pairs, doc_users))
    return store.write("user_stats", tables.refresh_rates(added), 2)


# --- workers and latency --------------------------------------------------------------


def _intervals(spark: SparkSession, sf_dir: str, seconds: int = latency.INTERVAL_SECONDS) -> DataFrame:
    return latency.with_processed_count(latency.interval_stats(_events(spark, sf_dir), seconds), seconds)


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = TABLES["worker_stats"].fieldNames()
    hourly = _intervals(spark, sf_dir, 3600).select(*columns)
    return tables.latest_snapshots(hourly, _intervals(spark, sf_dir).select(*columns))


@registered
def worker_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7."""
    stats = _intervals(spark, sf_dir).drop("interval_start")
    return _rounded(stats, "avg_latency_ms", "total_latency_ms")


@registered
def worker_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly statistics replaced by ten-second ones where those are later."""
    return _rounded(tables.worker_listing(_snapshot(spark, sf_dir)), "avg_latency_ms", "throughput")


@registered
def system_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8, A9, U12."""
    return _rounded(latency.latency_report(latency.system_latency(_events(spark, sf_dir))), "total_latency_ms")


@registered
def latency_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval records merged into one."""
    return _rounded(tables.merge_latency(latency.interval_stats(_events(spark, sf_dir))), "total_latency_ms")


@registered
def dashboard_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A3, A10."""
    matching = _match(spark, sf_dir)
    metrics = reports.dashboard_metrics(
        matching.author_pair_counts(),
        tables.comment_counts(matching.docs),
        matching.shingled,
        _snapshot(spark, sf_dir),
    )
    return _rounded(metrics.withColumn("total_similarities", F.col("total_similarities").cast("bigint")), "total_throughput")


@registered
def message_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T13, ST8: latency of events as if produced ``value`` milliseconds before their time."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    seen = F.col("ts").cast("timestamp").cast("double")
    stamped = events.select("event_id", latency_ms(seen, seen - F.col("value") / 1000).alias("latency_ms"))
    return stamped.withColumn("latency_ms", F.round("latency_ms", 2))


# --- runs -----------------------------------------------------------------------------


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation messages in one interleaved stream, ordered by turn, then conversation."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    offset = F.shiftleft(F.col("turn").cast("bigint"), 32) + F.col("conv_id")
    return table.select(
        F.lit(0).alias("part"), offset.alias("offset"), F.col("role").alias("user_id"), "text", "conv_id", "turn"
    )


@registered
def author_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4, ST6: runs of messages by the same role."""
    return runs.author_runs(_turns(spark, sf_dir)).select("conv_id", "turn", "run_id")


@registered
def run_scoped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: pairs within a run only."""
    scoped = runs.scope_to_runs(runs.author_runs(_turns(spark, sf_dir))).withColumnRenamed("offset", "doc_id")
    found = find_pairs(scoped.select("doc_id", "user_id", "text"), PARAMS, "exact").pairs()
    return found.select(F.col("user_id").alias("run"), "doc_id_1", "doc_id_2", "similarity")


# --- sources and sinks ----------------------------------------------------------------


@registered
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through the comment CSV format."""
    given = {"commentID": F.col("doc_id").cast("string"), "userID": F.col("user_id"), "commentBody": F.col("text")}
    columns = [
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in comments.COMMENT_SCHEMA.fields
    ]
    path = Workspace.of(spark, "csv").path("comments")
    comments.write_comments_csv(_documents(spark, sf_dir).select(*columns), path)
    read = comments.read_comments_csv(spark, path)
    return comments.to_message(read, F.lit(EPOCH))


@registered
def json_message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, S6, S8, S9."""
    return messages.decode(messages.encode(_messages(spark, sf_dir)))


@registered
def lake_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10-S12."""
    path = Workspace.of(spark, "lake").path("documents")
    lake.write_lake(_messages(spark, sf_dir), path)
    return lake.read_lake(spark, path).drop("ingested_at")


def _lake(spark: SparkSession, sf_dir: str) -> lake.Lake:
    path = Workspace.of(spark, "lake").path("documents")
    lake.write_lake(_messages(spark, sf_dir), path)
    return lake.Lake.at(spark, path)


@registered
def lake_author_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One author's comments from the lake, those in a similar pair and the others."""
    stored = _lake(spark, sf_dir)
    paired = _match(spark, sf_dir).paired_documents()
    found = [
        reports.author_comments(stored, LAKE_AUTHOR, paired, similar, limit=None).select("doc_id", "text", F.lit(similar).alias("similar"))
        for similar in (True, False)
    ]
    return found[0].unionByName(found[1])


@registered
def lake_pairs_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty most similar pairs within a language, with texts from the folders of their authors."""
    listed = reports.similar_comments(
        _match(spark, sf_dir, author="lang").top(reports.PAIR_LIMIT), _doc_users(spark, sf_dir)
    )
    return reports.with_texts(listed, _lake(spark, sf_dir), reports.PAIR_LIMIT)


@registered
def lake_dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the lines of files that another program left, and the times of arrival that their names give.

    Every document is a line; after some of them follow a blank, a broken and a foreign one. Even ids carry a time of arrival.
    """
    sent = _messages(spark, sf_dir)
    stamp = F.when(F.pmod("id", F.lit(2)) == 0, F.lit(float(EPOCH)))
    row = F.to_json(F.struct("id", "text", "produced_at", stamp.alias("ingested_at"), "user_id"))
    extra = {7: F.lit("  "), 11: F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "text": "no end')), 13: F.lit('{"other": 1}')}
    lines = F.array(row, *[F.when(F.pmod("id", F.lit(n)) == 0, line) for n, line in extra.items()])
    path = Workspace.of(spark, "dirty").path("documents")
    lake.write_lines(sent.select(F.explode(F.array_compact(lines)).alias("value")), path, EPOCH)
    stored = lake.Lake.at(spark, path)
    kinds = ["document", "broken", "foreign", "blank", "from_name"]
    totals = stored.accounts().agg(*[F.coalesce(F.sum(k), F.lit(0)).cast("bigint").alias(k) for k in kinds])
    read = stored.documents().agg(F.count(F.lit(1)).alias("n"), F.sum("ingested_at").alias("arrivals"))
    kept = stored.quarantine().agg(F.count(F.lit(1)).alias("n"))
    rows = [
        totals.unpivot([], kinds, "kind", "n"),
        read.select(F.lit("read").alias("kind"), "n"),
        read.select(F.lit("sum_of_arrivals").alias("kind"), F.col("arrivals").cast("bigint").alias("n")),
        kept.select(F.lit("quarantined").alias("kind"), "n"),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@registered
def sample_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2."""
    return comments.sample_head(_documents(spark, sf_dir), SAMPLE_ROWS, "doc_id")


# --- streams --------------------------------------------------------------------------


def _pieces(spark: SparkSession, sf_dir: str) -> int:
    """Files of a batch, so that no task writes more than about a split of the documents."""
    splits = spark.read.parquet(f"{sf_dir}/documents.parquet").rdd.getNumPartitions()
    return -(-splits // STREAM_FILES)


def _topic(spark: SparkSession, sf_dir: str, workspace: Workspace) -> DataFrame:
    path, pieces = workspace.path("topic"), _pieces(spark, sf_dir)
    messages.write_topic_files(_messages(spark, sf_dir), path, STREAM_FILES, pieces=pieces)
    return messages.read_topic_files(spark, path, pieces)


def _streamed_pairs(spark: SparkSession, sf_dir: str, retention: float | None = None) -> DataFrame:
    workspace = Workspace.of(spark, "stream")
    stream = PairStream(spark, workspace.path("facts"), PARAMS, retention)
    stream.start(_topic(spark, sf_dir, workspace), workspace.path("checkpoint"), available_now=True).awaitTermination()
    return stream.pairs()


@registered
def stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7, S15, ST1-ST4: pairs found batch by batch."""
    return _streamed_pairs(spark, sf_dir)


@registered
def stream_bounded_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5: only documents produced at most ``RETENTION_SECONDS`` apart are compared, across batches too."""
    return _streamed_pairs(spark, sf_dir, RETENTION_SECONDS)


@registered
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4: two batches, split by parity of the id, each of them processed twice."""
    stream = PairStream(spark, Workspace.of(spark, "stream").path("facts"), PARAMS)
    for batch_id in (0, 0, 1, 1):
        stream.process(_messages(spark, sf_dir).where(F.pmod("id", F.lit(2)) == batch_id), batch_id)
    return stream.pairs()


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _appended(frame: DataFrame, out: str, checkpoint: str) -> None:
    written = frame.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    written.trigger(availableNow=True).start().awaitTermination()


@registered
def stream_joined_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2, ST3, ST5: pairs from one stateful self-join with retention, over a stored stream of shingles; labelled documents come twice."""
    workspace = Workspace.of(spark, "stream")
    sent = _messages(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"))
    again = sent.join(labels, "id", "left_semi").withColumn("produced_at", F.col("produced_at") + 0.5)
    pieces = _pieces(spark, sf_dir)
    messages.write_topic_files(sent.unionByName(again), workspace.path("topic"), STREAM_FILES, pieces=pieces)
    timed = messages.with_event_time(messages.read_topic_files(spark, workspace.path("topic"), pieces))
    with _settings(spark, BOUNDED_STORE):
        events = shingle_events(timed, PARAMS, lateness="3650 days")
        _appended(events, workspace.path("events"), workspace.path("events-checkpoint"))
        stored = spark.readStream.schema(events.schema).parquet(workspace.path("events"))
        found = pair_events(stored, PARAMS, retention="3650 days", lateness="3650 days")
        _appended(found, workspace.path("pairs"), workspace.path("checkpoint"))
    return spark.read.schema(found.schema).parquet(workspace.path("pairs"))


@registered
def stream_keyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5: each document against the newest ones of its author, ``STATE_NEWEST`` in each of ``STATE_SHARDS`` shards.

    The topic's parts are written and read one after the other, as what state of bounded size finds depends on the order of arrival.
    """
    workspace, pieces = Workspace.of(spark, "stream"), _pieces(spark, sf_dir)
    sent = _messages(spark, sf_dir)
    low, high = sent.agg(F.min("id"), F.max("id")).first()
    width = (high - low) // STREAM_FILES + 1
    out = workspace.path("pairs")
    with _settings(spark, STATE_STORE):
        for n in range(STREAM_FILES):
            part = sent.where(F.floor((F.col("id") - low) / width) == n)
            messages.write_topic_files(part, workspace.path(f"topic/{n}"), 1, pieces=pieces)
            # what has arrived since the last start is one batch
            arrived = messages.read_topic_files(spark, workspace.path("topic/*"), 2 * pieces)
            found = newest_pairs(messages.with_event_time(arrived), PARAMS, STATE_NEWEST, STATE_SHARDS, retention=1e9)
            _appended(found, out, workspace.path("checkpoint"))
    return spark.read.schema(found.schema).parquet(out)


@registered
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10: batches and messages of a stream that is stopped and started again, from the stored counters."""
    workspace = Workspace.of(spark, "stream")
    counters = AuthorCounters(spark, workspace.path("counts"))
    topic = _topic(spark, sf_dir, workspace)
    for _ in range(2):
        log = ProgressLog(spark, workspace.path("progress"))
        query = topic.writeStream.foreachBatch(log.logged(counters.process)).option("checkpointLocation", workspace.path("checkpoint"))
        query.trigger(availableNow=True).start().awaitTermination()
    return log.totals().select("batches", "messages", "with_text")


@registered
def stream_user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST9, A6."""
    workspace = Workspace.of(spark, "stream")
    counters = AuthorCounters(spark, workspace.path("counts"))
    counters.start(_topic(spark, sf_dir, workspace), workspace.path("checkpoint"), available_now=True).awaitTermination()
    return counters.totals()


@registered
def stream_worker_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7: intervals as they stand after the last event, open ones too."""
    workspace = Workspace.of(spark, "stream")
    source = f"{sf_dir}/events.parquet"
    events = (
        spark.readStream.schema(spark.read.parquet(source).schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    windows = worker_windows(_seen(events)).withColumn("interval_start", F.unix_timestamp("interval_start"))
    kept = WorkerWindows(spark, workspace.path("windows"), windows)
    kept.start(workspace.path("checkpoint"), available_now=True).awaitTermination()
    return _rounded(kept.current(), "avg_latency_ms", "total_latency_ms")
