import os

import pytest
from pyspark.sql import functions as F

from reecho.sources import comments as csv
from reecho.sources import lake, messages, tables

TEXTS = ['plain', 'with "quotes" and, commas', "two\nlines", "tab\tend ", "", " lead", 'back\\slash "q"', "é—“x”"]


@pytest.fixture
def sent(spark):
    rows = [(i, t, f"100{i % 3}", 1000.0 + i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, messages.MESSAGE_SCHEMA)


def test_csv_round_trip(spark, folder):
    columns = {"commentID": F.col("id").cast("string"), "commentBody": F.col("text"), "userID": F.col("user")}
    given = spark.createDataFrame([(i, t, f"u{i}") for i, t in enumerate(TEXTS)], "id int, text string, user string")
    rows = given.select(*[
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in csv.COMMENT_SCHEMA.fields])
    csv.write_comments_csv(rows, f"{folder}/c")
    read = csv.to_message(csv.read_comments_csv(spark, f"{folder}/c"), F.lit(5)).orderBy("id").collect()
    assert [(r.id, r.text, r.user_id, r.produced_at) for r in read] == [
        (i, t, f"u{i}", 5.0) for i, t in enumerate(TEXTS)]


def test_foreign_csv_with_doubled_quotes(spark, folder):
    header = ",".join(f.name for f in csv.COMMENT_SCHEMA.fields)
    line = '7,approved,7,42,N,L,,"He said ""hi"",\nthen left",2020-01-01 10:00:00,,,5,0,False,,,1,comment,0,0,7,False,a'
    with open(os.path.join(folder, "a.csv"), "w") as out:
        out.write(f"{header}\n{line}\n")
    (row,) = csv.read_comments_csv(spark, folder).collect()
    assert row.commentBody == 'He said "hi",\nthen left' and row.recommendations == 5 and row.userID == "42"


def test_bad_comment_id_is_an_error(spark):
    frame = spark.createDataFrame([("x1", "t", "u")], "commentID string, commentBody string, userID string")
    with pytest.raises(Exception, match="bad comment id: x1"):
        csv.to_message(frame).collect()


def test_sample_head(spark):
    frame = spark.range(20)
    assert [r.id for r in csv.sample_head(frame, 3, "id").collect()] == [0, 1, 2]
    assert csv.sample_head(frame, 0, "id").count() == 20


def test_messages_round_trip(sent):
    encoded = messages.encode(sent)
    assert encoded.columns == ["key", "value"] and encoded.where("key = '1000'").count() == 3
    assert sorted(messages.decode(encoded).collect()) == sorted(sent.collect())


def test_empty_messages_are_dropped(spark):
    values = [(None,), ("{}",), ("null",), ("not json",), ('{"id": 0, "text": ""}',)]
    assert [r.id for r in messages.decode(spark.createDataFrame(values, "value string")).collect()] == [0]


def test_kafka_options():
    source = messages.kafka_source("h:1", max_per_trigger=7)
    assert source["startingOffsets"] == "earliest" and source["maxOffsetsPerTrigger"] == "7"
    assert "maxOffsetsPerTrigger" not in messages.kafka_source("h:1")
    assert messages.kafka_sink("h:1") == {"kafka.bootstrap.servers": "h:1", "topic": "documents"}


def test_lake_round_trip_and_pruning(spark, sent, folder):
    lake.write_lake(sent, folder, parts=8)
    read = lake.read_lake(spark, folder, parts=8)
    assert sorted((r.id, r.text, r.user_id) for r in read.collect()) == sorted(
        (r.id, r.text, r.user_id) for r in sent.collect())
    mine = lake.read_lake(spark, folder, "1001", parts=8)
    assert {r.user_id for r in mine.collect()} == {"1001"}
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    folders = [name for name in os.listdir(folder) if "=" in name]
    assert folders and all(name.startswith("part=") for name in folders) and len(folders) <= 8


def test_lake_opens_the_folders_of_listed_authors(spark, sent, folder):
    lake.write_lake(sent, folder, parts=8)
    stored = lake.Lake.at(spark, folder, 8)
    authors = spark.createDataFrame([("1001",), ("1001",), (None,), ("nobody",)], "user_id string").repartition(2)
    found = stored.of_authors(authors, 4)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in sent.collect() if r.user_id == "1001")


def test_lake_accounts_for_what_it_cannot_read(spark, folder):
    """A lake of one folder per author, with blank, broken and foreign lines and a file of another kind."""
    user = os.path.join(folder, "user_id=7")
    os.makedirs(user)
    with open(os.path.join(user, "1700000000_5_0.jsonl"), "w") as out:
        out.write('{"id": 5, "text": "ok", "user_id": "7"}\n\n{broken\n{"id": 8, "text": "late", "ingested_at": 9.5}\n   \n{"name": 1}\n')
        out.write('{"id": 9, "text": "a time that is none", "produced_at": "noon"}\n')
    with open(os.path.join(user, "notes.txt"), "w") as out:
        out.write('{"id": 6, "text": "foreign"}\n')
    stored = lake.Lake.at(spark, folder)
    assert stored.parts is None
    rows = sorted((r.id, r.user_id, r.ingested_at) for r in stored.documents().collect())
    assert rows == [(5, "7", 1700000000.0), (8, "7", 9.5)]
    assert [r.id for r in stored.of_author("7").orderBy("id").collect()] == [5, 8] and not stored.of_author("8").count()
    authors = spark.createDataFrame([("7",)], "user_id string")
    assert stored.of_authors(authors).count() == 2
    assert [tuple(r) for r in stored.accounts().collect()] == [("1700000000_5_0.jsonl", 2, 2, 1, 2, 1)]
    kept = sorted((r.kind, r.line) for r in stored.quarantine().collect())
    assert kept == [
        ("broken", '{"id": 9, "text": "a time that is none", "produced_at": "noon"}'), ("broken", "{broken"), ("foreign", '{"name": 1}'),
    ]


def test_batch_table_replaces_a_replayed_batch(spark, folder):
    table = tables.BatchTable(spark, f"{folder}/t", tables.SCHEMAS["doc_users"])
    assert table.read().count() == 0
    for batch, doc in ((0, 1), (1, 2), (1, 3), (2, 4)):
        table.write(spark.createDataFrame([(doc, "u")], tables.SCHEMAS["doc_users"]), batch)
    assert sorted(r.doc_id for r in table.read().collect()) == [1, 3, 4]
    assert sorted(r.doc_id for r in table.read(before=2, since=1).collect()) == [3]


def test_snapshot_versions(spark, folder):
    store = tables.SnapshotTables(spark, folder)
    first = store.write("doc_users", spark.createDataFrame([(1, "a")], "doc_id int, user_id string"), 1)
    both = first.unionByName(spark.createDataFrame([(2, "b")], tables.SCHEMAS["doc_users"]))
    store.write("doc_users", both, 2)
    assert store.read("doc_users", 1).count() == 1 and store.read("doc_users", 2).count() == 2
