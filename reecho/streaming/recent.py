"""Pair detection against an author's newest documents, with keyed state that is bounded by count and by time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from reecho.functions import text as tx
from reecho.operators.documents import computed_once
from reecho.params import MatchParams
from reecho.schemas import BIGINT, BIGINTS, DOUBLE, STRING, record

# The state needs a store that can hold several variables a key; a session sets it before the query starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
# State that grows with the stream lies on disk; what all stores of an executor keep in memory is bounded.
BOUNDED_STORE = STATE_STORE | {
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}
PAIRS = record(user_id=STRING, doc_id_1=BIGINT, doc_id_2=BIGINT, similarity=DOUBLE)


class NewestDocuments(StatefulProcessor):
    """State of one (author, shard): its newest documents with their shingles.

    A document is compared with what the shard holds, and stays if the shard is its own. What is beyond ``newest`` goes with the
    document that displaces it; what is older than ``retention`` seconds against the watermark goes by a timer.
    """

    def __init__(self, threshold: float, newest: int, retention: float):
        self.threshold, self.newest, self.retention = threshold, newest, retention

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.documents = handle.getMapState("documents", record(doc_id=BIGINT), record(produced_at=DOUBLE, shingles=BIGINTS))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        stored = {k[0]: (v[0], frozenset(v[1])) for k, v in self.documents.iterator()}
        before = dict(stored)
        arrived = pd.concat(list(rows)).sort_values(["produced_at", "id"], kind="stable")
        found = []
        for row in arrived.itertuples():
            own = frozenset((np.asarray(row.shingles, np.int64) + (1 << 31)).tolist())
            for other, (time, shingles) in stored.items():
                shared = len(own & shingles)
                similarity = shared / (len(own) + len(shingles) - shared)
                if other != row.id and similarity >= self.threshold and abs(time - row.produced_at) <= self.retention:
                    found.append((key[0], min(other, row.id), max(other, row.id), similarity))
            if row.stays:
                stored[row.id] = (row.produced_at, own)
                if len(stored) > self.newest:
                    stored.pop(min(stored, key=lambda doc: (stored[doc][0], doc)))
        for doc in before.keys() - stored.keys():
            self.documents.removeKey((doc,))
        for doc in stored.keys() - before.keys():
            self.documents.updateValue((doc,), (stored[doc][0], sorted(stored[doc][1])))
        self._wait_for(stored)
        yield pd.DataFrame(found, columns=PAIRS.fieldNames())

    def _wait_for(self, stored: dict) -> None:
        """One timer, for the document that is the first to grow too old."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if stored:
            self.handle.registerTimer(int((min(time for time, _ in stored.values()) + self.retention) * 1000))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() / 1000
        left = {}
        for (doc,), (time, shingles) in list(self.documents.iterator()):
            if time + self.retention <= now:
                self.documents.removeKey((doc,))
            else:
                left[doc] = (time, shingles)
        if left:
            self.handle.registerTimer(int((min(time for time, _ in left.values()) + self.retention) * 1000))
        yield pd.DataFrame([], columns=PAIRS.fieldNames())

    def close(self) -> None:
        pass


def newest_pairs(
    messages: DataFrame,
    params: MatchParams = MatchParams(),
    newest: int = 1000,
    shards: int = 4,
    retention: float = 86_400.0,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Stream of ``(user_id, doc_id_1, doc_id_2, similarity)``: each document against the newest ones of its author before it.

    An author's documents are dealt by id into ``shards``, and each shard keeps its ``newest``, at most ``retention`` seconds of event time
    long. A document meets all shards, so a busy author's comparisons and state lie in several tasks. State
    does not grow with the stream, only with its authors. Documents of one batch are taken in order of their times, then ids.

    ``messages`` needs ``(id, text, user_id, produced_at, event_time)``; documents without words take no part. Needs ``STATE_STORE``.
    """
    shingled = computed_once(
        messages.withWatermark("event_time", lateness), "shingles", tx.process_text(F.col("text"), params.shingle_size)
    ).where(F.size("shingles") > 0)
    own = F.pmod(F.col("id"), F.lit(shards))
    # each shard gets a copy; ids have 32 bits, as signed ones they take half the room
    shingled = shingled.withColumn("shingles", F.transform("shingles", lambda x: (x - F.lit(1 << 31)).cast("int")))
    dealt = shingled.select(
        "user_id", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "id", "produced_at", "shingles", "event_time"
    ).withColumn("stays", own == F.col("shard"))
    processor = NewestDocuments(params.threshold, newest, retention)
    schema = T.StructType(PAIRS.fields)
    return dealt.groupBy("user_id", "shard").transformWithStateInPandas(processor, schema, "Append", "EventTime")
