"""SQL counterparts of the registered queries, for DuckDB."""

from __future__ import annotations

from query_catalog import EPOCH, LAKE_AUTHOR, LONG_TEXT_WORDS, PARAMS, SAMPLE_ROWS, STATE_NEWEST, STATE_SHARDS, STREAM_FILES

SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
MENTION = r"@[\p{L}\p{N}_]+"
URL = rf"(?:https?://|www\.)[^{SPACE}]+"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
T, P = PARAMS.threshold, PARAMS.prime


def docs(author: str = "source") -> str:
    return f"docs AS (SELECT doc_id, {author} AS user_id, text FROM documents)"


def clean() -> str:
    def drop(inner: str, pattern: str, by: str = "") -> str:
        return f"regexp_replace({inner}, '{pattern}', '{by}', 'g')"

    stripped = drop(drop(drop("lower(text)", MENTION), URL), PUNCTUATION)
    return f"""clean AS (SELECT doc_id, user_id, trim({drop(stripped, f"[{SPACE}]+", " ")}) AS clean FROM docs),
    words AS (SELECT doc_id, user_id, CASE WHEN clean = '' THEN []::VARCHAR[] ELSE string_split(clean, ' ') END AS w FROM clean)"""


def shingles(k: int = 1) -> str:
    gram = "unnest(w)" if k == 1 else (
        f"unnest(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k - 1}], ' ')))"
    )
    return f"""{clean()},
    grams AS (SELECT doc_id, user_id, {gram} AS g FROM words WHERE len(w) >= {k}),
    sh AS (SELECT DISTINCT doc_id, user_id, CAST('0x' || substr(md5(g), 1, 8) AS BIGINT) AS x FROM grams),
    sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id)"""


def signatures() -> str:
    family = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(PARAMS.hash_family()))
    return f"""{shingles()},
    fam(i, a, b) AS (VALUES {family}),
    sig AS (SELECT doc_id, user_id, i, min((CAST(a AS BIGINT) * x + b) % {P}) AS h FROM sh, fam GROUP BY ALL),
    bands AS (SELECT doc_id, user_id, CAST(i // {PARAMS.rows_per_band} AS INTEGER) AS band,
                     list(h ORDER BY i) AS key FROM sig GROUP BY ALL)"""


def candidates() -> str:
    return f"""{signatures()},
    cand AS (SELECT DISTINCT l.user_id, l.doc_id AS d1, r.doc_id AS d2 FROM bands l JOIN bands r
             ON l.user_id = r.user_id AND l.band = r.band AND l.key = r.key AND l.doc_id < r.doc_id)"""


def scored(name: str) -> str:
    return f"""{name} AS (SELECT o.user_id, d1 AS doc_id_1, d2 AS doc_id_2, shared / (a.n + b.n - shared)::DOUBLE AS similarity
             FROM {name}_overlap o JOIN sizes a ON a.doc_id = d1 JOIN sizes b ON b.doc_id = d2
             WHERE shared / (a.n + b.n - shared)::DOUBLE >= {T})"""


def lsh_pairs() -> str:
    return f"""{candidates()},
    pairs_overlap AS (SELECT c.user_id, d1, d2, count(*) AS shared FROM cand c JOIN sh a ON a.doc_id = d1
                      JOIN sh b ON b.doc_id = d2 AND a.x = b.x GROUP BY ALL),
    {scored("pairs")}"""


def exact_pairs(shingled: bool = True) -> str:
    start = f"{shingles()},\n" if shingled else ""
    return f"""{start}exact_overlap AS (SELECT a.user_id, a.doc_id AS d1, b.doc_id AS d2, count(*) AS shared FROM sh a
                      JOIN sh b ON a.user_id = b.user_id AND a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
    {scored("exact")}"""


RATE = "{pairs} / nullif({total} * ({total} - 1) / 2, 0)::DOUBLE"


def rate(pairs: str, total: str) -> str:
    return RATE.format(pairs=pairs, total=total)


def spammer_report(pairs: str) -> str:
    value = rate("p.similar_pairs", "t.total_comments")
    return f"""SELECT user_id, total_comments, similar_pairs, {value} AS similarity_rate,
           round({value} * 100, 2) AS rate_percent
    FROM (SELECT user_id, count(*) AS total_comments FROM docs GROUP BY user_id) t
    JOIN (SELECT user_id, count(*) AS similar_pairs FROM {pairs} GROUP BY user_id) p USING (user_id)
    WHERE total_comments >= 10 ORDER BY similarity_rate DESC, user_id LIMIT 100"""


STATS = f"""stats AS (SELECT t.user_id, t.total_comments, coalesce(p.n, 0) AS similar_pairs,
           {rate("coalesce(p.n, 0)", "t.total_comments")} AS similarity_rate
    FROM (SELECT user_id, count(*) AS total_comments FROM docs GROUP BY user_id) t
    LEFT JOIN (SELECT user_id, count(*) AS n FROM pairs GROUP BY user_id) p USING (user_id))"""

BY_SOURCE = "du AS (SELECT doc_id, source AS user_id FROM documents)"
BY_LANG = "du AS (SELECT doc_id, lang AS user_id FROM documents)"
LABELLED = "lab AS (SELECT * FROM du WHERE doc_id IN (SELECT doc_id FROM labels))"

SEEN = "seen AS (SELECT event_type AS worker, ts, value AS latency_ms FROM events)"


def intervals(name: str, seconds: int) -> str:
    return f"""{name} AS (SELECT *, CAST(sum(interval_processed) OVER (PARTITION BY worker ORDER BY timestamp) AS BIGINT) AS processed_count
    FROM (SELECT worker, CAST(floor(epoch(ts) / {seconds}) * {seconds} + {seconds} AS BIGINT) AS timestamp,
                 count(*) / {seconds}.0::DOUBLE AS throughput, count(*) AS interval_processed,
                 avg(latency_ms) AS avg_latency_ms, min(latency_ms) AS min_latency_ms, max(latency_ms) AS max_latency_ms,
                 sum(latency_ms) AS total_latency_ms, count(latency_ms) AS latency_count
          FROM seen GROUP BY ALL))"""


SNAPSHOT = f"""{SEEN}, {intervals("fine", 10)}, {intervals("hourly", 3600)},
    snap AS (SELECT * FROM (SELECT * FROM fine UNION ALL SELECT * FROM hourly)
             QUALIFY row_number() OVER (PARTITION BY worker ORDER BY timestamp DESC, throughput DESC) = 1)"""

TURNS = "turns AS (SELECT conv_id, turn, role, text, (turn << 32) + conv_id AS pos FROM conversations)"
RUNS = f"""{TURNS},
    runs AS (SELECT *, CAST(sum(switched) OVER (ORDER BY pos) AS BIGINT) AS run_id
             FROM (SELECT *, CASE WHEN lag(role) OVER (ORDER BY pos) IS NOT DISTINCT FROM role THEN 0 ELSE 1 END AS switched FROM turns))"""

PAIR_COLUMNS = "user_id, doc_id_1, doc_id_2, similarity"


def query(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


ORACLES = {
    "clean_text": query(docs(), clean(), select="SELECT doc_id, clean FROM clean"),
    "word_tokens": query(
        docs(), clean(),
        select="SELECT doc_id, word, count(*) AS occurrences FROM (SELECT doc_id, unnest(w) AS word FROM words) GROUP BY ALL",
    ),
    "shingles_k1": query(docs(), shingles(1), select="SELECT doc_id, x AS shingle FROM sh"),
    "shingles_k4": query(docs(), shingles(4), select="SELECT doc_id, x AS shingle FROM sh"),
    "short_docs": query(
        docs(), clean(),
        select=f"""SELECT user_id, count(*) AS total_comments, count(*) FILTER (len(w) >= {LONG_TEXT_WORDS}) AS processed
                   FROM words GROUP BY user_id""",
    ),
    "minhash_signature": query(docs(), signatures(), select="SELECT doc_id, CAST(i AS INTEGER) AS i, h FROM sig"),
    "lsh_bands": query(
        docs(), signatures(),
        "whole AS (SELECT doc_id, user_id, list_sort(list(x)) AS s FROM sh GROUP BY ALL)",
        "reps AS (SELECT min(doc_id) AS rep_id FROM whole GROUP BY user_id, s)",
        select="""SELECT rep_id, band, array_to_string(key, '-') AS band_values
                  FROM bands JOIN reps ON doc_id = rep_id""",
    ),
    "bucket_sizes": query(
        docs(), signatures(),
        select="""SELECT user_id, band, n_docs, count(*) AS n_buckets
                  FROM (SELECT user_id, band, key, count(*) AS n_docs FROM bands GROUP BY ALL) GROUP BY ALL""",
    ),
    "lsh_candidates": query(docs(), candidates(), select="SELECT user_id, d1 AS doc_id_1, d2 AS doc_id_2 FROM cand"),
    "similar_pairs": query(docs(), lsh_pairs(), select=f"SELECT {PAIR_COLUMNS} FROM pairs"),
    "exact_pairs": query(docs(), exact_pairs(), select=f"SELECT {PAIR_COLUMNS} FROM exact"),
    "lsh_recall": query(
        docs(), lsh_pairs(), exact_pairs(shingled=False),
        select="""SELECT CAST(floor(e.similarity * 10) AS BIGINT) AS tenth, count(*) AS exact_pairs, count(p.doc_id_1) AS lsh_pairs
                  FROM exact e LEFT JOIN pairs p USING (user_id, doc_id_1, doc_id_2) GROUP BY ALL""",
    ),
    "spammers": query(docs(), exact_pairs(), select=spammer_report("exact")),
    "spammers_redelivered": query(docs(), exact_pairs(), select=spammer_report("exact")),
    "spammers_lsh": query(docs(), lsh_pairs(), select=spammer_report("pairs")),
    "spammers_from_tables": query(
        docs("lang"), lsh_pairs(), BY_SOURCE,
        "own AS (SELECT a.user_id FROM pairs p JOIN du a ON a.doc_id = doc_id_1 JOIN du b ON b.doc_id = doc_id_2 WHERE a.user_id = b.user_id)",
        select=spammer_report("own").replace("FROM docs", "FROM du"),
    ),
    "user_stats": query(docs(), lsh_pairs(), STATS, select="SELECT * FROM stats"),
    "top_users": query(
        docs(), lsh_pairs(), STATS,
        select="SELECT * FROM stats WHERE total_comments > 10 ORDER BY total_comments DESC, user_id LIMIT 10",
    ),
    "user_pair_counts": query(
        docs("lang"), lsh_pairs(), BY_LANG, LABELLED,
        select="""SELECT a.user_id, count(*) AS similar_pairs FROM pairs JOIN lab a ON a.doc_id = doc_id_1
                  JOIN lab b ON b.doc_id = doc_id_2 WHERE a.user_id = b.user_id GROUP BY ALL""",
    ),
    "pairs_with_authors": query(
        docs("lang"), lsh_pairs(), BY_SOURCE,
        select="""SELECT doc_id_1, doc_id_2, similarity, a.user_id AS user_id_1, b.user_id AS user_id_2,
                         a.user_id = b.user_id AS same_author
                  FROM pairs JOIN du a ON a.doc_id = doc_id_1 JOIN du b ON b.doc_id = doc_id_2""",
    ),
    "pairs_with_text": query(
        docs("lang"), lsh_pairs(),
        select="""SELECT doc_id_1, doc_id_2, similarity, a.source AS user_id_1, b.source AS user_id_2,
                         a.source = b.source AS same_author, round(similarity * 100, 1) AS percent,
                         a.text AS text_1, b.text AS text_2
                  FROM pairs JOIN documents a ON a.doc_id = doc_id_1 JOIN documents b ON b.doc_id = doc_id_2
                  ORDER BY similarity DESC, doc_id_1, doc_id_2 LIMIT 50""",
    ),
    "author_similar_docs": query(
        docs(), lsh_pairs(),
        select="""SELECT doc_id, user_id FROM docs
                  WHERE doc_id IN (SELECT doc_id_1 FROM pairs UNION ALL SELECT doc_id_2 FROM pairs)""",
    ),
    "author_other_docs": query(
        docs(), lsh_pairs(),
        select="""SELECT doc_id, user_id FROM docs
                  WHERE doc_id NOT IN (SELECT doc_id_1 FROM pairs UNION ALL SELECT doc_id_2 FROM pairs)""",
    ),
    "doc_author_lookup": """SELECT event_id AS doc_id, source AS user_id FROM events
                            LEFT JOIN documents ON event_id = doc_id""",
    "doc_users_first_wins": """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN source ELSE lang END AS user_id
                               FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "similarities_insert_ignore": f"""WITH
        stored AS ({query(docs(), lsh_pairs(), select="SELECT doc_id_1, doc_id_2, similarity FROM pairs")}),
        wider AS ({query(docs("lang"), lsh_pairs(), select="SELECT doc_id_1, doc_id_2, similarity FROM pairs")})
        SELECT * FROM stored UNION ALL SELECT * FROM wider ANTI JOIN stored USING (doc_id_1, doc_id_2)""",
    "counter_upsert": query(
        docs(), lsh_pairs(), BY_SOURCE, LABELLED,
        f"""totals AS (SELECT user_id, count(*) AS total_comments
                       FROM (SELECT user_id FROM du UNION ALL SELECT user_id FROM lab) GROUP BY ALL)""",
        select=f"""SELECT user_id, total_comments, coalesce(n, 0) AS similar_pairs,
                   CASE WHEN n IS NULL THEN 0.0::DOUBLE ELSE {rate("n", "total_comments")} END AS similarity_rate
                   FROM totals LEFT JOIN (SELECT user_id, count(*) AS n FROM pairs GROUP BY ALL) USING (user_id)""",
    ),
    "stats_sync": query(
        docs("lang"), lsh_pairs(), BY_SOURCE,
        select=f"""SELECT user_id, count(*) AS total_comments, 0::BIGINT AS similar_pairs, 0.0::DOUBLE AS similarity_rate
                   FROM du GROUP BY ALL
                   UNION ALL
                   SELECT user_id, total_comments, coalesce(n, 0),
                          CASE WHEN n IS NULL THEN 0.0::DOUBLE ELSE {rate("n", "total_comments")} END
                   FROM (SELECT user_id, count(*) AS total_comments FROM docs GROUP BY ALL)
                   LEFT JOIN (SELECT user_id, count(*) AS n FROM pairs GROUP BY ALL) USING (user_id)""",
    ),
    "integrity": query(
        docs("lang"), lsh_pairs(), BY_SOURCE, LABELLED,
        "users AS (SELECT * FROM du UNION ALL SELECT * FROM lab UNION ALL SELECT doc_id, NULL FROM lab WHERE doc_id % 5 = 0)",
        """sims AS (SELECT doc_id_1, doc_id_2, similarity FROM pairs UNION ALL SELECT doc_id_2, doc_id_1, similarity FROM pairs
             UNION ALL SELECT doc_id_1, doc_id_2, similarity FROM pairs WHERE doc_id_1 % 3 = 0
             UNION ALL SELECT doc_id_1, doc_id_2, NULL FROM pairs WHERE doc_id_1 % 4 = 0)""",
        "totals AS (SELECT user_id FROM users GROUP BY user_id)",
        "st AS (SELECT user_id FROM totals UNION ALL SELECT user_id FROM totals WHERE user_id < 'src2')",
        select="""SELECT 'doc_users_duplicate_key' AS rule, (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM users GROUP BY doc_id)) AS violations
                  UNION ALL SELECT 'doc_users_null', (SELECT count(*) FROM users WHERE doc_id IS NULL OR user_id IS NULL)
                  UNION ALL SELECT 'similarities_duplicate_key', (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM sims GROUP BY doc_id_1, doc_id_2))
                  UNION ALL SELECT 'similarities_null', (SELECT count(*) FROM sims WHERE similarity IS NULL)
                  UNION ALL SELECT 'similarities_order', (SELECT count(*) FROM sims WHERE doc_id_1 >= doc_id_2)
                  UNION ALL SELECT 'similarities_range', (SELECT count(*) FROM sims WHERE NOT similarity BETWEEN 0.5 AND 1)
                  UNION ALL SELECT 'user_stats_duplicate_key', (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM st GROUP BY user_id))
                  UNION ALL SELECT 'user_stats_null', (SELECT count(*) FROM st WHERE user_id IS NULL)""",
    ),
    "table_cycle": query(
        docs(), lsh_pairs(), STATS, select="SELECT user_id, total_comments, similar_pairs, similarity_rate FROM stats"
    ),
    "worker_window_stats": query(
        SEEN, intervals("fine", 10),
        select="""SELECT worker, timestamp, throughput, interval_processed, round(avg_latency_ms, 6) AS avg_latency_ms,
                         min_latency_ms, max_latency_ms, round(total_latency_ms, 6) AS total_latency_ms, latency_count,
                         processed_count FROM fine""",
    ),
    "worker_snapshot": query(
        SNAPSHOT,
        select="""SELECT worker, round(throughput, 6) AS throughput, processed_count, timestamp,
                         round(avg_latency_ms, 6) AS avg_latency_ms, min_latency_ms, max_latency_ms FROM snap""",
    ),
    "system_latency": query(
        SEEN,
        select="""SELECT round(sum(latency_ms) / count(latency_ms), 2) AS avg_latency_ms, min(latency_ms) AS min_latency_ms,
                         max(latency_ms) AS max_latency_ms, round(sum(latency_ms), 6) AS total_latency_ms,
                         count(latency_ms) AS latency_count FROM seen""",
    ),
    "latency_merge": query(
        SEEN,
        select="""SELECT round(sum(latency_ms), 6) AS total_latency_ms, count(latency_ms) AS latency_count,
                         min(latency_ms) AS min_latency_ms, max(latency_ms) AS max_latency_ms FROM seen""",
    ),
    "dashboard_metrics": query(
        docs(), lsh_pairs(), SNAPSHOT,
        select="""SELECT (SELECT count(*) FROM pairs) AS total_similarities, (SELECT count(*) FROM docs) AS total_comments,
                         (SELECT count(*) FROM words WHERE len(w) >= 1) AS total_processed,
                         (SELECT round(sum(throughput), 6) FROM snap) AS total_throughput""",
    ),
    "message_latency": "SELECT event_id, round(value, 2) AS latency_ms FROM events",
    "author_runs": query(RUNS, select="SELECT conv_id, turn, run_id FROM runs"),
    "run_scoped_pairs": query(
        RUNS, "docs AS (SELECT pos AS doc_id, '0/' || run_id AS user_id, text FROM runs)", exact_pairs(),
        select="SELECT user_id AS run, doc_id_1, doc_id_2, similarity FROM exact",
    ),
    "csv_round_trip": f"SELECT doc_id AS id, text, source AS user_id, {EPOCH}::DOUBLE AS produced_at FROM documents",
    "json_message_round_trip":
        f"SELECT doc_id AS id, text, source AS user_id, (doc_id + {EPOCH})::DOUBLE AS produced_at FROM documents",
    "lake_round_trip":
        f"SELECT doc_id AS id, text, (doc_id + {EPOCH})::DOUBLE AS produced_at, source AS user_id FROM documents",
    "lake_author_comments": query(
        docs(), lsh_pairs(),
        select=f"""SELECT doc_id, text, doc_id IN (SELECT doc_id_1 FROM pairs UNION ALL SELECT doc_id_2 FROM pairs) AS similar
                   FROM docs WHERE user_id = '{LAKE_AUTHOR}'""",
    ),
    "lake_dirty_lines": f"""SELECT 'document' AS kind, count(*) AS n FROM documents
        UNION ALL SELECT 'read', count(*) FROM documents
        UNION ALL SELECT 'broken', count(*) FROM documents WHERE doc_id % 11 = 0
        UNION ALL SELECT 'foreign', count(*) FROM documents WHERE doc_id % 13 = 0
        UNION ALL SELECT 'blank', count(*) FROM documents WHERE doc_id % 7 = 0
        UNION ALL SELECT 'from_name', count(*) FROM documents WHERE doc_id % 2 = 1
        UNION ALL SELECT 'sum_of_arrivals', CAST(count(*) * {EPOCH} AS BIGINT) FROM documents
        UNION ALL SELECT 'quarantined', (SELECT count(*) FROM documents WHERE doc_id % 11 = 0) + (SELECT count(*) FROM documents WHERE doc_id % 13 = 0)""",
    "sample_head": f"SELECT doc_id, source AS user_id, text FROM documents ORDER BY doc_id LIMIT {SAMPLE_ROWS}",
    "stream_pairs": query(docs(), lsh_pairs(), select=f"SELECT {PAIR_COLUMNS} FROM pairs"),
    "stream_bounded_state": query(
        docs(), lsh_pairs(), select=f"SELECT {PAIR_COLUMNS} FROM pairs WHERE abs(doc_id_1 - doc_id_2) <= 300"
    ),
    "stream_replay": query(docs(), lsh_pairs(), select=f"SELECT {PAIR_COLUMNS} FROM pairs"),
    "stream_joined_pairs": query(docs(), lsh_pairs(), select=f"SELECT {PAIR_COLUMNS} FROM pairs"),
    "stream_keyed_state": query(
        docs(), exact_pairs(),
        "placed AS (SELECT DISTINCT user_id, doc_id FROM sh)",
        select=f"""SELECT {PAIR_COLUMNS} FROM exact e WHERE (
                     SELECT count(*) FROM placed z WHERE z.user_id = e.user_id AND z.doc_id % {STATE_SHARDS} = e.doc_id_1 % {STATE_SHARDS}
                       AND z.doc_id > e.doc_id_1 AND z.doc_id < e.doc_id_2) < {STATE_NEWEST}""",
    ),
    "stream_progress": f"SELECT {STREAM_FILES}::BIGINT AS batches, count(*) AS messages, count(text) AS with_text FROM documents",
    "stream_user_counts": "SELECT source AS user_id, count(*) AS total_comments FROM documents GROUP BY ALL",
    "stream_worker_windows": query(
        SEEN, intervals("fine", 10),
        select="""SELECT worker, timestamp - 10 AS interval_start, throughput, interval_processed,
                         round(avg_latency_ms, 6) AS avg_latency_ms, min_latency_ms, max_latency_ms,
                         round(total_latency_ms, 6) AS total_latency_ms, latency_count
                  FROM fine""",
    ),
}
ORACLES["lake_pairs_with_text"] = ORACLES["pairs_with_text"]
