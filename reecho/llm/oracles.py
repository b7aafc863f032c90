"""DuckDB counterparts of the registered queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ITEM_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, p, p + least(len(w), 13) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(g) AS l FROM win),
spots AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, lengths WHERE len(w) >= l),
hit AS (SELECT doc_id, p, l, g FROM (SELECT doc_id, p, l, list_slice(w, p, p + l - 1) AS g FROM spots) SEMI JOIN win USING (g)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM hit) GROUP BY doc_id),
m AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
  FROM hit JOIN win USING (g) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""


def near_duplicates(k: int) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, p, p + least(len(w), {k}) - 1) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), {k}) + 2)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
low AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.component_id, d.doc_id) AS component_id,
  coalesce(low.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.doc_id = d.doc_id
"""


LINE_DEDUP = """
WITH RECURSIVE cut AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, n, lines[n] AS line, trim(regexp_replace(lines[n], '[ \\t\\n\\v\\f\\r]+', ' ', 'g'), ' ') AS plain
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS n FROM cut)),
u AS (
  SELECT row_number() OVER () AS id, plain, f FROM (
    SELECT plain, min(struct_pack(d := doc_id, n := n)) AS f FROM l WHERE plain <> '' GROUP BY plain)),
s AS (
  SELECT DISTINCT id, plain[k:k + 6] AS g
  FROM (SELECT id, plain, unnest(range(1, greatest(length(plain) - 6, 1) + 1)) AS k FROM u)),
c AS (SELECT id, count(*) AS n FROM s GROUP BY id),
ordered AS (
  SELECT id, g, n, row_number() OVER (PARTITION BY id ORDER BY spread, g) AS place
  FROM s JOIN c USING (id) JOIN (SELECT g, count(*) AS spread FROM s GROUP BY g) USING (g)),
prefix AS (SELECT * FROM ordered WHERE place <= n - (n * 80 + 99) // 100 + 1),
near AS (
  SELECT DISTINCT x.id AS a, y.id AS b FROM prefix x JOIN prefix y ON x.g = y.g AND x.id < y.id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
shared AS (SELECT a, b, count(*) AS n FROM near JOIN s x ON x.id = a JOIN s y ON y.id = b AND y.g = x.g GROUP BY ALL),
half AS (SELECT a, b FROM shared JOIN c i ON i.id = a JOIN c j ON j.id = b WHERE 100 * shared.n >= 80 * (i.n + j.n - shared.n)),
link AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(a, b) AS (SELECT id, id FROM u UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
kept AS (SELECT x.plain, min(y.f) AS f FROM reach JOIN u x ON x.id = a JOIN u y ON y.id = b GROUP BY ALL),
stay AS (SELECT l.doc_id, l.n, l.line, kept.f IS NULL OR (kept.f.d = l.doc_id AND kept.f.n = l.n) AS stays FROM l LEFT JOIN kept USING (plain))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (stays), '')) AS text_sha256
FROM stay GROUP BY doc_id
"""


DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
whole AS (SELECT lang, term, sum(c) AS c FROM c GROUP BY ALL),
nl AS (SELECT lang, sum(n) AS n FROM n GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    CAST(1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 5) // (coalesce(n.n, 0) + 5 * v.v) AS BIGINT) AS p,
    CAST(1 + 1000000000::HUGEINT * (whole.c + 5) // (nl.n + 5 * v.v) AS BIGINT) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN whole USING (lang, term) JOIN nl USING (lang)
  LEFT JOIN c USING (lang, source, term) LEFT JOIN n USING (lang, source)),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y USING (lang, term) GROUP BY ALL),
pair AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


# crc32 of an id's digits: eight steps of the reflected polynomial for each byte.
_STEP = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
_BYTE = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: " + _STEP + ")"
_CRC = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: ascii(s))), lambda c, b: {_BYTE}), 4294967295)"

PERIODIC_RUNS = f"""
WITH d AS (
  SELECT doc_id, {_CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS again, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN again THEN g % n END AS a FROM e),
b AS (SELECT *, CASE WHEN again THEN 1 + (n - a) // (3 + g % 8) END AS p FROM a),
t AS (
  SELECT doc_id, n, i, w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM b)),
m AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
  WHERE 3 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m) GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(24, 3 * q) GROUP BY ALL),
digest AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM r GROUP BY doc_id),
best AS (
  SELECT * FROM r x WHERE NOT EXISTS (
    SELECT 1 FROM r y WHERE y.doc_id = x.doc_id AND (y.length * x.period > x.length * y.period OR (
      y.length * x.period = x.length * y.period AND (y.start < x.start OR (y.start = x.start AND y.period < x.period)))))),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.period, CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM d LEFT JOIN digest USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


ORACLES: dict[str, str] = {
    "op4_contamination": CONTAMINATION,
    "op6_line_dedup": LINE_DEDUP,
    "op9_near_duplicates": near_duplicates(4),
    "op12_divergence": DIVERGENCE,
    "op13_periodic_runs": PERIODIC_RUNS,
}
