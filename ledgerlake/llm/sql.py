"""DuckDB SQL for the rows of the queries that SQL can express on whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9 = rf"""
WITH d AS (SELECT doc_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
b AS (SELECT item_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM benchmark),
i AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, unnest(list_transform(
    range(1, greatest(2, len(ws) - 8)), lambda i: ws[i:i + 9])) AS win FROM b WHERE len(ws) > 0),
k AS (SELECT DISTINCT n FROM i),
pl AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS p, ws FROM d, k WHERE len(ws) >= n),
o AS (SELECT doc_id, p, q.n, item_id FROM (SELECT doc_id, p, n, ws[p:p + n - 1] AS win FROM pl) q
  JOIN i ON q.win = i.win AND q.n = i.n),
h AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS w FROM o)
  GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM o GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, {_WORDS.format('t')} AS ws FROM d),
p AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
three AS (SELECT doc_id, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c
  FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM three WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) >= 2),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
again AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, source, len(ws) AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    coalesce(again.n, 0) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words
  FROM w LEFT JOIN again USING (doc_id) LEFT JOIN hit USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    100 * n_symbols > 10 * n_words OR n_dup_lines > 10 OR word_chars < 2 * n_words
      OR word_chars > 15 * n_words AS more_failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed OR more_failed)::DOUBLE AS f
  FROM f GROUP BY source),
s AS (SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS sq, count(*) / sum(n) AS hn FROM h),
b AS (SELECT mean, sq - mean * mean - mean * (1 - mean) * hn AS between_hosts FROM s),
k AS (SELECT mean, CASE WHEN between_hosts > 0
    THEN least(10000, greatest(2, mean * (1 - mean) / between_hosts - 1)) ELSE 10000 END AS weight FROM b),
v AS (SELECT source, (f + mean * weight) / (n + weight) AS rate FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed OR rate >= 0.8 THEN false WHEN rate > 0.02 THEN NOT more_failed
    ELSE true END AS kept,
  CASE WHEN rate >= 0.8 THEN 'rejected' WHEN rate > 0.02 THEN 'suspect' ELSE 'trusted' END
    AS host_verdict
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr({0}, (i // 4) * 5 + 1, 5))::BIGINT
      >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '')"""

OP3 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS sha FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS newest FROM h)
SELECT page_id, payload_bytes, {_BASE32.format("sha")} AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM m
"""

OP4 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT doc_id, x, length(x) // 2 AS n FROM d),
w AS (SELECT doc_id, p, substr(x, 2 * p + 1, 200) AS s FROM (
  SELECT doc_id, x, unnest(range(0, n - 99)) AS p FROM b WHERE n >= 100)),
g AS (SELECT doc_id, p, row_number() OVER (PARTITION BY md5(s) ORDER BY doc_id, p) AS k FROM w),
hit AS (SELECT doc_id, p, coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000) AS q
  FROM g WHERE k > 1),
runs AS (SELECT doc_id, p, sum((p > q + 100)::INT) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM hit),
span AS (SELECT doc_id, r, min(p) AS a, max(p) + 100 AS z FROM runs GROUP BY ALL),
gaps AS (SELECT b.doc_id, x, n, a, z, coalesce(lag(z) OVER o, 0) AS before, row_number() OVER o AS k,
    count(*) OVER (PARTITION BY b.doc_id) AS spans, sum(z - a) OVER (PARTITION BY b.doc_id) AS removed
  FROM b JOIN span USING (doc_id) WINDOW o AS (PARTITION BY b.doc_id ORDER BY a)),
cut AS (SELECT doc_id, max(spans) AS spans, max(removed) AS removed,
    string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
      || max(CASE WHEN k = spans THEN substr(x, 2 * z + 1) ELSE '' END) AS kept
  FROM gaps GROUP BY doc_id)
SELECT b.doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM b LEFT JOIN cut USING (doc_id)
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
z AS (SELECT doc_id, source, md5(t) AS h, len({_WORDS.format('t')}) AS size,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS symbols,
    (('0x' || substr(md5('1|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(t)), 1, 12))::BIGINT + 0.5)
      / 281474976710656.0 AS u FROM d),
x AS (SELECT *, -ln(u) / CASE WHEN size > 0 THEN size::DOUBLE / (size + symbols) ELSE 1.0 END AS key
  FROM z),
s AS (SELECT source, sum(size)::BIGINT AS total FROM x GROUP BY source),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
r AS (SELECT *, total * 2.0::DOUBLE AS cap, total * 2.0::DOUBLE / weight AS ratio FROM w),
l AS (SELECT *, ((SELECT sum(total) FROM s) * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0.0)) / sum(weight) OVER (ORDER BY ratio, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, total, CASE WHEN level >= ratio THEN cap
    ELSE max(CASE WHEN level < ratio THEN level END) OVER () * weight END AS target FROM l),
e AS (SELECT x.*, total, target, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END
    AS epochs, coalesce(sum(size) OVER (PARTITION BY x.source ORDER BY key, doc_id, h
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM x JOIN t ON x.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, total AS source_size, target,
  (epochs * size + least(greatest(floor(target)::BIGINT - epochs * total - before, 0), size))::BIGINT
    AS taken
FROM e
"""


OP2 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM s a JOIN s b
  ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * both_have >= 75 * (x.n + y.n - both_have)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id,
  d.doc_id = min(reach.b) AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""

_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12 = rf"""
WITH d AS (SELECT doc_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
f AS (SELECT * FROM d WHERE len(ws) > 0),
g AS (SELECT count(*)::BIGINT AS docs, sum(len(ws))::BIGINT AS words FROM f),
t AS (SELECT doc_id, n, w, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, len(ws)::BIGINT AS n, unnest(ws) AS w FROM f) GROUP BY doc_id, n, w),
k AS (SELECT w, floor(1000 * ln((2::DOUBLE * any_value(docs) + 2) / (2::DOUBLE * count(*) + 1)))::BIGINT AS worth
  FROM t, g GROUP BY w),
q AS (SELECT item_id, w, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest({_TERMS.format(_LOWER.format("coalesce(text, '')"))}) AS w FROM benchmark)
  GROUP BY item_id, w),
s AS (SELECT item_id, doc_id, sum(times * worth * ((1000000000 * tf) //
    (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN k USING (w) JOIN t USING (w), g GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

# one step of the common CRC-32 per bit; 3988292384 is its reversed polynomial
_CRC32 = """xor(list_reduce(list_transform(string_split({0}, ''), lambda d: ascii(d)::BIGINT),
  lambda a, d: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(a, d)),
  4294967295::BIGINT), 4294967295)"""

OP13 = f"""
WITH t AS (SELECT conv_id, coalesce(text, '') AS said, coalesce(role, '') AS who, turn,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'d': digest, 'n': strlen(said)}} ORDER BY turn NULLS FIRST, who, digest) AS own
  FROM t GROUP BY conv_id),
h AS (SELECT conv_id, own, conv_id - conv_id % 5 AS base,
    ({_CRC32.format("conv_id::VARCHAR")} % 9)::INT AS h FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS path
  FROM h LEFT JOIN o b ON b.conv_id = h.base),
m AS (SELECT conv_id, len(path)::BIGINT AS len, depth, path[1:depth] AS node, path[1:depth - 1] AS above
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS depth FROM r)),
n AS (SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CASE WHEN len = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends,
    CASE WHEN depth > 0 THEN (count(*) - 1) * any_value(node[depth].n) ELSE 0 END AS saved
  FROM m GROUP BY node, depth),
c AS (SELECT above AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above, depth),
k AS (SELECT n.*, p.conv_id AS parent_conv_id, coalesce(n_children, 0) AS n_children
  FROM n LEFT JOIN c USING (node, depth) LEFT JOIN n p ON n.depth = p.depth + 1 AND n.above = p.node),
s AS (SELECT node[1:d] AS node, d AS depth, sum(saved)::BIGINT AS saved_tokens,
    count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT node, saved, n_children, unnest(range(0, depth + 1)) AS d FROM k) GROUP BY node[1:d], d)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM k JOIN s USING (node, depth)
"""

ORACLE: dict[str, str] = {
    "op2_near_duplicates": OP2, "op3_warc": OP3, "op4_repeated_passages": OP4,
    "op7_source_mixing": OP7,
    "op9_decontamination": OP9, "op10_host_quality": OP10, "op12_lexical_search": OP12,
    "op13_conversation_trie": OP13}
