"""DuckDB twins of the training-data queries that SQL can express."""

from __future__ import annotations

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha256(body) AS h FROM p),
f AS (SELECT h, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY h)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
  CASE WHEN f.first_id IS NULL OR f.first_id IS NOT DISTINCT FROM d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first_id IS NULL OR f.first_id IS NOT DISTINCT FROM d.page_id THEN NULL ELSE f.first_id END AS refers_to
FROM d LEFT JOIN f ON d.h = f.h AND d.n >= 100
"""

OP5 = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS body, replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;') AS who FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, who, body)) AS turns_sha256,
  CAST(length(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, who, body) FILTER (WHERE role = 'assistant'), '')) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, who, body) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(who) + 1 + length(body) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP8 = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight, 3 * source_size AS most FROM s),
o AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS BIGINT) AS room, CAST(sum(weight) OVER after AS BIGINT) AS free
  FROM w WINDOW before AS (ORDER BY most / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY most / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
z AS (SELECT *, room * weight >= most * free AS stops FROM o),
l AS (SELECT room, free FROM z WHERE NOT stops ORDER BY most / weight, source IS NULL, source LIMIT 1),
t AS (SELECT z.source, z.source_size, CASE WHEN stops THEN CAST(most AS DOUBLE) ELSE weight * l.room / l.free END AS target FROM z LEFT JOIN l ON true),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
g AS (SELECT d.*, r.source_size, r.target, CAST(floor(rate) AS BIGINT) AS times, rate - floor(rate) AS odds FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
x AS (SELECT g.source, k.seed, abs(sum(size * (times + CASE WHEN CAST('0x' || substr(md5(k.seed || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) / 281474976710656.0 < odds THEN 1 ELSE 0 END)) - any_value(target)) AS miss
  FROM g, range(16) k(seed) GROUP BY g.source, k.seed),
b AS (SELECT source, min_by(seed, (miss, seed)) AS seed FROM x GROUP BY source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (times + CASE WHEN CAST('0x' || substr(md5(b.seed || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) / 281474976710656.0 < odds THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM g JOIN b ON g.source IS NOT DISTINCT FROM b.source
"""

OP9 = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.z, c.z) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.z) = len(c.z))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP11 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM i, (VALUES (1), (2), (3), (4)) x(m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM g WHERE m > 1 AND f >= 30),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, k.k, h.f AS l, r.f AS r, (2000000 * k.a::HUGEINT) // (h.f + r.f) AS score FROM k
  JOIN g h ON h.lang = k.lang AND h.phrase = array_to_string(k.w[1:k.k], ' ') JOIN g r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:k.m], ' ')),
b AS (SELECT lang, phrase, a, min_by((l, r, score), (score, k)) AS x FROM s GROUP BY lang, phrase, a),
o AS (SELECT lang, array_to_string(w[i:i + y - 1], ' ') AS phrase, max(a) AS a FROM (SELECT *, unnest(range(1, m)) AS i FROM c WHERE m > 2), (VALUES (2), (3)) z(y) WHERE y < m AND i + y - 1 <= m GROUP BY ALL),
q AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.a IS NULL OR 100 * o.a::HUGEINT < 80 * b.a::HUGEINT),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY x[3] DESC, a DESC, phrase) AS rank, phrase, a, x[1] AS l, x[2] AS r, x[3] AS score FROM q)
SELECT z.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM z JOIN t ON t.lang = z.lang WHERE rank <= 2000
"""

OP13 = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
c AS (SELECT count(*) AS N_docs, CAST(sum(n) AS BIGINT) AS L FROM s),
p AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * N_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, N_docs),
i AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * N_docs) // L))) AS impact FROM p JOIN s USING (doc_id) JOIN w USING (term), c),
r AS (SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY ALL HAVING sum(times * impact) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {"op3_warc": OP3, "op5_chat": OP5, "op8_mixing": OP8, "op9_topk": OP9, "op11_collocations": OP11, "op13_lexical": OP13}
