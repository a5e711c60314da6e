"""SQL that says the same as the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP3 = rf"""WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, UNNEST(ls) AS line, UNNEST(range(0, len(ls))) AS pos FROM raw),
k AS (SELECT doc_id, pos, line, {_WORDS.format("line")} AS ws, row_number() OVER (ORDER BY doc_id, pos) AS o FROM l),
t AS (SELECT *, len(ws) AS n, array_to_string(ws, ' ') AS key FROM k),
u AS (SELECT key, any_value(ws) AS ws, any_value(n) AS n, min(o) AS o FROM t WHERE n >= 3 GROUP BY key),
v AS (SELECT key, n, o, i, array_to_string(list_concat(ws[1:i - 1], ws[i + 1:]), ' ') AS s FROM (SELECT *, UNNEST(range(1, n + 1)) AS i FROM u WHERE n >= 8)),
swapped AS (SELECT key FROM (SELECT key, o, min(o) OVER (PARTITION BY s, i, n) AS lead FROM v) WHERE lead < o),
gone AS (SELECT v.key FROM v JOIN u ON u.key = v.s AND u.n = v.n - 1 AND u.n >= 8 WHERE u.o < v.o UNION SELECT u.key FROM v JOIN u ON u.key = v.s AND u.n = v.n - 1 AND u.n >= 8 WHERE v.o < u.o),
fell AS (SELECT key FROM swapped UNION SELECT key FROM gone),
j AS (SELECT t.*, u.o AS first, t.n < 3 OR (t.o = u.o AND fell.key IS NULL) AS stays, coalesce(t.o = u.o AND fell.key IS NOT NULL, false) AS near FROM t LEFT JOIN u ON t.n >= 3 AND t.key = u.key LEFT JOIN fell ON t.n >= 3 AND t.key = fell.key)
SELECT d.doc_id, count(j.o) AS n_lines, count(j.o) FILTER (NOT stays) AS n_dropped, count(j.o) FILTER (near) AS n_near,
sha256(coalesce(string_agg(line, chr(10) ORDER BY j.o) FILTER (stays), '')) AS kept_sha256 FROM documents d LEFT JOIN j USING (doc_id) GROUP BY d.doc_id"""

OP5 = rf"""WITH k AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM (SELECT *, UNNEST(range(1, len(ws) - 11)) AS i FROM k WHERE len(ws) >= 13)),
f AS (SELECT s, min(doc_id) AS m FROM h GROUP BY s),
c AS (SELECT DISTINCT doc_id, i + t.j AS p FROM h JOIN f USING (s), range(0, 13) t(j) WHERE m < doc_id),
x AS (SELECT doc_id, UNNEST(ws) AS w, UNNEST(range(1, len(ws) + 1)) AS p FROM k),
y AS (SELECT x.doc_id, count(c.p) AS n_removed, string_agg(w, ' ' ORDER BY x.p) FILTER (c.p IS NULL) AS kept FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.p = x.p GROUP BY x.doc_id)
SELECT k.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k LEFT JOIN y USING (doc_id)"""

OP6 = """WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), '>', '&gt;') AS x,
lag(role) OVER w IS NOT DISTINCT FROM role AND row_number() OVER w > 1 AS joined, lead(role) OVER w IS NOT DISTINCT FROM role AND lead(turn) OVER w IS NOT NULL AS more FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(length(x) + CASE WHEN joined THEN 3 ELSE CASE role WHEN 'user' THEN 6 WHEN 'assistant' THEN 3 WHEN 'system' THEN 7 ELSE length(role) + 5 END END
 + CASE WHEN more THEN 0 ELSE CASE role WHEN 'user' THEN 7 WHEN 'assistant' THEN 4 WHEN 'system' THEN 8 ELSE 6 END END) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""

OP8 = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), q AS (SELECT *, CASE WHEN strlen(h) >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS whole FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN whole = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN whole <> page_id THEN whole END AS refers_to FROM q"""


def _seeds(masks: tuple[str, ...], span: int) -> str:
    parts = [f"SELECT *, {k} AS mask, concat_ws(' ', {', '.join(f'ws[i + {j + 1}]' for j, bit in enumerate(mask) if bit == '1')}) AS seed FROM {{0}}" for k, mask in enumerate(masks)]
    return " UNION ALL ".join(parts)


def op10(masks: tuple[str, ...], span: int, around: int, least: int, penalty: int) -> str:
    at = "SELECT *, UNNEST(range(0, len(ws) - {0})) AS i FROM {1} WHERE len(ws) >= {2}"
    return rf"""WITH d AS (SELECT doc_id, {_WORDS.format("lower(coalesce(text, ''))")} AS ws FROM documents), b AS (SELECT item_id, {_WORDS.format("lower(coalesce(text, ''))")} AS ws FROM benchmark),
dp AS ({at.format(span - 1, "d", span)}), bp AS ({at.format(span - 1, "b", span)}),
ds AS ({_seeds(masks, span).format("dp")}), bs AS ({_seeds(masks, span).format("bp")}),
hit AS (SELECT DISTINCT ds.doc_id, bs.item_id, ds.i, bs.i AS j FROM ds JOIN bs ON ds.mask = bs.mask AND ds.seed = bs.seed),
al AS (SELECT h.doc_id, h.item_id, h.i, h.j, t, len(b.ws) AS m, CASE WHEN d.ws[h.i + t + 1] = b.ws[h.j + t + 1] THEN 1 ELSE -{penalty} END AS v FROM hit h JOIN d USING (doc_id) JOIN b USING (item_id), range(-{around}, {span + around}) r(t)
 WHERE h.i + t >= 0 AND h.j + t >= 0 AND h.i + t < len(d.ws) AND h.j + t < len(b.ws)),
ps AS (SELECT *, sum(v) OVER (PARTITION BY doc_id, item_id, i, j ORDER BY t) AS s FROM al),
rs AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY doc_id, item_id, i, j ORDER BY t)) AS run FROM ps),
best AS (SELECT doc_id, item_id, max(run) AS score FROM rs GROUP BY doc_id, item_id, m HAVING max(run) >= least({least}, m)),
per AS (SELECT doc_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items, max(score) AS score FROM best GROUP BY doc_id)
SELECT doc_id, score IS NOT NULL AS contaminated, coalesce(items, '') AS items, CAST(coalesce(score, 0) AS BIGINT) AS score FROM d LEFT JOIN per USING (doc_id)"""
