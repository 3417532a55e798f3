"""DuckDB twins of the contract queries that SQL can express."""

from __future__ import annotations

from shelfspark.llm import quality

_WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
    CAST(('0x' || substr(sha256('mix-1:' || doc_id), 1, 12)) AS BIGINT) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
t AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
    coalesce(sum(source_size) OVER o, 0) AS size_before, coalesce(sum(weight) OVER o, 0) AS weight_before
    FROM w WINDOW o AS (ORDER BY source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (1.5::DOUBLE * CAST(total AS DOUBLE) - 2 * CAST(size_before AS DOUBLE)) / CAST(all_weight - weight_before AS DOUBLE) AS level FROM t),
f AS (SELECT *, (SELECT arg_min(level, source_size / weight::DOUBLE) FROM l WHERE level * weight < 2 * source_size) AS fill FROM l),
g AS (SELECT source, source_size, coalesce(least(fill * weight, 2.0::DOUBLE * source_size), 2.0::DOUBLE * source_size) AS target FROM f),
q AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM g),
n AS (SELECT *, floor(rate) AS whole, target - floor(rate) * source_size AS rest FROM q),
h AS (SELECT source, draw, sum(size) AS w FROM d GROUP BY source, draw),
c AS (SELECT *, sum(w) OVER (PARTITION BY source ORDER BY draw) AS upto FROM h),
m AS (SELECT n.source, arg_min(CASE WHEN 2 * (rest - upto + w) >= w THEN draw + 1 ELSE draw END, draw) AS below FROM n JOIN c ON n.source IS NOT DISTINCT FROM c.source WHERE rest > 0 AND upto >= rest GROUP BY n.source),
b AS (SELECT n.*, CASE WHEN rest <= 0 THEN 0 ELSE coalesce(below, 281474976710656) END AS below FROM n LEFT JOIN m ON n.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST((whole + CASE WHEN draw < below THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source"""

_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(quality.RULES.values()))

LEDGER = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
p AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
q AS (SELECT r, i, ws[i] || chr(0) || ws[i + 1] || chr(0) || ws[i + 2] AS run FROM p),
a AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, run) AS n FROM q) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM a, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(array_to_string(ws, '')), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines, len(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, len(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower
    FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_rules & {quality.mask_of(quality.POLICIES["base-1"])} <> 0 AS base_failed, failed_rules & {quality.mask_of(quality.POLICIES[quality.DEFAULT_POLICY])} = 0 AS kept, failed_rules FROM b"""

_MASKED = f"failed_rules & {quality.mask_of(quality.POLICIES[quality.DEFAULT_POLICY])}"
ABLATION = f"WITH l AS ({LEDGER}), r(rule, bit) AS (VALUES {', '.join(f"('{rule}', {quality.mask_of((rule,))})" for rule in quality.POLICIES[quality.DEFAULT_POLICY])}) SELECT rule, CAST(sum(CASE WHEN failed_rules & bit <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS failing, CAST(sum(CASE WHEN {_MASKED} = bit THEN 1 ELSE 0 END) AS BIGINT) AS rejected_alone, CAST(sum(CASE WHEN {_MASKED} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN {_MASKED} IN (0, bit) THEN 1 ELSE 0 END) AS BIGINT) AS kept_without FROM l, r GROUP BY rule"

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SIGNED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

WINNOW = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '{_SIGNED}') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW}, '{_SIGNED}') AS ws FROM benchmark WHERE item_id IS NOT NULL),
k AS (SELECT *, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM k)),
dw AS (SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM (SELECT d.*, s.n, unnest(range(1, len(ws) - s.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k) s WHERE len(ws) >= s.n)),
h AS (SELECT r, i, dw.n, item FROM dw JOIN iw USING (n, win)),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)"""

_SIGN = "||".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hexed, {10 * k + 1}, 10) AS BIGINT) >> {5 * (7 - j)}) & 31 AS INTEGER) + 1, 1)" for k in range(4) for j in range(8))

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), g AS (SELECT h, max(page_id) AS m FROM p GROUP BY h),
x AS (SELECT page_id, h, m, sha1(h) AS hexed FROM p JOIN g USING (h))
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, {_SIGN} AS payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to FROM x"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '{_WORD}') AS ws FROM documents),
n AS (SELECT *, least(4, len(ws)) AS k FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT r, hash(array_to_string(ws[i:i + k - 1], ' ')) AS g FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM n)),
z AS (SELECT r, count(*) AS size FROM s GROUP BY r),
o AS (SELECT a.r AS x, b.r AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN z p ON p.r = x JOIN z q ON q.r = y WHERE 100 * shared >= 85 * (p.size + q.size - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
c AS (SELECT r AS x, r AS y FROM d UNION SELECT c.x, e.y FROM c JOIN e ON c.y = e.x),
m AS (SELECT c.x, min(d.doc_id) AS component_id FROM c JOIN d ON d.r = c.y GROUP BY c.x),
f AS (SELECT x, count(*) AS n_links FROM e GROUP BY x)
SELECT d.doc_id, CAST(coalesce(z.size, 0) AS BIGINT) AS n_shingles, m.component_id, CAST(coalesce(f.n_links, 0) AS BIGINT) AS n_links FROM d JOIN m ON m.x = d.r LEFT JOIN z ON z.r = d.r LEFT JOIN f ON f.x = d.r"""

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS terms, sum(n) AS words FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
e AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * terms) AS p, 1 + (1000000000::HUGEINT * (lang_n + 2)) // (words + 2 * terms) AS q FROM e JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f QUALIFY part = 'pair' OR rank <= 10"""


def chat(budget: int = 1024, history: int = 256, history_turns: int = 8, block: int = 256) -> str:
    """Windows by recursion from turn to turn; the digests read the turns themselves."""
    return rf"""
WITH RECURSIVE u AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT conv_id, role, text, CAST(floor(turn / {block}) AS BIGINT) AS b, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i,
    CAST(ceil((octet_length(encode(text)) + octet_length(encode(role))) / 4) AS BIGINT) + 4 AS n,
    6 + length(replace(replace(replace(replace(role, '\', '\\'), '<turn', '<\turn'), '</turn', '</\turn'), '>', '\g')) + 2 + length(replace(replace(replace(text, '\', '\\'), '<turn', '<\turn'), '</turn', '</\turn')) + 8 AS chars FROM u),
p AS MATERIALIZED (SELECT *, sum(n) OVER w AS e, sum(n) OVER w - n AS s, sum(chars) OVER w AS ce, sum(chars) OVER w - chars AS cs, dense_rank() OVER (PARTITION BY conv_id ORDER BY b) AS nth FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
y AS (SELECT conv_id, n AS sn, chars AS sc FROM p WHERE i = 0 AND role = 'system'),
x AS (SELECT p.*, coalesce(sn, 0) AS sn, coalesce(sc, 0) AS sc, {budget} - CASE WHEN i > 0 THEN coalesce(sn, 0) ELSE 0 END AS room, CASE WHEN sn IS NULL THEN 0 ELSE 1 END AS least FROM p LEFT JOIN y USING (conv_id)),
h AS (SELECT x.conv_id, x.i, min(q.s) AS hs FROM x JOIN p q ON q.conv_id = x.conv_id AND q.i BETWEEN x.i - {history_turns} AND x.i AND (q.i >= x.least OR q.i = x.i) AND q.nth >= x.nth - 1 AND (x.s - q.s <= least({history}, x.room) OR q.i = x.i) GROUP BY x.conv_id, x.i),
k AS (SELECT x.conv_id, x.i, coalesce(max(q.i), x.i) AS hi FROM x JOIN h USING (conv_id, i) LEFT JOIN p q ON q.conv_id = x.conv_id AND q.b = x.b AND q.i >= x.i AND q.e - hs <= x.room GROUP BY x.conv_id, x.i),
m AS (SELECT x.conv_id, x.i, x.nth, k.hi, l.ce, x.cs, x.sc, coalesce(min(q.cs), x.cs) AS begins FROM x JOIN h USING (conv_id, i) JOIN k USING (conv_id, i) JOIN p l ON l.conv_id = x.conv_id AND l.i = k.hi
    LEFT JOIN p q ON q.conv_id = x.conv_id AND q.i < x.i AND q.s >= hs AND l.e - q.s <= x.room GROUP BY x.conv_id, x.i, x.nth, k.hi, l.ce, x.cs, x.sc),
f AS (SELECT m.conv_id, m.i, hi FROM m WHERE i IN (SELECT min(i) FROM p WHERE p.conv_id = m.conv_id AND p.nth = m.nth)
    UNION ALL SELECT m.conv_id, m.i, m.hi FROM f JOIN m ON m.conv_id = f.conv_id AND m.i = f.hi + 1 AND m.nth = (SELECT nth FROM p WHERE p.conv_id = f.conv_id AND p.i = f.i)),
c AS (SELECT conv_id, sum(ce - begins + CASE WHEN i > 0 THEN sc ELSE 0 END) AS formatted_chars FROM f JOIN m USING (conv_id, i) GROUP BY conv_id),
d AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256, coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS loss FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM d JOIN c USING (conv_id)"""


def lloyd(rounds: int = 3) -> str:
    """Plain Lloyd rounds over all distances."""
    q = [
        """WITH e AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM e),
x AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, unnest(q) AS a FROM v),
k0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q FROM v QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), q) <= 16),
c0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS i, unnest(q) AS a FROM k0)"""
    ]
    for n in range(rounds + 1):
        q.append(f"""d{n} AS (SELECT r, c, sum((x.a - c.a) * (x.a - c.a)) AS d FROM x JOIN c{n} c USING (i) GROUP BY r, c),
a{n} AS MATERIALIZED (SELECT r, min(c) AS c, any_value(d) AS d FROM d{n} JOIN (SELECT r, min(d) AS d FROM d{n} GROUP BY r) USING (r, d) GROUP BY r)""")
        if n < rounds:
            q.append(f"""s{n} AS (SELECT a{n}.c, i, sum(x.a) AS s, count(*) AS n FROM a{n} JOIN x USING (r) GROUP BY a{n}.c, i),
c{n + 1} AS MATERIALIZED (SELECT c, i, CASE WHEN s IS NULL THEN o.a ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS a FROM c{n} o LEFT JOIN s{n} USING (c, i))""")
    q.append(f"h AS (SELECT c, sha256(string_agg(CAST(a AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)")
    return ",\n".join(q) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{rounds} JOIN v USING (r) JOIN h USING (c)"""
