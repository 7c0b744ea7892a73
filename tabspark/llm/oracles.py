"""SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

from tabspark.llm import decontam

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON s.doc_id = c.x"""

_UNITS = ", ".join(f"'{u}'" for u in decontam.UNITS)
_SLOTS = "('#', '%', '@')"
_CAPITAL = r"([\p{Ll},;] )(\p{Lu}\p{Ll}+)"
_WORDS = r"\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{M}@]+"

LEAKS = rf"""
WITH sides AS (SELECT 'd' AS side, doc_id AS id, regexp_replace(replace(coalesce(text, ''), '@', ' '), '[ \t\n\x0B\f\r]+', ' ', 'g') AS text FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT 'i', item_id, regexp_replace(replace(coalesce(text, ''), '@', ' '), '[ \t\n\x0B\f\r]+', ' ', 'g') FROM benchmark WHERE item_id IS NOT NULL),
split AS (SELECT side, id, regexp_extract_all(lower(regexp_replace(regexp_replace(text, '{_CAPITAL}', '\1@\2', 'g'), '{_CAPITAL}', '\1@\2', 'g')), '{_WORDS}') AS raw FROM sides),
t AS (SELECT side, id, raw, list_transform(raw, lambda w: ltrim(w, '@')) AS p, list_transform(raw, lambda w, i: CASE WHEN w < ':' THEN '#' WHEN w < 'A' THEN '@'
  WHEN w IN ({_UNITS}) AND i > 1 AND raw[greatest(i, 2) - 1] < ':' THEN '%' ELSE w END) AS w FROM split),
items AS (SELECT DISTINCT id AS item, raw, p, w, least({decontam.WINDOW}, len(w)) AS width FROM t WHERE side = 'i' AND len(w) > 0),
forms AS (SELECT item, w, w AS said, width, 'template' AS kind, false AS named FROM items UNION ALL SELECT item, w, p, width, 'plain', false FROM items
  UNION ALL SELECT item, list_concat(['@'], w[2:]), list_concat(['@'], w[2:]), width, 'template', true FROM items WHERE raw[1] >= 'A'),
iw AS (SELECT DISTINCT item, width, kind, pos, array_to_string(said[pos + 1:pos + width], ' ') AS win FROM (SELECT *, unnest(range(0, len(w) - width + 1)) AS pos FROM forms)
  WHERE (NOT named OR pos = 0) AND (kind = 'plain' AND width = {decontam.WINDOW} OR len(list_filter(w[pos + 1:pos + width], lambda x: x NOT IN {_SLOTS})) >= {decontam.WINDOW // 2})),
total AS (SELECT item, kind, count(DISTINCT pos) AS total FROM iw GROUP BY ALL),
dw AS (SELECT id AS doc, width, kind, spot, array_to_string(CASE WHEN kind = 'plain' THEN p ELSE w END[spot + 1:spot + width], ' ') AS win FROM (
  SELECT t.id, t.w, t.p, k.width, k.kind, unnest(range(0, len(t.w) - k.width + 1)) AS spot FROM t CROSS JOIN (SELECT DISTINCT width, kind FROM iw) k WHERE t.side = 'd')),
met AS (SELECT DISTINCT doc, item, kind, width, spot - pos AS shift, pos FROM dw JOIN iw USING (width, kind, win)),
al AS (SELECT doc, item, kind, shift, count(*) AS n, min(pos) AS start_pos FROM met GROUP BY ALL),
rows_of AS (SELECT doc, item, shift, max(n) AS longest FROM (SELECT doc, item, shift, count(*) AS n FROM (
  SELECT *, pos - row_number() OVER (PARTITION BY doc, item, shift ORDER BY pos) AS island FROM met WHERE kind = 'plain') GROUP BY doc, item, shift, island) GROUP BY ALL),
copied AS (SELECT doc, item, shift, n, start_pos, total, true AS verbatim FROM al JOIN total USING (item, kind) JOIN rows_of USING (doc, item, shift) WHERE kind = 'plain' AND longest >= least({decontam.ENOUGH}, total)),
other AS (SELECT al.doc, al.item, al.shift, total, i.raw AS ir, i.w AS iw, d.raw AS dr, d.w AS dw FROM al JOIN total USING (item, kind) JOIN items i USING (item)
  JOIN (SELECT DISTINCT id, raw, w FROM t WHERE side = 'd') d ON d.id = al.doc
  WHERE kind = 'template' AND n >= least({decontam.ENOUGH}, total) AND NOT EXISTS (SELECT 1 FROM copied c WHERE c.doc = al.doc AND c.item = al.item AND c.shift = al.shift)),
places AS (SELECT doc, item, shift, total, q, ir[q + 1] AS asked, dr[q + shift + 1] AS given, iw[q + 1] AS kind, iw[q + 1] IS NOT DISTINCT FROM dw[q + shift + 1] AS alike
  FROM (SELECT *, unnest(range(greatest(0, -shift), least(len(iw), len(dw) - shift))) AS q FROM other)),
stretch AS (SELECT p.*, count(*) FILTER (NOT alike) OVER (PARTITION BY p.doc, p.item, p.shift ORDER BY p.q) AS stretch, met.pos IS NOT NULL AS begins, met.width FROM places p
  LEFT JOIN met ON met.kind = 'template' AND met.doc = p.doc AND met.item = p.item AND met.shift = p.shift AND met.pos = p.q),
bounds AS (SELECT *, min(CASE WHEN begins THEN q END) OVER s AS lo, max(CASE WHEN begins THEN q + width END) OVER s AS hi FROM stretch WHERE alike OR begins WINDOW s AS (PARTITION BY doc, item, shift, stretch)),
judged AS (SELECT doc, item, shift, total, stretch, count(*) FILTER (begins) AS n, min(lo) AS lo, bool_and(kind NOT IN {_SLOTS} OR asked = given) AS verbatim,
  count(DISTINCT CASE WHEN kind IN {_SLOTS} THEN asked || ' ' || given END) = count(DISTINCT CASE WHEN kind IN {_SLOTS} THEN asked END) AS consistent FROM bounds WHERE q >= lo AND q < hi GROUP BY ALL),
changed AS (SELECT doc, item, shift, sum(n) AS n, min(lo) AS start_pos, total, bool_and(verbatim) AS verbatim FROM judged WHERE consistent GROUP BY doc, item, shift, total HAVING sum(n) >= least({decontam.ENOUGH}, total)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc, item ORDER BY n DESC, shift + start_pos, verbatim DESC, total DESC) AS place FROM (FROM copied UNION ALL BY NAME FROM changed))
SELECT doc AS doc_id, item AS item_id, CAST(n AS BIGINT) AS n_windows, n / total AS coverage, CAST(shift + start_pos AS BIGINT) AS start, verbatim FROM best WHERE place = 1"""

RECORDS = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS size FROM pages),
r AS (SELECT *, size >= 1000 AND row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST) > 1 AS again, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to FROM r"""

PHRASES = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM w, (VALUES (1), (2), (3)) t(k)),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.g, c.f AS a, x.f AS l, y.f AS r, j, CAST(1000000 * CAST(c.f AS HUGEINT) * c.f // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:j] JOIN f y ON y.lang = c.lang AND y.g = c.g[j + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inner_ones AS (SELECT DISTINCT s.lang, s.g FROM c s JOIN (SELECT lang, f, unnest([g[1:2], g[2:3]]) AS g FROM c WHERE k = 3) b ON s.lang = b.lang AND s.g = b.g AND 100 * b.f >= 50 * s.f),
r AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM lowest ANTI JOIN inner_ones USING (lang, g))
SELECT * FROM (SELECT r.lang, CAST(row_number() OVER (PARTITION BY r.lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang)) WHERE rank <= 2000"""

#: crc32 of the decimal id, bit by bit: the reflected polynomial 0xEDB88320
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(CAST(conv_id AS VARCHAR), '.'), lambda c: CAST(ascii(c) AS BIGINT))), lambda s, c:
  list_reduce(list_concat([xor(s, c)], [CAST(x AS BIGINT) FOR x IN range(8)]), lambda u, v: xor(u // 2, (u % 2) * 3988292384))))"""

PREFIXES = rf"""
WITH t AS (SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(x ORDER BY i) AS own FROM t GROUP BY conv_id),
p AS (SELECT conv_id, own, conv_id - conv_id % 20 AS base, CAST({_CRC} % 4 AS BIGINT) AS h FROM o),
r AS (SELECT p.conv_id, list_concat(coalesce(b.own, [])[1:h], p.own[h + 1:]) AS s FROM p LEFT JOIN o b ON b.conv_id = p.base),
e AS (SELECT conv_id, d, s[1:d] AS k, s[1:d - 1] AS up, len(s) = d AS ends FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM r)),
n AS (SELECT d, k, min(CASE WHEN d > 0 THEN up END) AS up, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
  CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(k[d].t, '[^\x20\x09-\x0D]+')) END AS saved FROM e GROUP BY d, k),
c AS (SELECT d - 1 AS d, up AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN c USING (d, k)),
below AS (SELECT v AS d, k[1:v] AS k, sum(saved) AS saved, count(*) FILTER (kids = 0) AS leaves FROM (SELECT k, saved, kids, unnest(range(0, d + 1)) AS v FROM m) GROUP BY ALL)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, m.n AS n_convs, CAST(m.kids AS BIGINT) AS n_children, b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN below b USING (d, k) LEFT JOIN n q ON q.d = m.d - 1 AND q.k = m.up"""
