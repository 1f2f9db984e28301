"""DuckDB SQL of the operators that SQL can express, over the tables as views."""

from __future__ import annotations

from .common import LOWER, UPPER
from .mixing import MAX_EPOCHS, TOTAL_SHARE
from .quality_rules import MAX_REPEAT_PCT, MIN_WORDS, STOP_WORDS
from .url_filter import RULES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOP = ", ".join("'" + w + "'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws.split()}))
_LANGS = ", ".join(f"'{x}'" for x in STOP_WORDS)

# The unsigned CRC-32 of a text of digits, bit by bit over its bytes.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLE = {
    "op9_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+7], chr(31)) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)),
often AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM often, range(8) AS t(k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(rep.n, 0) AS n_repeat_words,
    len(list_filter(ws, lambda w: rtrim(lower(w), '.,;:') IN ({_STOP}))) AS n_stop,
    len(list_filter(ws, lambda w: w LIKE '%!!' OR w LIKE '%!!.')) AS n_marked
  FROM d LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 15.0 * n_words
    AND n_symbols / n_words <= 0.3 AND (lang IS NULL OR lang NOT IN ({_LANGS}) OR n_stop / n_words >= 0.02)
    AND n_dup_lines / len(lines) <= 0.5 AND n_marked / n_words <= 0.3 AS kept
FROM f""",
    "op3_mix_sources": rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5) / 281474976710656.0)
      / (1.0 / (1.0 + 10.0 * len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>!]')) / greatest(length(coalesce(text, '')), 1))) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, {MAX_EPOCHS}.0 * source_size AS cap, {TOTAL_SHARE} * sum(source_size) OVER () AS budget,
    coalesce(sum({MAX_EPOCHS}.0 * source_size) OVER (ORDER BY 1.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(w) OVER (ORDER BY 1.0 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
  FROM s),
l AS (
  SELECT *, max((budget - used) / left_w) OVER () AS level FROM c),
t AS (
  SELECT source, source_size, least(cap, level * w)::DOUBLE AS target FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (
  SELECT doc_id, size, source_size, target, epochs, round(target - epochs * source_size)::BIGINT AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * epochs + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM r""",
    "op11_conversation_trie": rf"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, own, conv_id - conv_id % 5 AS leader, {_CRC32} % 9 AS h
  FROM (SELECT conv_id, count(*) AS own, conv_id::VARCHAR AS s FROM t GROUP BY conv_id)),
c2 AS (
  SELECT c.*, least(c.h, coalesce(l.own, 0)) AS head FROM c LEFT JOIN c l ON l.conv_id = c.leader),
q AS (
  SELECT c2.conv_id, t.pos, role, text FROM c2 JOIN t ON t.conv_id = c2.leader AND t.pos < c2.h
  UNION ALL
  SELECT c2.conv_id, t.pos - h + head, role, text FROM c2 JOIN t ON t.conv_id = c2.conv_id AND t.pos >= c2.h),
p AS (
  SELECT conv_id, pos + 1 AS depth, strlen(text) AS bytes, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
    OVER (PARTITION BY conv_id ORDER BY pos)) AS key
  FROM q UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (
  SELECT depth, key, min(conv_id) AS name, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY depth, key),
u AS (
  SELECT n.*, pn.key AS parent_key, pn.name AS parent FROM n
  LEFT JOIN p pp ON pp.conv_id = n.name AND pp.depth = n.depth - 1
  LEFT JOIN n pn ON pn.depth = pp.depth AND pn.key = pp.key),
k AS (
  SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM u WHERE depth > 0 GROUP BY ALL),
v AS (
  SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN k USING (depth, key)),
sub AS (
  SELECT DISTINCT a.depth, a.key, b.depth AS below, b.key AS below_key FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
total AS (
  SELECT sub.depth, sub.key, sum((v.n_children = 0)::BIGINT) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved
  FROM sub JOIN v ON v.depth = below AND v.key = below_key GROUP BY ALL),
e AS (
  SELECT depth, key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM p JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id) USING (conv_id, depth) GROUP BY depth, key)
SELECT name AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM v JOIN total USING (depth, key) LEFT JOIN e USING (depth, key)""",
    "op12_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hash FROM documents),
h AS (
  SELECT *, length(text) AS n, ('0x' || hash[1:8])::BIGINT AS h1, ('0x' || hash[9:16])::BIGINT AS h2,
    ('0x' || hash[17:24])::BIGINT AS h3, ('0x' || hash[25:32])::BIGINT AS h4 FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
x AS (
  SELECT *, substring(text, 1, a) AS head, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS tail FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle
    ELSE '<S>' || tail || '<P>' || head || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM x""",
    "op13_url_filter": rf"""
WITH RECURSIVE r(host, path, verdict) AS (
  VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}),
tag AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script|<style.*?</style', ' ', 'g'),
    '(?i)<(?:link|meta)\b[^<>]*>')) AS t FROM pages WHERE contains(url, '://')),
link AS (
  SELECT url AS a, replace(CASE WHEN regexp_matches(t, '(?i)<link') THEN regexp_extract(t, '(?i)\shref\s*=\s*["'']([^"'']*)', 1)
    ELSE regexp_extract(t, '(?i)url\s*=\s*([^"'';]*)', 1) END, '&amp;', '&') AS b
  FROM tag WHERE regexp_matches(t, '(?i)rel\s*=\s*["'']?canonical|http-equiv\s*=\s*["'']?refresh')),
named AS (
  SELECT url, lower(regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)) || CASE regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)
    WHEN '' THEN '/' ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) END || regexp_extract(url, '(?s)^[^?#]*(\?[^#]*)', 1) AS node
  FROM (SELECT a AS url FROM link UNION SELECT b FROM link UNION SELECT url FROM pages) WHERE contains(url, '://')),
edge AS (
  SELECT x.node AS a, y.node AS b FROM link JOIN named x ON x.url = link.a JOIN named y ON y.url = link.b),
two AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(a, b) AS (
  SELECT a, b FROM two UNION SELECT reach.a, two.b FROM reach JOIN two ON two.a = reach.b),
place AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, 0 AS of_page FROM pages
  UNION ALL
  SELECT NULL, node, regexp_extract(node, '(?s)^.*?://([^/?#]*)', 1), regexp_extract(node, '(?s)^.*?://[^/?#]*([^?#]*)', 1), 1
  FROM (SELECT DISTINCT b AS node FROM reach)),
ruled AS (
  SELECT p.*, (SELECT max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) FROM r
    WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS f FROM place p),
class AS (
  SELECT reach.a AS node, CASE WHEN bool_or(f.verdict = 'allow') THEN 'allow' WHEN bool_or(f.verdict = 'block') THEN 'block' END AS verdict
  FROM reach JOIN ruled ON ruled.of_page = 1 AND ruled.url = reach.b GROUP BY reach.a)
SELECT page_id, ruled.host, ruled.path, f.rule AS rule, coalesce(f.verdict, class.verdict, 'allow') AS verdict
FROM ruled LEFT JOIN named ON named.url = ruled.url LEFT JOIN class ON class.node = named.node WHERE of_page = 0""",
}
