"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

from .queries import URL_RULES

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

URL_FILTER = rf"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {_RULES}),
rest AS (SELECT page_id, row_number() OVER () AS rn,
                CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r
         FROM pages),
parts AS (SELECT page_id, rn, translate(regexp_extract(r, '^([^/?#]*)', 1),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT rn, r_host || r_path AS rule, r_verdict,
                row_number() OVER (PARTITION BY rn ORDER BY length(r_host || r_path) DESC) AS k
         FROM parts JOIN rules ON (host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (rn)
"""

LINE_DEDUP = """
WITH lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                      generate_subscripts(string_split(text, chr(10)), 1) AS pos
               FROM documents),
spread AS (SELECT trim(line) AS k FROM lines WHERE trim(line) <> ''
           GROUP BY trim(line) HAVING count(DISTINCT coalesce(source, '')) >= 10),
judged AS (SELECT doc_id, line, pos, k IS NOT NULL AND row_number() OVER (PARTITION BY trim(line) ORDER BY doc_id, pos) > 1 AS gone
           FROM lines LEFT JOIN spread ON trim(line) = k)
SELECT doc_id, any_value(n) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM judged) GROUP BY doc_id
"""


# The measures, their room and the sides that fail are the operator's parameters,
# written out here.
QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
ws AS (SELECT rn, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
w AS (SELECT rn, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM ws),
win AS (SELECT rn, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS g FROM w WINDOW o AS (PARTITION BY rn ORDER BY i)),
twice AS (SELECT rn, i FROM win WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rn, g) > 1),
covered AS (SELECT rn, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY rn),
lines AS (SELECT rn, unnest(string_split(t, chr(10))) AS line FROM d),
repeated AS (SELECT rn, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM lines
             WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rn),
counts AS (SELECT rn, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(repeated.n, 0)::BIGINT AS n_dup_lines,
                  coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines
           FROM d JOIN ws USING (rn) LEFT JOIN covered USING (rn) LEFT JOIN repeated USING (rn)),
stats AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
measures(measure, room, both_sides) AS (VALUES (0, 10000, true), (1, 1000, false), (2, 3000, false), (3, 3000, false)),
ratios AS (SELECT rn, lang, source, measure, room, both_sides, base_failed,
                  CASE measure WHEN 0 THEN 10000 * word_chars // greatest(n_words, 1) WHEN 1 THEN 10000 * n_symbols // greatest(n_words, 1)
                               WHEN 2 THEN 10000 * n_dup_lines // greatest(n_lines, 1) ELSE 10000 * n_repeat_words // greatest(n_words, 1) END AS r
           FROM stats, measures),
bins AS (SELECT *, r - r % (1::BIGINT << greatest(length(bin(r)) - 7, 0)) AS b FROM ratios WHERE NOT base_failed),
levels(level) AS (VALUES (1), (2), (3)),
grouped AS (SELECT level, measure, room, both_sides, b, count(*) AS n, CASE WHEN level = 1 THEN source END AS source, CASE WHEN level < 3 THEN lang END AS lang
            FROM bins, levels GROUP BY ALL),
walked AS (SELECT *, sum(n) OVER (g ORDER BY b) AS upto, sum(n) OVER g AS docs FROM grouped
           WINDOW g AS (PARTITION BY level, lang, source, measure)),
quartiles AS (SELECT level, lang, source, measure, room, both_sides, docs, min(b) FILTER (WHERE 4 * upto >= docs) AS q1,
                     min(b) FILTER (WHERE 4 * upto >= 2 * docs) AS q2, min(b) FILTER (WHERE 4 * upto >= 3 * docs) AS q3
              FROM walked GROUP BY ALL),
fences AS (SELECT level, lang, source, measure, docs, CASE WHEN both_sides THEN q2 - greatest(6 * least(q3 - q2, q2 - q1), room) ELSE -1 END AS low,
                  q2 + greatest(6 * least(q3 - q2, q2 - q1), room) AS high FROM quartiles),
judged AS (SELECT rn, bool_and(CASE WHEN s.docs >= 100 THEN r BETWEEN s.low AND s.high WHEN l.docs >= 100 THEN r BETWEEN l.low AND l.high
                                    ELSE r BETWEEN c.low AND c.high END) AS within
           FROM bins JOIN fences s ON s.level = 1 AND s.measure = bins.measure AND s.lang IS NOT DISTINCT FROM bins.lang AND s.source IS NOT DISTINCT FROM bins.source
           JOIN fences l ON l.level = 2 AND l.measure = bins.measure AND l.lang IS NOT DISTINCT FROM bins.lang
           JOIN fences c ON c.level = 3 AND c.measure = bins.measure GROUP BY rn)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(within, false) AS kept
FROM stats LEFT JOIN judged USING (rn)
"""


COLLOCATIONS = r"""
WITH d AS (SELECT row_number() OVER () AS rn, coalesce(lang, 'und') AS lang,
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT rn, lang, ps, unnest(ps) AS piece, generate_subscripts(ps, 1) AS k
           FROM (SELECT rn, lang, string_split_regex(t, '[.,;:!?\x0A-\x0D]') AS ps FROM d)),
w AS (SELECT rn, lang, k, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT rn, lang, k, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces)),
g AS (SELECT lang, word AS w1, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY rn, k ORDER BY i)),
one AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
covered AS (SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL),
pairs AS (SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, l.f AS l, r.f AS r, 1 AS k
          FROM two t JOIN one l ON l.lang = t.lang AND l.w1 = t.w1 JOIN one r ON r.lang = t.lang AND r.w1 = t.w2
          LEFT JOIN covered c ON c.lang = t.lang AND c.w1 = t.w1 AND c.w2 = t.w2
          WHERE t.f >= 10 AND (c.f IS NULL OR 100 * c.f < 50 * t.f)),
triples AS (SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, l.f AS l, r.f AS r, 1 AS k
            FROM three t JOIN one l ON l.lang = t.lang AND l.w1 = t.w1 JOIN two r ON r.lang = t.lang AND r.w1 = t.w2 AND r.w2 = t.w3
            UNION ALL
            SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, l.f, r.f, 2
            FROM three t JOIN two l ON l.lang = t.lang AND l.w1 = t.w1 AND l.w2 = t.w2 JOIN one r ON r.lang = t.lang AND r.w1 = t.w3),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM (SELECT * FROM pairs UNION ALL SELECT * FROM triples)),
cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM cut)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang) USING (lang) WHERE rank <= 2000
"""

PREFIX_TRIE = """
WITH RECURSIVE crc_steps(i, k, v) AS (
    SELECT i, 0, i FROM range(256) AS t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_steps WHERE k < 8),
crc_table AS (SELECT i, v FROM crc_steps WHERE k = 8),
ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
folded(conv_id, s, pos, v) AS (
    SELECT conv_id, s, 0, 4294967295::BIGINT FROM ids
    UNION ALL SELECT conv_id, s, pos + 1, xor(f.v >> 8, t.v)
    FROM folded f JOIN crc_table t ON t.i = xor(f.v, ascii(substr(s, pos + 1, 1))::BIGINT) % 256 WHERE pos < length(s)),
given AS (SELECT conv_id, xor(v, 4294967295) % 9 AS h FROM folded WHERE pos = length(s)),
turns AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS p
          FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)),
rebuilt AS (SELECT g.conv_id, 0 AS part, p, role, text FROM given g JOIN turns t ON t.conv_id = g.conv_id - g.conv_id % 5 AND p <= h
            UNION ALL SELECT conv_id, 1, p, role, text FROM given g JOIN turns t USING (conv_id) WHERE p > h),
paths AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(md5(strlen(role) || ':' || role || text), '') OVER w AS path, strlen(text) AS bytes
          FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
          UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY ALL),
ended AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
          FROM (SELECT conv_id, max_by(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path),
below AS (SELECT substr(path, 1, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
up AS (SELECT n.path AS low, (n_convs - 1) * bytes AS tokens, b.n IS NULL AS leaf, substr(n.path, 1, 32 * unnest(range(depth + 1))) AS path
       FROM nodes n LEFT JOIN below b USING (path)),
sums AS (SELECT path, count(*) FILTER (WHERE leaf) AS n_leaves, sum(tokens)::BIGINT AS saved_tokens FROM up GROUP BY path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(b.n, 0) AS n_children, n_leaves, saved_tokens,
       coalesce(sha, sha256('')) AS ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN below b USING (path) LEFT JOIN ended USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, 32 * (n.depth - 1)) AND p.depth = n.depth - 1
"""


def registry() -> dict[str, str]:
    return {"op1_line_dedup": LINE_DEDUP, "op10_url_filter": URL_FILTER, "op11_quality_rules": QUALITY_RULES,
            "op12_collocations": COLLOCATIONS, "op13_prefix_trie": PREFIX_TRIE}
