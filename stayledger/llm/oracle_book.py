"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# The level of the targets is found from running sums in order of cap / weight; documents are in order of their key.
OP6 = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS tie, len(coalesce(text, '')) AS chars,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (SELECT doc_id, source, size, tie,
             -ln(u) / CASE WHEN size > 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + abs(chars::DOUBLE / size::DOUBLE - 6.0::DOUBLE)) ELSE 1.0 END AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT source, source_size, (source_size * 3)::DOUBLE AS cap,
             ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(cap) OVER before, 0))
             / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0)) AS level
      FROM w WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(cap / weight) AS free FROM l WHERE level * weight <= cap),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT min(level) FROM l WHERE cap / weight = (SELECT free FROM f)) * weight, cap)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
p AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (
        PARTITION BY source ORDER BY key, doc_id NULLS LAST, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
SELECT p.doc_id, p.size, e.source_size, e.target,
       (e.epochs * p.size + least(p.size, greatest(0, floor(e.target) - e.epochs * e.source_size - p.before)))::BIGINT AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
"""


# Windows of 1 to 8 lines that have words; those with 8 words and an earlier equal window are deleted. Longer windows are
# unions of those of 8 lines.
OP5 = r"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
every AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM raw),
counted AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM every),
w AS (SELECT doc_id, line, i, words, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos FROM counted WHERE words > 0),
runs AS (
  SELECT doc_id, pos, n, sum(words) OVER ahead AS words, list(line) OVER ahead AS content, count(*) OVER ahead AS found
  FROM w, (VALUES (1), (2), (3), (4), (5), (6), (7), (8)) AS sizes(n)
  WINDOW ahead AS (PARTITION BY doc_id, n ORDER BY pos RANGE BETWEEN CURRENT ROW AND n - 1 FOLLOWING)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n, content ORDER BY doc_id, pos) AS copy FROM runs WHERE found = n),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM ranked WHERE copy > 1 AND words >= 8),
flagged AS (SELECT w.doc_id, w.i, w.pos, gone.pos IS NOT NULL AS deleted FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.pos = gone.pos),
starts AS (SELECT *, deleted AND NOT coalesce(lag(deleted) OVER (PARTITION BY doc_id ORDER BY pos), false) AS starting FROM flagged),
per_doc AS (SELECT doc_id, count(*) FILTER (WHERE deleted) AS n_removed, count(*) FILTER (WHERE starting) AS n_runs FROM starts GROUP BY doc_id),
kept AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.i) AS text
         FROM every e LEFT JOIN flagged f ON e.doc_id = f.doc_id AND e.i = f.i WHERE NOT coalesce(f.deleted, false) GROUP BY e.doc_id)
SELECT raw.doc_id, coalesce(len(raw.lines), 0)::BIGINT AS n_lines, coalesce(per_doc.n_removed, 0)::BIGINT AS n_removed,
       coalesce(per_doc.n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM raw LEFT JOIN per_doc USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


# Matches and the pieces between them, added up to positions; the added kinds after the base ones.
OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
rules(rule, kind, pattern, judged, at_least) AS (VALUES
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
  (2, 'hex', '[0-9a-f]+', 0, 24),
  (3, 'github', 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 0),
  (4, 'slack', 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 0),
  (5, 'google', 'AIza[A-Za-z0-9_-]{35}', 0, 0),
  (6, 'jwt', 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+', 0, 0),
  (7, 'pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0),
  (8, 'login', '://[A-Za-z0-9_.~-]+:[A-Za-z0-9_.~!$&*+=%-]+@', 0, 0)),
m AS (
  SELECT k, rule, kind, at_least, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern) AS found,
         CASE WHEN judged = 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern) END AS judged
  FROM d, rules WHERE regexp_matches(text, pattern)),
e AS (SELECT k, rule, kind, at_least, unnest(range(len(found))) AS i, unnest(found) AS own, unnest(gaps[1:len(found)]) AS gap, unnest(judged) AS judged FROM m),
p AS (SELECT *, sum(length(gap) + length(own)) OVER (PARTITION BY k, rule ORDER BY i) AS upto FROM e),
s AS (SELECT k, rule, (upto - length(own))::BIGINT AS start, kind || ':' || (upto - length(own))::BIGINT || ':' || upto::BIGINT AS span FROM p WHERE length(judged) >= at_least),
g AS (
  SELECT k, count(*) FILTER (WHERE rule = 0) AS a, count(*) FILTER (WHERE rule = 1) AS b, count(*) FILTER (WHERE rule = 2) AS c,
         string_agg(span, ',' ORDER BY start, rule) FILTER (WHERE rule < 3) AS base, string_agg(span, ',' ORDER BY start, rule) AS spans
  FROM s GROUP BY k)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (k)
"""


OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
n AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
m AS (SELECT k, doc_id, (75 + (25 * len(terms) * docs) // total)::BIGINT AS m FROM d, n WHERE len(terms) > 0),
e AS (SELECT k, unnest(terms) AS term FROM d),
t AS (SELECT k, term, count(*)::BIGINT AS tf FROM e WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, n GROUP BY term, docs),
s AS (SELECT item_id, k, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM t JOIN q USING (term) JOIN w USING (term) JOIN m USING (k) GROUP BY item_id, k),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s JOIN m USING (k) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_line_runs": OP5, "op6_source_mix": OP6, "op11_secret_scan": OP11, "op13_lexical_search": OP13}
