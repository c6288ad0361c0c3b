"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {}

ORACLES["op1_pareto_mix"] = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), graded AS (SELECT *, length(bin(size))::BIGINT AS g FROM sized),
listed AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM graded GROUP BY source
), weighed AS (SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM listed),
filled AS (
  SELECT *, (sum(s) OVER () * 150 / 100.0
      - (sum(2 * s) OVER (ORDER BY 2.0 * s / w, r ROWS UNBOUNDED PRECEDING) - 2 * s))::DOUBLE
    / (sum(w) OVER (ORDER BY 2.0 * s / w DESC, r DESC ROWS UNBOUNDED PRECEDING))::DOUBLE AS level
  FROM weighed
), water AS (SELECT arg_min(level, 2.0 * s / w) AS level FROM filled WHERE level * w <= 2 * s),
target AS (
  SELECT source, s, CASE WHEN water.level IS NULL THEN 2.0 * s ELSE least(w * water.level, 2 * s)::DOUBLE END AS target
  FROM weighed CROSS JOIN water
), level AS (SELECT source, g, sum(size) AS words FROM graded GROUP BY source, g),
scaled AS (
  SELECT t.*, g, CASE WHEN sum(words * g) OVER below > 0
      THEN (target - 2 * coalesce(sum(words) OVER above, 0))::DOUBLE / (sum(words * g) OVER below)::DOUBLE ELSE 0 END AS scale
  FROM level JOIN target t ON level.source IS NOT DISTINCT FROM t.source
  WINDOW above AS (PARTITION BY t.source ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    below AS (PARTITION BY t.source ORDER BY g DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), free AS (SELECT source, max(g) AS free, arg_max(scale, g) AS scale FROM scaled WHERE scale * g <= 2 GROUP BY source),
expected AS (
  SELECT d.*, t.s, t.target,
    CASE WHEN g > coalesce(free, 0) THEN 2.0 ELSE least(2.0, coalesce(scale, 0) * g) END AS copies
  FROM graded d JOIN target t ON d.source IS NOT DISTINCT FROM t.source
  LEFT JOIN free f ON d.source IS NOT DISTINCT FROM f.source
), draw AS (
  SELECT *, floor(copies)::BIGINT AS whole, copies - floor(copies) AS p,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM expected
), ranked AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds,
    target - sum(size * whole) OVER (PARTITION BY source) AS room
  FROM draw
), placed AS (
  SELECT *, sum(CASE WHEN p > 0 THEN size END) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id
    ROWS UNBOUNDED PRECEDING) - size / 2.0 AS mid
  FROM ranked
)
SELECT doc_id, size, s AS source_size, target,
  (size * (whole + CASE WHEN p > 0 AND mid <= room THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

ORACLES["op7_line_dedup"] = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM line
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.line, k.pos, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SHINGLES = f"""
word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {{docs}}
), shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM word
)"""

COMPONENTS = f"""{SHINGLES}, size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM shared JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS root FROM {{docs}} UNION SELECT edge.b, reach.root FROM reach JOIN edge ON reach.doc_id = edge.a
)"""

ORACLES["op10_jaccard_join"] = f"""
WITH RECURSIVE {COMPONENTS.format(docs="documents")}
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(root) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN size USING (doc_id) GROUP BY d.doc_id
"""

ORACLES["op11_filter_audit"] = """
WITH split AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), judged AS (
  SELECT part, doc_id, [
      len(w) < 50,
      100 * len(list_distinct(w)) < 65 * len(w),
      100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
      regexp_matches(text, '[#$%&*|]'),
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), min(doc_id) OVER (PARTITION BY text) IS NOT NULL)
    ] AS fails
  FROM split
), marked AS (
  SELECT j.*, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM judged j
), class AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM marked GROUP BY part, fails
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), step AS (
  SELECT filter_order, s::INT AS step, ascii(filter_order[s]) - 64 AS f,
    [ascii(x) - 64 FOR x IN string_split(filter_order[1:s - 1], '') IF x <> ''] AS before
  FROM orders, range(1, 6) r(s)
), counted AS (
  SELECT part, filter_order, step, f, class.n, good, toxic, fails[f] AS own,
    list_bool_or([fails[b] FOR b IN before]) IS TRUE AS gone,
    list_bool_or([fails[b] FOR b IN [1, 2, 3, 4, 5] IF b <> f]) AS other
  FROM class, step
), out AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (WHERE NOT gone AND NOT own), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE NOT gone AND own), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND own), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE own AND NOT other), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE NOT gone AND own), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE NOT gone AND own), 0)::BIGINT AS toxic_lost
  FROM counted GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM out
"""


def _nearest(number: int) -> str:
    """Keys (distance and entry in one number) of all parts by book ``number``."""
    return f"""near{number} AS (
  SELECT r, part, any_value(x) AS x, min(64 * list_sum([(x[i] - y[i]) * (x[i] - y[i]) FOR i IN range(1, len(x) + 1)]) + e) AS k
  FROM piece JOIN book{number} USING (part) GROUP BY r, part
)"""


def _moved(number: int) -> str:
    """Book ``number + 1`` from the parts' nearest entries in book ``number``."""
    return f"""mean{number} AS (
  SELECT part, k % 64 AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
  FROM near{number}, range(1, 1025) g(i) WHERE i <= len(x) GROUP BY part, k % 64, i
), book{number + 1} AS (
  SELECT b.part, b.e, coalesce(m.y, b.y) AS y FROM book{number} b
  LEFT JOIN (SELECT part, e, list((s - (s % n + n) % n) // n ORDER BY i) AS y FROM mean{number} GROUP BY part, e) m USING (part, e)
)"""


ORACLES["op12_vector_codes"] = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), piece AS (
  SELECT r, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS x FROM kept, range(16) p(part)
), book0 AS (SELECT part, r - 1 AS e, x AS y FROM piece WHERE r <= 64),
{_nearest(0)}, {_moved(0)}, {_nearest(1)}, {_moved(1)}, {_nearest(2)}, coded AS (
  SELECT r, string_agg(printf('%02x', k % 64), '' ORDER BY part) AS code, sum(k // 64)::BIGINT AS error FROM near2 GROUP BY r
), books AS (
  SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, e)) AS sha FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM kept JOIN coded USING (r) CROSS JOIN books
"""
