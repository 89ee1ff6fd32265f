"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from .license_texts import LICENCES, NOTICES, SPELLINGS
from .licenses import COPYRIGHT_LINE, PUNCTUATION

#: Words of a text: runs of anything but ASCII white space.
_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op10_pareto_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5)
           / 281474976710656.0 AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 2 AS cap,
         ([3.0, 1.0, 2.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source
), f AS (
  SELECT *, (SELECT 1.5 * sum(source_size)::DOUBLE FROM s) AS budget,
         coalesce(sum(cap) OVER before, 0) AS capped,
         (SELECT sum(w) FROM s) - coalesce(sum(w) OVER before, 0) AS w_left
  FROM s WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT first((budget - capped) / w_left ORDER BY cap / w, source NULLS LAST)
           FILTER ((budget - capped) / w_left * w < cap) AS level FROM f
), t AS (
  SELECT source, source_size, least(cap, coalesce(w * level, cap)) AS target FROM s, l
), p AS (
  SELECT d.doc_id, d.source, d.size, d.u, t.source_size, t.target,
         CASE WHEN d.size > 0 THEN least(t.target / t.source_size::DOUBLE, 2.0) ELSE 0 END AS want
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, floor(want) AS certain,
         CASE WHEN want > floor(want) THEN (u / (1 - u)) / ((want - floor(want)) / (1 - (want - floor(want)))) END AS odds
  FROM p
), r AS (
  SELECT *, floor(odds / (1 + odds) * 1e15) AS rank_key,
         target - sum(certain * size) OVER (PARTITION BY source) AS rest
  FROM k
), c AS (
  SELECT *, CASE WHEN odds IS NOT NULL AND sum(size) OVER (
           PARTITION BY source, odds IS NULL ORDER BY rank_key, doc_id::VARCHAR) <= rest THEN 1 ELSE 0 END AS more
  FROM r
), g AS (
  SELECT *, rest - sum(more * size) OVER (PARTITION BY source) AS gap FROM c
), n AS (
  SELECT *, CASE WHEN more = 0 AND odds IS NOT NULL AND abs(size - gap) < abs(gap) THEN
           row_number() OVER (PARTITION BY source, more = 0 AND odds IS NOT NULL AND abs(size - gap) < abs(gap)
                              ORDER BY abs(size - gap), rank_key, doc_id::VARCHAR) END AS nearest
  FROM g
)
SELECT doc_id, size, source_size, target,
       ((certain + more + CASE WHEN nearest = 1 THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM n
"""

ORACLES["op8_cuckoo_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    flat = f"trim(regexp_replace(lower(x), {_quoted(PUNCTUATION)}, ' ', 'g'))"
    for a, b in SPELLINGS:
        flat = f"replace({flat}, '{a}', '{b}')"
    line = f"CASE WHEN regexp_matches(lower(x), {_quoted(COPYRIGHT_LINE)}) THEN '' ELSE {flat} END"
    return f"list_filter(list_transform(string_split(coalesce({text}, ''), chr(10)), lambda x: {line}), lambda x: x <> '')"


_KNOWN = (
    [(n, t) for n, _, t in LICENCES] + [(n, f"{title}\n{t}") for n, title, t in LICENCES if title] + NOTICES
)
ORACLES["op1_license_scan"] = f"""
WITH known AS (
  SELECT DISTINCT license, array_to_string({_canonical_sql("text")}, ' ') AS canonical
  FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in _KNOWN)}) AS v(license, text)
), d AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_canonical_sql("text")} AS lines FROM documents
), n AS (
  SELECT row_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT row_id, unnest(lines) AS line FROM d) JOIN known ON line = canonical GROUP BY row_id
)
SELECT doc_id, sha256(array_to_string(lines, ' ')) AS canonical_digest, license, coalesce(notices, '') AS notices
FROM d LEFT JOIN known ON array_to_string(lines, ' ') = canonical LEFT JOIN n USING (row_id)
"""


# Pairs of different sets by their shingles in common, and what each can reach by links.
ORACLES["op9_ngram_jaccard_join"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{_WORDS}') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                 END AS sh
  FROM d
), k AS (
  SELECT doc_id, sh, md5(array_to_string(list_sort(sh), chr(10))) AS same FROM s
), c AS (
  SELECT same, min(doc_id) AS rep, any_value(sh) AS sh, len(any_value(sh)) AS n FROM k WHERE len(sh) > 0 GROUP BY same
), e AS (
  SELECT rep, n, unnest(sh) AS x FROM c
), p AS (
  SELECT a.rep AS x, b.rep AS y
  FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), q AS (
  SELECT x, y FROM p UNION ALL SELECT y, x FROM p
), r AS (
  SELECT rep AS a, rep AS b FROM c
  UNION
  SELECT r.a, q.y FROM r JOIN q ON q.x = r.b
), g AS (
  SELECT a AS rep, min(b) AS component_id FROM r GROUP BY a
)
SELECT k.doc_id, CAST(len(k.sh) AS BIGINT) AS n_shingles, coalesce(g.component_id, k.doc_id) AS component_id
FROM k LEFT JOIN c ON c.same = k.same AND len(k.sh) > 0 LEFT JOIN g ON g.rep = c.rep
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
