"""Registered operators in SQL, for a side-by-side check on the same tables. What is missing is tested against brute force."""

from __future__ import annotations

from vecframe.llm.centroid_clusters import CLUSTERS, DIMENSION, ROUNDS, SCALE
from vecframe.llm.near_vectors import COSINE
from vecframe.llm.ngram_join import THRESHOLD, WORDS
from vecframe.llm.secrets import RULES
from vecframe.llm.vector_codes import ENTRIES, PARTS
from vecframe.llm.vector_codes import ROUNDS as CODE_ROUNDS
from vecframe.llm.vector_codes import SCALE as CODE_SCALE


def _components(key: str, table: str, pairs: str, class_name: str) -> str:
    """Links and components of ``pairs`` (a, b) with a < b."""
    return f"""
    links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
    reach AS (
      SELECT {key} AS node, {key} AS met FROM {table}
      UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.met
    ),
    roots AS (SELECT node, min(met) AS root FROM reach GROUP BY node),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT t.{key}, coalesce(n, 0) AS n_links, root AS {class_name}, t.{key} = root AS kept
    FROM {table} t JOIN roots ON node = t.{key} LEFT JOIN counts ON a = t.{key}
    """


NGRAM_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, w[i:i + {WORDS - 1}] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL
), pairs AS (
  SELECT a, b FROM shared s JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE s.n >= {THRESHOLD} * (p.n + q.n - s.n) - 1e-9
), {_components('doc_id', 'documents', 'pairs', 'class_id').strip()}
"""

NEAR_VECTORS = f"""
WITH RECURSIVE pairs AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id < y.vec_id
  WHERE list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) >= {COSINE}
), {_components('vec_id', 'embeddings', 'pairs', 'component_id').strip()}
"""


def _spans(number: int) -> str:
    rule = RULES[number]
    pattern = rule.pattern.replace("'", "''")
    return f"""
    SELECT doc_id, '{rule.kind}' AS kind, {number} AS kind_no, stop - length(match) AS start, stop
    FROM (
      SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
      FROM (
        SELECT doc_id, unnest(matches) AS match, unnest(gaps[1:len(matches)]) AS gap, unnest(measured) AS measured, generate_subscripts(matches, 1) AS i
        FROM (
          SELECT doc_id, regexp_extract_all(text, '{pattern}') AS matches, string_split_regex(text, '{pattern}') AS gaps,
                 regexp_extract_all(text, '{pattern}', {rule.group}) AS measured
          FROM documents))
    ) WHERE length(measured) >= {rule.least}
    """


SECRETS = f"""
WITH spans AS ({" UNION ALL ".join(_spans(i) for i in range(len(RULES)))}), joined AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES)},
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES)}, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined USING (doc_id)
"""

FINITE = "len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"
GAP = "list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"


def _whole(scale: int, columns: str) -> str:
    return f"SELECT row_number() OVER () AS row, {columns}, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {FINITE}"


def _lloyd(rounds: int, source: str, part: str = "") -> str:
    """Rounds of assignments a0, a1, ... and centres c1, c2, ... over rows (row, v) of ``source`` from centres c0 (c, v), apart by column ``part``."""
    same, by, of = (f"USING ({part})", f"{part}, ", f"a.{part} = x.{part} AND ") if part else ("ON true", "", "")
    steps = []
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT {by}row, min({{'d': {GAP}, 'c': c.c}}) AS best FROM {source} x JOIN c{r} c {same} GROUP BY {by}row)")
        if r < rounds:
            steps.append(f"""
            m{r} AS (
              SELECT {by}c, list(mean ORDER BY pos) AS v FROM (
                SELECT {by}c, pos, floor(sum(n)::DOUBLE / count(*))::BIGINT AS mean
                FROM (SELECT {'x.' + by if part else ''}a.best.c AS c, unnest(x.v) AS n, generate_subscripts(x.v, 1) AS pos FROM {source} x JOIN a{r} a ON {of}a.row = x.row)
                GROUP BY {by}c, pos) GROUP BY {by}c
            ), c{r + 1} AS MATERIALIZED (SELECT {by}c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} m USING ({by}c))""")
    return ", ".join(steps)


CENTROID_CLUSTERS = f"""
WITH kept AS MATERIALIZED (SELECT * FROM ({_whole(SCALE, 'vec_id')}) WHERE len(v) = {DIMENSION}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept QUALIFY c < {CLUSTERS}),
{_lloyd(ROUNDS, 'kept')}
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
       sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept JOIN a{ROUNDS} USING (row) JOIN c{ROUNDS} c ON c.c = best.c
"""

VECTOR_CODES = f"""
WITH kept AS MATERIALIZED ({_whole(CODE_SCALE, 'vec_id, label')}),
pieces AS MATERIALIZED (SELECT row, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS v FROM kept, range({PARTS}) t(p)),
c0 AS MATERIALIZED (
  SELECT p, c, v FROM pieces JOIN (SELECT row, row_number() OVER (ORDER BY vec_id, v) - 1 AS c FROM kept QUALIFY c < {ENTRIES}) USING (row)
),
{_lloyd(CODE_ROUNDS, 'pieces', 'p')},
coded AS (SELECT row, string_agg(printf('%02x', best.c), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{CODE_ROUNDS} GROUP BY row)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, c)) FROM c{CODE_ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (row)
"""

ORACLE = {"op1_ngram_join": NGRAM_JOIN, "op2_near_vectors": NEAR_VECTORS, "op7_secrets": SECRETS, "op12_centroid_clusters": CENTROID_CLUSTERS, "op13_vector_codes": VECTOR_CODES}
