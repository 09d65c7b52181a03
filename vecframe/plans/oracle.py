"""The registered queries in SQL, for a side-by-side check on the same tables."""

from __future__ import annotations

from vecframe.functions.text import SPECIAL_TOKENS
from vecframe.plans.corpus import TOP_N
from vecframe.plans.queries import FEW, INTEGER_RANGES, LEAST_COUNT

SIMILARITY = {
    "cosine": ("list_cosine_similarity", "DESC"),
    "dot_product": ("list_inner_product", "DESC"),
    "euclidean": ("list_distance", "ASC"),
}


def _knn(metric: str = "cosine", keep: str = "true", join: str = "true", columns: str = "", k: str = "10") -> str:
    function, direction = SIMILARITY[metric]
    return f"""
    SELECT query_id, CAST(rank AS INTEGER) AS rank, "key", round(score, 6) AS score{columns}
    FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {direction}, "key") AS rank
      FROM (
        SELECT q.vec_id AS query_id, e.vec_id AS "key", e.label AS label, e.embedding AS embedding,
               {function}(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS score
        FROM embeddings q JOIN embeddings e ON {join}
      ) WHERE {keep}
    ) WHERE rank <= {k}
    """


KNN_SINGLE = """
WITH mean AS (
  SELECT list(m::FLOAT ORDER BY pos) AS v FROM (
    SELECT pos, avg(embedding[pos]::DOUBLE) AS m
    FROM embeddings, generate_series(1, 64) g(pos) GROUP BY pos)
)
SELECT CAST(row_number() OVER (ORDER BY score DESC, "key") AS INTEGER) AS rank, "key", round(score, 6) AS score
FROM (SELECT vec_id AS "key", list_cosine_similarity(v::DOUBLE[], embedding::DOUBLE[]) AS score FROM embeddings, mean)
ORDER BY score DESC, "key" LIMIT 10
"""

KNN_FILTER_ID = """
SELECT q.vec_id AS query_id, CASE WHEN e.vec_id IS NULL THEN NULL ELSE 1 END AS rank, e.vec_id AS "key",
       round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS score
FROM embeddings q LEFT JOIN embeddings e ON e.vec_id = q.vec_id + q.label
"""

KNN_MIXED = """
WITH asked AS (
  SELECT vec_id, embedding, label + 1 AS k,
    CASE WHEN label < 4 THEN 'cosine' WHEN label < 7 THEN 'dot_product' ELSE 'euclidean' END AS metric,
    CASE WHEN label = 0 THEN 2.0 WHEN label < 3 THEN 0.25 END AS low,
    CASE WHEN label = 9 THEN 1.2 END AS far,
    CASE WHEN label = 5 THEN 'nowhere' WHEN label < 5 THEN 'all' ELSE 'odd' END AS collection
  FROM embeddings
), pairs AS (
  SELECT a.vec_id AS query_id, a.k, a.metric, a.low, a.far, e.vec_id AS "key",
    CASE a.metric WHEN 'cosine' THEN list_cosine_similarity(a.embedding::DOUBLE[], e.embedding::DOUBLE[])
      WHEN 'dot_product' THEN list_inner_product(a.embedding::DOUBLE[], e.embedding::DOUBLE[])
      ELSE list_distance(a.embedding::DOUBLE[], e.embedding::DOUBLE[]) END AS score
  FROM asked a JOIN embeddings e ON a.collection = 'all' OR (a.collection = 'odd' AND e.label IN (1, 3, 5, 7, 9))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id
    ORDER BY CASE WHEN metric = 'euclidean' THEN score ELSE -score END, "key") AS rank
  FROM pairs
  WHERE (low IS NULL OR score >= low) AND (far IS NULL OR score <= far) AND query_id % 7 NOT IN (3, 5)
)
SELECT a.vec_id AS query_id, CAST(rank AS INTEGER) AS rank, "key", round(score, 6) AS score
FROM asked a LEFT JOIN (SELECT * FROM ranked WHERE rank <= k) r ON r.query_id = a.vec_id
"""

FETCH = """
SELECT c.conv_id * 3 AS vec_id, e.vec_id IS NOT NULL AS found, e.label, CAST(len(e.embedding) AS INTEGER) AS dimension
FROM conversations c LEFT JOIN embeddings e ON e.vec_id = c.conv_id * 3
"""

SIGN_HITS = """
WITH signs AS (
  SELECT vec_id, [CASE WHEN x >= 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END FOR x IN embedding] AS v FROM embeddings
), hits AS (
  SELECT query_id, "key", row_number() OVER (PARTITION BY query_id ORDER BY score DESC, "key") AS rank FROM (
    SELECT q.vec_id AS query_id, e.vec_id AS "key", list_inner_product(q.v, e.v) AS score FROM signs q, signs e)
), truth AS (
  SELECT query_id, "key" FROM (
    SELECT q.vec_id AS query_id, e.vec_id AS "key", row_number() OVER (PARTITION BY q.vec_id
      ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) DESC, e.vec_id) AS rank
    FROM embeddings q, embeddings e) WHERE rank <= 10
), found AS (
  SELECT t.query_id, count(h.rank) AS n, count(*) AS wanted, coalesce(sum(1 / log2(h.rank + 1)), 0) AS gain
  FROM truth t LEFT JOIN (SELECT * FROM hits WHERE rank <= 10) h ON h.query_id = t.query_id AND h."key" = t."key"
  GROUP BY t.query_id
)
"""

RECALL = SIGN_HITS + "SELECT round(avg(n / wanted), 6) AS recall, count(*) AS queries FROM found"
NDCG = SIGN_HITS + """
SELECT round(avg(gain / (SELECT sum(1 / log2(i + 1)) FROM generate_series(1, wanted) s(i))), 6) AS ndcg,
       count(*) AS queries FROM found
"""


def _elements(key: str, value: str, source: str, name: str | None = None) -> str:
    return f"""
    SELECT {key} AS {name or key}, CAST(pos - 1 AS INTEGER) AS pos, round(({value})[pos]::DOUBLE, 6) AS value
    FROM {source}, generate_series(1, 64) g(pos)
    """


NORMALIZED = """
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos,
  round((x / greatest(sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 1e-9))::FLOAT::DOUBLE, 6) AS value
FROM (SELECT vec_id, pos, (embedding[pos] * label::FLOAT)::DOUBLE AS x FROM embeddings, generate_series(1, 64) g(pos))
"""

VECTOR_MEAN = """
SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(avg(embedding[pos]::DOUBLE), 6) AS value
FROM embeddings, generate_series(1, 64) g(pos) GROUP BY label, pos
"""

PROFILE = """
SELECT 'detected' AS state, 'vec_id' AS id_field, 'embedding' AS vector_field,
       CAST(max(len(embedding)) AS INTEGER) AS dimension, count(*) AS samples_analyzed, 0::BIGINT AS pending_count
FROM embeddings HAVING count(DISTINCT vec_id) = count(*) AND min(len(embedding)) = max(len(embedding))
"""

_GROWN = [("embeddings", "vec_id", "embedding", key) for key in ("vec_id % 2 = 0", "true")] + [("documents", "doc_id", None, key) for key in ("doc_id % 2 = 0", "true")]
PROFILE_FILES = " UNION ALL ".join(
    f"""
    SELECT CASE WHEN keys AND vectors THEN 'detected' ELSE 'analyzing' END AS state, CASE WHEN keys THEN '{key}' END AS id_field,
           CASE WHEN vectors THEN '{vector}' END AS vector_field, CASE WHEN vectors THEN dimension END AS dimension, n AS samples_analyzed, {int(rows != 'true')}::BIGINT AS pending_count
    FROM (SELECT count({key}) = count(*) AND count(DISTINCT {key}) >= 0.9 * count(*) AS keys, {f"min(len({vector})) = max(len({vector}))" if vector else "false"} AS vectors,
                 CAST({f"max(len({vector}))" if vector else "NULL"} AS INTEGER) AS dimension, count(*) AS n FROM {name} WHERE {rows})
    """
    for name, key, vector, rows in _GROWN
)

MIRROR_ID = """
SELECT vec_id AS "key", CASE WHEN label = 0 THEN 'own' ELSE CAST(vec_id AS VARCHAR) END AS id,
  CASE WHEN label BETWEEN 1 AND 4 THEN CAST(label AS VARCHAR) END AS label,
  CAST(CASE WHEN label BETWEEN 1 AND 4 THEN 2 ELSE 1 END AS INTEGER) AS entries
FROM embeddings
"""

PROMOTE_KEY = """
SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN CAST(doc_id AS VARCHAR) ELSE md5(CAST(doc_id AS VARCHAR)) END AS "key",
  lang IN ('en', 'de') AS has_metadata, CASE WHEN lang IN ('en', 'de') THEN lang END AS lang
FROM documents
"""

FILES = """
WITH files AS (
  SELECT doc_id AS "key", 0::BIGINT AS seq, n_chars::DOUBLE AS value, source AS source_file FROM documents
)
"""

UPSERT = FILES + """
SELECT "key", seq, value, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY "key" ORDER BY seq DESC) AS place FROM (
    SELECT * FROM files UNION ALL
    SELECT conv_id, turn + 1, length(text)::DOUBLE, role FROM conversations)
) WHERE place = 1
"""

UPDATE = FILES + """
SELECT f."key", CASE WHEN o.o_orderkey IS NULL THEN f.seq ELSE 1 END AS seq,
       coalesce(o.o_totalprice, f.value) AS value, f.source_file
FROM files f LEFT JOIN orders o ON o.o_orderkey = f."key"
"""

UPDATE_REPORT = FILES + """
SELECT f.source_file, count(*) AS updated FROM orders o LEFT JOIN files f ON o.o_orderkey = f."key" GROUP BY f.source_file
"""

DELETE_IDS = FILES + 'SELECT * FROM files WHERE "key" NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)'
DELETE_REPORT = FILES + """
SELECT source_file, count(*) AS deleted FROM files
WHERE "key" IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY source_file
"""
DELETE_FILE = FILES + "SELECT * FROM files WHERE source_file <> 'src3'"
REPLACE_FILE = FILES + """
SELECT * FROM files WHERE source_file <> 'src3' AND "key" NOT IN (SELECT page_id FROM pages)
UNION ALL SELECT page_id, 1, length(html)::DOUBLE, 'src3' FROM pages
"""

IDEMPOTENT_APPEND = """
WITH incoming AS (
  SELECT source || '-' || lang AS name, sum(n_chars)::BIGINT AS size FROM documents GROUP BY ALL
), loaded AS (
  SELECT source || '-' || lang AS name, sum(n_chars)::BIGINT AS size FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY ALL
)
SELECT i.name, i.size, CASE WHEN l.name IS NULL THEN 'load' WHEN l.size = i.size THEN 'skip' ELSE 'conflict' END AS action
FROM incoming i LEFT JOIN loaded l ON l.name = i.name
"""

APPEND_FILES = IDEMPOTENT_APPEND.rsplit("SELECT", 1)[0] + """, actions AS (
  SELECT i.name, CASE WHEN l.name IS NULL THEN 'load' WHEN l.size = i.size THEN 'skip' ELSE 'conflict' END AS action
  FROM incoming i LEFT JOIN loaded l ON l.name = i.name
), turns AS (
  SELECT conv_id AS "key", max(turn) AS seq, 0.0::DOUBLE AS value, 'turns' AS source_file, 0 AS late FROM conversations GROUP BY conv_id
), rows AS (
  SELECT doc_id AS "key", 0::BIGINT AS seq, n_chars::DOUBLE AS value, source || '-' || lang AS source_file FROM documents
)
SELECT "key", seq, value, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY "key" ORDER BY seq DESC, late) AS place FROM (
    SELECT * FROM turns
    UNION ALL SELECT *, 0 FROM rows WHERE "key" IN (SELECT doc_id FROM labels) AND "key" NOT IN (SELECT "key" FROM turns)
    UNION ALL SELECT *, 1 FROM rows WHERE source_file IN (SELECT name FROM actions WHERE action = 'load'))
) WHERE place = 1
"""

NEWEST = """
WITH newest AS (
  SELECT user_id AS "key", event_id AS seq, event_type AS op, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events {where}
  ) WHERE place = 1
)
"""

MERGE = NEWEST + """
SELECT c_custkey AS "key", -1::BIGINT AS seq, c_acctbal AS value FROM customer
WHERE c_custkey NOT IN (SELECT "key" FROM newest)
UNION ALL SELECT "key", seq, value FROM newest WHERE op <> 'error'
"""

LIST_FILES = NEWEST.format(where="") + """
SELECT source AS name, count(*) AS vector_count, false AS is_wal FROM documents GROUP BY source
UNION ALL SELECT '__wal__', count(*), true FROM newest WHERE op <> 'error'
"""

STATS = """
SELECT 'embeddings' AS name, count(*) AS vector_count, CAST(max(len(embedding)) AS INTEGER) AS dimension,
       CAST(coalesce(sum(len(embedding)), 0) * 4 AS BIGINT) AS vector_bytes FROM embeddings
UNION ALL
SELECT 'unlabelled', count(*), CAST(max(len(embedding)) AS INTEGER), CAST(coalesce(sum(len(embedding)), 0) * 4 AS BIGINT)
FROM embeddings WHERE label IS NULL
"""

SPACE = r"[\s\x1C-\x1F\x{85}\p{Z}]"


def _normalized(text: str) -> str:
    bare = rf"regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}_\s\x1C-\x1F\x{{85}}\p{{Z}}]', '', 'g')"
    return f"trim(regexp_replace({bare}, '{SPACE}+', ' ', 'g'))"


def _truncated(text: str) -> str:
    cut = f"substr({text}, 1, 800)"
    from_end = f"instr(reverse({cut}), ' ')"
    return f"""CASE WHEN length({text}) <= 800 THEN {text}
      WHEN {from_end} > 0 AND 800 - {from_end} > 700 THEN substr({cut}, 1, 800 - {from_end}) || ' …'
      ELSE {cut} || ' …' END"""


TEXTS = f"""
WITH texts AS (
  SELECT doc_id, text, source, CAST(1900 + n_chars % 120 AS INTEGER) AS year, lang, {_normalized('text')} AS title_norm
  FROM documents
), wanted AS (
  SELECT * FROM texts WHERE lang IN ('en', 'es') AND length(text) >= 200 AND text IS NOT NULL
), popular AS (
  SELECT title_norm, year, popularity FROM (
    SELECT t.title_norm, t.year, quality * 1000 + d.n_chars % 97 AS popularity,
      row_number() OVER (PARTITION BY t.title_norm, t.year ORDER BY quality * 1000 + d.n_chars % 97 DESC, d.doc_id) AS place
    FROM texts t JOIN labels l ON l.doc_id = t.doc_id JOIN documents d ON d.doc_id = t.doc_id
  ) WHERE place = 1
), joined AS (
  SELECT * FROM (
    SELECT w.*, p.popularity, row_number() OVER (PARTITION BY w.title_norm, w.year ORDER BY w.doc_id) AS place
    FROM wanted w JOIN popular p ON p.title_norm = w.title_norm AND p.year = w.year
  ) WHERE place = 1
), best AS (
  SELECT *, row_number() OVER (ORDER BY popularity DESC, doc_id) AS n FROM joined
  ORDER BY popularity DESC, doc_id LIMIT {TOP_N}
), corpus AS (
  SELECT format('film-{{:05d}}', n - 1) AS id, regexp_replace(text, '^{SPACE}+|{SPACE}+$', '', 'g') AS title, year,
         source AS genre, {_truncated('text')} AS plot
  FROM best
)
"""

DEDUP = TEXTS + """
SELECT doc_id, year FROM (
  SELECT *, row_number() OVER (PARTITION BY title_norm, year ORDER BY doc_id) AS place FROM texts) WHERE place = 1
"""

TOKEN = r"[!-/:-@\[-`{-~\p{P}]|[^ \t\n\r\p{Zs}!-/:-@\[-`{-~\p{P}]+"


def _tokens(text: str) -> str:
    clean = rf"regexp_replace(replace(replace(replace({text}, chr(9), ' '), chr(10), ' '), chr(13), ' '), '\p{{C}}|�', '', 'g')"
    return f"regexp_extract_all(strip_accents(lower({clean})), '{TOKEN}')"


TOKEN_COUNTS = f"""
SELECT token, count(*) AS n FROM (SELECT unnest({_tokens('text')}) AS token FROM documents) GROUP BY token
"""


# Every character is a piece, so no word is unknown but the longest; the best piece at each place of
# each distinct token is found first, and a recursion walks over them.
WORDPIECES = f"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, unnest(list) AS token, generate_subscripts(list, 1) AS place
  FROM (SELECT doc_id, {_tokens('text')} AS list FROM documents)
), counts AS (
  SELECT token, count(*) AS n FROM tokens GROUP BY token
), letters AS (
  SELECT DISTINCT unnest(string_split(token, '')) AS c FROM counts
), pieces AS (
  SELECT 0 AS part, i AS r, piece FROM (SELECT unnest({SPECIAL_TOKENS}) AS piece, unnest(range({len(SPECIAL_TOKENS)})) AS i)
  UNION ALL SELECT 1, row_number() OVER (ORDER BY c), c FROM letters WHERE c <> ''
  UNION ALL SELECT 2, row_number() OVER (ORDER BY c), '##' || c FROM letters WHERE c <> ''
  UNION ALL SELECT * FROM (
    SELECT 3, row_number() OVER (ORDER BY n DESC, token) AS r, token FROM counts WHERE n >= {LEAST_COUNT})
), vocabulary AS (
  SELECT piece, CAST(row_number() OVER (ORDER BY part, r) - 1 AS INTEGER) AS id
  FROM (SELECT *, row_number() OVER (PARTITION BY piece ORDER BY part, r) AS copy FROM pieces) WHERE copy = 1
), best AS (
  SELECT token, start, max(size) AS size, arg_max(id, size) AS id
  FROM (
    SELECT token, start, size, CASE WHEN start > 1 THEN '##' ELSE '' END || substr(token, start, size) AS piece
    FROM counts, generate_series(1, length(token)) s(start), generate_series(1, length(token) - start + 1) l(size)
    WHERE length(token) <= 100
  ) JOIN vocabulary USING (piece) GROUP BY token, start
), steps AS (
  SELECT token, list(size ORDER BY start) AS sizes, list(id ORDER BY start) AS found FROM best GROUP BY token
), walk AS (
  SELECT token, 1::BIGINT AS start, sizes, found, []::INTEGER[] AS ids FROM steps
  UNION ALL
  SELECT token, start + sizes[start], sizes, found, list_append(ids, found[start]) FROM walk WHERE start <= len(sizes)
), split AS (
  SELECT token, ids FROM walk WHERE start = len(sizes) + 1
  UNION ALL SELECT token, [1::INTEGER] FROM counts WHERE length(token) > 100
), rows AS (
  SELECT doc_id, (list_concat([2], coalesce(flatten(list(ids ORDER BY place) FILTER (ids IS NOT NULL)), []), [3]))[1:256] AS ids
  FROM documents LEFT JOIN tokens USING (doc_id) LEFT JOIN split USING (token) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids, array_to_string(ids, ' ') AS ids FROM rows
"""


def _embedded(name: str, source: str, key: str, text: str) -> str:
    """Tables ``<name>_slots`` (key, slot, value) of non-zero elements and ``<name>_vectors`` (key, v)."""
    return f"""
    {name}_codes AS (
      SELECT {key}, ('0x' || substr(h, 1, 8))::BIGINT % 384 AS slot,
             CASE WHEN ('0x' || substr(h, 9, 1))::INTEGER < 8 THEN 1 ELSE -1 END AS sign
      FROM (SELECT {key}, md5(unnest({_tokens(text)})) AS h FROM {source})
    ), {name}_sums AS (
      SELECT {key}, slot, sum(sign)::DOUBLE AS s FROM {name}_codes GROUP BY ALL HAVING sum(sign) <> 0
    ), {name}_slots AS (
      SELECT {key}, slot, (s / greatest(sqrt(sum(s * s) OVER (PARTITION BY {key})), 1e-9))::FLOAT AS value
      FROM {name}_sums
    ), {name}_vectors AS (
      SELECT k.{key}, list(coalesce(v.value, 0::FLOAT)::DOUBLE ORDER BY g.slot) AS v
      FROM {source} k CROSS JOIN generate_series(0, 383) g(slot)
      LEFT JOIN {name}_slots v ON v.{key} = k.{key} AND v.slot = g.slot GROUP BY k.{key}
    )"""


EMBED = f"""
WITH {_embedded('d', 'documents', 'doc_id', 'text')}
SELECT doc_id, CAST(slot AS INTEGER) AS pos, round(value::DOUBLE, 6) AS value FROM d_slots WHERE round(value::DOUBLE, 6) <> 0
"""

TEXT_SEARCH = f"""
WITH {_embedded('d', 'documents', 'doc_id', 'text')}, {_embedded('b', 'benchmark', 'item_id', 'text')},
scored AS (
  SELECT item_id AS query_id, doc_id AS "key",
    CASE WHEN list_inner_product(b.v, b.v) = 0 OR list_inner_product(d.v, d.v) = 0 THEN 0.0
      ELSE list_cosine_similarity(b.v, d.v) END AS score
  FROM b_vectors b, d_vectors d
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, "key", round(score, 6) AS score, lang, source
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, "key") AS rank FROM scored)
JOIN documents ON doc_id = "key" WHERE rank <= 10
"""

CORPUS = TEXTS.rstrip() + f""",
{_embedded('c', 'corpus', 'id', 'plot')}
SELECT id, title, year, genre, plot, 384 AS dimension,
       round(list_inner_product(v, range(1, 385)::DOUBLE[]), 4) AS checksum
FROM corpus JOIN c_vectors USING (id)
"""

VALIDATE = TEXTS + """
SELECT 0::BIGINT AS wrong_columns, CAST(CASE WHEN count(*) BETWEEN 4000 AND 6000 THEN 0 ELSE 1 END AS BIGINT) AS row_count_outside,
  0::BIGINT AS wrong_dimension, count(*) FILTER (length(plot) < 100) AS too_short, count(*) FILTER (length(plot) > 1000) AS too_long,
  CAST(CASE WHEN min(year) < 1950 THEN 0 ELSE 1 END AS BIGINT) AS no_early_year,
  CAST(CASE WHEN max(year) >= 2010 THEN 0 ELSE 1 END AS BIGINT) AS no_late_year
FROM corpus
"""

ROWS = "(SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, embedding FROM embeddings)"


def _matrix(format: str) -> str:
    value = "embedding"
    if format in INTEGER_RANGES:
        shift, scale = INTEGER_RANGES[format]
        value = f"[floor((x::DOUBLE + {shift}) * {scale}) FOR x IN embedding]"
    return _elements("id", value, ROWS)


EXPORT = f"""
WITH snapshot AS ({MERGE.format(where="WHERE event_id <= 5000")})
SELECT "key" % 10 AS part, count(*) AS rows, max(seq) AS last, round(max(value::FLOAT::DOUBLE), 2) AS most,
  (SELECT count(*) FROM snapshot) AS vector_count, (SELECT count(*) FROM snapshot) AS part_rows, 2 AS input_dim,
  (SELECT max(seq) FROM snapshot) AS high_water
FROM snapshot GROUP BY "key" % 10
"""


def _few(sql: str) -> str:
    return sql.replace(f"LIMIT {TOP_N}", f"LIMIT {FEW}")


def _mmr(metric: str, trade_off: float) -> str:
    """Five picks, each a step over the rows that are left."""
    function, direction = SIMILARITY[metric]
    sign = "-" if metric == "euclidean" else ""
    steps = []
    for n in range(1, 6):
        worst = f"coalesce((SELECT max(list_cosine_similarity(p.v, h.v)) FROM picked{n - 1} p WHERE p.query_id = h.query_id), 0.0)"
        value = f"{trade_off} * {sign}score - {1 - trade_off} * {worst}" if n > 1 else f"{trade_off} * {sign}score"
        left = f'WHERE NOT EXISTS (SELECT 1 FROM picked{n - 1} p WHERE p.query_id = h.query_id AND p."key" = h."key")' if n > 1 else ""
        before = f"SELECT * FROM picked{n - 1} UNION ALL " if n > 1 else ""
        steps.append(
            f"""picked{n} AS MATERIALIZED ({before}SELECT query_id, {n} AS place, "key", score, v FROM (
            SELECT h.*, row_number() OVER (PARTITION BY query_id ORDER BY {value} DESC, rank) AS best FROM hits h {left}) WHERE best = 1)"""
        )
    return f"""
    WITH hits AS MATERIALIZED (SELECT * FROM (
      SELECT q.vec_id AS query_id, e.vec_id AS "key", e.embedding::DOUBLE[] AS v,
        {function}(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS score,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY {function}(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) {direction}, e.vec_id) AS rank
      FROM embeddings q, embeddings e) WHERE rank <= 20
    ), {", ".join(steps)}
    SELECT query_id, CAST(place AS INTEGER) AS rank, "key", round(score, 6) AS score FROM picked5
    """


ORACLE: dict[str, str] = {
    "knn_cosine": _knn(),
    "knn_dot": _knn("dot_product"),
    "knn_euclidean": _knn("euclidean"),
    "knn_single": KNN_SINGLE,
    "knn_filtered": _knn(join="e.label = 3"),
    "knn_filter_id": KNN_FILTER_ID,
    "knn_typed_filter": _knn(join="e.label = 3 AND e.vec_id % 2 = 0", columns=', CAST("key" AS VARCHAR) AS id, label'),
    "knn_min_score": _knn(keep="score >= 0.25"),
    "knn_join": _knn(join="e.label = q.label"),
    "knn_mixed": KNN_MIXED,
    "knn_with_payload": _knn(columns=", label, round(list_sum(embedding::DOUBLE[]), 6) AS vector_sum"),
    "knn_ivf": _knn(),
    "knn_pca_full": _knn(),
    "knn_index_cells": _knn(columns=", label"),
    "knn_index_filtered": _knn(join="e.label = q.label"),
    "knn_index_pca": _knn("dot_product"),
    "knn_exact_pruned": _knn(),
    "knn_exact_pruned_dot": _knn("dot_product"),
    "knn_exact_pruned_l2": _knn("euclidean"),
    "knn_lsh_l2": f"""
    SELECT query_id, count(*) AS hits, min("key") FILTER (rank = 1) AS first, true AS exact, true AS reached FROM ({_knn("euclidean")}) GROUP BY query_id
    """,
    "search_target": "SELECT true AS reached, count(*) AS queries FROM embeddings",
    "mmr": _mmr("cosine", 0.7),
    "mmr_dot": _mmr("dot_product", 0.5),
    "mmr_euclidean": _mmr("euclidean", 0.7),
    "fetch_keys": FETCH,
    "fetch_stored_keys": FETCH.replace("c.conv_id * 3", "c.item_id * 20").replace("FROM conversations c", "FROM benchmark c"),
    "recall_at_k": RECALL,
    "ndcg_at_k": NDCG,
    "coerce_vectors": _elements(
        "vec_id", "CASE WHEN label > 0 THEN embedding ELSE [0::FLOAT FOR x IN embedding] END", "embeddings"
    ),
    "normalize_vectors": NORMALIZED,
    "vector_mean": VECTOR_MEAN,
    "profile_schema": PROFILE,
    "profile_files": PROFILE_FILES,
    "confirm_schema": """SELECT vec_id AS "key", label, CAST(len(embedding) AS INTEGER) AS dimension,
        embedding[-1]::DOUBLE AS last FROM embeddings""",
    "remap_schema": """SELECT vec_id AS item, label, CAST(len(embedding) AS INTEGER) AS dimension,
        1 AS files_rewritten FROM embeddings""",
    "remap_stored": "SELECT vec_id AS item, label, CAST(len(embedding) AS INTEGER) AS dimension, 1 AS files_rewritten FROM embeddings",
    "mirror_id": MIRROR_ID,
    "promote_key": PROMOTE_KEY,
    "upsert_rows": UPSERT,
    "update_rows": UPDATE,
    "update_report": UPDATE_REPORT,
    "delete_ids": DELETE_IDS,
    "delete_report": DELETE_REPORT,
    "delete_file": DELETE_FILE,
    "replace_file": REPLACE_FILE,
    "idempotent_append": IDEMPOTENT_APPEND,
    "append_files": APPEND_FILES,
    "list_files": LIST_FILES,
    "stored_update": UPDATE,
    "stored_delete": DELETE_IDS,
    "stored_delete_file": DELETE_FILE,
    "stored_replace_file": REPLACE_FILE,
    "stored_files": f"SELECT *, CASE WHEN NOT is_wal THEN true END AS has_size, NOT is_wal AS has_time FROM ({LIST_FILES})",
    "merge_on_read": MERGE.format(where=""),
    "snapshot_at": MERGE.format(where="WHERE event_id <= 5000"),
    "wal_net_count": NEWEST.format(where="") + "SELECT count(*) AS vector_count FROM newest WHERE op <> 'error'",
    "collection_stats": STATS,
    "stream_merge": NEWEST.format(where="") + "SELECT \"key\", seq, value FROM newest WHERE op <> 'error'",
    "stream_replay": NEWEST.format(where="") + "SELECT \"key\", seq, value FROM newest WHERE op <> 'error'",
    "corpus_filter": TEXTS + "SELECT doc_id, year, lang AS origin FROM wanted",
    "dedup_keep_first": DEDUP,
    "corpus_join": TEXTS + "SELECT doc_id, year, popularity FROM joined",
    "top_n": TEXTS + "SELECT doc_id, popularity FROM best",
    "selected_range": TEXTS + "SELECT count(*) AS rows, min(popularity) AS low, max(popularity) AS high FROM best",
    "row_ids": TEXTS + "SELECT format('film-{:05d}', n - 1) AS id, doc_id FROM best",
    "normalize_title": f"SELECT doc_id, {_normalized('text')} AS title_norm FROM documents",
    "truncate_text": f"SELECT doc_id, {_truncated('text')} AS plot FROM documents",
    "token_counts": TOKEN_COUNTS,
    "wordpiece_ids": WORDPIECES,
    "embed_hash": EMBED,
    "text_search": TEXT_SEARCH,
    "corpus_build": CORPUS,
    "top_n_few": _few(TEXTS + "SELECT doc_id, popularity FROM best"),
    "row_ids_few": _few(TEXTS + "SELECT format('film-{:05d}', n - 1) AS id, doc_id FROM best"),
    "corpus_build_few": _few(CORPUS),
    "validate_corpus": VALIDATE,
    "read_csv_vectors": _elements("vec_id", "embedding", "embeddings"),
    "read_jsonl_vectors": _elements("vec_id", "embedding", "embeddings"),
    "read_arrow_vectors": _elements("vec_id", "embedding", "embeddings"),
    **{f"read_{f}": _matrix(f) for f in ("fvecs", "bvecs", "ivecs", "fbin", "u8bin", "i8bin", "npy")},
    "export_manifest": EXPORT,
}
