"""DuckDB SQL for the queries that SQL can express."""

_OP4 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p
), f AS (
  SELECT hex, payload_bytes, min(page_id) AS first_id FROM d GROUP BY hex, payload_bytes
)
SELECT d.page_id, d.payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST(list_sum(list_transform(range(5), lambda j:
        CAST(substr(CAST(CAST(unhex(d.hex) AS BIT) AS VARCHAR), CAST(5 * i + j + 1 AS BIGINT), 1) AS INTEGER) * (16 // CAST(2 ** j AS INTEGER))
      )) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN d.page_id = f.first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN d.page_id <> f.first_id THEN f.first_id END AS refers_to
FROM d JOIN f USING (hex, payload_bytes)
"""

_OP9 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *,
    length(replace(replace(replace(replace(role, '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>'), '### ', '\### ')) AS role_chars,
    length(replace(replace(replace(replace(text, '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>'), '### ', '\### ')) AS text_chars
  FROM c
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum(role_chars + text_chars + 15) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""

_FINITE = "list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))"

_OP11 = f"""
WITH e AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND coalesce({_FINITE}, true)
), s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.n <> c.n
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def _op12(rounds: int = 6) -> str:
    """Rounds of assign and average, written out; components are rows (n, part, place, x)."""
    near = """
SELECT n, part, entry, d FROM (
  SELECT p.n, p.part, b.entry, d, row_number() OVER (PARTITION BY p.n, p.part ORDER BY d, b.entry) AS place
  FROM p JOIN {book} b USING (part), LATERAL (
    SELECT list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d)
) WHERE place = 1"""
    steps = [
        f"""
WITH e AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER () AS n,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND coalesce({_FINITE}, true)
), p AS MATERIALIZED (
  SELECT n, part, v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)] AS x FROM e, range(8) AS t(part)
), first AS (
  SELECT n, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM e
), b0 AS MATERIALIZED (
  SELECT part, entry, x FROM p JOIN first USING (n) WHERE entry < 16
)"""
    ]
    for i in range(rounds):
        steps.append(
            f"""a{i} AS MATERIALIZED ({near.format(book=f"b{i}")}
), s{i} AS (
  SELECT part, entry, j, CAST(floor_div(sum(x[j]), count(*)) AS BIGINT) AS x
  FROM p JOIN a{i} USING (n, part), range(1, 1025) AS t(j) WHERE j <= len(x) GROUP BY part, entry, j
), b{i + 1} AS MATERIALIZED (
  SELECT o.part, o.entry, coalesce(m.x, o.x) AS x
  FROM b{i} o LEFT JOIN (SELECT part, entry, list(x ORDER BY j) AS x FROM s{i} GROUP BY part, entry) m USING (part, entry)
)"""
        )
    steps.append(
        f"""z AS ({near.format(book=f"b{rounds}")}
), c AS (
  SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY n
), h AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM e JOIN c USING (n), h
"""
    )
    return ", ".join(steps).replace(
        "floor_div(sum(x[j]), count(*))",
        # Integer division cuts towards zero.
        "sum(x[j]) // count(*) - CASE WHEN sum(x[j]) < 0 AND sum(x[j]) % count(*) <> 0 THEN 1 ELSE 0 END",
    )


_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS MATERIALIZED (
  SELECT n, lang, source, term, count(*) AS c
  FROM (SELECT n, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)
  GROUP BY ALL
), kept AS MATERIALIZED (
  SELECT lang, term, CAST(sum(c) AS HUGEINT) AS c FROM w GROUP BY lang, term HAVING count(*) >= 30
), l AS (
  SELECT lang, count(*) AS v, sum(c) AS total FROM kept GROUP BY lang
), g AS MATERIALIZED (
  SELECT DISTINCT lang, source FROM d
), k AS MATERIALIZED (
  SELECT w.lang, w.source, w.term, CAST(sum(w.c) AS HUGEINT) AS c FROM w JOIN kept USING (lang, term) GROUP BY ALL
), t AS (
  SELECT lang, source, sum(c) AS total FROM k GROUP BY ALL
), r AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(k.c, 0) AS c,
    1 + (1000000000 * (coalesce(k.c, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
    1 + (1000000000 * (kept.c + 5)) // (l.total + 5 * l.v) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN t USING (lang, source)
    LEFT JOIN k ON k.lang = g.lang AND k.source = g.source AND k.term = kept.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM r a JOIN r b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM r WHERE c > 0 AND p > q
), x AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM f
)
SELECT * FROM x WHERE part = 'pair' OR rank <= 50
"""

ORACLES = {
    "op4_warc_roundtrip": _OP4,
    "op9_chat_format": _OP9,
    "op11_exact_topk": _OP11,
    "op12_vector_codes": _op12(),
    "op13_source_divergence": _OP13,
}
