"""DuckDB SQL with the same rows as the registered queries, where SQL can express them."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1_WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, upper(sha1(coalesce(html, ''))) AS hex FROM pages
), d AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda k:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31)::INTEGER, 1)), '') AS digest,
    min(page_id) OVER (PARTITION BY hex) AS first_id
  FROM p
)
SELECT page_id, octet_length(payload) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""

OP4_JACCARD_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '{WORD}') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY 1
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT a AS node, a AS seen FROM links UNION SELECT a, b FROM links
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.comp, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(seen) AS comp FROM reach GROUP BY 1) c USING (doc_id)
"""

OP6_DECONTAMINATION = f"""
WITH i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({ASCII_LOWER}, '{ALNUM_WORD}') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 13 THEN [w]
    ELSE list_transform(range(1, len(w) - 11), lambda k: w[k:k + 12]) END) AS win FROM i
), d AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '{ALNUM_WORD}') AS w FROM documents
), sizes AS (
  SELECT DISTINCT len(win) AS size FROM win
), place AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS k, w FROM d, sizes WHERE len(w) >= size
), found AS (
  SELECT doc_id, k, place.size, win.item FROM place JOIN win ON w[k:k + place.size - 1] = win.win
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY 1
), items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY 1
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP10_QUALITY_CASCADE = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), f AS (
  SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM f WHERE len(w) >= 3)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win
    JOIN (SELECT doc_id, g FROM win GROUP BY 1, 2 HAVING count(*) >= 2) USING (doc_id, g)
  ) GROUP BY 1
), c AS (
  SELECT doc_id, text, len(w) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    length(text) - length(regexp_replace(text, '[A-Z]+', '', 'g')) AS n_upper,
    length(text) - length(regexp_replace(text, '!+', '', 'g')) AS n_exclaim
  FROM f LEFT JOIN rep USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 5 * n_upper > 2 * length(text)
    OR 10 * n_exclaim > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM b
"""

def _clustering_sql(k: int = 40, rounds: int = 5) -> str:
    parts = [
        f"""kept AS (
  SELECT row_number() OVER () AS r, vec_id, sha256('2:' || vec_id) AS pick,
    list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), entries AS MATERIALIZED (
  SELECT r, unnest(x) AS v, unnest(range(64)) AS d FROM kept
), first AS (
  SELECT row_number() OVER (ORDER BY pick, x) - 1 AS k, x FROM kept ORDER BY pick, x LIMIT {k}
), c0 AS MATERIALIZED (
  SELECT k, unnest(x) AS v, unnest(range(64)) AS d FROM first
)"""
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(distance := distance, k := k)) AS near
  FROM (SELECT r, k, CAST(sum((e.v - c.v) * (e.v - c.v)) AS BIGINT) AS distance
        FROM entries e JOIN c{i} c ON e.d = c.d GROUP BY r, k)
  GROUP BY r
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT k, d, CAST((s - (s % n + n) % n) // n AS BIGINT) AS v
  FROM (SELECT near.k AS k, d, sum(v) AS s, count(*) AS n FROM a{i} JOIN entries USING (r) GROUP BY 1, 2)
  UNION ALL
  SELECT k, d, v FROM c{i} WHERE k NOT IN (SELECT near.k FROM a{i})
)""")
    last = rounds
    return "WITH " + ", ".join(parts) + f"""
, named AS (
  SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY k
)
SELECT vec_id, CAST(near.k AS INTEGER) AS cluster, near.distance AS distance,
  CAST(sum(near.distance) OVER (PARTITION BY near.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(near.distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN named ON named.k = near.k
"""


ORACLE_SQL = {
    "op1_warc": OP1_WARC,
    "op4_jaccard_join": OP4_JACCARD_JOIN,
    "op6_decontamination": OP6_DECONTAMINATION,
    "op10_quality_cascade": OP10_QUALITY_CASCADE,
    "op11_bitplane_clusters": _clustering_sql(),
}
