"""DuckDB SQL for the training-data queries that SQL can express."""

W = r"[^\x20\x09-\x0D]+"

#: Counts of each document (row r), and what the four rules say of them.
COUNTED = rf"""
docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
split AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '{W}') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{W}')) AS lines FROM docs),
grams AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM split WHERE len(w) > 3),
keyed AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM grams),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM keyed) WHERE n > 1),
cover AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, i + unnest([0, 1, 2]) AS p FROM twice) GROUP BY r),
counted AS (
  SELECT s.r, doc_id, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN cover c ON s.r = c.r),
ruled AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
         10 * n_symbols > n_words AS f_symbols, 10 * n_dup_lines > 3 * n_lines AS f_dup_lines,
         (word_chars < 2 * n_words OR word_chars > 20 * n_words) AS f_word_length FROM counted),
failures AS (
  SELECT source, unnest([0, 1, 2, 3]) AS rule,
         unnest([base_failed, f_symbols, f_dup_lines, f_word_length]) AS failed FROM ruled WHERE source IS NOT NULL),
hosts AS (SELECT source, rule, count(*) AS n, sum(failed::INT)::DOUBLE AS f FROM failures GROUP BY source, rule),
moments AS (SELECT rule, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS q FROM hosts GROUP BY rule),
priors AS (SELECT rule, m, CASE WHEN q - m * m > 1e-12 THEN least(greatest(m * (1 - m) / (q - m * m) - 1, 1), 1000) ELSE 1000 END AS s FROM moments),
bad AS (SELECT DISTINCT h.source FROM hosts h JOIN priors p ON h.rule = p.rule WHERE (h.f + p.s * p.m) / (h.n + p.s) > 0.5),
judged AS (SELECT c.*, NOT base_failed AND b.source IS NOT NULL AS host_rejected FROM ruled c LEFT JOIN bad b ON c.source = b.source)
"""

QUALITY = f"""WITH {COUNTED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
       NOT base_failed AND NOT host_rejected AS kept FROM judged"""

NEAR = rf"""WITH RECURSIVE
docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{W}') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM docs),
items AS (SELECT doc_id, len(s) AS n, md5(unnest(s)) AS g FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS m FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * m >= 85 * (na + nb - m)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM sets LEFT JOIN least_of ON doc_id = a"""



def _codes(rounds: int = 6) -> str:
    """Codebooks round by round, a pair of tables for each."""
    gap = "list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    nearest = f"SELECT r, p, min((g, e)) AS m FROM (SELECT a.r, a.p, b.e, {gap} AS g FROM parts a JOIN book{{k}} b ON a.p = b.p) GROUP BY r, p"
    steps = [
        f"""near{k} AS MATERIALIZED ({nearest.format(k=k)}),
means{k} AS (SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS c FROM (SELECT a.p, n.m[2] AS e, a.x, unnest(range(1, len(a.x) + 1)) AS i FROM near{k} n JOIN parts a ON a.r = n.r AND a.p = n.p) GROUP BY p, e, i),
book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN
  (SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS x FROM means{k} GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""
        for k in range(rounds)
    ]
    return f"""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS x FROM kept, range(8) t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= 16),
{",\n".join(steps)},
final AS MATERIALIZED ({nearest.format(k=rounds)}),
coded AS (SELECT r, string_agg(printf('%02x', m[2]::INT), '' ORDER BY p) AS code, sum(m[1])::BIGINT AS error FROM final GROUP BY r)
SELECT vec_id, label, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept ON coded.r = kept.r"""


#: Squares are added from the first component on.
NEAREST = """WITH kept AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
  FROM kept q JOIN kept c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op1_quality_rules": QUALITY, "op3_near_dedup": NEAR, "op11_vp_search": NEAREST, "op13_vector_codes": _codes()}
