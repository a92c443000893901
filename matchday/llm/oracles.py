"""SQL with the results of the queries that SQL can express, over the same tables."""

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

OP8 = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '{_WORD}')) END AS size
  FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
w AS (
  SELECT *, row_number() OVER (ORDER BY src) AS place, 2.0::DOUBLE * source_size AS most FROM s),
x AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM w),
l AS (
  SELECT *, row_number() OVER r AS turn,
         (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
            - coalesce(sum(most) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           AS level
  FROM x WINDOW r AS (ORDER BY most / weight, place)),
o AS (SELECT *, min(CASE WHEN level <= most / weight THEN turn END) OVER () AS open_turn FROM l),
t AS (
  SELECT src, source_size,
         coalesce(least(most, max(CASE WHEN turn = open_turn THEN level END) OVER () * weight), most) AS target,
         CAST(CAST('0x' || substr(md5('mix' || src), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS shift
  FROM o),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.shift,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.src ORDER BY d.size, ((d.doc_id % 4096) + 4096) % 4096, d.doc_id) AS place
  FROM d JOIN t USING (src))
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * least(floor(shift + place * rate) - floor(shift + (place - 1) * rate), 2) AS BIGINT) AS taken
FROM p
"""

OP10 = f"""
WITH l AS (
  SELECT doc_id, line, pos, {_LOWER.format(f"trim(line, {_SPACES})")} AS k
  FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
f AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.*, f.k IS NOT NULL AS gone FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


OP5 = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""


OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
           {_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
t AS (SELECT d, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
l AS (SELECT d, sum(tf)::BIGINT AS n FROM t GROUP BY d),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM l),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
i AS (
  SELECT i, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
             {_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
w AS (
  SELECT i, item_id, term, times * CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM i JOIN f USING (term), a),
s AS (
  SELECT i, item_id, d, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM w JOIN t USING (term) JOIN l USING (d), a GROUP BY ALL),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_knn": OP5, "op8_mixing": OP8, "op10_line_dedup": OP10, "op13_lexical_search": OP13}
