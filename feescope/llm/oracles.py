"""DuckDB statements for the corpus queries that SQL can express."""

WARC = """WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h,
         min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""

USABLE = """v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0)"""

NEAREST = "WITH " + USABLE + """,
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
  FROM ok q JOIN ok c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""

DUPLICATES = "WITH RECURSIVE " + USABLE + """,
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
FROM v LEFT JOIN least ON v.vec_id = least.a LEFT JOIN n ON v.vec_id = n.a"""

# One selection round inside the deciding buckets: rows that still fit are taken by running sums.
_ROUND = """r{i} AS (
  SELECT source, doc_id, key, n, gap - coalesce(sum(now * n) OVER (PARTITION BY source), 0) AS gap, flag + now AS flag FROM (
    SELECT *, CASE WHEN {fits} AND run <= gap THEN 1 ELSE 0 END AS now FROM (
      SELECT *, sum(CASE WHEN {fits} THEN n ELSE 0 END) OVER (
        PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS run FROM {before}) t) u)"""


def mixing(rounds: int = 5) -> str:
    steps, before = [], "r"
    for i in range(rounds):
        fits = "(flag = 0)" if i == 0 else "(flag = 0 AND n <= gap)"
        steps.append(_ROUND.format(i=i, fits=fits, before=before))
        before = f"r{i}"
    return """WITH d AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
k AS (
  SELECT *, -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
            / (1.0::DOUBLE / (1.0::DOUBLE + abs(coalesce(CAST(length(text) AS DOUBLE) / greatest(size, 1), 0.0::DOUBLE) - 6.0::DOUBLE) / 6.0::DOUBLE)) AS key
  FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_rows FROM k GROUP BY source),
w AS (
  SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS w,
         3.0::DOUBLE * source_size AS cap FROM s),
f AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - (sum(cap) OVER by_room - cap))
            / (sum(w) OVER () - (sum(w) OVER by_room - w)) AS share FROM w
  WINDOW by_room AS (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, cap / w < share AS capped FROM f),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN cap ELSE (SELECT arg_min(share, cap / w) FROM g WHERE NOT capped) * w END AS target
  FROM g),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
b AS (
  SELECT k.doc_id, k.source, k.size, k.key, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         CAST(floor(CASE WHEN k.key < 1 THEN k.key / (1.0::DOUBLE + k.key) ELSE 0.5::DOUBLE + log2(k.key) / 6.0::DOUBLE END * (SELECT ceil(sqrt(max(n_rows)) / 8) FROM s)) AS BIGINT) AS bucket
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
parts AS (
  SELECT source, bucket, rest, sum(size) AS n FROM b GROUP BY source, bucket, rest),
upto AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto FROM parts),
ends AS (
  SELECT source, min(bucket) AS e_bucket, arg_min(upto - n, bucket) AS before FROM upto WHERE upto > rest GROUP BY source),
r AS (
  SELECT b.doc_id, b.source, b.key, b.size AS n, b.rest - ends.before AS gap, 0 AS flag
  FROM b JOIN ends ON b.source IS NOT DISTINCT FROM ends.source AND b.bucket = ends.e_bucket),
""" + ",\n".join(steps) + f""",
last AS (
  SELECT source, arg_min(doc_id, {{'d': abs(gap - n), 'k': key, 'i': doc_id}}) AS doc_id FROM {before}
  WHERE flag = 0 AND n > 0 AND abs(gap - n) < gap GROUP BY source)
SELECT b.doc_id, b.source, b.size, b.source_size, b.target,
       CAST(b.size * (b.epochs + CASE WHEN ends.e_bucket IS NULL OR b.bucket > ends.e_bucket THEN 0 WHEN b.bucket < ends.e_bucket THEN 1
                                 ELSE {before}.flag + CASE WHEN last.doc_id IS NOT NULL THEN 1 ELSE 0 END END) AS BIGINT) AS taken
FROM b LEFT JOIN ends ON b.source IS NOT DISTINCT FROM ends.source
       LEFT JOIN {before} ON b.doc_id = {before}.doc_id
       LEFT JOIN last ON b.doc_id = last.doc_id"""
