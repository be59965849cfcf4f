"""The operators that SQL can express, as DuckDB SQL over the same tables.

They follow the contracts, not the methods: all pairs that share a shingle, all
strings of a length, all windows of an item's size.
"""

from __future__ import annotations

_SPACE = r"'[\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DEDUP = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_SPACE}),
                             lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM worded
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM sets
  UNION
  SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
), components AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components ON node = doc_id
"""

REPEATED_STRINGS = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n_bytes FROM bytes),
strings AS (
  SELECT doc_id, start, md5_number(substr(h, 2 * start + 1, 200)) AS string
  FROM (SELECT doc_id, h, unnest(range(0, n_bytes - 99)) AS start FROM sized WHERE n_bytes >= 100)
), repeats AS (
  SELECT doc_id, start FROM strings
  QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, start) > 1
), grouped AS (
  SELECT doc_id, start,
    sum(new) OVER (PARTITION BY doc_id ORDER BY start) AS span
  FROM (SELECT *, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id ORDER BY start) <= 100 THEN 0 ELSE 1 END AS new
        FROM repeats)
), spans AS (
  SELECT doc_id, span, min(start) AS a, max(start) + 100 AS b FROM grouped GROUP BY doc_id, span
), between_spans AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    list({'f': kept_from, 't': a} ORDER BY a) AS kept
  FROM between_spans GROUP BY doc_id
)
SELECT s.doc_id, s.n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(c.n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN c.doc_id IS NULL THEN h ELSE
    concat(array_to_string(list_transform(c.kept, lambda k: substr(h, 2 * k.f + 1, 2 * (k.t - k.f))), ''),
           substr(h, 2 * c.last + 1)) END)) AS kept_sha256
FROM sized s LEFT JOIN cut c ON c.doc_id = s.doc_id
"""

_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"

BENCHMARK_WINDOWS = f"""
WITH items AS (
  SELECT item_id, w AS iw, len(w) AS width,
    list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS own
  FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) >= 5
), docs AS (
  SELECT doc_id, w, len(w) AS n, list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents)
), spread AS (SELECT doc_id, n, unnest(s) AS shingle, generate_subscripts(s, 1) - 1 AS place FROM docs),
wanted AS (SELECT item_id, width, unnest(list_distinct(own)) AS shingle FROM items),
hits AS (
  SELECT DISTINCT doc_id, item_id, width, greatest(least(place, n - width), 0) AS place
  FROM spread JOIN wanted USING (shingle)
), windows AS (
  SELECT h.doc_id, h.item_id, h.place, unnest(d.s[h.place + 1:h.place + h.width - 4]) AS shingle
  FROM hits h JOIN docs d USING (doc_id)
), in_window AS (SELECT doc_id, item_id, place, shingle, count(*) AS n FROM windows GROUP BY ALL),
in_item AS (SELECT item_id, shingle, count(*) AS n FROM (SELECT item_id, unnest(own) AS shingle FROM items) GROUP BY ALL),
scored AS (
  SELECT w.doc_id, w.item_id, w.place, sum(w.n) AS own_n, sum(least(w.n, coalesce(i.n, 0))) AS shared
  FROM in_window w LEFT JOIN in_item i ON i.item_id = w.item_id AND i.shingle = w.shingle GROUP BY ALL
), judged AS (
  SELECT doc_id, item_id, place,
    CAST(shared AS DOUBLE) / CAST(own_n + len(items.own) - shared AS DOUBLE) AS similarity
  FROM scored JOIN items USING (item_id)
)
SELECT doc_id, item_id, max(similarity) AS similarity, CAST(arg_min(place, (-similarity, place)) AS BIGINT) AS first_word
FROM judged WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""

_WHOLE = """len(embedding) = list_count(embedding)
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: isfinite(x))), len(embedding) = 0)"""


def _centroids(k: int, rounds: int) -> str:
    nearest = """a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, j, c, d FROM (
    SELECT r, vec_id, v, j, c,
      CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM kept CROSS JOIN c{i})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1
)"""
    update = """c{i} AS MATERIALIZED (
  SELECT j, coalesce(m.c, o.c) AS c FROM c{o} o LEFT JOIN (
    SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c FROM (
      SELECT j, pos, sum(x) AS s, count(*) AS n
      FROM (SELECT j, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{o}) GROUP BY j, pos)
    GROUP BY j) m USING (j)
)"""
    steps = [nearest.format(i=0)]
    for i in range(1, rounds + 1):
        steps += [update.format(i=i, o=i - 1), nearest.format(i=i)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND {_WHOLE}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS j, v AS c
  FROM kept WHERE vec_id IS NOT NULL ORDER BY j LIMIT {k}
), {", ".join(steps)}
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds}
"""


CENTROID_CLUSTERS = _centroids(8, 10)

HARD_NEGATIVES = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_WHOLE}
), scored AS MATERIALIZED (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
    coalesce(CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT), 0) AS score
  FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.r <> b.r
), positives AS (
  SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id, s.r) AS rank
  FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""
