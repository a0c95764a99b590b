"""DuckDB statements of the registered operator queries that SQL can express."""

EXACT_DEDUP = """
WITH normalised AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM normalised
WINDOW same AS (PARTITION BY body)
"""

MIX_SOURCES = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(cast(doc_id AS varchar), '') || ':mix') AS pick,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS bigint) AS size
  FROM documents),
per_source AS (
  SELECT source, sum(size) AS words,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
levels AS (  -- the level of words per weight if every source up to this one stops at its limit
  SELECT *, sum(words) OVER () AS total,
         3 * words <= 0 OR 3 * words * sum(weight) OVER (ORDER BY 3.0::double * words / weight, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
           <= weight * (sum(words) OVER () - coalesce(sum(3 * words) OVER (
                ORDER BY 3.0::double * words / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS full_up
  FROM per_source),
planned AS (
  SELECT source, cast(words AS bigint) AS source_size,
         CASE WHEN full_up THEN cast(3 * words AS double)
              ELSE cast((total - sum(CASE WHEN full_up THEN 3 * words ELSE 0 END) OVER ()) * weight AS double)
                   / cast(sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER () AS double) END AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target,
         cast(floor(target) AS bigint) AS budget,
         coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY pick, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM sized JOIN planned ON sized.source IS NOT DISTINCT FROM planned.source)
SELECT doc_id, size, source_size, target,
       cast(CASE WHEN source_size = 0 THEN 0
            ELSE budget // source_size * size
                 + greatest(0, least(size, budget % source_size - earlier)) END AS bigint) AS taken
FROM placed
"""

NEAR_DEDUP = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sets AS (
  SELECT doc_id, row_no, CASE WHEN len(words) = 0 THEN []
                      WHEN len(words) = 1 THEN words
                      ELSE list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))])
                 END AS shingles
  FROM worded),
items AS (SELECT row_no, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.row_no AS u, b.row_no AS v
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.row_no < b.row_no
       AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.row_no, b.row_no, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(u, v) AS (
  SELECT row_no, row_no FROM sets
  UNION
  SELECT reach.u, both_ways.v FROM reach JOIN both_ways ON reach.v = both_ways.u),
named AS (SELECT u, min(doc_id) AS component_id FROM reach JOIN sets ON reach.v = sets.row_no GROUP BY u)
SELECT doc_id, len(shingles) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM sets JOIN named ON sets.row_no = named.u
"""

SUBSTRING_DEDUP = r"""
WITH worded AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
starts AS (
  SELECT doc_id, row_no, words, unnest(range(1, len(words) - 11)) AS start FROM worded),
windows AS (
  SELECT doc_id, row_no, start, array_to_string(words[start:start + 12], ' ') AS passage
  FROM starts),
firsts AS (SELECT passage, min(doc_id) AS first_doc FROM windows GROUP BY passage),
gone AS (
  SELECT DISTINCT row_no, unnest(range(start, start + 13)) AS place
  FROM windows JOIN firsts USING (passage) WHERE first_doc < doc_id),
gone_lists AS (SELECT row_no, list(place) AS places FROM gone GROUP BY row_no)
SELECT doc_id, cast(len(words) AS bigint) AS n_words,
       cast(coalesce(len(places), 0) AS bigint) AS n_removed,
       sha256(array_to_string(
         [words[i] for i in range(1, len(words) + 1) if places IS NULL OR NOT list_contains(places, i)],
         ' ')) AS kept_sha256
FROM worded LEFT JOIN gone_lists USING (row_no)
"""

_ROUNDS = 10
_NEAREST = """
  SELECT vec_id, row_no, numbers, arg_min(centroid_no, (distance, centroid_no)) AS cluster, min(distance) AS distance
  FROM (SELECT v.*, c.centroid_no,
               list_sum([(numbers[i] - components[i]) * (numbers[i] - components[i]) for i in range(1, 65)]) AS distance
        FROM vectors v, {centroids} c)
  GROUP BY vec_id, row_no, numbers"""

_ROUND = """
nearest_{n} AS MATERIALIZED ({nearest}),
sums_{n} AS (
  SELECT cluster, place, sum(number) AS total, count(*) AS n
  FROM (SELECT cluster, unnest(range(1, 65)) AS place, unnest(numbers) AS number FROM nearest_{n})
  GROUP BY cluster, place),
means_{n} AS (
  SELECT cluster, list(cast((total - ((total % n) + n) % n) // n AS bigint) ORDER BY place) AS means
  FROM sums_{n} GROUP BY cluster),
centroids_{n} AS MATERIALIZED (
  SELECT centroid_no, coalesce(means, components) AS components
  FROM centroids_{before} LEFT JOIN means_{n} ON cluster = centroid_no),"""

CLUSTERS = (
    """
WITH vectors AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row_no,
         [cast(floor(1024 * cast(x AS double)) AS bigint) for x in embedding] AS numbers
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if isfinite(x)]) = 64),
centroids_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, numbers) - 1 AS centroid_no,
         numbers AS components
  FROM vectors
  QUALIFY centroid_no < 8),"""
    + "".join(
        _ROUND.format(n=n, before=n - 1, nearest=_NEAREST.format(centroids=f"centroids_{n - 1}"))
        for n in range(1, _ROUNDS + 1)
    )
    + f"""
assigned AS MATERIALIZED ({_NEAREST.format(centroids=f"centroids_{_ROUNDS}")})
SELECT vec_id, cast(cluster AS integer) AS cluster, cast(distance AS bigint) AS distance,
       cast(sum(distance) OVER (PARTITION BY cluster) AS bigint) AS cluster_inertia,
       cast(sum(distance) OVER () AS bigint) AS inertia,
       sha256(array_to_string(components, ',')) AS centroid_sha256
FROM assigned JOIN centroids_{_ROUNDS} ON cluster = centroid_no
"""
)
