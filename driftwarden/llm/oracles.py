"""SQL of the package's queries, for DuckDB."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_SHARE = "1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY {keys}) + 5 * v)"
SOURCE_DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'),
             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM (SELECT DISTINCT r, lang, term FROM t) GROUP BY lang, term HAVING count(*) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
gc AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
gp AS (SELECT lang, source, term, n, {_SHARE.format(keys='lang, source')} AS p FROM gc JOIN sizes USING (lang)),
lp AS (SELECT lang, term, {_SHARE.format(keys='lang')} AS q
       FROM (SELECT lang, term, sum(n) AS n FROM gc GROUP BY lang, term) JOIN sizes USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM gp a JOIN gp b USING (lang, term) GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
           UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 50
"""


def _centroid_clustering(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    parts = [f"""
WITH x AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS e FROM embeddings WHERE len(embedding) = {dims}),
q AS MATERIALIZED (SELECT vec_id, list_transform(e, lambda v: floor(256 * v)::BIGINT) AS q FROM x
      WHERE len(list_filter(e, lambda v: v IS NOT NULL AND isfinite(v))) = {dims}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h) - 1)::INT AS cluster, q AS c
       FROM (SELECT sha256('2:' || vec_id) AS h, q FROM q ORDER BY h LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (SELECT vec_id, q, cluster, distance FROM (
       SELECT vec_id, q, cluster,
              list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
       FROM q, c{i}) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if i < rounds:
            parts.append(f"""
m{i} AS (SELECT cluster, d, sum(q[d])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, {dims + 1}) AS r(d) GROUP BY cluster, d),
n{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS c FROM m{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(n{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN n{i} USING (cluster))""")
    return ",".join(parts) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


_REACH = """
reach AS (SELECT id AS v, id AS m FROM {nodes} UNION SELECT reach.v, b FROM reach JOIN links ON reach.m = links.a),
least AS (SELECT v AS id, min(m) AS component_id FROM reach GROUP BY v)"""

EMBEDDING_NEARDUP = f"""
WITH RECURSIVE e AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS MATERIALIZED (SELECT id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM e
     WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)),
links AS MATERIALIZED (SELECT x.id AS a, y.id AS b FROM u x JOIN u y ON x.label = y.label AND x.id <> y.id AND len(x.e) = len(y.e)
     AND x.norm > 0 AND y.norm > 0 AND list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.93),
{_REACH.format(nodes="e")}
SELECT e.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.id = component_id AS kept
FROM e JOIN least USING (id) LEFT JOIN (SELECT a AS id, count(*) AS n FROM links GROUP BY a) USING (id)
"""

_LATIN_WORDS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION = f"""
WITH i AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_LATIN_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
g AS MATERIALIZED (SELECT DISTINCT item_id::VARCHAR AS item, n, unnest(list_transform(range(1, len(w) - n + 2),
     lambda s: array_to_string(w[s:s + n - 1], ' '))) AS k FROM i),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_LATIN_WORDS}, []) AS w FROM documents),
places AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d JOIN (SELECT DISTINCT n FROM g) ON len(w) >= n),
hits AS MATERIALIZED (SELECT r, p.n, s, item FROM (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS k FROM places) p
     JOIN g ON p.n = g.n AND p.k = g.k),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS line FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(line, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id AS id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+'), []) AS w
     FROM documents),
s AS MATERIALIZED (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
     lambda p: hash(array_to_string(w[p:p + 3], ' ')))) AS g FROM d WHERE len(w) > 0),
n AS MATERIALIZED (SELECT id, count(*) AS n FROM s GROUP BY id),
met AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM met JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
{_REACH.format(nodes="d")}
SELECT d.id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d JOIN least USING (id) LEFT JOIN n USING (id)
"""

ORACLES = {
    "op1_embedding_neardup": EMBEDDING_NEARDUP,
    "op5_decontamination": DECONTAMINATION,
    "op6_jaccard_join": JACCARD_JOIN,
    "op11_source_divergence": SOURCE_DIVERGENCE,
    "op12_centroid_clustering": _centroid_clustering(),
}
