"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

import hashlib
import math

from driftwarden.detectors.iforest import FEATURES, SAMPLES, TREES
from driftwarden.detectors.lof import NEIGHBOURS as LOF_NEIGHBOURS
from driftwarden.detectors.ocsvm import GAMMA, NU, TOLERANCE
from driftwarden.plans.queries import (
    DRAWN, FOREST, LONG_TEXT, NEIGHBOURS, SEARCH_FOREST, SEARCH_NEIGHBOURS, SEARCH_SUPPORT, SPLIT_SEED, THRESHOLDS)
from driftwarden.plans.search import PARAMETERS
from driftwarden.plans.spaces import CANDIDATES as WHOLE_DRAWN
from driftwarden.plans.spaces import SEED
from driftwarden.plans.workloads import GENUINE, LINE_ORDER, RETURNED, SEGMENT_LENGTH

LINES = f"""
lines AS MATERIALIZED (
  SELECT l_suppkey AS entity, l_partkey, l_returnflag, l_quantity, l_discount,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS pos
  FROM lineitem),
tok AS MATERIALIZED (
  SELECT entity, pos, CAST(pos // {SEGMENT_LENGTH} AS INTEGER) AS seg, p_brand AS token
  FROM lines JOIN part ON l_partkey = p_partkey),
lab AS MATERIALIZED (
  SELECT entity, CAST(pos // {SEGMENT_LENGTH} AS INTEGER) AS seg,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) >= {RETURNED} AS INTEGER) AS label
  FROM lines GROUP BY 1, 2),
partial AS MATERIALIZED (
  SELECT entity, seg, CASE WHEN seg < {GENUINE} OR entity IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 4500)
                           THEN label END AS label FROM lab)"""

VECTORS = LINES + f""",
cnt AS MATERIALIZED (SELECT entity, seg, token AS term, count(*) AS tf FROM tok GROUP BY 1, 2, 3),
feat AS MATERIALIZED (
  SELECT entity, seg, term, tf, tf / sqrt(sum(tf * tf) OVER (PARTITION BY entity, seg)) AS value FROM cnt),
v AS MATERIALIZED (SELECT entity, 0 AS cv, seg AS id, term, value FROM feat),
r AS MATERIALIZED (SELECT DISTINCT entity, 0 AS cv, seg AS id, true AS is_fit, seg >= {GENUINE} AS is_scored FROM feat)"""

# TF-IDF over the test segments, each once per fold: scored in its own fold, fitted in the others.
RUNS = LINES + f""",
known AS (SELECT s_suppkey AS entity FROM supplier WHERE s_acctbal > 4500),
cnt AS MATERIALIZED (
  SELECT entity, seg, token AS term, count(*) AS tf FROM tok SEMI JOIN known USING (entity) WHERE seg >= {GENUINE} GROUP BY 1, 2, 3),
ndoc AS (SELECT entity, count(*) AS n FROM lab WHERE seg >= {GENUINE} GROUP BY 1),
idf AS (SELECT entity, term, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1 AS idf
        FROM (SELECT entity, term, count(*) AS df FROM cnt GROUP BY 1, 2) JOIN ndoc USING (entity)),
w AS (SELECT entity, seg, term, tf * idf AS w FROM cnt JOIN idf USING (entity, term)),
feat AS MATERIALIZED (SELECT entity, seg, term, w / sqrt(sum(w * w) OVER (PARTITION BY entity, seg)) AS value FROM w),
fold AS MATERIALIZED (
  SELECT entity, seg, label, (row_number() OVER (PARTITION BY entity, label
         ORDER BY md5('{SPLIT_SEED}|fold|' || seg), seg) - 1) % 3 AS fold
  FROM lab SEMI JOIN known USING (entity) WHERE seg >= {GENUINE}),
runs AS MATERIALIZED (SELECT entity, seg, label, fold, cv FROM fold, (SELECT unnest([0, 1, 2]) AS cv)),
v AS MATERIALIZED (SELECT entity, cv, seg AS id, term, value FROM feat JOIN runs USING (entity, seg)),
r AS MATERIALIZED (SELECT entity, cv, seg AS id, fold <> cv AS is_fit, fold = cv AS is_scored FROM runs)"""

CENTROID = """,
c_n AS (SELECT entity, cv, count(*) AS n FROM r WHERE is_fit GROUP BY 1, 2),
c_s AS MATERIALIZED (
  SELECT entity, cv, term, sum(value) AS s FROM v JOIN r USING (entity, cv, id) WHERE is_fit GROUP BY 1, 2, 3),
c_q AS (SELECT entity, cv, sum(s * s) AS ss FROM c_s GROUP BY 1, 2),
c_x AS (SELECT entity, cv, id, sum(value * value) AS xx, sum(value * coalesce(s, 0)) AS xs
        FROM v LEFT JOIN c_s USING (entity, cv, term) GROUP BY 1, 2, 3),
c_d AS MATERIALIZED (
  SELECT entity, cv, id, CASE WHEN xx - 2 * xs / n + ss / (n * n) > 2e-15 * (xx + ss / (n * n))
                              THEN sqrt(xx - 2 * xs / n + ss / (n * n)) ELSE 0 END AS dist
  FROM r JOIN c_x USING (entity, cv, id) JOIN c_n USING (entity, cv) JOIN c_q USING (entity, cv) WHERE is_scored),
c_m AS (SELECT entity, cv, avg(dist) AS mean FROM c_d GROUP BY 1, 2),
c_r AS MATERIALIZED (
  SELECT entity, cv, id, dist, CASE WHEN mean > 0 THEN dist / mean ELSE 0 END AS ratio
  FROM c_d JOIN c_m USING (entity, cv)),
c_flag AS MATERIALIZED (
  SELECT entity, id AS seg, dist AS score, CAST(ratio > 1.15 AS INTEGER) AS flag FROM c_r)"""

PAIRS = """,
vec AS (SELECT entity, cv, id, list({'t': term, 'v': value} ORDER BY term) AS vec, sum(value * value) AS xx
        FROM v GROUP BY 1, 2, 3),
rv AS MATERIALIZED (SELECT * FROM r JOIN vec USING (entity, cv, id)),
dots AS (SELECT a.entity, a.cv, a.id AS i, b.id AS j, sum(a.value * b.value) AS dot
         FROM v a JOIN v b ON a.entity = b.entity AND a.cv = b.cv AND a.term = b.term GROUP BY 1, 2, 3, 4),
pairs AS MATERIALIZED (
  SELECT a.entity, a.cv, a.id AS i, b.id AS j, a.is_fit AS i_fit, a.is_scored AS i_scored,
         CASE WHEN a.vec = b.vec THEN 0.0
              ELSE round(sqrt(greatest(a.xx + b.xx - 2 * coalesce(dot, 0), 0)), 9) END AS dist,
         CASE WHEN a.vec = b.vec THEN 0.0 ELSE greatest(a.xx + b.xx - 2 * coalesce(dot, 0), 0) END AS square
  FROM rv a JOIN rv b ON a.entity = b.entity AND a.cv = b.cv AND b.is_fit
  LEFT JOIN dots ON dots.entity = a.entity AND dots.cv = a.cv AND dots.i = a.id AND dots.j = b.id)"""


def lof(k: int, name: str) -> str:
    """Factors of fitted rows (``{name}_fit``) and of scored rows (``{name}_new``) for k neighbours."""
    return f""",
{name}_k AS (SELECT entity, cv, greatest(least({k}, count(*) - 1), 1) AS k FROM r WHERE is_fit GROUP BY 1, 2),
{name}_a AS MATERIALIZED (SELECT * FROM (
  SELECT p.*, row_number() OVER (PARTITION BY entity, cv, i ORDER BY dist, j) AS rn FROM pairs p WHERE i_fit AND i <> j)
  JOIN {name}_k USING (entity, cv) WHERE rn <= k),
{name}_b AS MATERIALIZED (SELECT * FROM (
  SELECT p.*, row_number() OVER (PARTITION BY entity, cv, i ORDER BY dist, j) AS rn FROM pairs p WHERE i_scored)
  JOIN {name}_k USING (entity, cv) WHERE rn <= k),
{name}_kd AS MATERIALIZED (SELECT entity, cv, i AS j, max(dist) AS kd FROM {name}_a GROUP BY 1, 2, 3),
{name}_al AS MATERIALIZED (SELECT entity, cv, i, 1 / (avg(greatest(dist, kd)) + 1e-10) AS lrd
  FROM {name}_a JOIN {name}_kd USING (entity, cv, j) GROUP BY 1, 2, 3),
{name}_bl AS (SELECT entity, cv, i, 1 / (avg(greatest(dist, kd)) + 1e-10) AS lrd
  FROM {name}_b JOIN {name}_kd USING (entity, cv, j) GROUP BY 1, 2, 3),
{name}_fit AS MATERIALIZED (SELECT a.entity, a.cv, a.i, round(avg(n.lrd) / any_value(o.lrd), 9) AS factor
  FROM {name}_a a JOIN {name}_al n ON n.entity = a.entity AND n.cv = a.cv AND n.i = a.j
  JOIN {name}_al o ON o.entity = a.entity AND o.cv = a.cv AND o.i = a.i GROUP BY 1, 2, 3),
{name}_new AS MATERIALIZED (SELECT a.entity, a.cv, a.i, round(avg(n.lrd) / any_value(o.lrd), 9) AS factor
  FROM {name}_b a JOIN {name}_al n ON n.entity = a.entity AND n.cv = a.cv AND n.i = a.j
  JOIN {name}_bl o ON o.entity = a.entity AND o.cv = a.cv AND o.i = a.i GROUP BY 1, 2, 3)"""


def lof_flags(k: int) -> str:
    return PAIRS + lof(k, "l") + """,
l_off AS (SELECT entity, cv, quantile_cont(CAST(-factor AS DOUBLE), 0.25) AS off FROM l_fit GROUP BY 1, 2),
l_flag AS MATERIALIZED (
  SELECT entity, i AS seg, factor AS score, CAST(-factor < off AS INTEGER) AS flag
  FROM l_new JOIN l_off USING (entity, cv))"""


LOF = lof_flags(NEIGHBOURS)


def _uniform(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


def _average_path(n: str) -> str:
    return (f"CASE WHEN {n} <= 1 THEN 0.0::DOUBLE WHEN {n} = 2 THEN 1.0::DOUBLE ELSE "
            f"2.0::DOUBLE * (ln({n} - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * ({n} - 1.0::DOUBLE) / {n} END")


def forest(trees: int, samples: int, features: int, by_size: bool = False) -> str:
    """The forest level by level: splits of every node, then the leaf each row ends in.

    ``by_size``: groups may have fewer rows than a sample, and their trees fewer levels then.
    """
    depth = math.ceil(math.log2(samples))
    deep = f""",
f_deep AS MATERIALIZED (SELECT entity, ceil(log2(greatest(least({samples}, count(*)), 2))) AS deepest FROM r WHERE is_fit GROUP BY 1)""" if by_size else ""
    norm = f"CASE WHEN any_value(size) <= 1 THEN 1 ELSE any_value({_average_path('size')}) END" if by_size else f"any_value({_average_path('size')})"
    sql = f"""{deep},
t AS (SELECT unnest(range({trees})) AS tree),
f_s AS MATERIALIZED (SELECT entity, tree, id FROM (
  SELECT entity, tree, id, row_number() OVER (PARTITION BY entity, tree
         ORDER BY md5(concat_ws('|', entity, tree, 'row', id)), id) AS rn FROM r, t WHERE is_fit) WHERE rn <= {samples}),
f_f AS MATERIALIZED (SELECT entity, tree, term, rn FROM (
  SELECT entity, tree, term, row_number() OVER (PARTITION BY entity, tree
         ORDER BY md5(concat_ws('|', entity, tree, 'term', term)), term) AS rn
  FROM (SELECT DISTINCT entity, term FROM v), t) WHERE rn <= {features}),
f_x AS MATERIALIZED (
  SELECT entity, tree, id, term, rn, coalesce(value, 0.0::DOUBLE) AS x
  FROM f_s JOIN f_f USING (entity, tree) LEFT JOIN v USING (entity, id, term)),
f_n0 AS MATERIALIZED (SELECT entity, tree, id, 0 AS node FROM f_s),
f_a AS MATERIALIZED (SELECT entity, id, tree, 0 AS node FROM r, t)"""
    leaves = []
    for level in range(depth + 1):
        sql += f""",
f_c{level} AS MATERIALIZED (SELECT entity, tree, node, count(*) AS n FROM f_n{level} GROUP BY 1, 2, 3)"""
        if level == depth:
            leaves.append(f"SELECT entity, tree, node, {level} + ({_average_path('n')}) AS path FROM f_c{level}")
            break
        pick, split = _uniform("entity", "tree", "node", "'feature'"), _uniform("entity", "tree", "node", "'split'")
        sql += f""",
f_u{level} AS (SELECT entity, tree, node, term, rn, min(x) AS lo, max(x) AS hi
  FROM f_n{level} JOIN f_x USING (entity, tree, id){f' JOIN f_deep USING (entity) WHERE {level} < deepest' if by_size else ''} GROUP BY 1, 2, 3, 4, 5 HAVING min(x) < max(x)),
f_o{level} AS (SELECT *, row_number() OVER (PARTITION BY entity, tree, node ORDER BY rn) - 1 AS place,
  count(*) OVER (PARTITION BY entity, tree, node) AS usable FROM f_u{level}),
f_p{level} AS MATERIALIZED (SELECT entity, tree, node, term, lo + ({split}) * (hi - lo) AS split
  FROM f_o{level} WHERE place = floor(({pick}) * usable)),
f_n{level + 1} AS MATERIALIZED (SELECT entity, tree, id, CASE WHEN x <= split THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
  FROM f_n{level} JOIN f_p{level} USING (entity, tree, node) JOIN f_x USING (entity, tree, id, term)),
f_a{level} AS MATERIALIZED (SELECT a.entity, a.id, a.tree,
  CASE WHEN p.split IS NULL THEN a.node WHEN coalesce(v.value, 0) <= p.split THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node
  FROM {'f_a' if level == 0 else f'f_a{level - 1}'} a LEFT JOIN f_p{level} p USING (entity, tree, node)
  LEFT JOIN v ON v.entity = a.entity AND v.id = a.id AND v.term = p.term)"""
        leaves.append(f"SELECT entity, tree, node, {level} + ({_average_path('n')}) AS path FROM f_c{level} "
                      f"WHERE (entity, tree, node) NOT IN (SELECT (entity, tree, node) FROM f_p{level})")
    sql += f""",
f_l AS MATERIALIZED ({' UNION ALL '.join(leaves)}),
f_size AS (SELECT entity, least({samples}, count(*)) AS size FROM r WHERE is_fit GROUP BY 1),
f_score AS MATERIALIZED (
  SELECT entity, id, round(pow(2.0::DOUBLE, -avg(path) / {norm}), 9) AS score
  FROM f_a{depth - 1} JOIN f_l USING (entity, tree, node) JOIN f_size USING (entity) GROUP BY 1, 2),
f_off AS (SELECT entity, quantile_cont(-score, 0.25) AS off FROM f_score GROUP BY 1),
f_flag AS MATERIALIZED (
  SELECT entity, id AS seg, score, CAST(-score < off AS INTEGER) AS flag
  FROM f_score JOIN f_off USING (entity) WHERE id >= {GENUINE})"""
    return sql


FORESTS = forest(**FOREST)
WHOLE_FORESTS = forest(TREES, SAMPLES, FEATURES, by_size=True)


# The chi-square quantiles of two terms at 0.5 and 0.975, -2 ln(1 - share).
KEPT_RATIO = f"({-2 * math.log(0.025)!r}::DOUBLE / {-2 * math.log(0.5)!r}::DOUBLE)"

COLUMNS = f""",
q AS (SELECT entity, CAST(pos // {SEGMENT_LENGTH} AS INTEGER) AS seg, sum(l_quantity) AS qty, avg(l_discount) AS disc
      FROM lines GROUP BY 1, 2),
z AS MATERIALIZED (SELECT entity, seg AS id,
  round((qty - avg(qty) OVER e) / stddev_pop(qty) OVER e, 6) AS y,
  round((disc - avg(disc) OVER e) / stddev_pop(disc) OVER e, 6) AS x FROM q WINDOW e AS (PARTITION BY entity))"""


def _envelopes(steps: int = 14) -> str:
    """Distances of every row under every setting of ``e_set`` (s, share, centered), rows ``e_r`` (entity, cv, id, is_fit).

    Two columns, so the covariance matrix is inverted in closed form; a support that no longer changes gives the same
    distances again, so a few steps more than needed are harmless.
    """
    def fit(source: str, name: str, to: str) -> str:
        return f""",
m{name} AS (SELECT s, entity, cv, avg(x) * any_value(1 - centered) AS mx, avg(y) * any_value(1 - centered) AS my,
  avg(x * x) - avg(x) * avg(x) * any_value(1 - centered) AS xx, avg(y * y) - avg(y) * avg(y) * any_value(1 - centered) AS yy,
  avg(x * y) - avg(x) * avg(y) * any_value(1 - centered) AS xy FROM {source} GROUP BY 1, 2, 3),
{to} AS MATERIALIZED (SELECT s, share, centered, entity, cv, id, is_fit, x, y, n, round(greatest(
  (yy * (x - mx) * (x - mx) - 2 * xy * (x - mx) * (y - my) + xx * (y - my) * (y - my)) / (xx * yy - xy * xy), 0), 6) AS d
  FROM d0 JOIN m{name} USING (s, entity, cv))"""

    sql = """,
e_z AS MATERIALIZED (SELECT entity, cv, id, is_fit, x, y FROM e_r JOIN z USING (entity, id)),
e_med AS (SELECT entity, cv, quantile_cont(x, 0.5) AS mx, quantile_cont(y, 0.5) AS my, count(*) AS n FROM e_z WHERE is_fit GROUP BY 1, 2),
d0 AS MATERIALIZED (SELECT s, share, centered, entity, cv, id, is_fit, x, y, n,
  round(greatest((x * x + y * y) - 2 * (x * mx + y * my) + (mx * mx + my * my), 0), 6) AS d
  FROM e_z JOIN e_med USING (entity, cv), e_set)"""
    for step in range(1, steps + 1):
        sql += f""",
s{step} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s, entity, cv ORDER BY d, id) AS rn
  FROM d{step - 1} WHERE is_fit) WHERE rn <= floor(share * n))"""
        sql += fit(f"s{step}", str(step), f"d{step}")
    sql += f""",
e_lim AS (SELECT s, entity, cv, quantile_cont(d, 0.5) * {KEPT_RATIO} AS upto FROM d{steps} WHERE is_fit GROUP BY 1, 2, 3),
e_kept AS (SELECT * FROM d{steps} JOIN e_lim USING (s, entity, cv) WHERE is_fit AND d <= upto)"""
    return sql + fit("e_kept", "_last", "e_d")


ENVELOPE = COLUMNS + f""",
e_set AS (SELECT 0 AS s, 0.5::DOUBLE AS share, 0 AS centered),
e_r AS (SELECT entity, 0 AS cv, id, true AS is_fit FROM z){_envelopes()},
e_off AS (SELECT entity, quantile_cont(-d, 0.1) AS off FROM e_d GROUP BY 1),
e_flag AS MATERIALIZED (SELECT entity, id AS seg, d AS score, CAST(-d < off AS INTEGER) AS flag
  FROM e_d JOIN e_off USING (entity) WHERE id >= {GENUINE})"""

OCSVM = f""",
o_g AS (SELECT entity, i, any_value(i_scored) AS i_scored, sum(exp(-0.4::DOUBLE * square)) AS g FROM pairs GROUP BY 1, 2),
o_s AS (SELECT entity, i, i_scored, max(g) OVER (PARTITION BY entity) - g AS s FROM o_g),
o_flag AS MATERIALIZED (SELECT entity, i AS seg, s AS score, CAST(s > 1e-5 AS INTEGER) AS flag FROM o_s WHERE i_scored)"""

# The dual at nu < 1, a pair of weights a step and all entities at once, until no pair violates optimality by more than 1e-6;
# s is rho minus the kernel sum, rho the mean over weights off their bounds, else the middle of the bounds.
DUAL = f""",
o_k AS MATERIALIZED (SELECT entity, list(line ORDER BY i) AS k, list(i ORDER BY i) AS ids, list(i_scored ORDER BY i) AS scored FROM (
  SELECT entity, i, any_value(i_scored) AS i_scored, list(exp(-{GAMMA}::DOUBLE * square) ORDER BY j) AS line FROM pairs GROUP BY 1, 2) GROUP BY 1),
o_a AS (SELECT entity, k, list_transform(range(len(k)), lambda p: greatest(0, least(1, {NU} * len(k) - p))::DOUBLE) AS alpha FROM o_k),
o_run AS (
  SELECT entity, 0 AS step, alpha, list_transform(k, lambda line: list_dot_product(line, alpha)) AS grad FROM o_a
  UNION ALL
  SELECT entity, step + 1,
    list_transform(alpha, lambda a, p: CASE WHEN p = i THEN CASE WHEN move = 1 - a THEN 1 ELSE a + move END
                                            WHEN p = j THEN CASE WHEN move = a THEN 0 ELSE a - move END ELSE a END),
    list_transform(grad, lambda g, p: g + move * (k[i][p] - k[j][p]))
  FROM (SELECT *, least(gap / greatest(k[i][i] + k[j][j] - 2 * k[i][j], 1e-12), 1 - alpha[i], alpha[j]) AS move
    FROM (SELECT *, list_position(ups, list_min(ups)) AS i, list_position(downs, list_max(downs)) AS j, list_max(downs) - list_min(ups) AS gap
      FROM (SELECT entity, step, alpha, grad, k,
              list_transform(grad, lambda g, p: CASE WHEN alpha[p] < 1 THEN g ELSE 'infinity'::DOUBLE END) AS ups,
              list_transform(grad, lambda g, p: CASE WHEN alpha[p] > 0 THEN g ELSE '-infinity'::DOUBLE END) AS downs
            FROM o_run JOIN o_k USING (entity)))
    WHERE gap > {TOLERANCE})),
o_end AS MATERIALIZED (SELECT entity, arg_max(alpha, step) AS alpha, arg_max(grad, step) AS grad FROM o_run GROUP BY 1),
o_row AS MATERIALIZED (SELECT entity, unnest(ids) AS i, unnest(scored) AS i_scored, unnest(alpha) AS a, unnest(grad) AS g
  FROM o_end JOIN o_k USING (entity)),
o_rho AS (SELECT entity, coalesce(avg(CASE WHEN a > 0 AND a < 1 THEN g END),
    (min(CASE WHEN a <= 0 THEN g END) + max(CASE WHEN a >= 1 THEN g END)) / 2,
    max(CASE WHEN a >= 1 THEN g END), min(CASE WHEN a <= 0 THEN g END)) AS rho FROM o_row GROUP BY 1),
o_flag AS MATERIALIZED (SELECT entity, i AS seg, rho - g AS score, CAST(rho - g > 1e-5 AS INTEGER) AS flag
  FROM o_row JOIN o_rho USING (entity) WHERE i_scored)"""


def five(parts: str) -> str:
    """Flags of five detectors and their votes."""
    return f"""{parts},
five AS MATERIALIZED ({' UNION ALL '.join(f"SELECT '{n}' AS detector, entity, seg, flag FROM {t}_flag" for n, t in (
    ('centroid', 'c'), ('lof', 'l'), ('iforest', 'f'), ('ocsvm', 'o'), ('envelope', 'e')))}),
votes AS (SELECT entity, seg, CAST(sum(flag) AS INTEGER) AS votes, CAST(sum(flag) > 2 AS INTEGER) AS flag FROM five GROUP BY 1, 2)"""


FIVE = five(LOF + FORESTS + OCSVM + ENVELOPE)
WHOLE_FIVE = five(lof_flags(LOF_NEIGHBOURS) + WHOLE_FORESTS + DUAL + ENVELOPE)


def _grade(source: str) -> str:
    """Weighted grade per entity, candidate and fold, averaged over the folds."""
    return f"""
SELECT detector, entity, candidate, avg(CASE
    WHEN tn + fp + fn = 0 OR tp + fp + fn = 0 THEN (tn + tp) / (tn + fp + fn + tp)
    ELSE (tn + 9 * tp) / (fp + tn + 9 * (tp + fn)) END) AS score
FROM (SELECT detector, entity, cv, candidate,
        sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn, sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
        sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp
      FROM ({source}) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3"""


def _drawn(space: dict[str, list], drawn: int = DRAWN) -> list[dict]:
    """Combinations drawn as the search draws them: lowest md5 first, the last parameter running fastest."""
    size = math.prod(len(v) for v in space.values())
    lowest = sorted((hashlib.md5(f"{SEED}|candidate|{i}".encode()).hexdigest(), i) for i in range(size))[:drawn]
    found = []
    for _, rest in lowest:
        row = {}
        for name, options in reversed(space.items()):
            rest, at = divmod(rest, len(options))
            row[name] = options[at]
        found.append(row)
    return found


def _line(start: float, stop: float, num: int, whole: bool = False) -> list:
    step = (float(stop) - float(start)) / (num - 1)
    values = [float(stop) if i == num - 1 else i * step + float(start) for i in range(num)]
    return [int(v) for v in values] if whole else values


SHARES = _line(0.001, 0.5, 25)
def _candidates(neighbours: tuple, trees: tuple, features: tuple, samples: tuple, drawn: int) -> dict[str, list[dict]]:
    return {
        "centroid": _drawn({"threshold": _line(*THRESHOLDS)}, drawn),
        "lof": _drawn({"n_neighbors": _line(*neighbours, True), "leaf_size": [0] * 25, "algorithm": [0],
                       "contamination": SHARES, "metric": [0]}, drawn),
        "iforest": _drawn({"n_estimators": _line(*trees, True), "max_features": _line(*features, True),
                           "max_samples": _line(*samples, True), "contamination": SHARES, "bootstrap": [True, False]}, drawn),
        "envelope": _drawn({"contamination": SHARES, "support_fraction": _line(*SEARCH_SUPPORT), "assume_centered": [True, False]}, drawn),
    }


CANDIDATES = _candidates(SEARCH_NEIGHBOURS, **SEARCH_FOREST, drawn=DRAWN)
WHOLE_CANDIDATES = _candidates((10, 150, 25), (5, 300, 50), (5, 150, 25), (5, 100, 20), WHOLE_DRAWN)


def _values(rows: list[tuple]) -> str:
    def text(v) -> str:
        return "NULL::DOUBLE" if v is None else f"{v!r}::DOUBLE" if isinstance(v, float) else f"'{v}'" if isinstance(v, str) else str(int(v))

    return "(VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows) + ")"


def _beyond(name: str, source: str) -> str:
    """``{name}_pred``: rows scored beyond the share of the fitted rows' scores, from (candidate, share, entity, cv, id, score, is_fit)."""
    return f""",
{name}_p AS MATERIALIZED (SELECT candidate, share, entity, cv, -score AS v, (count(*) OVER w - 1) * share AS spot,
  row_number() OVER (PARTITION BY candidate, entity, cv ORDER BY -score) - 1 AS pos
  FROM ({source}) WHERE is_fit WINDOW w AS (PARTITION BY candidate, entity, cv)),
{name}_o AS (SELECT candidate, entity, cv, any_value(spot) - floor(any_value(spot)) AS t,
  max(CASE WHEN pos = floor(spot) THEN v END) AS lo, max(CASE WHEN pos = ceil(spot) THEN v END) AS hi FROM {name}_p GROUP BY 1, 2, 3),
{name}_pred AS MATERIALIZED (SELECT candidate, entity, cv, id, CAST(-score < lo + (hi - lo) * t AS INTEGER) AS pred
  FROM ({source}) JOIN {name}_o USING (candidate, entity, cv) WHERE NOT is_fit)"""


def _forest_search() -> str:
    """Forests of every setting over the runs, level by level; candidates take the first trees of their setting's forest."""
    found = CANDIDATES["iforest"]
    settings = sorted({(c["max_samples"], c["max_features"], c["bootstrap"]) for c in found})
    trees = [max(c["n_estimators"] for c in found if (c["max_samples"], c["max_features"], c["bootstrap"]) == s) for s in settings]
    rows = [(i, t, *s) for i, (s, t) in enumerate(zip(settings, trees))]
    tried = [(i, settings.index((c["max_samples"], c["max_features"], c["bootstrap"])), c["n_estimators"], c["contamination"])
             for i, c in enumerate(found)]
    depth = max(math.ceil(math.log2(max(s[0], 2))) for s in settings)
    keys, joined = "entity, cv, s, tree", "USING (entity, cv, s, tree)"
    sql = f""",
h_set AS MATERIALIZED (SELECT * FROM {_values(rows)} AS t(s, trees, samples, features, boot)),
h_t AS MATERIALIZED (SELECT s, samples, features, boot, unnest(range(trees)) AS tree FROM h_set),
h_fit AS MATERIALIZED (SELECT entity, cv, id, row_number() OVER (PARTITION BY entity, cv ORDER BY id) - 1 AS pos FROM r WHERE is_fit),
h_n AS MATERIALIZED (SELECT entity, cv, s, least(samples, count(*)) AS size, count(*) AS n,
  ceil(log2(greatest(least(samples, count(*)), 2))) AS deepest FROM h_fit, h_set GROUP BY entity, cv, s, samples),
h_s AS MATERIALIZED (SELECT {keys}, rn AS draw, id FROM (
    SELECT {keys}, id, samples, row_number() OVER (PARTITION BY {keys}
           ORDER BY md5(concat_ws('|', entity, cv, tree, 'row', id)), id) AS rn FROM h_fit, h_t WHERE boot = 0) WHERE rn <= samples
  UNION ALL SELECT {keys}, draw, id FROM (
    SELECT entity, cv, s, tree, draw, floor(({_uniform("entity", "cv", "tree", "'draw'", "draw")}) * n) AS pos
    FROM (SELECT entity, cv, s, n, unnest(range(size)) AS draw FROM h_n) JOIN h_t USING (s) WHERE boot = 1)
  JOIN h_fit USING (entity, cv, pos)),
h_f AS MATERIALIZED (SELECT {keys}, term, rn FROM (
  SELECT {keys}, term, features, row_number() OVER (PARTITION BY {keys}
         ORDER BY md5(concat_ws('|', entity, cv, tree, 'term', term)), term) AS rn
  FROM (SELECT DISTINCT entity, cv, term FROM v JOIN r USING (entity, cv, id) WHERE is_fit), h_t) WHERE rn <= features),
h_x AS MATERIALIZED (SELECT {keys}, draw, term, rn, coalesce(value, 0.0::DOUBLE) AS x
  FROM h_s JOIN h_f {joined} LEFT JOIN v USING (entity, cv, id, term)),
h_n0 AS MATERIALIZED (SELECT {keys}, draw, 0 AS node FROM h_s),
h_a0 AS MATERIALIZED (SELECT {keys}, id, 0 AS node FROM r, h_t)"""
    leaves = []
    for level in range(depth + 1):
        sql += f""",
h_c{level} AS MATERIALIZED (SELECT {keys}, node, count(*) AS n FROM h_n{level} GROUP BY ALL)"""
        if level == depth:
            leaves.append(f"SELECT {keys}, node, {level} + ({_average_path('n')}) AS path FROM h_c{level}")
            break
        pick, split = (_uniform("entity", "cv", "tree", "node", f"'{w}'") for w in ("feature", "split"))
        sql += f""",
h_u{level} AS (SELECT {keys}, node, term, rn, min(x) AS lo, max(x) AS hi FROM h_n{level} JOIN h_x USING ({keys}, draw)
  JOIN h_n USING (entity, cv, s) WHERE {level} < deepest GROUP BY {keys}, node, term, rn HAVING min(x) < max(x)),
h_o{level} AS (SELECT *, row_number() OVER (PARTITION BY {keys}, node ORDER BY rn) - 1 AS place,
  count(*) OVER (PARTITION BY {keys}, node) AS usable FROM h_u{level}),
h_p{level} AS MATERIALIZED (SELECT {keys}, node, term, lo + ({split}) * (hi - lo) AS split
  FROM h_o{level} WHERE place = floor(({pick}) * usable)),
h_n{level + 1} AS MATERIALIZED (SELECT {keys}, draw, CASE WHEN x <= split THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
  FROM h_n{level} JOIN h_p{level} USING ({keys}, node) JOIN h_x USING ({keys}, draw, term)),
h_a{level + 1} AS MATERIALIZED (SELECT a.entity, a.cv, a.s, a.tree, a.id,
  CASE WHEN p.split IS NULL THEN a.node WHEN coalesce(v.value, 0) <= p.split THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node
  FROM h_a{level} a LEFT JOIN h_p{level} p USING ({keys}, node)
  LEFT JOIN v ON v.entity = a.entity AND v.cv = a.cv AND v.id = a.id AND v.term = p.term)"""
        leaves.append(f"SELECT {keys}, node, {level} + ({_average_path('n')}) AS path FROM h_c{level} ANTI JOIN h_p{level} USING ({keys}, node)")
    sql += f""",
h_l AS MATERIALIZED ({' UNION ALL '.join(leaves)}),
h_cand AS (SELECT * FROM {_values(tried)} AS t(candidate, s, counted, share)),
h_score AS MATERIALIZED (SELECT candidate, any_value(share) AS share, entity, cv, id,
  round(pow(2.0::DOUBLE, -avg(path) / CASE WHEN any_value(size) <= 1 THEN 1 ELSE any_value({_average_path('size')}) END), 9) AS score
  FROM h_a{depth} JOIN h_l USING ({keys}, node) JOIN h_n USING (entity, cv, s) JOIN h_cand USING (s) WHERE tree < counted
  GROUP BY candidate, entity, cv, id)"""
    return sql + _beyond("h", "SELECT * FROM h_score JOIN r USING (entity, cv, id)")


def _whole_forest_search() -> str:
    """The same for the full space, a forest per group and size: samples and terms beyond what a group has change nothing.

    A tree has one number and a row the list of its values in the order of the tree's terms.
    """
    found = WHOLE_CANDIDATES["iforest"]
    tried = _values([(i, c["n_estimators"], c["max_samples"], c["max_features"], c["bootstrap"], c["contamination"])
                     for i, c in enumerate(found)])
    trees, depth = max(c["n_estimators"] for c in found), math.ceil(math.log2(max(c["max_samples"] for c in found)))
    sql = f""",
h_fit AS MATERIALIZED (SELECT entity, cv, id, row_number() OVER (PARTITION BY entity, cv ORDER BY id) - 1 AS pos FROM r WHERE is_fit),
h_term AS MATERIALIZED (SELECT DISTINCT entity, cv, term FROM v JOIN r USING (entity, cv, id) WHERE is_fit),
h_g AS MATERIALIZED (SELECT * FROM (SELECT entity, cv, count(*) AS n FROM h_fit GROUP BY 1, 2)
  JOIN (SELECT entity, cv, count(*) AS terms FROM h_term GROUP BY 1, 2) USING (entity, cv)),
h_want AS MATERIALIZED (SELECT entity, cv, candidate, counted, share, boot, least(samples, n) AS size, least(features, terms) AS wide
  FROM h_g, {tried} AS t(candidate, counted, samples, features, boot, share)),
h_set AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY entity, cv, size, wide, boot) AS s FROM (
  SELECT entity, cv, size, wide, boot, max(counted) AS trees FROM h_want GROUP BY 1, 2, 3, 4, 5)),
h_try AS (SELECT entity, cv, unnest(range({trees})) AS tree FROM h_g),
h_t AS MATERIALIZED (SELECT *, s * {trees} + tree AS no FROM (
  SELECT entity, cv, s, size, wide, boot, ceil(log2(greatest(size, 2))) AS deepest, unnest(range(trees)) AS tree FROM h_set)),
h_l AS MATERIALIZED (SELECT entity, cv, tree, id, list(coalesce(value, 0.0::DOUBLE) ORDER BY rn) AS xs FROM (
  SELECT entity, cv, tree, term, row_number() OVER (PARTITION BY entity, cv, tree
         ORDER BY md5(concat_ws('|', entity, cv, tree, 'term', term)), term) AS rn FROM h_term JOIN h_try USING (entity, cv))
  JOIN r USING (entity, cv) LEFT JOIN v USING (entity, cv, id, term) GROUP BY 1, 2, 3, 4),
h_n0 AS MATERIALIZED (
  SELECT no, draw, id, 0 AS node FROM h_t JOIN (
    SELECT entity, cv, tree, id, row_number() OVER (PARTITION BY entity, cv, tree
           ORDER BY md5(concat_ws('|', entity, cv, tree, 'row', id)), id) AS draw FROM h_fit JOIN h_try USING (entity, cv))
    USING (entity, cv, tree) WHERE boot = 0 AND draw <= size
  UNION ALL SELECT no, draw, id, 0 FROM h_t JOIN (
    SELECT entity, cv, tree, draw, floor(({_uniform("entity", "cv", "tree", "'draw'", "draw")}) * n) AS pos
    FROM (SELECT entity, cv, n, unnest(range(n)) AS draw FROM h_g) JOIN h_try USING (entity, cv))
    USING (entity, cv, tree) JOIN h_fit USING (entity, cv, pos) WHERE boot = 1 AND draw < size),
h_a0 AS MATERIALIZED (SELECT no, id, 0 AS node FROM h_t JOIN r USING (entity, cv))"""
    leaves = []
    for level in range(depth + 1):
        sql += f""",
h_c{level} AS MATERIALIZED (SELECT no, node, count(*) AS n FROM h_n{level} GROUP BY ALL)"""
        if level == depth:
            leaves.append(f"SELECT no, node, {level} + ({_average_path('n')}) AS path FROM h_c{level}")
            break
        pick, split = (_uniform("entity", "cv", "tree", "node", f"'{w}'") for w in ("feature", "split"))
        sql += f""",
h_u{level} AS (SELECT no, node, rn, min(x) AS lo, max(x) AS hi FROM (
  SELECT no, node, unnest(xs[1:wide]) AS x, unnest(range(1, wide + 1)) AS rn
  FROM h_n{level} JOIN h_t USING (no) JOIN h_l USING (entity, cv, tree, id) WHERE {level} < deepest)
  GROUP BY 1, 2, 3 HAVING min(x) < max(x)),
h_o{level} AS (SELECT *, row_number() OVER (PARTITION BY no, node ORDER BY rn) - 1 AS place,
  count(*) OVER (PARTITION BY no, node) AS usable FROM h_u{level}),
h_p{level} AS MATERIALIZED (SELECT no, node, rn, lo + ({split}) * (hi - lo) AS split
  FROM h_o{level} JOIN h_t USING (no) WHERE place = floor(({pick}) * usable)),
h_n{level + 1} AS MATERIALIZED (SELECT no, draw, id, CASE WHEN xs[rn] <= split THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
  FROM h_n{level} JOIN h_p{level} USING (no, node) JOIN h_t USING (no) JOIN h_l USING (entity, cv, tree, id)),
h_a{level + 1} AS MATERIALIZED (SELECT a.no, a.id, CASE WHEN p.split IS NULL THEN a.node
    WHEN l.xs[p.rn] <= p.split THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node
  FROM h_a{level} a LEFT JOIN h_p{level} p USING (no, node) JOIN h_t t USING (no)
  JOIN h_l l ON l.entity = t.entity AND l.cv = t.cv AND l.tree = t.tree AND l.id = a.id)"""
        leaves.append(f"SELECT no, node, {level} + ({_average_path('n')}) AS path FROM h_c{level} "
                      f"WHERE (no, node) NOT IN (SELECT (no, node) FROM h_p{level})")
    sql += f""",
h_e AS MATERIALIZED (SELECT entity, cv, size, wide, boot, tree, id, path FROM h_a{depth} JOIN ({' UNION ALL '.join(leaves)})
  USING (no, node) JOIN h_t USING (no)),
h_score AS MATERIALIZED (SELECT candidate, any_value(share) AS share, entity, cv, id,
  round(pow(2.0::DOUBLE, -avg(path) / CASE WHEN any_value(size) <= 1 THEN 1 ELSE any_value({_average_path('size')}) END), 9) AS score
  FROM h_e JOIN h_want USING (entity, cv, size, wide, boot) WHERE tree < counted GROUP BY candidate, entity, cv, id)"""
    return sql + _beyond("h", "SELECT * FROM h_score JOIN r USING (entity, cv, id)")


def _search(candidates: dict[str, list[dict]], forests: str) -> str:
    sql = RUNS + CENTROID + PAIRS
    thresholds = _values([(i, c["threshold"]) for i, c in enumerate(candidates["centroid"])])
    parts = [f"""SELECT 'centroid' AS detector, entity, cv, candidate, id, CAST(ratio > threshold AS INTEGER) AS pred
FROM c_r, {thresholds} AS tried(candidate, threshold)"""]
    near = candidates["lof"]
    for k in sorted({c["n_neighbors"] for c in near}):
        sql += lof(k, f"l{k}")
        mine = _values([(i, c["contamination"]) for i, c in enumerate(near) if c["n_neighbors"] == k])
        sql += _beyond(f"b{k}", f"""SELECT candidate, share, entity, cv, i AS id, factor AS score, is_fit
  FROM (SELECT *, true AS is_fit FROM l{k}_fit UNION ALL SELECT *, false FROM l{k}_new), {mine} AS t(candidate, share)""")
        parts.append(f"SELECT 'lof' AS detector, entity, cv, candidate, id, pred FROM b{k}_pred")
    sql += forests
    parts.append("SELECT 'iforest' AS detector, entity, cv, candidate, id, pred FROM h_pred")
    found = candidates["envelope"]
    settings = sorted({(c["support_fraction"], c["assume_centered"]) for c in found})
    tried = _values([(i, settings.index((c["support_fraction"], c["assume_centered"])), c["contamination"]) for i, c in enumerate(found)])
    sql += COLUMNS + f""",
e_set AS (SELECT * FROM {_values([(i, *s) for i, s in enumerate(settings)])} AS t(s, share, centered)),
e_r AS (SELECT entity, cv, id, is_fit FROM r){_envelopes()}"""
    sql += _beyond("e", f"""SELECT candidate, t.share, entity, cv, id, d AS score, is_fit FROM e_d JOIN {tried} AS t(candidate, s, share) USING (s)""")
    parts.append("SELECT 'envelope' AS detector, entity, cv, candidate, id, pred FROM e_pred")
    judged = f"SELECT p.*, label FROM ({' UNION ALL '.join(parts)}) p JOIN lab ON lab.entity = p.entity AND lab.seg = p.id"
    return f"WITH {sql},\nscores AS MATERIALIZED ({_grade(judged)})"


SEARCH = _search(CANDIDATES, _forest_search())
WHOLE_SEARCH = _search(WHOLE_CANDIDATES, _whole_forest_search())
WINNERS = """,
best AS MATERIALIZED (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY detector, entity ORDER BY round(score, 9) DESC, candidate) AS rn FROM scores)
  WHERE rn = 1)"""
BEST = SEARCH + WINNERS
SETTINGS = _values([(name, i, *[None if c.get(p) is None else float(c[p]) for p in PARAMETERS])
                    for name, found in CANDIDATES.items() for i, c in enumerate(found)])


def _summary(cascade: bool) -> str:
    """Winners, their means, medians and deviations; ``cascade`` counts the rows before each in."""
    columns = [*PARAMETERS, "score"]

    def row(name: str, call: str, source: str) -> str:
        return f"SELECT detector, '{name}' AS row, {', '.join(call.format(c) + f' AS {c}' for c in columns)} FROM {source} GROUP BY detector"

    first = "SELECT * FROM won"
    means = row("mean", "avg({})", "won")
    medians = row("median", "quantile_cont({}, 0.5)", f"({first} UNION ALL SELECT * FROM means)" if cascade else "won")
    spread = f"({first} UNION ALL SELECT * FROM means UNION ALL SELECT * FROM medians)" if cascade else "won"
    return f"""{BEST},
won AS MATERIALIZED (SELECT b.detector, CAST(entity AS VARCHAR) AS row, {', '.join(PARAMETERS)}, round(score, 9) AS score
  FROM best b JOIN {SETTINGS} AS c(detector, candidate, {', '.join(PARAMETERS)}) ON b.detector = c.detector AND b.candidate = c.candidate),
means AS MATERIALIZED ({means}),
medians AS MATERIALIZED ({medians}),
spreads AS ({row("std", "stddev_samp({})", spread)})
SELECT detector, row, {', '.join(f'round({c}, 6) AS {c}' for c in columns)} FROM (
  SELECT * FROM won UNION ALL SELECT * FROM means UNION ALL SELECT * FROM medians UNION ALL SELECT * FROM spreads)"""


TERMS = r"""
terms AS MATERIALIZED (
  SELECT source AS entity, doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
cnt AS MATERIALIZED (SELECT entity, doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2, 3)"""

SPLIT = f"""
split AS MATERIALIZED (
  SELECT doc_id, row_number() OVER (ORDER BY md5('{SPLIT_SEED}|split|' || doc_id), doc_id) - 1
                 >= (SELECT ceil(count(*) * 0.2) FROM documents) AS is_train FROM documents)"""

SCORED_DOCS = f"""
docs AS MATERIALIZED (
  SELECT d.doc_id, lang, toxic AS label, quality, n_chars AS score, CAST(n_chars >= {LONG_TEXT} AS INTEGER) AS pred
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _area(order: str, name: str) -> str:
    return f"""SELECT lang, '{name}' AS "order",
  CASE WHEN min(dx) IS NULL THEN -1.0 WHEN min(dx) >= 0 THEN sum(a) WHEN max(dx) <= 0 THEN -sum(a) ELSE -1.0 END AS auc
FROM (SELECT lang, x - x0 AS dx, (x - x0) * (y + y0) / 2 AS a FROM (
  SELECT lang, score AS x, quality AS y, lag(score) OVER w AS x0, lag(quality) OVER w AS y0
  FROM docs WINDOW w AS (PARTITION BY lang ORDER BY {order}))) GROUP BY 1"""


ORACLES: dict[str, str] = {
    "read_tokens": f"WITH {LINES} SELECT entity, pos, token FROM tok",
    "segments": f"WITH {LINES} SELECT entity, pos, seg, token FROM tok",
    "segment_documents": f"WITH {LINES} SELECT entity, seg, string_agg(token, ' ' ORDER BY pos) AS doc FROM tok GROUP BY 1, 2",
    "split_genuine": f"""WITH {LINES} SELECT entity, seg, count(*) AS n_tokens,
        CASE WHEN seg < {GENUINE} THEN 'genuine' ELSE 'unlabelled' END AS part FROM tok GROUP BY 1, 2""",
    "vocab_segment": f'WITH {LINES} SELECT entity, seg, token, count(*) AS "count" FROM tok GROUP BY 1, 2, 3',
    "vocab_entity": f'WITH {LINES} SELECT entity, token, count(*) AS "count" FROM tok GROUP BY 1, 2',
    "vocab_total": f'WITH {LINES} SELECT token, count(*) AS "count" FROM tok GROUP BY 1',
    "vocab_levels": f"""WITH {LINES} SELECT CASE grouping(entity, seg) WHEN 0 THEN 'segment' WHEN 1 THEN 'entity' ELSE 'total' END AS level,
        entity, seg, token, count(*) AS "count" FROM tok GROUP BY GROUPING SETS ((entity, seg, token), (entity, token), (token))""",
    "vocab_ranked": f"""WITH {LINES} SELECT entity, token, n AS "count",
        row_number() OVER (PARTITION BY entity ORDER BY n DESC, token) AS rank
        FROM (SELECT entity, token, count(*) AS n FROM tok GROUP BY 1, 2)""",
    "tf_l2": f"WITH {VECTORS} SELECT entity, seg, term, round(value, 6) AS value FROM feat",
    "centroid_distances": f"WITH {VECTORS}{CENTROID} SELECT entity, id AS seg, round(dist, 6) AS dist FROM c_d",
    "knn_segments": f"""WITH {VECTORS}{PAIRS}
        SELECT entity, i AS seg, CAST(rn AS INTEGER) AS rank, j AS neighbour, dist FROM (
          SELECT *, row_number() OVER (PARTITION BY entity, i ORDER BY dist, j) AS rn FROM pairs WHERE i <> j)
        WHERE rn <= {NEIGHBOURS}""",
    "detect_centroid": f"WITH {VECTORS}{CENTROID} SELECT entity, seg, round(score, 6) AS score, flag FROM c_flag",
    "detect_lof": f"WITH {VECTORS}{LOF} SELECT entity, seg, score, flag FROM l_flag",
    "detect_iforest": f"WITH {VECTORS}{WHOLE_FORESTS} SELECT entity, seg, score, flag FROM f_flag",
    "detect_ocsvm_nu1": f"WITH {VECTORS}{PAIRS}{OCSVM} SELECT entity, seg, round(score, 6) AS score, flag FROM o_flag",
    "ocsvm_optimality": f"""WITH {VECTORS} SELECT entity, count(*) AS n, round({NU}::DOUBLE * count(*), 6) AS total, true AS optimal
        FROM r WHERE is_fit GROUP BY 1""",
    "detect_envelope_2d": f"WITH {LINES}{ENVELOPE} SELECT entity, seg, score, flag FROM e_flag",
    "majority_vote": f"""WITH {VECTORS}{CENTROID}{LOF}{FORESTS}
        SELECT entity, seg, CAST(sum(flag) AS INTEGER) AS votes, CAST(sum(flag) > 1 AS INTEGER) AS flag
        FROM (SELECT entity, seg, flag FROM c_flag UNION ALL SELECT entity, seg, flag FROM l_flag
              UNION ALL SELECT entity, seg, flag FROM f_flag) GROUP BY 1, 2""",
    "majority_vote_of_five": f"WITH RECURSIVE {VECTORS}{CENTROID}{WHOLE_FIVE} SELECT entity, seg, votes, flag FROM votes",
    "labels_unpivot": f"WITH {LINES} SELECT entity, seg, label FROM partial WHERE label IS NOT NULL",
    "labelled_segments": f"""WITH {LINES} SELECT entity, seg, doc, label FROM partial JOIN (
        SELECT entity, seg, string_agg(token, ' ' ORDER BY pos) AS doc FROM tok GROUP BY 1, 2) USING (entity, seg)
        WHERE label IS NOT NULL""",
    "submission_matrix": f"""WITH {VECTORS}{CENTROID} SELECT entity, seg, coalesce(label, flag) AS label
        FROM partial LEFT JOIN c_flag USING (entity, seg)""",
    "evaluate_detectors": f"""WITH {VECTORS}{CENTROID}{FIVE},
        u AS (SELECT detector, entity, seg, flag FROM five UNION ALL SELECT 'vote', entity, seg, flag FROM votes),
        e AS (SELECT detector, entity, avg(CAST(label = flag AS INTEGER)) AS acc,
          sum(CASE WHEN label = 0 AND flag = 0 THEN 1 ELSE 0 END) AS tn, sum(CASE WHEN label = 0 AND flag = 1 THEN 1 ELSE 0 END) AS fp,
          sum(CASE WHEN label = 1 AND flag = 0 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN label = 1 AND flag = 1 THEN 1 ELSE 0 END) AS tp
          FROM u JOIN lab USING (entity, seg) WHERE entity IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 4500) GROUP BY 1, 2)
        SELECT detector, round(avg(acc), 6) AS accuracy, round(avg(tn), 6) AS true_negative, round(avg(fn), 6) AS false_negative,
          round(avg(tp), 6) AS true_positive, round(avg(fp), 6) AS false_positive FROM e GROUP BY 1""",
    "weighted_grade": f"""WITH {VECTORS}{CENTROID}
        SELECT entity, round(score, 6) AS grade FROM ({_grade(
            "SELECT 'centroid' AS detector, entity, 0 AS cv, 0 AS candidate, label, flag AS pred FROM c_flag JOIN lab USING (entity, seg)")})""",
    "confusion_matrix": f"""WITH {VECTORS}{CENTROID} SELECT label, flag AS pred, count(*) AS n
        FROM c_flag JOIN lab USING (entity, seg) GROUP BY 1, 2""",
    "search_scores": f"{WHOLE_SEARCH} SELECT detector, entity, candidate, round(score, 6) AS score FROM scores",
    "search_best": f"{WHOLE_SEARCH}{WINNERS} SELECT detector, entity, candidate, round(score, 9) AS score FROM best",
    "search_summary": _summary(False),
    "search_summary_cascade": _summary(True),
    "tokenize": r"""SELECT entity, doc_id, CAST(idx - 1 AS INTEGER) AS idx, terms[idx] AS term FROM (
        SELECT entity, doc_id, terms, unnest(range(1, len(terms) + 1)) AS idx FROM (
          SELECT source AS entity, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS terms FROM documents))""",
    "vocabulary": f"""WITH {TERMS} SELECT entity, term, dense_rank() OVER (PARTITION BY entity ORDER BY term) - 1 AS term_id
        FROM (SELECT DISTINCT entity, term FROM cnt)""",
    "term_counts": f"""WITH {TERMS}, voc AS (
          SELECT entity, term, row_number() OVER (PARTITION BY entity ORDER BY term) - 1 AS term_id
          FROM (SELECT DISTINCT entity, term FROM cnt))
        SELECT entity, doc_id, term_id, term, tf FROM cnt JOIN voc USING (entity, term)""",
    "tfidf_l2": f"""WITH {TERMS},
        n AS (SELECT source AS entity, count(*) AS n FROM documents GROUP BY 1),
        idf AS (SELECT entity, term, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1 AS idf
          FROM (SELECT entity, term, count(*) AS df FROM cnt GROUP BY 1, 2) JOIN n USING (entity)),
        w AS (SELECT entity, doc_id, term, tf * idf AS w FROM cnt JOIN idf USING (entity, term))
        SELECT entity, doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY entity, doc_id)), 6) AS value FROM w""",
    "tfidf_train_test": f"""WITH {TERMS}, {SPLIT},
        c AS (SELECT doc_id, is_train, term, tf FROM cnt JOIN split USING (doc_id)),
        idf AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM split WHERE is_train)) / (1.0::DOUBLE + count(*))) + 1 AS idf
          FROM c WHERE is_train GROUP BY 1),
        w AS (SELECT doc_id, is_train, term, tf * idf AS w FROM c JOIN idf USING (term))
        SELECT doc_id, is_train, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS value FROM w""",
    "train_test_split": f"WITH {SPLIT} SELECT doc_id, is_train FROM split",
    "stratified_folds": f"""SELECT doc_id, toxic AS label, CAST((row_number() OVER (PARTITION BY toxic
        ORDER BY md5('{SPLIT_SEED}|fold|' || doc_id), doc_id) - 1) % 3 AS INTEGER) AS fold FROM labels""",
    "class_weights": """SELECT toxic AS label, count(*) AS n,
        round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT toxic) FROM labels) * count(*)), 6) AS weight
        FROM labels GROUP BY 1""",
    "upsample_minority": f"""WITH mino AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS m FROM labels WHERE toxic = 1),
        draws AS (SELECT unnest(range((SELECT count(*) FROM labels WHERE toxic = 0))) AS draw),
        p AS (SELECT draw, floor({_uniform(f"'{SPLIT_SEED}'", "'draw'", "draw")} * (SELECT count(*) FROM mino)) AS m FROM draws)
        SELECT doc_id, toxic AS label, NULL::BIGINT AS draw FROM labels WHERE toxic = 0
        UNION ALL SELECT doc_id, 1 AS label, draw FROM p JOIN mino ON p.m = mino.m""",
    "binary_metrics": f"""WITH {SCORED_DOCS}, c AS (SELECT lang,
          sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END)::BIGINT AS tn, sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END)::BIGINT AS fp,
          sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END)::BIGINT AS fn, sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END)::BIGINT AS tp
          FROM docs GROUP BY 1)
        SELECT lang, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
          round(CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END, 6) AS precision,
          round(CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END, 6) AS recall,
          round(CASE WHEN 2 * tp + fp + fn = 0 THEN 1.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1_score, tn, fp, fn, tp FROM c""",
    "roc_auc": f"""WITH {SCORED_DOCS}, k AS (SELECT lang, label,
          rank() OVER (PARTITION BY lang ORDER BY score) + (count(*) OVER (PARTITION BY lang, score) - 1) / 2 AS rk FROM docs),
        s AS (SELECT lang, sum(CASE WHEN label = 1 THEN rk ELSE 0 END) AS r, sum(label) AS p, count(*) - sum(label) AS n FROM k GROUP BY 1)
        SELECT lang, round(CASE WHEN p * n = 0 THEN -1.0 ELSE (r - p * (p + 1) / 2) / (p * n) END, 6) AS roc_auc FROM s""",
    "auc_trapezoid": f"""WITH {SCORED_DOCS} SELECT lang, "order", round(auc, 6) AS auc FROM (
        {_area("score, doc_id", "length")} UNION ALL {_area("doc_id", "id")})""",
}
ORACLES["vocab_csv_roundtrip"] = ORACLES["vocab_levels"]
