"""Cross-validated parameter search, all entities and folds in the same Spark jobs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.detectors.centroid import NOISE, relative_distances
from driftwarden.detectors.envelope import STEPS, GroupEnvelope, detect_envelope
from driftwarden.detectors.iforest import detect_iforest, group_forest
from driftwarden.detectors.lof import QUERY, lof_factors, lof_neighbours
from driftwarden.detectors.ocsvm import TOLERANCE, descend, detect_ocsvm, middle_of
from driftwarden.operators import blocks
from driftwarden.operators.blocks import by_group, by_size, typed
from driftwarden.operators.dense import matrix, squared_distances
from driftwarden.operators.grids import Space, param_sample
from driftwarden.operators.metrics import grade_cells, weighted_grade
from driftwarden.operators.neighbours import with_vector_key
from driftwarden.operators.ranking import group_percentile, group_percentiles
from driftwarden.operators.sampling import FOLDS
from driftwarden.operators.skew import attach, join_scalars, largest_group
from driftwarden.plans.spaces import CANDIDATES, SEED
from driftwarden.runtime import cut

Detector = Callable[..., DataFrame]
# Detectors that run once per candidate in big groups, with the parameters of their space under their own names.
DETECTORS: dict[str, tuple[Detector, dict[str, str]]] = {
    "iforest": (detect_iforest, {"n_estimators": "trees", "max_samples": "samples", "max_features": "features",
                                 "bootstrap": "bootstrap", "contamination": "contamination"}),
    "ocsvm": (detect_ocsvm, {"nu": "nu", "gamma": "gamma"}),
    "envelope": (detect_envelope, {"support_fraction": "support", "assume_centered": "centered",
                                   "contamination": "contamination"}),
}


def cross_validated(vectors: DataFrame, folds: DataFrame, keys: Sequence[str], n_folds: int = FOLDS) -> DataFrame:
    """Repeat every vector once per fold (column ``cv``): scored in its own fold, fitted in the others."""
    rows = vectors.select(*keys, "terms", "vals").join(folds.select(*keys, "fold", "label"), list(keys))
    runs = rows.withColumn("cv", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
    return (runs.withColumn("is_fit", F.col("fold") != F.col("cv"))
            .withColumn("is_scored", F.col("fold") == F.col("cv")).drop("fold"))


def _graded(counts: DataFrame, group: list[str]) -> DataFrame:
    """Grades from rows (group, candidate, label, pred, n)."""
    def cell(label: int, pred: int) -> Column:
        return F.sum(F.when((F.col("label") == label) & (F.col("pred") == pred), F.col("n")).otherwise(0))

    cells = counts.groupBy(*group, "candidate").agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"),
                                                    cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))
    return grade_cells(cells, [*group, "candidate"])


def _mean_grades(grades: DataFrame, entity: Sequence[str], detector: str) -> DataFrame:
    return (grades.groupBy(*entity, "candidate").agg(F.avg("grade").alias("score"))
            .select(F.lit(detector).alias("detector"), *entity, "candidate", "score"))


def search_centroid(runs: DataFrame, entity: Sequence[str], id_col: str, thresholds: Sequence[float],
                    largest: int | None = None) -> DataFrame:
    """(detector, entity, candidate, score) for distance thresholds in rising order.

    A row's flags for all thresholds follow from how many of them its ratio exceeds,
    so rows are counted per (fold, label, exceeded) and candidates meet only those counts.
    """
    if list(thresholds) != sorted(thresholds):
        raise ValueError("thresholds must rise")
    group = [*entity, "cv"]
    ratios = relative_distances(runs, group, id_col, largest)
    labels = runs.filter("is_scored").select(*group, id_col, "label")
    exceeded = reduce(lambda a, b: a + b, [(F.col("ratio") > t).cast("int") for t in thresholds])
    counts = (ratios.join(labels, [*group, id_col]).withColumn("_over", exceeded)
              .groupBy(*group, "label", "_over").agg(F.count(F.lit(1)).alias("n")))
    tried = counts.withColumn("candidate", F.explode(F.sequence(F.lit(0), F.lit(len(thresholds) - 1))))
    tried = tried.withColumn("pred", (F.col("candidate") < F.col("_over")).cast("int"))
    return _mean_grades(_graded(tried, group), entity, "centroid")


def search_lof(runs: DataFrame, entity: Sequence[str], id_col: str, candidates: Sequence[tuple[int, float]],
               largest: int | None = None) -> DataFrame:
    """(detector, entity, candidate, score) for (neighbours, contamination) pairs.

    Neighbour lists are found once for the largest number of neighbours, factors once
    per number, and rows with the same vector and label are counted before grading.
    """
    group = [*entity, "cv"]
    near = lof_neighbours(runs, group, id_col, max(k for k, _ in candidates), largest=largest)
    scored = cut(with_vector_key(runs.filter("is_scored")).groupBy(*group, "vkey", "label")
                 .agg(F.count(F.lit(1)).alias("n")), "scored")
    parts = []
    for k in sorted({k for k, _ in candidates}):
        shares = [(i, c) for i, (kk, c) in enumerate(candidates) if kk == k]
        factors = cut(lof_factors(near, group, k), "factors")
        negative = factors.filter(F.col("member") != QUERY).withColumn("_negative", -F.col("factor"))
        limits = group_percentiles(negative, group, "_negative", [c for _, c in shares], "_limits", "copies", largest)
        asked = factors.filter(F.col("member") == QUERY).select(*group, "vkey", "factor")
        rated = join_scalars(asked, limits, group, ["vkey"], largest=largest).join(scored, [*group, "vkey"])
        numbers = F.array(*[F.lit(i) for i, _ in shares])
        tried = rated.select(*group, "label", "n", "factor", F.explode(F.arrays_zip(
            "_limits", numbers.alias("number"))).alias("_c"))
        parts.append(tried.select(*group, "label", "n", F.col("_c.number").alias("candidate"),
                                  (-F.col("factor") < F.col("_c._limits")).cast("int").alias("pred")))
    return _mean_grades(_graded(reduce(DataFrame.unionByName, parts), group), entity, "lof")


def search_detector(runs: DataFrame, entity: Sequence[str], id_col: str, name: str, detect: Detector,
                    candidates: Sequence[dict[str, Any]]) -> DataFrame:
    """The same for any detector: each candidate is one run over all entities and folds at once."""
    group = [*entity, "cv"]
    largest = largest_group(runs, group)
    labels = runs.filter("is_scored").select(*group, id_col, "label")
    parts = []
    for number, params in enumerate(candidates):
        flags = detect(runs, group, id_col, largest=largest, **params).withColumnRenamed("flag", "pred")
        grades = weighted_grade(flags.join(labels, [*group, id_col]), group)
        parts.append(cut(grades.withColumn("candidate", F.lit(number)), "grades"))
    return _mean_grades(reduce(DataFrame.unionByName, parts), entity, name)


# A group of up to so many rows is searched by one task, every model being fitted once for all candidates that share it.
GROUP_ROWS = 1_024
PARAMETERS = ["threshold", "n_neighbors", "contamination", "n_estimators", "max_features", "max_samples", "bootstrap",
              "nu", "gamma", "support_fraction", "assume_centered"]


def draw_candidates(spark: SparkSession, of: Mapping[str, Space], n: int = CANDIDATES, seed: int = SEED) -> dict[str, list[dict]]:
    """``n`` combinations at most of each detector's space, drawn by hash; a list position is the candidate's number."""
    return {name: [r.asDict() for r in param_sample(spark, space, n, seed).collect()] for name, space in of.items()}


def candidate_table(spark: SparkSession, candidates: Mapping[str, Sequence[dict]]) -> DataFrame:
    """(detector, candidate, PARAMETERS as double): the settings that can change a result."""
    rows = [(name, i, *[None if c.get(p) is None else float(c[p]) for p in PARAMETERS])
            for name, found in candidates.items() for i, c in enumerate(found)]
    return spark.createDataFrame(rows, "detector string, candidate int, " + ", ".join(f"{p} double" for p in PARAMETERS))


def _beyond(scores: np.ndarray, fit: np.ndarray, contamination: float) -> np.ndarray:
    """Whether each score is beyond the share ``contamination`` of the fitted rows' scores, highest first."""
    ordered = np.sort(-scores[fit])
    if not len(ordered):
        return np.zeros(len(scores), bool)
    spot = (len(ordered) - 1) * contamination
    low, high = ordered[math.floor(spot)], ordered[math.ceil(spot)]
    return -scores < low + (high - low) * (spot - math.floor(spot))


def _try_centroid(key: tuple, rows: pd.DataFrame, id_col: str, found: Sequence[dict]) -> Iterator[np.ndarray]:
    x, fit, scored = _dense(rows), rows["is_fit"].to_numpy(dtype=bool), rows["is_scored"].to_numpy(dtype=bool)
    centre = x[fit].mean(0) if fit.any() else np.zeros(x.shape[1])
    own, middle = (x * x).sum(1), centre @ centre
    square = own - 2 * x @ centre + middle
    dist = np.sqrt(np.where(square > NOISE * (own + middle), square, 0.0))
    mean = dist[scored].mean() if scored.any() else 0.0
    ratio = dist / mean if mean > 0 else np.zeros(len(dist))
    for c in found:
        yield (ratio > c["threshold"]) & fit.any()


def _dense(rows: pd.DataFrame) -> np.ndarray:
    return matrix(rows["terms"], rows["vals"], pd.Index(sorted(set().union(*rows["terms"]))))


def _try_lof(key: tuple, rows: pd.DataFrame, id_col: str, found: Sequence[dict]) -> Iterator[np.ndarray]:
    fit, ids = np.flatnonzero(rows["is_fit"]), rows[id_col].to_numpy()
    names = pd.factorize(pd.Series([(tuple(t), tuple(v)) for t, v in zip(rows["terms"], rows["vals"])]))[0]
    dist = np.sqrt(squared_distances(rows, rows.iloc[fit]))
    dist[names[:, None] == names[fit][None, :]] = 0.0
    dist = np.round(dist, 9)
    order = np.lexsort((np.broadcast_to(ids[fit], dist.shape), dist))  # of the fitted rows, for every row
    own = np.full(len(rows), -1)
    own[fit] = np.arange(len(fit))
    factors = {}
    for k in {c["n_neighbors"] for c in found} if len(fit) > 1 else ():
        k_ = max(min(k, len(fit) - 1), 1)
        others = order[fit][order[fit] != own[fit][:, None]].reshape(len(fit), -1)[:, :k_]
        reach = np.take_along_axis(dist[fit], others, 1)
        limit = reach.max(1)
        density = 1 / (np.maximum(reach, limit[others]).mean(1) + 1e-10)
        fitted = np.round(density[others].mean(1) / density, 9)
        near = order[:, :k_]
        mine = 1 / (np.maximum(np.take_along_axis(dist, near, 1), limit[near]).mean(1) + 1e-10)
        factors[k] = fitted, np.round(density[near].mean(1) / mine, 9)
    for c in found:
        if not factors:
            yield np.zeros(len(rows), bool)
            continue
        fitted, asked = factors[c["n_neighbors"]]
        both = np.concatenate([asked, fitted])
        yield _beyond(both, np.arange(len(both)) >= len(rows), c["contamination"])[:len(rows)]


def _try_iforest(key: tuple, rows: pd.DataFrame, id_col: str, found: Sequence[dict]) -> Iterator[np.ndarray]:
    fit = rows["is_fit"].to_numpy(dtype=bool)
    settings = [(c["n_estimators"], c["max_samples"], c["max_features"], c["bootstrap"]) for c in found]
    scores = group_forest(key, rows, id_col, settings)
    for setting, c in zip(settings, found):
        yield _beyond(scores[setting], fit, c["contamination"])


def _try_ocsvm(key: tuple, rows: pd.DataFrame, id_col: str, found: Sequence[dict]) -> Iterator[np.ndarray]:
    square, fit = squared_distances(rows, rows), rows["is_fit"].to_numpy(dtype=bool)
    order = np.flatnonzero(fit)
    kernels = {g: np.exp(-g * square) for g in {c["gamma"] for c in found}}
    for c in found:
        if not len(order):
            yield fit
            continue
        kernel = kernels[c["gamma"]]
        inner = kernel[np.ix_(order, order)]
        room = np.ones(len(order))
        alpha = np.clip(c["nu"] * len(order) - np.arange(len(order)), 0.0, 1.0)
        alpha, grad = descend(inner, alpha, inner @ alpha, room, TOLERANCE)
        yield middle_of(alpha, grad, room) - kernel[:, order] @ alpha > 10 * TOLERANCE


def _try_envelope(key: tuple, rows: pd.DataFrame, id_col: str, found: Sequence[dict]) -> Iterator[np.ndarray]:
    group, dist = GroupEnvelope(rows, id_col), {}
    for c in found:
        setting = c["support_fraction"], c["assume_centered"]
        if setting not in dist:
            dist[setting] = group.fitted(c["support_fraction"], STEPS, True, 0.0, c["assume_centered"])
        yield _beyond(dist[setting], group.fit, c["contamination"])


TRIALS = {"centroid": _try_centroid, "lof": _try_lof, "iforest": _try_iforest, "ocsvm": _try_ocsvm, "envelope": _try_envelope}


def _search_large(runs: DataFrame, entity: Sequence[str], id_col: str, name: str, found: Sequence[dict],
                  largest: int) -> DataFrame:
    """Groups that no task takes: shared distances where they are all there is to fit, else a run per candidate."""
    if name == "lof":
        return search_lof(runs, entity, id_col, [(c["n_neighbors"], c["contamination"]) for c in found], largest)
    if name == "centroid":
        order = sorted(range(len(found)), key=lambda i: found[i]["threshold"])
        scores = search_centroid(runs, entity, id_col, [found[i]["threshold"] for i in order], largest)
        return scores.withColumn("candidate", F.get(F.array(*[F.lit(i) for i in order]), F.col("candidate")))
    detect, names = DETECTORS[name]
    return search_detector(runs, entity, id_col, name, detect, [{to: c[of] for of, to in names.items()} for c in found])


def search_all(runs: DataFrame, entity: Sequence[str], id_col: str, candidates: Mapping[str, Sequence[dict]],
               largest: int | None = None) -> DataFrame:
    """(detector, entity, candidate, score) of every candidate of every detector: the mean grade over the folds.

    A task holds a group (entity and fold), fits one model per distinct fit setting and passes on a count per candidate,
    label and prediction: a forest serves all contaminations and all numbers of trees, distances all thresholds and
    numbers of neighbours, a kernel matrix all nu, an envelope all contaminations. Only groups beyond ``GROUP_ROWS`` rows
    take a distributed run per candidate.
    """
    group = [*entity, "cv"]
    largest = largest_group(runs, group) if largest is None else largest
    small, large = by_size(runs, group, min(GROUP_ROWS, blocks.SCORE_ROWS), largest)
    columns = [*group, "detector", "candidate", "label", "pred", "n"]

    def try_all(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["is_scored"].to_numpy(dtype=bool)
        label, out = rows["label"].to_numpy()[asked], []
        for name, found in candidates.items():
            for number, flags in enumerate(TRIALS[name](key, rows, id_col, found)):
                pred = flags[asked].astype(int)
                out += [(*key, name, number, y, p, n) for y in (0, 1) for p in (0, 1)
                        if (n := int(((label == y) & (pred == p)).sum()))]
        return pd.DataFrame(out, columns=columns)

    parts = []
    if small is not None:
        schema = typed(runs, group) + ", detector string, candidate int, label int, pred int, n long"
        counts = by_group(small, group).applyInPandas(try_all, schema)
        grades = _graded(counts, [*group, "detector"])
        parts.append(grades.groupBy("detector", *entity, "candidate").agg(F.sum("grade").alias("_s"), F.count("grade").alias("_n")))
    if large is not None:
        runs_of_large = cut(large, "large-runs")
        for name, found in candidates.items():
            big = _search_large(runs_of_large, entity, id_col, name, found, largest)
            parts.append(big.select("detector", *entity, "candidate", F.col("score").alias("_s"), F.lit(1).cast("long").alias("_n")))
    found = reduce(DataFrame.unionByName, parts).groupBy("detector", *entity, "candidate")
    return found.agg((F.sum("_s") / F.sum("_n")).alias("score"))


def best_candidates(scores: DataFrame, entity: Sequence[str] = ("entity",)) -> DataFrame:
    """Highest mean score per (detector, entity); the lower candidate number wins a tie."""
    best = F.max(F.struct("score", (-F.col("candidate")).alias("rank")))
    return (scores.groupBy("detector", *entity).agg(best.alias("_b"))
            .select("detector", *entity, (-F.col("_b.rank")).alias("candidate"), F.col("_b.score").alias("score")))


def summarise(best: DataFrame, columns: Sequence[str], cascade: bool = False) -> DataFrame:
    """(detector, param, stat, value): mean, median and sample deviation of the winners.

    ``cascade`` takes the median over the winners and their mean, and the deviation
    over the winners, their mean and that median.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("param"), F.col(c).cast("double").alias("v")) for c in columns]))
    long = best.select("detector", pairs.alias("_p")).select("detector", "_p.param", "_p.v").filter(F.col("v").isNotNull())
    keys = ["detector", "param"]
    largest = largest_group(long, keys)

    def stat(df: DataFrame, name: str) -> DataFrame:
        if name == "median":
            found = group_percentile(df, keys, "v", 0.5, "value", largest=largest)
        else:
            found = df.groupBy(*keys).agg((F.avg("v") if name == "mean" else F.stddev_samp("v")).alias("value"))
        return found.withColumn("stat", F.lit(name))

    def grown(df: DataFrame, extra: DataFrame) -> DataFrame:
        return df.unionByName(extra.select(*keys, F.col("value").alias("v"))) if cascade else df

    mean = stat(long, "mean")
    with_mean = grown(long, mean)
    median = stat(with_mean, "median")
    deviation = stat(grown(with_mean, median), "std")
    return mean.unionByName(median).unionByName(deviation).select(*keys, "stat", "value")


def result_table(best: DataFrame, columns: Sequence[str], entity: str = "entity", cascade: bool = False) -> DataFrame:
    """(detector, row, columns): a row per entity's winner, then the rows mean, median and std."""
    winners = best.select("detector", F.col(entity).cast("string").alias("row"),
                          *[F.col(c).cast("double").alias(c) for c in columns])
    stats = (summarise(best, columns, cascade).groupBy("detector", F.col("stat").alias("row"))
             .pivot("param", list(columns)).agg(F.first("value")))
    return winners.unionByName(stats.select("detector", "row", *columns))
