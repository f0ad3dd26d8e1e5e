"""Robust covariance envelope: Mahalanobis distance to the most concentrated part of the rows."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache, reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.detectors.iforest import flag_above
from driftwarden.operators import blocks
from driftwarden.operators.blocks import apply_model, by_group, by_size, typed
from driftwarden.operators.dense import dot_products, matrix, row_pieces
from driftwarden.operators.features import unpack_vectors
from driftwarden.operators.ranking import group_percentile, with_position
from driftwarden.operators.skew import attach, join_scalars, largest_group
from driftwarden.runtime import cut

SUPPORT = 0.5
CONTAMINATION = 0.1
# Fixed value: concentration steps at most; they end when no group's support changes any more.
STEPS = 30
DIGITS = 6
# Rows of a group that one task fits from its rows' own products, whatever the number of terms.
GROUP_ROWS = 2_048
# In bigger groups a task inverts a dims x dims matrix, so the number of terms is checked there.
MAX_DIMS = 2_000
RANK_TOLERANCE = 1e-9
# Shares of the chi-square distribution for the median and for rows that are kept.
MEDIAN_SHARE, KEPT_SHARE = 0.5, 0.975


def gamma_share(a: float, x: float) -> float:
    """The regularised lower incomplete gamma function: by its series below a + 1, else by its continued fraction."""
    if x <= 0:
        return 0.0
    head = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return head * total
    b, c = x + 1 - a, 1e300
    d = 1 / b
    value, i = d, 0
    while True:
        i += 1
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b)
        c = b + step / c
        value *= d * c
        if abs(d * c - 1) < 1e-16:
            return 1 - head * value


def chi_square_quantile(dims: int, share: float) -> float:
    """The value that a chi-square variable stays below with probability ``share``, by halving."""
    low, high = 0.0, dims + 10.0 * math.sqrt(2.0 * dims) + 20.0
    while True:
        middle = (low + high) / 2
        if middle in (low, high):
            return middle
        if gamma_share(dims / 2, middle / 2) < share:
            low = middle
        else:
            high = middle


def median_distances(vectors: DataFrame, keys: list[str], id_col: str, largest: int | None) -> DataFrame:
    """Fitted rows with their squared distance to the coordinate-wise median; absent terms count as 0."""
    fitted = vectors.filter("is_fit")
    long = unpack_vectors(fitted, keys).groupBy(*keys, "term", "value").agg(F.count(F.lit(1)).alias("_w"))
    present = long.groupBy(*keys, "term").agg(F.sum("_w").alias("_p"))
    n = fitted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    absent = join_scalars(present, n, keys, ["term"]).filter("_n > _p").select(
        *keys, "term", F.lit(0.0).alias("value"), (F.col("_n") - F.col("_p")).alias("_w"))
    middle = group_percentile(long.unionByName(absent), [*keys, "term"], "value", 0.5, "_m", weight="_w", largest=largest)
    middle = middle.filter("_m != 0")
    squares = middle.groupBy(*keys).agg(F.sum(F.col("_m") * F.col("_m")).alias("_mm"))
    mixed = attach(unpack_vectors(fitted, [*keys, id_col]), middle, [*keys, "term"], id_col, largest)
    mixed = mixed.groupBy(*keys, id_col).agg(F.sum(F.col("value") * F.col("_m")).alias("_xm"))
    own = F.aggregate("vals", F.lit(0.0), lambda total, v: total + v * v)
    rows = fitted.withColumn("_xx", own).join(mixed, [*keys, id_col], "left")
    rows = join_scalars(rows, squares, keys, [id_col], "left", largest)
    square = F.col("_xx") - 2 * F.coalesce("_xm", F.lit(0.0)) + F.coalesce("_mm", F.lit(0.0))
    return rows.select(*vectors.columns, F.round(F.greatest(square, F.lit(0.0)), DIGITS).alias("dist"))


def closest(measured: DataFrame, keys: list[str], id_col: str, share: float, largest: int | None) -> DataFrame:
    """The floor(share x n) fitted rows with the smallest distance, ties by id."""
    fitted = measured.filter("is_fit")
    placed = with_position(fitted, keys, ["dist", id_col], "_pos", largest)
    n = fitted.groupBy(*keys).agg(F.floor(F.lit(float(share)) * F.count(F.lit(1))).alias("_h"))
    return join_scalars(placed, n, keys, [id_col], largest=largest).filter(F.col("_pos") < F.col("_h"))


def support_sums(support: DataFrame, keys: list[str]) -> DataFrame:
    """(group, i, j, s): sums of products of the support rows over pairs of terms.

    An extra term named "" with value 1 makes the sums and the row count part of the
    same table. A task multiplies a batch of a group's rows at once, so a row costs no
    row per pair of its terms and a few dims x dims numbers per group are shuffled on.
    """
    columns = [*keys, "i", "j", "s"]

    def multiply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, rows in frame.groupby(keys, dropna=False, sort=False):
                names = sorted(set().union(*rows["terms"]))
                x = np.column_stack([np.ones(len(rows)), matrix(rows["terms"], rows["vals"], pd.Index(names))])
                sums = np.triu(x.T @ x)
                kept = sums != 0
                kept[0] = kept[np.diag_indices_from(kept)] = True  # so that every term is listed
                i, j = np.nonzero(kept)
                named = np.array(["", *names], dtype=object)
                yield pd.DataFrame(dict(zip(keys, key)) | {"i": named[i], "j": named[j], "s": sums[i, j]})[columns]

    parts = support.select(*keys, "terms", "vals").mapInPandas(
        multiply, typed(support, keys) + ", i string, j string, s double")
    return parts.groupBy(*keys, "i", "j").agg(F.sum("s").alias("s"))


def _invert(sums: pd.DataFrame, ridge: float, centered: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms, mean, inverse covariance) with mean 0 if ``centered``; a singular matrix gets its pseudo-inverse."""
    names = np.unique(sums["j"])
    at = pd.Index(names)
    full = np.zeros((len(names), len(names)))
    i, j = at.get_indexer(sums["i"]), at.get_indexer(sums["j"])
    full[i, j] = full[j, i] = sums["s"]
    mean = full[0, 1:] / full[0, 0] * (not centered)
    cov = full[1:, 1:] / full[0, 0] - np.outer(mean, mean)
    cov[np.diag_indices_from(cov)] += ridge
    size, axes = np.linalg.eigh(cov) if len(mean) else (np.zeros(0), np.zeros((0, 0)))
    keep = size > RANK_TOLERANCE * max(size.max(initial=0.0), 1e-300)
    return names[1:], mean, (axes[:, keep] / size[keep]) @ axes[:, keep].T


def _distances(rows: pd.DataFrame, names: np.ndarray, mean: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    index, found = pd.Index(names), []
    for part in row_pieces(rows, len(mean)):
        x = matrix(part["terms"], part["vals"], index) - mean
        found.append(np.einsum("ij,ij->i", x @ inverse, x))
    return np.round(np.maximum(np.concatenate(found), 0.0), DIGITS)


def mahalanobis(vectors: DataFrame, support: DataFrame, keys: list[str], id_col: str, ridge: float,
                centered: bool, largest: int | None) -> DataFrame:
    """All rows with their squared distance to the support rows, rounded to 6 digits.

    A group that is one block inverts its matrix where its rows are scored. Otherwise
    the matrix is inverted once and sent to all blocks.
    """
    columns = [*vectors.columns, "dist"]
    schema = typed(vectors, columns[:-1]) + ", dist double"
    sums = support_sums(support, keys)
    if largest is not None and largest <= blocks.SCORE_ROWS:
        def both(rows: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
            return rows.assign(dist=_distances(rows, *_invert(pairs, ridge, centered)))[columns]

        return apply_model(vectors, sums, keys, id_col, both, schema, largest)

    def invert(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        names, mean, inverse = _invert(pdf, ridge, centered)
        return pd.DataFrame([[*key, names, mean, inverse.ravel()]], columns=[*keys, "dims", "mean", "inverse"])

    def measure(rows: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        names, mean, inverse = (fitted[c].iloc[0] for c in ("dims", "mean", "inverse"))
        return rows.assign(dist=_distances(rows, names, mean, np.asarray(inverse).reshape(len(mean), len(mean))))[columns]

    model = by_group(sums, keys).applyInPandas(
        invert, typed(support, keys) + ", dims array<string>, mean array<double>, inverse array<double>")
    return apply_model(vectors, model, keys, id_col, measure, schema, largest)


def _reweighted(measured: DataFrame, keys: list[str], id_col: str, largest: int | None) -> DataFrame:
    """Rows within the 97.5 % ellipse once the median distance is scaled to its expected value."""
    fitted = measured.filter("is_fit")
    medians = group_percentile(fitted, keys, "dist", 0.5, "_median", largest=largest)
    ratio = F.udf(_kept_ratio, "double")  # once per group
    dims = unpack_vectors(fitted, keys).groupBy(*keys).agg(F.count_distinct("term").cast("int").alias("_p"))
    limits = dims.join(medians, keys).select(*keys, (F.col("_median") * ratio("_p")).alias("_limit"))
    return (join_scalars(fitted, limits, keys, [id_col], largest=largest)
            .filter(F.col("dist") <= F.col("_limit")))


@lru_cache(maxsize=4_096)
def _kept_ratio(dims: int) -> float:
    return chi_square_quantile(dims, KEPT_SHARE) / chi_square_quantile(dims, MEDIAN_SHARE)


class GroupEnvelope:
    """All rows of a small group; distances to any support by the rows' own products."""

    def __init__(self, rows: pd.DataFrame, id_col: str):
        self.fit, self.ids = rows["is_fit"].to_numpy(dtype=bool), rows[id_col].to_numpy()
        fitted = rows[rows["is_fit"]]
        self.index = pd.Index(sorted(set().union(*fitted["terms"]))) if len(fitted) else pd.Index([])
        self.dims = len(self.index)
        self.x = matrix(rows["terms"], rows["vals"], self.index) if self.dims <= MAX_DIMS else None
        self.rows, self.products = rows, None
        self.measured: dict[tuple, np.ndarray] = {}  # distances by support and setting, as settings and steps meet again
        if self.x is None:
            self.products = dot_products(rows, rows)

    @cached_property
    def start(self) -> np.ndarray:
        """Squared distances to the coordinate-wise median of the fitted rows."""
        n = int(self.fit.sum())
        x, index = self.x, self.index
        if x is None:  # a term in less than half of the rows has median 0
            seen = pd.Series(np.concatenate(list(self.rows["terms"][self.fit]))).value_counts()
            index = pd.Index(sorted(seen.index[2 * seen >= n]))
            x = matrix(self.rows["terms"], self.rows["vals"], index)
        middle = np.median(x[self.fit], axis=0) if n else np.zeros(x.shape[1])
        own = np.array([float(np.dot(v, v)) for v in self.rows["vals"]])
        return np.round(np.maximum(own - 2 * x @ middle + middle @ middle, 0.0), DIGITS)

    def closest(self, dist: np.ndarray, share: float) -> np.ndarray:
        order = np.lexsort((self.ids, dist))
        order = order[self.fit[order]]
        return np.sort(order[:int(math.floor(share * len(order)))])

    def distances(self, support: np.ndarray, ridge: float, centered: bool) -> np.ndarray:
        asked = support.tobytes(), ridge, centered
        if asked not in self.measured:
            self.measured[asked] = self._distances(support, ridge, centered)
        return self.measured[asked]

    def _distances(self, support: np.ndarray, ridge: float, centered: bool) -> np.ndarray:
        if not len(support):
            return np.zeros(len(self.fit))
        if self.x is not None:
            part = self.x[support]
            mean = part.mean(0) * (not centered)
            cov = part.T @ part / len(part) - np.outer(mean, mean)
            cov[np.diag_indices_from(cov)] += ridge
            size, axes = np.linalg.eigh(cov) if self.dims else (np.zeros(0), np.zeros((0, 0)))
            keep = size > RANK_TOLERANCE * max(size.max(initial=0.0), 1e-300)
            away = (self.x - mean) @ axes[:, keep]
            found = (away * away / size[keep]).sum(1)
        else:  # the covariance has the eigenvalues of the support's own products
            k, h = self.products, len(support)
            to = k[:, support]
            centre = to.mean(1, keepdims=True) * (not centered)
            middle = k[np.ix_(support, support)].mean() * (not centered)
            across = to - centre - (centre[support].T - middle) * (not centered)
            size, axes = np.linalg.eigh(across[support] / h)
            keep = size > RANK_TOLERANCE * max(size.max(initial=0.0), 1e-300)
            along = (across @ axes[:, keep]) ** 2 / (h * size[keep])
            found = (along / (size[keep] + ridge)).sum(1)
            if ridge:
                found += np.maximum(np.diag(k) - 2 * centre[:, 0] + middle - along.sum(1), 0.0) / ridge
        return np.round(np.maximum(found, 0.0), DIGITS)

    def fitted(self, share: float, steps: int, reweight: bool, ridge: float, centered: bool) -> np.ndarray:
        """Concentration steps until the support stays, then one re-weighting."""
        dist, support = self.start, None
        for _ in range(steps):
            near = self.closest(dist, share)
            if support is not None and np.array_equal(near, support):
                break
            support, dist = near, self.distances(near, ridge, centered)
        if reweight and self.dims and self.fit.any():
            limit = np.median(dist[self.fit]) * _kept_ratio(self.dims)
            dist = self.distances(np.flatnonzero(self.fit & (dist <= limit)), ridge, centered)
        return dist


def _support_names(near: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """A number per group that tells whether its support stays the same."""
    return near.groupBy(*keys).agg(F.sum(F.xxhash64(id_col).cast("decimal(38,0)")).alias("_name"))


def check_dims(vectors: DataFrame, keys: list[str]) -> None:
    terms = unpack_vectors(vectors.filter("is_fit"), keys).select(*keys, "term").distinct()
    widest = largest_group(terms, keys)
    if widest > MAX_DIMS:
        raise ValueError(f"a group has {widest} terms; the envelope inverts a full matrix and takes up to {MAX_DIMS}")


def detect_envelope(vectors: DataFrame, group: Sequence[str] = ("entity",), id_col: str = "seg",
                    contamination: float = CONTAMINATION, support: float = SUPPORT, steps: int = STEPS,
                    reweight: bool = True, ridge: float = 0.0, centered: bool = False, largest: int | None = None) -> DataFrame:
    """(group, id, score, flag).

    Starts from the rows nearest the coordinate-wise median, re-fits on the closest share ``support`` of the rows until
    it stays the same (``steps`` times at most), then once on all rows that fit the resulting ellipse (``reweight``).
    ``centered`` takes 0 for the centre instead of the mean of those rows. Groups of up to ``GROUP_ROWS`` rows are fitted
    in one task each, with any number of terms; bigger ones by sums over all tasks.
    """
    keys = list(group)
    largest = largest_group(vectors, keys) if largest is None else largest
    vectors = vectors.select(*keys, id_col, "terms", "vals", "is_fit", "is_scored")
    columns = [*keys, id_col, "is_fit", "is_scored"]

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        dist = GroupEnvelope(rows, id_col).fitted(support, steps, reweight, ridge, centered)
        return rows[columns].assign(dist=dist)

    small, large = by_size(vectors, keys, min(GROUP_ROWS, blocks.SCORE_ROWS), largest)
    parts = []
    if small is not None:
        parts.append(by_group(small, keys).applyInPandas(whole, typed(vectors, columns) + ", dist double"))
    if large is not None:
        parts.append(_large_distances(large, keys, id_col, support, steps, reweight, ridge, centered, largest).select(*columns, "dist"))
    measured = cut(reduce(DataFrame.unionByName, parts), "envelope")
    return flag_above(measured.withColumnRenamed("dist", "score"), keys, id_col, contamination, largest)


def _large_distances(vectors: DataFrame, keys: list[str], id_col: str, support: float, steps: int, reweight: bool,
                     ridge: float, centered: bool, largest: int) -> DataFrame:
    """All rows of groups of any size with their distance."""
    check_dims(vectors, keys)
    measured, names = cut(median_distances(vectors, keys, id_col, largest), "envelope"), None
    for _ in range(steps):
        near = cut(closest(measured, keys, id_col, support, largest), "support")
        new = cut(_support_names(near, keys, id_col), "support-names")
        if names is not None and new.join(names, [*keys, "_name"], "left_anti").isEmpty():
            break
        names = new
        measured = cut(mahalanobis(vectors, near, keys, id_col, ridge, centered, largest), "envelope")
    if reweight:
        near = _reweighted(measured, keys, id_col, largest)
        measured = cut(mahalanobis(vectors, near, keys, id_col, ridge, centered, largest), "envelope")
    return measured
