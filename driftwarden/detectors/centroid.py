"""Distance from the entity's centre, flagged where it is far above the mean distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.operators.skew import attach, is_bounded, join_scalars, largest_group
from driftwarden.runtime import cut

THRESHOLD = 1.15
# Squared distances below this share of their parts are rounding error and count as 0.
NOISE = 2e-15


def _per_group(rows: DataFrame, keys: list[str], id_col: str, largest: int | None, **values) -> DataFrame:
    """Add an aggregate over the row's group: a window for bounded groups, else an aggregate joined back."""
    if keys and is_bounded(largest):
        return rows.select("*", *[c.over(Window.partitionBy(*keys)).alias(n) for n, c in values.items()])
    rows = cut(rows, "rows")
    totals = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in values.items()])
    return join_scalars(rows, totals, keys, [id_col], "inner", largest)


def centroid_distances(vectors: DataFrame, group: Sequence[str], id_col: str,
                       largest: int | None = None) -> DataFrame:
    """Scored rows with ``dist``, the Euclidean distance to the mean of the fitted rows.

    With S the per-term sum over the n fitted rows, dist^2 = x.x - 2 x.S / n + S.S / n^2,
    and S.S is the sum of x.S over the fitted rows. So only the terms a row really has
    take part; a row without terms takes part with one empty term of weight 0.
    """
    keys = list(group)
    used = vectors.filter(F.col("is_fit") | F.col("is_scored"))
    pairs = F.explode_outer(F.arrays_zip("terms", "vals")).alias("_p")
    long = used.select(*keys, id_col, "is_fit", "is_scored", pairs).select(
        *keys, id_col, "is_fit", "is_scored", F.coalesce("_p.terms", F.lit("")).alias("term"),
        F.coalesce("_p.vals", F.lit(0.0)).alias("value"))
    fitted = F.when(F.col("is_fit"), F.col("value")).otherwise(F.lit(0.0))
    sums = long.groupBy(*keys, "term").agg(F.sum(fitted).alias("_sum"))
    rows = attach(long, sums, [*keys, "term"], id_col, largest).groupBy(*keys, id_col).agg(
        F.sum(F.col("value") * F.col("value")).alias("_xx"), F.sum(F.col("value") * F.col("_sum")).alias("_xs"),
        F.max("is_fit").alias("_fit"), F.max("is_scored").alias("_scored"))
    rows = _per_group(rows, keys, id_col, largest, _n=F.sum(F.col("_fit").cast("long")),
                      _ss=F.sum(F.when(F.col("_fit"), F.col("_xs"))))
    centre = F.col("_ss") / (F.col("_n") * F.col("_n"))
    square = F.col("_xx") - 2 * F.col("_xs") / F.col("_n") + centre
    dist = F.when(square > NOISE * (F.col("_xx") + centre), F.sqrt(square)).otherwise(F.lit(0.0)).alias("dist")
    return rows.filter(F.col("_scored") & (F.col("_n") > 0)).select(*keys, id_col, dist)


def relative_distances(vectors: DataFrame, group: Sequence[str], id_col: str,
                       largest: int | None = None) -> DataFrame:
    """Distances with ``ratio``, the distance over the mean distance of the scored rows."""
    keys = list(group)
    rated = _per_group(centroid_distances(vectors, keys, id_col, largest), keys, id_col, largest, _mean=F.avg("dist"))
    ratio = F.when(F.col("_mean") > 0, F.col("dist") / F.col("_mean")).otherwise(F.lit(0.0))
    return rated.select(*keys, id_col, "dist", ratio.alias("ratio"))


def detect_centroid(vectors: DataFrame, group: Sequence[str] = ("entity",), id_col: str = "seg",
                    threshold: float = THRESHOLD, largest: int | None = None) -> DataFrame:
    """(group, id, score, flag): flagged when distance / mean distance > ``threshold``."""
    largest = largest_group(vectors, group) if largest is None else largest
    rated = relative_distances(vectors, group, id_col, largest)
    return rated.select(*group, id_col, F.col("dist").alias("score"),
                        (F.col("ratio") > threshold).cast("int").alias("flag"))
