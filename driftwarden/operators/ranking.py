"""Order inside groups of any size: positions, running totals, exact percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.operators.skew import is_bounded, join_scalars, largest_group
from driftwarden.runtime import cut

# A group this small is sorted by a single task; bigger ones are spread over sorted slices.
MAX_WINDOW_ROWS = 4_000_000
SLICE_ROWS = 1_000_000


def _order(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], value: Column | str | int,
                  out: str, largest: int | None = None, max_window_rows: int | None = None) -> DataFrame:
    """Inclusive running total of ``value`` inside each group, in a total order.

    ``largest`` is a proven bound on the rows per group; without it the groups are
    counted first. Bounded groups use a window. Otherwise all rows are range-
    partitioned by (group, order), summed per slice, and each slice starts from the
    total of the slices before it, so a group may span any number of tasks.
    """
    amount = F.lit(value) if isinstance(value, int) else (F.col(value) if isinstance(value, str) else value)
    limit = MAX_WINDOW_ROWS if max_window_rows is None else max_window_rows
    keys, sort = list(group), _order(order)
    if largest is None:
        largest = largest_group(df, keys)
    if largest <= limit:
        frame = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(amount).over(frame))

    slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // SLICE_ROWS))
    ranged = df.repartitionByRange(slices, *[F.col(k) for k in keys], *sort)
    placed = cut(ranged.withColumn("_slice", F.spark_partition_id()), "slices")
    totals = placed.groupBy(*keys, "_slice").agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.withColumn("_part", F.sum(amount).over(inside)).join(starts, [*keys, "_slice"])
    return joined.withColumn(out, F.col("_part") + F.col("_start")).drop("_slice", "_part", "_start")


def with_position(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], out: str = "pos",
                  largest: int | None = None, max_window_rows: int | None = None) -> DataFrame:
    """Zero-based position of every row in its group."""
    ranked = running_total(df, group, order, 1, out, largest, max_window_rows)
    return ranked.withColumn(out, F.col(out).cast("long") - 1)


def group_percentiles(df: DataFrame, group: Sequence[str], value: str, shares: Sequence[float], out: str,
                      weight: str | None = None, largest: int | None = None,
                      max_window_rows: int | None = None) -> DataFrame:
    """Exact percentiles per group with linear interpolation, as an array in the order of ``shares``.

    ``weight`` counts copies of a value. Bounded groups use the built-in exact
    aggregate, which holds a group's values in one task. Otherwise copies are combined
    and the two order statistics of each share are picked by their position.
    """
    keys = list(group)
    if keys and is_bounded(largest):
        exact = F.percentile(value, F.array(*[F.lit(float(p)) for p in shares]), F.col(weight) if weight else 1)
        return df.groupBy(*keys).agg(exact.alias(out))
    copies = F.sum(weight) if weight else F.count(F.lit(1))
    values = cut(df.groupBy(*keys, F.col(value).alias("_v")).agg(copies.cast("long").alias("_w")), "values")
    sizes = values.groupBy(*keys).agg(F.sum("_w").alias("_n"))
    ranked = running_total(values, keys, ["_v"], "_w", "_upto", largest, max_window_rows)
    ranked = join_scalars(ranked, sizes, keys, ["_v"])
    first = F.col("_upto") - F.col("_w")

    def at(index: Column) -> Column:
        return F.max(F.when((first <= index) & (index < F.col("_upto")), F.col("_v")))

    picks, results = [], []
    for i, share in enumerate(shares):
        spot = (F.col("_n") - 1) * F.lit(float(share))
        picks += [at(F.floor(spot)).alias(f"_lo{i}"), at(F.ceil(spot)).alias(f"_hi{i}"),
                  F.max(spot - F.floor(spot)).alias(f"_t{i}")]
        results.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_t{i}"))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, F.array(*results).alias(out))


def group_percentile(df: DataFrame, group: Sequence[str], value: str, share: float, out: str,
                     weight: str | None = None, largest: int | None = None,
                     max_window_rows: int | None = None) -> DataFrame:
    """One exact percentile per group."""
    found = group_percentiles(df, group, value, [share], out, weight, largest, max_window_rows)
    return found.withColumn(out, F.col(out)[0])
