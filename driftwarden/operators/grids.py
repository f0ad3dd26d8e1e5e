"""Parameter spaces as small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.functions.hashing import hash_key


def linspace(start: float, stop: float, num: int, whole: bool = False) -> Column:
    """``num`` evenly spaced values as an array; ``whole`` truncates them to integers."""
    if num == 1:
        values = F.array(F.lit(float(start)))
    else:
        step = (float(stop) - float(start)) / (num - 1)
        values = F.transform(F.sequence(F.lit(0), F.lit(num - 1)),
                             lambda i: F.when(i == num - 1, F.lit(float(stop))).otherwise(i * F.lit(step) + F.lit(float(start))))
    return F.transform(values, lambda v: v.cast("int")) if whole else values


def values(*options: Any) -> Column:
    """A list of options; a list inside it becomes an array value."""
    return F.array(*[F.array(*[F.lit(x) for x in o]) if isinstance(o, (list, tuple)) else F.lit(o) for o in options])


Space = Mapping[str, tuple[Column, int]]


def _decode(index: DataFrame, space: Space) -> DataFrame:
    """Read each index as a mixed-radix number with one digit per parameter; the last digit runs fastest."""
    rest, columns = F.col("candidate"), []
    for name, (options, size) in reversed(list(space.items())):
        columns.append(options[(rest % size).cast("int")].alias(name))
        rest = F.floor(rest / size)
    return index.select("candidate", *reversed(columns))


def grid_size(space: Space) -> int:
    size = 1
    for _, count in space.values():
        size *= count
    return size


def param_grid(spark: SparkSession, space: Space) -> DataFrame:
    """Every combination, numbered; no product of tables is formed."""
    return _decode(spark.range(grid_size(space)).withColumnRenamed("id", "candidate"), space)


def param_sample(spark: SparkSession, space: Space, n: int, seed: int) -> DataFrame:
    """``n`` distinct combinations drawn by hash (all of them if there are fewer)."""
    index = spark.range(grid_size(space)).withColumnRenamed("id", "candidate")
    drawn = index.orderBy(hash_key(seed, "candidate", F.col("candidate")), "candidate").limit(n)
    return _decode(drawn, space)
