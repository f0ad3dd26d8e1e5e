"""Ensemble vote over the detectors' flags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAJORITY = 2


def stack_flags(flags: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Long table (keys, detector, flag)."""
    parts = [df.select(*keys, F.lit(name).alias("detector"), "flag") for name, df in flags.items()]
    return reduce(DataFrame.unionByName, parts)


def majority_vote(stacked: DataFrame, keys: Sequence[str], more_than: int = MAJORITY) -> DataFrame:
    """Flag a row when more than ``more_than`` detectors flag it: one shuffle, no joins."""
    votes = stacked.groupBy(*keys).agg(F.sum("flag").cast("int").alias("votes"))
    return votes.withColumn("flag", (F.col("votes") > more_than).cast("int"))
