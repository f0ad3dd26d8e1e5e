"""Applying one bounded model per group to the group's rows, block by block."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from driftwarden.operators.skew import block_of, fresh, join_scalars

# Rows scored together in one task, and the group size up to which a group is one block.
SCORE_ROWS = 8_192


def by_group(df: DataFrame, keys: Sequence[str]) -> GroupedData:
    """Group rows for a Python function, over all shuffle partitions.

    The work per byte is high, so partitions must not be merged because they hold few bytes.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys).groupBy(*keys)


def by_size(rows: DataFrame, keys: Sequence[str], limit: int, largest: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of groups of at most ``limit`` rows, rows of bigger ones); None where the bound ``largest`` rules them out."""
    if largest <= limit:
        return rows, None
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    spread = [c for c in rows.columns if c not in keys][:1]
    counted = join_scalars(rows, sizes, keys, spread)
    return (counted.filter(F.col("_rows") <= limit).drop("_rows").select(*rows.columns),
            counted.filter(F.col("_rows") > limit).drop("_rows").select(*rows.columns))


def apply_model(rows: DataFrame, model: DataFrame, group: Sequence[str], id_col: str,
                score: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
                largest: int | None = None) -> DataFrame:
    """Cogroup every block of rows with its group's model rows and call ``score(rows, model)``.

    The model must be bounded in size. A group with more rows than a block takes is
    cut by id, and its model is repeated once per block.
    """
    keys = list(group)

    def call(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return score(left, right) if len(left) else pd.DataFrame()

    if largest is not None and largest <= SCORE_ROWS:
        return by_group(rows, keys).cogroup(by_group(fresh(model), keys)).applyInPandas(call, schema)
    blocked = rows.withColumn("_block", block_of(id_col, SCORE_ROWS))
    spread = fresh(blocked.select(*keys, "_block").distinct().join(model, keys))
    by = [*keys, "_block"]
    return by_group(blocked, by).cogroup(by_group(spread, by)).applyInPandas(call, schema)


def typed(df: DataFrame, columns: Sequence[str]) -> str:
    """Schema text of some columns of a frame."""
    types = dict(df.dtypes)
    return ", ".join(f"`{c}` {types[c]}" for c in columns)
