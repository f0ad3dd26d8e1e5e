"""Joins and totals that stay balanced when one key holds a large share of the rows.

Each helper takes ``largest``, a proven bound on the rows per key. Up to
``BOUNDED_ROWS`` a plain join or aggregate is balanced already; beyond it, or with
no bound known, keys are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.runtime import cut

BOUNDED_ROWS = 250_000
# Rows of one key that share a block; integer ids are unique, so a block never holds more.
BLOCK_ROWS = 65_536
SALTS = 32
# Keys with this many rows are sent to all tasks, the most frequent ones and no more than these.
FREQUENT_ROWS, FREQUENT_KEYS = 1_000, 100_000
# Rows of a shuffle that a task takes, on average.
TASK_ROWS = 1_000_000


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows in the biggest group (counts are combined before the shuffle)."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def is_bounded(largest: int | None) -> bool:
    return largest is not None and largest <= BOUNDED_ROWS


def block_of(id_col: str, rows: int | None = None) -> Column:
    return F.floor(F.col(id_col) / F.lit(rows or BLOCK_ROWS)).cast("long")


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under new identities, for a frame that meets its own relatives in a cogroup."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def join_scalars(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread_on: Sequence[str],
                 how: str = "inner", largest: int | None = None, salts: int = SALTS) -> DataFrame:
    """Join a table of one small row per group to the rows of the group.

    The rows of a group are spread over ``salts`` join keys by ``spread_on`` and the
    table is repeated once per salt. With no group key the table has one row.
    """
    if keys and is_bounded(largest):
        return rows.join(table, list(keys), how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_on), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], id_col: str,
           largest: int | None = None) -> DataFrame:
    """Join a table unique on ``keys`` to the rows, one join key per (keys, block of ids).

    Only (key, block) pairs that occur are carried, so nothing is repeated for small
    keys and a hot key is split into as many parts as it has blocks.
    """
    if is_bounded(largest):
        return rows.join(table, list(keys))
    blocked = rows.withColumn("_block", block_of(id_col))
    cells = blocked.select(*keys, "_block").distinct().join(table, list(keys))
    return blocked.join(cells, [*keys, "_block"]).drop("_block")


def pieces_for(df: DataFrame, rows: int) -> int:
    """Partitions for a shuffle of ``rows`` rows, so that no task grows with the table."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def attach_frequent(rows: DataFrame, table: DataFrame, keys: Sequence[str], n_rows: int) -> DataFrame:
    """Join a table unique on ``keys`` to ``n_rows`` stored rows, most of which share few keys, as terms of documents do.

    Rows of frequent keys meet their entries where they lie. Only the others are shuffled, fewer rows per key than make
    it frequent, so no key needs splitting.
    """
    pieces, least = pieces_for(rows, n_rows), max(FREQUENT_ROWS, -(-n_rows // FREQUENT_KEYS))
    table = cut(table, "attached")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).drop("_n")
    # at most FREQUENT_KEYS entries
    frequent = cut(table.join(sizes, list(keys)), "frequent")
    others = rows.join(F.broadcast(frequent.select(*keys)), list(keys), "left_anti")
    others = others.repartition(pieces, *keys).join(table.repartition(pieces, *keys), list(keys))
    return rows.join(F.broadcast(frequent), list(keys)).unionByName(others)
