"""Token counts per segment, per entity and over everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.operators.ranking import with_position
from driftwarden.runtime import cut


def count_tokens(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    return tokens.groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("count"))


def count_levels(segmented: DataFrame, capped_at: int | None = None) -> DataFrame:
    """Counts at all three levels from one scan of the tokens.

    The two coarser levels are sums of the finest one. With ``capped_at`` segments
    of that index and above count towards the coarser levels only.
    """
    finest = segmented.groupBy("entity", "seg", "token").agg(F.count(F.lit(1)).alias("n"))
    grouped = F.when(F.grouping_id() == 0, "segment").when(F.grouping_id() == 2, "entity").otherwise("total")
    levels = (
        finest.groupingSets(
            [[F.col("entity"), F.col("seg"), F.col("token")], [F.col("entity"), F.col("token")], [F.col("token")]],
            "entity", "seg", "token",
        )
        .agg(F.sum("n").alias("count"), grouped.alias("level"))
        .select("level", "entity", "seg", "token", "count")
    )
    if capped_at is not None:
        levels = levels.filter((F.col("level") != "segment") | (F.col("seg") < capped_at))
    return levels


def rank_counts(counts: DataFrame, group: Sequence[str], largest: int | None = None) -> DataFrame:
    """Rank tokens by falling count, ties in alphabetical order; the rank is a column, so it survives shuffles."""
    if largest is None:
        counts = cut(counts, "counts")
    ranked = with_position(counts, group, [F.desc("count"), "token"], "rank", largest)
    return ranked.withColumn("rank", F.col("rank") + 1)
