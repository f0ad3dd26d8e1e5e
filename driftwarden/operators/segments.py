"""Cutting ordered token streams into fixed-length segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assign_segments(tokens: DataFrame, length: int, n_segments: int | None = None) -> DataFrame:
    """Add ``seg``, the index of the ``length``-token segment a position falls in.

    ``n_segments`` leaves out positions beyond that many segments; by default the
    whole stream is segmented and the last segment may be shorter.
    """
    if n_segments is not None:
        tokens = tokens.filter(F.col("pos") < n_segments * length)
    return tokens.withColumn("seg", F.floor(F.col("pos") / F.lit(length)).cast("int"))


def segment_documents(segmented: DataFrame, group: Sequence[str] = ("entity",)) -> DataFrame:
    """One row per segment with its tokens in order joined by blanks.

    A collected group is one segment, so it never exceeds the segment length.
    """
    in_order = F.array_sort(F.collect_list(F.struct("pos", "token")))
    doc = F.concat_ws(" ", F.transform(in_order, lambda t: t["token"]))
    return segmented.groupBy(*group, "seg").agg(doc.alias("doc"))


def genuine(segments: DataFrame, n_genuine: int) -> DataFrame:
    return segments.filter(F.col("seg") < n_genuine)


def unlabelled(segments: DataFrame, n_genuine: int) -> DataFrame:
    return segments.filter(F.col("seg") >= n_genuine)


def outlier_flag(raw: Column) -> Column:
    """-1 (outlier) becomes 1, anything else 0."""
    return F.when(raw == -1, 1).otherwise(0)
