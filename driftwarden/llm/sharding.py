"""Proportional stratified interleaving: every shard holds the same mixture of sources.

Rows of a source are ranked in a seeded shuffle; the row of rank r among n gets the fraction (r - 1/2) / n. Sorted by
that fraction the sources interleave evenly, and cutting the order into equal runs gives the shards. Both rankings are
done in buckets (of the shuffle key, then of the fraction), each bucket starting at a running count, so neither a
source nor the whole table is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import source_key
from driftwarden.runtime import cut


def interleave(rows: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = 20, bits: int = 12,
               slices: int = 4096) -> DataFrame:
    """``rows`` plus ``position``, its place (from 0) in the proportional order, and ``total``, the number of rows.

    Null ids and sources are ordinary values; equal rows keep separate places. ``rows`` is read several times, so
    pass a written table.
    """
    keyed = rows.withColumns({"_source": source_key(F.col(source_col)),
                              "_key": F.xxhash64(F.lit(seed), F.col(id_col))})
    keyed = keyed.withColumn("_bucket", F.shiftright("_key", 64 - bits))
    others = [c for c in rows.columns if c != source_col]
    counts = keyed.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("_source").orderBy("_bucket")
    starts = counts.select(
        "_source", "_bucket", (F.sum("_n").over(running) - F.col("_n")).alias("_start"),
        F.sum("_n").over(Window.partitionBy("_source")).alias("_of"))
    in_bucket = Window.partitionBy("_source", "_bucket").orderBy("_key", *others)
    ranked = (
        keyed.withColumn("_rank", F.row_number().over(in_bucket))
        .join(starts, ["_source", "_bucket"])
        .withColumn("_share", (F.col("_start") + F.col("_rank") - 0.5) / F.col("_of"))
        .withColumn("_slice", F.floor(F.col("_share") * slices))
        .drop("_bucket", "_start", "_rank", "_of"))
    ranked = cut(ranked, "interleave")
    in_order = Window.orderBy("_slice")  # over the slices, of which there is a fixed number
    slice_starts = (
        ranked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", (F.sum("_n").over(in_order) - F.col("_n")).alias("_start"),
                F.sum("_n").over(Window.partitionBy()).alias("total")))
    in_slice = Window.partitionBy("_slice").orderBy("_share", "_source", "_key", *others)
    return (
        ranked.withColumn("_rank", F.row_number().over(in_slice))
        .join(slice_starts, "_slice")
        .withColumn("position", F.col("_start") + F.col("_rank") - 1)
        .select(*rows.columns, "position", "total"))


def cut_shards(ordered: DataFrame, n_shards: int) -> DataFrame:
    """``shard`` and ``slot`` from position and total: runs whose lengths differ by one at most."""
    shard = F.expr(f"position * {n_shards} div total")
    start = F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")
    return (ordered.withColumn("shard", shard).withColumn("slot", F.col("position") - start)
            .withColumn("shard", F.col("shard").cast("int")).drop("position", "total"))


def shard_documents(docs: DataFrame, n_shards: int = 24, seed: int = 20) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard.

    A null text has no bytes (size 8, checksum 0). Repeated rows and equal texts are separate rows with places of
    their own: the law is ``rows`` (counts at most one apart), which a large group of copies kept together would
    break. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = cut(docs.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"),
                           F.crc32(text.cast("binary")).alias("text_crc32")), "shard-rows")
    return cut_shards(interleave(slim, seed=seed), n_shards).select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
