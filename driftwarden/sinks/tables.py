"""Result files: count tables, the filled label matrix, search results, metric rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.operators.skew import join_scalars

# Columns of a band: a matrix of any length is stored as rows (entity, band) of this width.
BAND_COLUMNS = 500


def write_count_tables(ranked: DataFrame, path: str, keys: Sequence[str] = (), folders: Sequence[str] = ()) -> None:
    """(keys, token, count) as CSV with a header, replacing what was there.

    ``folders`` names the keys that become a folder each; the others are columns, so
    that the number of files need not grow with the number of segments. Rows are
    range-partitioned by (keys, rank): a small key lands in one file, a huge one in
    several whose names keep the rank order.
    """
    columns = [k for k in keys if k not in folders]
    ordered = ranked.repartitionByRange(*keys, "rank").sortWithinPartitions(*keys, "rank")
    writer = ordered.select(*columns, "token", "count", *folders).write.mode("overwrite").option("header", True)
    (writer.partitionBy(*folders) if folders else writer).csv(path)


def fill_labels(labels: DataFrame, flags: DataFrame, n_genuine: int, labelled: DataFrame) -> DataFrame:
    """Keep known cells; test cells of entities outside ``labelled`` take the prediction."""
    known = labelled.select("entity").withColumn("_known", F.lit(1))
    marked = join_scalars(labels, known, ["entity"], ["seg"], "left")
    joined = marked.join(flags.select("entity", "seg", "flag"), ["entity", "seg"], "left")
    predicted = F.col("_known").isNull() & (F.col("seg") >= n_genuine)
    cell = F.when(predicted, F.col("flag")).otherwise(F.col("label")).cast("int")
    return joined.select("entity", "seg", cell.alias("label"))


def label_matrix(labels: DataFrame, n_segments: int) -> DataFrame:
    """Wide form, one row per entity and one column per segment; for long streams see ``label_bands``."""
    return labels.groupBy("entity").pivot("seg", list(range(n_segments))).agg(F.first("label"))


def write_label_matrix(labels: DataFrame, n_segments: int, path: str) -> None:
    label_matrix(labels, n_segments).write.mode("overwrite").option("header", True).csv(path)


def label_bands(labels: DataFrame, width: int = BAND_COLUMNS) -> DataFrame:
    """(entity, band, 0, 1, ...): the wide form cut into bands of ``width`` segments, so no row grows with a stream."""
    places = labels.select("entity", F.floor(F.col("seg") / width).alias("band"),
                           (F.col("seg") % width).cast("int").alias("place"), "label")
    return places.groupBy("entity", "band").pivot("place", list(range(width))).agg(F.first("label"))


def write_label_bands(labels: DataFrame, path: str, width: int = BAND_COLUMNS) -> None:
    label_bands(labels, width).write.mode("overwrite").option("header", True).csv(path)


def write_search_results(results: DataFrame, path: str) -> None:
    """Best parameters with their summary rows, one folder per detector."""
    results.write.mode("overwrite").option("header", True).partitionBy("detector").csv(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Metric rows are appended; every file carries the header."""
    flat = [F.col(c).cast("string").alias(c) if t.startswith(("array", "struct")) else F.col(c)
            for c, t in metrics.dtypes]
    metrics.select(*flat).write.mode("append").option("header", True).csv(path)
