"""Wide label matrices (one row per entity, one column per segment) as long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def matrix_schema(n_segments: int) -> T.StructType:
    cells = [T.StructField(str(s), T.IntegerType()) for s in range(n_segments)]
    return T.StructType([T.StructField("entity", T.LongType()), *cells])


def read_label_matrix(spark: SparkSession, path: str, n_segments: int) -> DataFrame:
    """CSV with an index column first; empty cells are NULL."""
    return spark.read.csv(path, header=True, schema=matrix_schema(n_segments))


def read_label_bands(spark: SparkSession, path: str, width: int) -> DataFrame:
    """``labels(entity, seg, label)`` from a matrix stored in bands; empty cells are left out."""
    schema = T.StructType([T.StructField("entity", T.LongType()), T.StructField("band", T.LongType()),
                           *[T.StructField(str(i), T.IntegerType()) for i in range(width)]])
    long = spark.read.csv(path, header=True, schema=schema).unpivot(
        ["entity", "band"], [str(i) for i in range(width)], "place", "label")
    seg = (F.col("band") * width + F.col("place").cast("int")).cast("int")
    return long.filter(F.col("label").isNotNull()).select("entity", seg.alias("seg"), "label")


def unpivot_labels(matrix: DataFrame) -> DataFrame:
    """``labels(entity, seg, label)`` from the matrix; the column's place is the segment."""
    cells = [c for c in matrix.columns if c != "entity"]
    numbered = matrix.select("entity", *[F.col(c).alias(str(i)) for i, c in enumerate(cells)])
    long = numbered.unpivot("entity", [str(i) for i in range(len(cells))], "seg", "label")
    return long.select("entity", F.col("seg").cast("int").alias("seg"), "label")


def labelled_segments(segments: DataFrame, labels: DataFrame, keys: Sequence[str] = ("entity", "seg"),
                      entities: DataFrame | None = None) -> DataFrame:
    """Segments that have a label, with the label; of the given ``entities`` (entity) only, if any are given."""
    known = labels.filter(F.col("label").isNotNull()).select(*keys, F.col("label").cast("int").alias("label"))
    if entities is not None:
        known = known.join(entities, "entity", "left_semi")
    return segments.join(known, list(keys))
