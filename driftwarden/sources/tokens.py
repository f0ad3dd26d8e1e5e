"""Token files: one word per line, the line order is the stream order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.operators.ranking import with_position


def read_token_files(spark: SparkSession, path: str, entity_pattern: str = r"User(\d+)$",
                     largest: int | None = None) -> DataFrame:
    """Read all files below a glob as ``tokens(entity, pos, token)``.

    The entity is taken from the path. Files may be split over tasks: a line is
    ordered by its file, the start of its split and its place in the split. Blank
    lines are dropped; words such as ``null`` stay words.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("token"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"),
    )
    entity = F.regexp_extract("_file", entity_pattern, 1).cast("long")
    kept = lines.withColumn("entity", entity).filter(F.length(F.trim("token")) > 0)
    placed = with_position(kept, ["entity"], ["_file", "_split", "_line"], "pos", largest)
    return placed.select("entity", "pos", "token")
