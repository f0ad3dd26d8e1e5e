"""Session set-up and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_KEY = "driftwarden.scratch"


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "driftwarden") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = spark.conf.get(_SCRATCH_KEY, None)
    if root is None:
        root = tempfile.mkdtemp(prefix="driftwarden-")
        spark.conf.set(_SCRATCH_KEY, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never handed out twice."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/driftwarden-{app}/{name}-{uuid.uuid4().hex}"


def spread_scan(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a table of a few files over all cores before costly per-row work.

    A table with at least one file per core is left as it is, so big tables are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, *keys)


def deal_scan(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a table for aggregates of what its rows hold, by these keys and more, which then need no shuffle of their own.

    A piece follows a fixed part of the table's bytes, so tasks do not grow with the table.
    """
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(cores if splits <= cores else 4 * splits, *keys)


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from the table.

    Readers get column pruning, file-size statistics and a lineage that does not
    depend on any executor staying alive.
    """
    return cut_at(df, name)[0]


def cut_at(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """``cut`` and the path of the table, for a loop that drops what it has replaced."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete stage tables that nothing reads any more."""
    for path in paths:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's stage tables; call it after the results are written."""
    _delete(spark, f"{shared_root(spark)}/driftwarden-{spark.sparkContext.applicationId}")
