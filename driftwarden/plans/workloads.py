"""The test tables seen as streams, documents and dense vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.operators.features import l2_normalise, pack_vectors, term_counts, tokenize
from driftwarden.operators.ranking import with_position
from driftwarden.operators.segments import assign_segments
from driftwarden.operators.skew import join_scalars
from driftwarden.runtime import cut, deal_scan, spread_scan

SEGMENT_LENGTH = 20
GENUINE = 10
RETURNED = 10
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
              "l_returnflag", "l_quantity", "l_discount"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every supplier with its position in the supplier's stream and its segment."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", *LINE_ORDER)
    placed = with_position(lines, ["l_suppkey"], LINE_ORDER)
    return assign_segments(placed.withColumnRenamed("l_suppkey", "entity"), SEGMENT_LENGTH)


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered lines written once, for queries that need tokens and labels."""
    return cut(stream_lines(spark, sf_dir).select("entity", "pos", "seg", "l_partkey", "l_returnflag"), "lines")


def stream_tokens(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """tokens(entity, pos, seg, token): the brand of each line's part, over whole streams."""
    brands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("token"))
    lines = stream_lines(spark, sf_dir) if lines is None else lines
    return lines.select("entity", "pos", "seg", "l_partkey").join(brands, "l_partkey").select("entity", "pos", "seg", "token")


def line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, token) where the order does not matter: no positions, so no sort."""
    brands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("token"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity"), "l_partkey")
    return lines.join(brands, "l_partkey").select("entity", "token")


def stream_labels(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """labels(entity, seg, label): 1 for a segment with many returned lines."""
    lines = stream_lines(spark, sf_dir) if lines is None else lines
    returned = F.sum((F.col("l_returnflag") == "R").cast("int"))
    return (lines.groupBy("entity", "seg")
            .agg((returned >= RETURNED).cast("int").alias("label")))


def labelled_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities whose labels are known: suppliers with a high account balance."""
    return table(spark, sf_dir, "supplier").filter("s_acctbal > 4500").select(F.col("s_suppkey").alias("entity"))


def stream_features(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Long form (entity, seg, term, tf, value) of normalised term frequencies."""
    tokens = stream_tokens(spark, sf_dir, lines).withColumnRenamed("token", "term")
    return l2_normalise(term_counts(tokens, ["entity", "seg"]), ["entity", "seg"], "tf")


def with_roles(rows: DataFrame, is_fit, is_scored) -> DataFrame:
    return rows.withColumn("is_fit", is_fit).withColumn("is_scored", is_scored)


def stream_vectors(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Packed vectors: all segments are fitted on, the non-genuine ones are scored.

    A token is a term here, so every segment has one. The vectors are far smaller than
    the streams and every detector reads them more than once, so they are written once.
    """
    packed = cut(pack_vectors(stream_features(spark, sf_dir, lines), ["entity", "seg"]), "vectors")
    return with_roles(packed, F.lit(True), F.col("seg") >= GENUINE)


def quantity_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dense columns per segment, total quantity and mean discount, standardised per entity."""
    rows = stream_lines(spark, sf_dir).groupBy("entity", "seg").agg(
        F.sum("l_quantity").alias("qty"), F.avg("l_discount").alias("disc"))
    rows = cut(rows, "quantities")
    moments = rows.groupBy("entity").agg(*[f(c).alias(f"{n}_{c}") for c in ("qty", "disc")
                                           for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    joined = join_scalars(rows, moments, ["entity"], ["seg"])
    standard = [F.round((F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}"), 6) for c in ("disc", "qty")]
    packed = joined.select("entity", "seg", F.array(F.lit("disc"), F.lit("qty")).alias("terms"),
                           F.array(*standard).alias("vals"))
    return cut(with_roles(packed, F.lit(True), F.col("seg") >= GENUINE), "vectors")


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("entity"), "doc_id", "text")


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, spread for work on the texts."""
    return spread_scan(document_rows(spark, sf_dir), "doc_id")


def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = tokenize(deal_scan(document_rows(spark, sf_dir), "entity", "doc_id"), ["entity", "doc_id"])
    return term_counts(terms, ["entity", "doc_id"])


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense rows: the dimension number is the term."""
    rows = table(spark, sf_dir, "embeddings")
    values = F.transform("embedding", lambda x: x.cast("double"))
    names = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.lpad(i.cast("string"), 4, "0"))
    packed = rows.select(F.col("label").cast("long").alias("entity"), F.col("vec_id").alias("seg"),
                         names.alias("terms"), values.alias("vals"))
    return with_roles(packed, F.lit(True), F.lit(True))
