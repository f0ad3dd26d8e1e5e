"""Supervised text classifier: a feed-forward network over hashed TF-IDF features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.operators.features import fit_vocabulary
from driftwarden.operators.metrics import auc_trapezoid, binary_metrics, roc_auc
from driftwarden.operators.ranking import with_position
from driftwarden.operators.sampling import upsample_minority

# The network's weights live on the driver, so its input width is fixed; a wider vocabulary shares it by hash.
INPUT_WIDTH = 256


def input_vectors(features: DataFrame, rows: DataFrame, keys: Sequence[str], width: int = INPUT_WIDTH) -> DataFrame:
    """Rows with a dense ``features`` vector.

    Up to ``width`` terms have an input each; more terms are hashed, and those with
    the same hash add up.
    """
    n_terms = features.select("term").distinct().count()
    if n_terms <= width:
        inputs = fit_vocabulary(features, [], n_terms).withColumnRenamed("term_id", "_i")
        numbered = features.join(F.broadcast(inputs), "term").withColumn("_i", F.col("_i").cast("int"))
    else:
        numbered = features.withColumn("_i", F.pmod(F.xxhash64("term"), F.lit(width)).cast("int"))
    summed = numbered.groupBy(*keys, "_i").agg(F.sum("value").alias("_v"))
    packed = summed.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_i", "_v"))).alias("_m"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                         lambda i: F.coalesce(F.element_at("_m", i), F.lit(0.0)))
    empty = F.array_repeat(F.lit(0.0), width)
    return (rows.join(packed, list(keys), "left")
            .withColumn("features", array_to_vector(F.when(F.col("_m").isNull(), empty).otherwise(filled))).drop("_m"))


def create_network(width: int, hidden: Sequence[int], epochs: int, learning_rate: float, solver: str,
                   seed: int) -> MultilayerPerceptronClassifier:
    """Hidden layers of width 0 are left out."""
    layers = [width, *[h for h in hidden if h > 0], 2]
    return MultilayerPerceptronClassifier(layers=layers, maxIter=epochs, stepSize=learning_rate, solver=solver,
                                          seed=seed, labelCol="label", featuresCol="features")


def classify(rows: DataFrame, id_col: str, hidden: Sequence[int], epochs: int, learning_rate: float = 0.03,
             solver: str = "l-bfgs", seed: int = 0, width: int = INPUT_WIDTH, balanced: bool = False) -> DataFrame:
    """Fit on ``is_train`` rows; (id, is_train, label, pred, score) for all rows.

    ``balanced`` repeats rows with label 1 at random until both labels are equally frequent.
    """
    network = create_network(width, hidden, epochs, learning_rate, solver, seed)
    train = rows.filter("is_train")
    if balanced:
        train = upsample_minority(train, "label", id_col, seed)
    model = network.fit(train.withColumn("label", F.col("label").cast("double")))
    return model.transform(rows).select(
        id_col, "is_train", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("pred"),
        vector_to_array("probability")[1].alias("score"))


def _metrics(predicted: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """One row: the ten metrics of one part of the data."""
    base = binary_metrics(predicted)
    area = roc_auc(predicted)
    placed = with_position(predicted, [], [id_col], "_pos")
    trapezoid = auc_trapezoid(placed, [], "pred", "score", "_pos")
    one = base.withColumn("_k", F.lit(1)).join(area.withColumn("_k", F.lit(1)), "_k").join(
        trapezoid.withColumn("_k", F.lit(1)), "_k")
    matrix = F.struct("tn", "fp", "fn", "tp")
    return one.select("_k", *[F.col(c).alias(f"{prefix}_{n}") for c, n in (
        ("accuracy", "accuracy"), ("precision", "precision"), ("recall", "recall"), ("f1_score", "f1_score"),
        ("roc_auc", "roc_auc_score"), ("auc", "auc"))], matrix.alias(f"{prefix}_confusion_matrix"))


def metric_row(predicted: DataFrame, id_col: str, settings: dict[str, Any]) -> DataFrame:
    """Settings, then the train and test metrics: 20 columns."""
    train = _metrics(predicted.filter("is_train"), id_col, "train")
    test = _metrics(predicted.filter(~F.col("is_train")), id_col, "test")
    named = [(F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v)).alias(k)
             for k, v in settings.items()]
    return train.join(test, "_k").select(*named, *[c for c in train.columns if c != "_k"],
                                         *[c for c in test.columns if c != "_k"])


def grid_metrics(rows: DataFrame, id_col: str, grid: Sequence[dict[str, Any]], width: int = INPUT_WIDTH) -> DataFrame:
    """A metric row per grid point; one distributed fit each, over the same materialised rows."""
    parts = []
    for point in grid:
        predicted = classify(rows, id_col, point["hidden_units"], point["epochs"], point["learning_rate"],
                             point["optimizer"], point["rep"], width)
        parts.append(metric_row(predicted, id_col, point))
    return reduce(DataFrame.unionByName, parts)
