"""Scores of predictions against labels, as aggregates with any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.operators.ranking import running_total
from driftwarden.runtime import cut

POSITIVE_WEIGHT = 9
UNDEFINED = -1.0


def _cell(label: int, pred: int) -> Column:
    return F.sum(F.when((F.col("label") == label) & (F.col("pred") == pred), 1).otherwise(0))


def confusion_cells(rows: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """(group, tn, fp, fn, tp) from the columns ``label`` and ``pred``."""
    return rows.groupBy(*group).agg(_cell(0, 0).alias("tn"), _cell(0, 1).alias("fp"),
                                    _cell(1, 0).alias("fn"), _cell(1, 1).alias("tp"))


def confusion_matrix(rows: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """(group, label, pred, n)."""
    return rows.groupBy(*group, "label", "pred").agg(F.count(F.lit(1)).alias("n"))


def _ratio(top: Column, bottom: Column, empty: float) -> Column:
    return F.when(bottom == 0, F.lit(empty)).otherwise(top / bottom)


def binary_metrics(rows: DataFrame, group: Sequence[str] = (), zero_division: float = 1.0) -> DataFrame:
    """Accuracy, precision, recall, F1 and the confusion cells."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    cells = confusion_cells(rows, group)
    return cells.select(
        *group, ((tp + tn) / (tp + tn + fp + fn)).alias("accuracy"),
        _ratio(tp, tp + fp, zero_division).alias("precision"),
        _ratio(tp, tp + fn, zero_division).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn, zero_division).alias("f1_score"), "tn", "fp", "fn", "tp")


def grade_cells(cells: DataFrame, group: Sequence[str], weight: int = POSITIVE_WEIGHT) -> DataFrame:
    """Weighted grade from confusion cells; plain accuracy where labels and predictions hold one single class."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    single = ((tn + fp + fn) == 0) | ((tp + fp + fn) == 0)
    plain = (tn + tp) / (tn + fp + fn + tp)
    graded = (tn + weight * tp) / ((fp + tn) + weight * (tp + fn))
    return cells.select(*group, F.when(single, plain).otherwise(graded).alias("grade"))


def weighted_grade(rows: DataFrame, group: Sequence[str] = (), weight: int = POSITIVE_WEIGHT) -> DataFrame:
    return grade_cells(confusion_cells(rows, group), group, weight)


def evaluate(flags: DataFrame, labels: DataFrame, entity: str = "entity", id_col: str = "seg",
             by: Sequence[str] = ("detector",)) -> DataFrame:
    """Accuracy and confusion cells per labelled entity, averaged over the entities."""
    known = labels.filter(F.col("label").isNotNull()).select(entity, id_col, "label")
    rows = flags.withColumnRenamed("flag", "pred").join(known, [entity, id_col])
    cells = confusion_cells(rows, [*by, entity])
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cells.groupBy(*by).agg(
        F.avg((F.col("tn") + F.col("tp")) / n).alias("accuracy"),
        F.avg("tn").alias("true_negative"), F.avg("fn").alias("false_negative"),
        F.avg("tp").alias("true_positive"), F.avg("fp").alias("false_positive"))


def roc_auc(rows: DataFrame, group: Sequence[str] = (), score: str = "score", largest: int | None = None,
            max_window_rows: int | None = None) -> DataFrame:
    """Area under the ROC curve by the rank sum, ties counted half; -1 when a class is missing.

    Equal scores are combined first, then each score needs only the negatives below it.
    """
    keys = list(group)
    steps = rows.groupBy(*keys, F.col(score).alias("_s")).agg(
        F.sum((F.col("label") == 1).cast("long")).alias("_pos"), F.sum((F.col("label") == 0).cast("long")).alias("_neg"))
    steps = cut(steps, "steps")
    below = running_total(steps, keys, ["_s"], "_neg", "_upto", largest, max_window_rows)
    won = F.sum(F.col("_pos") * (F.col("_upto") - F.col("_neg") / 2))
    pairs = F.sum("_pos") * F.sum("_neg")
    return below.groupBy(*keys).agg(F.when(pairs == 0, F.lit(UNDEFINED)).otherwise(won / pairs).alias("roc_auc"))


def auc_trapezoid(points: DataFrame, group: Sequence[str], x: str, y: str, pos: str) -> DataFrame:
    """Area under y over x by trapezoids in the order of ``pos`` (0, 1, 2, ...); -1 when x is not monotone.

    Neighbouring points meet by an equi-join on the position, so no group is held by one task.
    """
    keys = list(group)
    here = points.select(*keys, F.col(pos).alias("_p"), F.col(x).alias("_x1"), F.col(y).alias("_y1"))
    before = points.select(*keys, (F.col(pos) + 1).alias("_p"), F.col(x).alias("_x0"), F.col(y).alias("_y0"))
    step = F.col("_x1") - F.col("_x0")
    steps = here.join(before, [*keys, "_p"]).select(
        *keys, step.alias("_dx"), (step * (F.col("_y1") + F.col("_y0")) / 2).alias("_a"))
    areas = steps.groupBy(*keys).agg(
        F.when(F.min("_dx") >= 0, F.sum("_a")).when(F.max("_dx") <= 0, -F.sum("_a"))
        .otherwise(F.lit(UNDEFINED)).alias("auc"))
    if not keys:
        return areas.select(F.coalesce("auc", F.lit(UNDEFINED)).alias("auc"))
    everyone = points.select(*keys).distinct()
    return everyone.join(areas, keys, "left").select(*keys, F.coalesce("auc", F.lit(UNDEFINED)).alias("auc"))
