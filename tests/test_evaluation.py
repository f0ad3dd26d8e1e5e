import numpy as np
import pytest

from driftwarden.operators.grids import grid_size, linspace, param_grid, param_sample
from driftwarden.operators.metrics import (
    auc_trapezoid, binary_metrics, confusion_matrix, evaluate, roc_auc, weighted_grade)
from driftwarden.operators.sampling import class_weights, stratified_folds, train_test_split, upsample_minority
from driftwarden.plans import search as R
from driftwarden.plans import spaces
from tests.helpers import as_rows, unit_rows, vectors_frame


def judged(spark, pairs):
    return spark.createDataFrame([(l, p) for l, p in pairs], "label int, pred int")


def test_binary_metrics(spark):
    r = binary_metrics(judged(spark, [(1, 1), (1, 0), (0, 0), (0, 1), (0, 0)])).first()
    assert (r.accuracy, r.precision, r.recall, r.f1_score) == (0.6, 0.5, 0.5, 0.5)
    assert (r.tn, r.fp, r.fn, r.tp) == (2, 1, 1, 1)
    none = binary_metrics(judged(spark, [(1, 0), (0, 0)])).first()
    assert (none.precision, none.recall, none.f1_score) == (1.0, 0.0, 0.0)
    assert as_rows(confusion_matrix(judged(spark, [(1, 0), (0, 0), (0, 0)])), "label", "pred", "n") == [(0, 0, 2), (1, 0, 1)]


def test_weighted_grade(spark):
    assert weighted_grade(judged(spark, [(1, 1), (1, 0), (0, 0), (0, 1)])).first().grade == (1 + 9) / (2 + 18)
    assert weighted_grade(judged(spark, [(0, 0), (0, 0)])).first().grade == 1.0
    assert weighted_grade(judged(spark, [(1, 1)])).first().grade == 1.0
    assert weighted_grade(judged(spark, [(0, 0), (0, 1)])).first().grade == 0.5


def test_evaluation_averages_over_labelled_entities(spark):
    flags = spark.createDataFrame([("d", 1, 0, 1), ("d", 1, 1, 0), ("d", 2, 0, 0), ("d", 3, 0, 1)],
                                  "detector string, entity long, seg int, flag int")
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 1), (2, 0, 0), (3, 0, None)], "entity long, seg int, label int")
    r = evaluate(flags, labels).first()
    assert (r.accuracy, r.true_negative, r.false_negative, r.true_positive, r.false_positive) == (0.75, 0.5, 0.5, 0.5, 0.0)


@pytest.mark.parametrize("limit", [None, 2])
def test_roc_auc_counts_ties_half(spark, limit):
    rng = np.random.default_rng(3)
    label, score = rng.integers(0, 2, 60), rng.integers(0, 12, 60)
    rows = spark.createDataFrame([(int(l), float(s)) for l, s in zip(label, score)], "label int, score double")
    wins = np.mean([(p > n) + 0.5 * (p == n) for p in score[label == 1] for n in score[label == 0]])
    assert roc_auc(rows, max_window_rows=limit).first().roc_auc == pytest.approx(wins)
    assert roc_auc(rows.filter("label = 0")).first().roc_auc == -1.0


def test_trapezoid(spark):
    points = spark.createDataFrame(
        [("up", 0, 0.0, 0.0), ("up", 1, 1.0, 1.0), ("up", 2, 3.0, 1.0), ("down", 0, 2.0, 1.0), ("down", 1, 0.0, 1.0),
         ("mixed", 0, 0.0, 1.0), ("mixed", 1, 2.0, 1.0), ("mixed", 2, 1.0, 1.0), ("one", 0, 1.0, 1.0)],
        "g string, pos long, x double, y double")
    got = {r.g: r.auc for r in auc_trapezoid(points, ["g"], "x", "y", "pos").collect()}
    assert got == {"up": 2.5, "down": 2.0, "mixed": -1.0, "one": -1.0}


def test_split_and_folds(spark):
    rows = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(101)], "id long, label int")
    split = train_test_split(rows, "id", 1)
    assert split.filter("not is_train").count() == 21
    assert as_rows(split, "id", "is_train") == as_rows(train_test_split(rows.repartition(9), "id", 1, max_window_rows=5), "id", "is_train")
    assert as_rows(split, "id", "is_train") != as_rows(train_test_split(rows, "id", 2), "id", "is_train")
    folds = stratified_folds(rows, ["label"], "id", 1)
    sizes = {(r.label, r.fold): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    for label, n in ((0, 86), (1, 15)):
        assert sorted(sizes[(label, f)] for f in range(3)) == sorted(len(range(f, n, 3)) for f in range(3))


def test_upsampling_and_weights(spark):
    rows = spark.createDataFrame([(i, int(i < 4)) for i in range(50)], "id long, label int")
    up = upsample_minority(rows, "label", "id", 1)
    assert up.filter("label = 1").count() == up.filter("label = 0").count() == 46
    assert up.filter("label = 1 and id >= 4").count() == 0
    assert as_rows(class_weights(rows, "label"), "label", "n", "weight") == [(0, 46, 50 / 92), (1, 4, 6.25)]


def test_spaces(spark):
    one = spark.range(1)
    assert one.select(linspace(10, 150, 25, whole=True).alias("v")).first().v == [int(x) for x in np.linspace(10, 150, 25)]
    assert one.select(linspace(0.001, 0.5, 25).alias("v")).first().v == pytest.approx(list(np.linspace(0.001, 0.5, 25)))
    for make in (spaces.iforest_space, spaces.lof_space, spaces.ocsvm_space, spaces.centroid_space, spaces.envelope_space):
        sample = param_sample(spark, make(), spaces.CANDIDATES, spaces.SEED)
        assert sample.count() == sample.select(*make()).distinct().count() == spaces.CANDIDATES
    grid = param_grid(spark, spaces.classifier_space())
    assert grid_size(spaces.classifier_space()) == grid.drop("candidate").distinct().count() == 72
    assert grid.filter("hidden_units[0] = 500 and optimizer = 'SGD'").count() == 8


@pytest.fixture(scope="module")
def runs(spark):
    vectors = vectors_frame(spark, {1: unit_rows(4, 30, 8), 2: unit_rows(5, 24, 8)}).drop("is_fit", "is_scored")
    rows = spark.createDataFrame([(e, s, int(s % 5 == 0)) for e, n in ((1, 30), (2, 24)) for s in range(n)],
                                 "entity long, seg int, label int")
    folds = stratified_folds(rows, ["entity", "label"], "seg", 3)
    return R.cross_validated(vectors, folds, ["entity", "seg"]).cache()


def test_shared_search_equals_one_run_per_candidate(runs):
    from driftwarden.detectors.centroid import detect_centroid
    from driftwarden.detectors.lof import detect_lof

    thresholds = [1.0, 1.1, 1.2]
    fast = R.search_centroid(runs, ["entity"], "seg", thresholds)
    slow = R.search_detector(runs, ["entity"], "seg", "centroid", detect_centroid, [{"threshold": t} for t in thresholds])
    columns = ("entity", "candidate", "score")
    assert [pytest.approx(r) for r in as_rows(fast, *columns)] == as_rows(slow, *columns)
    pairs = [(3, 0.2), (5, 0.1), (3, 0.4)]
    fast = R.search_lof(runs, ["entity"], "seg", pairs)
    slow = R.search_detector(runs, ["entity"], "seg", "lof", detect_lof, [{"k": k, "contamination": c} for k, c in pairs])
    assert [pytest.approx(r) for r in as_rows(fast, *columns)] == as_rows(slow, *columns)


def test_search_of_small_groups_equals_one_run_per_candidate(runs, monkeypatch):
    from driftwarden.operators import blocks

    candidates = {
        "centroid": [{"threshold": 1.2}, {"threshold": 1.05}],
        "lof": [{"n_neighbors": 3, "contamination": 0.2}, {"n_neighbors": 50, "contamination": 0.35}],
        "iforest": [{"n_estimators": n, "max_samples": 8, "max_features": 4, "bootstrap": b, "contamination": c}
                    for n, b, c in ((5, False, 0.2), (3, False, 0.4), (4, True, 0.3))],
        "ocsvm": [{"nu": 0.4, "gamma": 0.5}, {"nu": 0.9, "gamma": 0.5}],
        "envelope": [{"support_fraction": 0.6, "assume_centered": True, "contamination": 0.2}]}
    columns = ("detector", "entity", "candidate", "score")
    fast = as_rows(R.search_all(runs, ["entity"], "seg", candidates), *columns)
    assert len(fast) == 2 * 10 and all(0 <= r[3] <= 1 for r in fast)
    monkeypatch.setattr(blocks, "SCORE_ROWS", 8)
    slow = as_rows(R.search_all(runs, ["entity"], "seg", candidates), *columns)
    assert [(*r[:3], pytest.approx(r[3])) for r in fast] == slow


def test_search_runs_for_the_other_detectors(runs):
    from driftwarden.detectors.envelope import detect_envelope
    from driftwarden.detectors.iforest import detect_iforest
    from driftwarden.detectors.ocsvm import detect_ocsvm

    for name, detect, params in (
            ("iforest", detect_iforest, {"trees": 5, "samples": 8, "features": 4, "contamination": 0.2}),
            ("ocsvm", detect_ocsvm, {"nu": 0.4, "gamma": 0.5}),
            ("envelope", detect_envelope, {"contamination": 0.2, "support": 0.6, "steps": 1})):
        scores = R.search_detector(runs, ["entity"], "seg", name, detect, [params]).collect()
        assert len(scores) == 2 and all(0 <= r.score <= 1 for r in scores)


def test_best_and_summary(spark):
    scores = spark.createDataFrame([("d", 1, 0, 0.5), ("d", 1, 1, 0.5), ("d", 2, 0, 0.1), ("d", 2, 1, 0.7)],
                                   "detector string, entity long, candidate int, score double")
    best = R.best_candidates(scores)
    assert as_rows(best, "entity", "candidate", "score") == [(1, 0, 0.5), (2, 1, 0.7)]
    clean = {r.stat: r.value for r in R.summarise(best, ["score"]).collect()}
    assert clean["mean"] == pytest.approx(0.6) and clean["median"] == pytest.approx(0.6)
    assert clean["std"] == pytest.approx(np.std([0.5, 0.7], ddof=1))
    linked = {r.stat: r.value for r in R.summarise(best, ["score"], cascade=True).collect()}
    assert linked["std"] == pytest.approx(np.std([0.5, 0.7, 0.6, 0.6], ddof=1))
    table = R.result_table(best, ["score"])
    assert as_rows(table, "row", "score")[:2] == [("1", 0.5), ("2", 0.7)]
    assert sorted(r.row for r in table.collect()) == ["1", "2", "mean", "median", "std"]


def test_classifier_learns_a_word(spark):
    from driftwarden.plans.classify import classify, input_vectors, metric_row

    rows = spark.createDataFrame([(i, i % 5 != 4, int(i % 4 == 0)) for i in range(60)], "id long, is_train boolean, label int")
    features = rows.selectExpr("id", "if(label = 1, 'bad', 'good') as term", "1.0D as value")
    inputs = input_vectors(features, rows, ["id"], width=8).cache()
    assert input_vectors(features, rows, ["id"], width=1).first().features.size == 1
    for balanced in (False, True):
        predicted = classify(inputs, "id", [4, 0, 0], epochs=50, width=8, balanced=balanced).cache()
        assert predicted.filter("label = pred").count() == 60
    row = metric_row(predicted, "id", {"rep": 0, "learning_rate": 0.1, "epochs": 50, "hidden_units": [4, 0, 0],
                                       "optimizer": "l-bfgs", "loss_function": "binary_crossentropy"})
    assert len(row.columns) == 20
    first = row.first()
    assert (first.train_accuracy, first.test_roc_auc_score, first.test_precision) == (1.0, 1.0, 1.0)
