import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwarden.operators import skew
from driftwarden.operators.ranking import group_percentile, group_percentiles, running_total, with_position
from driftwarden.operators.skew import attach, join_scalars
from tests.helpers import as_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most of the rows."""
    rows = [("hot" if i % 5 else f"k{i % 3}", i, float((i * 37) % 101)) for i in range(500)]
    return spark.createDataFrame(rows, "g string, id long, x double").repartition(7)


def test_positions_agree_between_window_and_slices(skewed):
    whole = as_rows(with_position(skewed, ["g"], ["x", "id"]), "g", "id", "pos")
    sliced = as_rows(with_position(skewed, ["g"], ["x", "id"], max_window_rows=10), "g", "id", "pos")
    assert whole == sliced
    hot = [r[2] for r in whole if r[0] == "hot"]
    assert sorted(hot) == list(range(400))


def test_global_positions(skewed):
    whole = as_rows(with_position(skewed, [], ["id"]), "id", "pos")
    assert whole == [(i, i) for i in range(500)]
    assert as_rows(with_position(skewed, [], ["id"], max_window_rows=1), "id", "pos") == whole


def test_descending_order_in_slices(skewed):
    got = with_position(skewed, [], [F.desc("x"), "id"], max_window_rows=1)
    assert as_rows(got, "id", "pos") == as_rows(with_position(skewed, [], [F.desc("x"), "id"]), "id", "pos")


def test_running_total(skewed):
    got = {r.id: r.total for r in running_total(skewed, ["g"], ["id"], "x", "total", max_window_rows=3).collect()}
    expected, sums = {}, {}
    for r in sorted(skewed.collect(), key=lambda r: r.id):
        sums[r.g] = sums.get(r.g, 0.0) + r.x
        expected[r.id] = sums[r.g]
    assert got == expected


@pytest.mark.parametrize("largest", [None, 500])
def test_percentile_is_exact(skewed, largest):
    local = skewed.toPandas()
    for share in (0.0, 0.1, 0.25, 0.5, 1.0):
        got = group_percentile(skewed, ["g"], "x", share, "p", largest=largest, max_window_rows=20)
        for r in got.collect():
            assert r.p == pytest.approx(np.percentile(local[local.g == r.g].x, 100 * share), abs=1e-12)


@pytest.mark.parametrize("largest", [None, 500])
def test_weighted_percentiles(spark, largest):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 1), ("a", 3.0, 1), ("a", 10.0, 1), ("b", 5.0, 3), ("b", 9.0, 1)],
                               "g string, x double, w int")
    got = {r.g: r.p for r in group_percentiles(df, ["g"], "x", [0.25, 1.0], "p", "w", largest).collect()}
    assert got["a"] == [1.75, 10.0]
    assert got["b"] == [5.0, 9.0]


def test_joins_keep_every_row(skewed):
    table = skewed.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    plain = as_rows(skewed.join(table, "g"), "g", "id", "n")
    assert as_rows(join_scalars(skewed, table, ["g"], ["id"]), "g", "id", "n") == plain
    assert as_rows(attach(skewed, table, ["g"], "id"), "g", "id", "n") == plain
    total = skewed.agg(F.sum("x").alias("s"))
    assert join_scalars(skewed, total, [], ["id"]).filter("s is not null").count() == 500


def test_rows_of_frequent_keys_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(skew, "FREQUENT_ROWS", 5)
    rows = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1), ("c", 2), (None, 3), ("c", 2)], "g string, id int")
    table = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 4.0), ("z", 5.0)], "g string, n double")
    plain = rows.join(table, "g")
    assert as_rows(skew.attach_frequent(rows, table, ["g"], rows.count()), "g", "id", "n") == as_rows(plain, "g", "id", "n")


def test_partitions_follow_the_rows(spark):
    assert skew.pieces_for(spark.range(1), 900 * skew.TASK_ROWS) == 900
    assert skew.pieces_for(spark.range(1), 5) == int(spark.conf.get("spark.sql.shuffle.partitions"))
