"""One supplier holds a third of all lines and every size limit is tiny: results must not change."""

import os
import shutil

import duckdb
import pytest

import __spark_entry__ as entry_point
from driftwarden.detectors import iforest, ocsvm
from driftwarden.operators import blocks, neighbours, ranking, skew
from tests.test_oracles import SF_DIR, TABLES, _sorted

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")

CHECKED = ["segments", "vocab_ranked", "knn_segments", "detect_centroid", "detect_lof", "detect_iforest",
           "detect_ocsvm_nu1", "detect_envelope_2d", "tfidf_l2", "tfidf_train_test", "vocabulary", "roc_auc",
           "train_test_split", "stratified_folds", "upsample_minority", "submission_matrix", "ocsvm_optimality"]


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("hot")
    for name in TABLES:
        shutil.copy(f"{SF_DIR}/{name}.parquet", path)
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 4 ELSE l_suppkey END AS l_suppkey)
                    FROM '{SF_DIR}/lineitem.parquet') TO '{path}/lineitem.parquet' (FORMAT parquet)""")
    return str(path)


@pytest.fixture()
def tiny_limits(monkeypatch):
    monkeypatch.setattr(ranking, "MAX_WINDOW_ROWS", 40)
    monkeypatch.setattr(skew, "BOUNDED_ROWS", 10)
    monkeypatch.setattr(skew, "BLOCK_ROWS", 32)
    monkeypatch.setattr(blocks, "SCORE_ROWS", 16)
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 64)
    monkeypatch.setattr(ocsvm, "WORKING_SET", 64)
    monkeypatch.setattr(ocsvm, "KERNEL_ROWS", 50)


@pytest.mark.parametrize("name", CHECKED)
def test_split_paths_give_the_same_rows(spark, hot_dir, tiny_limits, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{hot_dir}/{table}.parquet'")
    df = entry_point.queries()[name](spark, hot_dir)
    columns = sorted(df.columns)
    cursor = con.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    expected = _sorted([tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()])
    assert _sorted(df.select(*columns).collect()) == expected


def test_sampling_below_a_hash_limit_is_the_same_draw(spark):
    rows = spark.range(3000).selectExpr("id % 2 as entity", "id as seg", "true as is_fit")
    direct = iforest.draw_samples(rows, ["entity"], "seg", 3, 10, largest=10)
    limited = iforest.draw_samples(rows, ["entity"], "seg", 3, 10, largest=1500)
    assert sorted(direct.collect()) == sorted(limited.collect())
    assert direct.count() == 2 * 3 * 10
