"""Queries that run with the whole settings, on rows built here: results equal their SQL and those of the full settings."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from driftwarden.detectors import iforest
from driftwarden.detectors.centroid import detect_centroid
from driftwarden.detectors.envelope import detect_envelope
from driftwarden.detectors.iforest import detect_iforest
from driftwarden.detectors.lof import detect_lof
from driftwarden.detectors.ocsvm import detect_ocsvm
from driftwarden.detectors.vote import majority_vote, stack_flags
from driftwarden.plans import workloads as W
from tests.test_oracles import _sorted

TABLES = ("lineitem", "part", "supplier")


@pytest.fixture(scope="module")
def streams_dir(tmp_path_factory):
    """Streams of 26, 22 and 2 segments over 12 brands; the first two entities are labelled."""
    path, rng = tmp_path_factory.mktemp("streams"), np.random.default_rng(5)
    sizes = {1: 515, 2: 435, 3: 25}
    n = sum(sizes.values())
    pd.DataFrame({
        "l_suppkey": np.repeat(list(sizes), list(sizes.values())), "l_shipdate": pd.Timestamp("1995-01-01"),
        "l_orderkey": np.arange(n), "l_linenumber": 1, "l_partkey": np.minimum(rng.geometric(0.2, n), 12),
        "l_extendedprice": rng.random(n).round(2), "l_returnflag": rng.choice(["R", "N"], n), "l_quantity": rng.integers(1, 50, n) * 1.0,
        "l_discount": rng.integers(0, 10, n) / 100}).astype({"l_shipdate": "datetime64[us]"}).to_parquet(path / "lineitem.parquet")
    pd.DataFrame({"p_partkey": range(1, 13), "p_brand": [f"b{i:02d}" for i in range(12)]}).to_parquet(path / "part.parquet")
    pd.DataFrame({"s_suppkey": [1, 2, 3], "s_acctbal": [5000.0, 6000.0, 10.0]}).to_parquet(path / "supplier.parquet")
    return str(path)


def by_sql(path, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    cursor = con.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    return [dict(zip(names, row)) for row in cursor.fetchall()]


def both(spark, path, name):
    """Rows of the query and of its SQL, columns in the order of the query's."""
    df = entry_point.queries()[name](spark, path)
    return _sorted(df.collect()), _sorted([tuple(row[c] for c in df.columns) for row in by_sql(path, name)])


def test_forest_has_all_trees_rows_and_terms(spark, streams_dir):
    got, expected = both(spark, streams_dir, "detect_iforest")
    assert got == expected and len(got) == 16 + 12
    full = detect_iforest(W.stream_vectors(spark, streams_dir), trees=100, samples=100, features=60)
    assert got == _sorted(full.select("entity", "seg", "score", "flag").collect())


def test_vote_of_five_takes_the_detectors_own_settings(spark, streams_dir):
    got, expected = both(spark, streams_dir, "majority_vote_of_five")
    assert got == expected and len(got) == 16 + 12
    vectors = W.stream_vectors(spark, streams_dir)
    flags = {"centroid": detect_centroid(vectors), "lof": detect_lof(vectors, k=40), "ocsvm": detect_ocsvm(vectors, nu=0.3),
             "iforest": detect_iforest(vectors, trees=100, samples=100, features=60),
             "envelope": detect_envelope(W.quantity_vectors(spark, streams_dir))}
    vote = majority_vote(stack_flags(flags, ["entity", "seg"]), ["entity", "seg"])
    assert got == _sorted(vote.collect())


@pytest.mark.parametrize("name", ["search_scores", "search_best"])
def test_search_tries_a_hundred_candidates_of_the_full_spaces(spark, streams_dir, name):
    got, expected = both(spark, streams_dir, name)
    assert got == expected
    if name == "search_scores":
        tried = {}
        for row in entry_point.queries()[name](spark, streams_dir).collect():
            tried.setdefault((row.detector, row.entity), set()).add(row.candidate)
        assert {k: len(v) for k, v in tried.items()} == {
            (d, e): n for d, n in (("centroid", 25), ("lof", 100), ("iforest", 100), ("envelope", 100)) for e in (1, 2)}


def test_settings_beyond_a_group_share_its_forest(monkeypatch):
    rows = pd.DataFrame({"seg": range(8), "terms": [["a", "b"]] * 8, "vals": [[float(i), float(i * i % 5)] for i in range(8)],
                         "is_fit": True})
    grown, grow = [], iforest._grow_trees
    monkeypatch.setattr(iforest, "_grow_trees", lambda *args: grown.append(1) or grow(*args))
    settings = [(5, 8, 2, False), (9, 100, 60, False), (3, 50, 2, False), (4, 4, 60, False)]
    scores = iforest.group_forest((1,), rows, "seg", settings)
    assert list(scores) == settings and len(grown) == 2
    for setting in settings:
        assert list(scores[setting]) == list(iforest.group_forest((1,), rows, "seg", [setting])[setting])
