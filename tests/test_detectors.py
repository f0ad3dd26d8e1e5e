import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftwarden.detectors import iforest, ocsvm
from driftwarden.detectors.centroid import detect_centroid
from driftwarden.detectors.envelope import detect_envelope, support_sums
from driftwarden.detectors.iforest import average_path, detect_iforest
from driftwarden.detectors.lof import detect_lof
from driftwarden.detectors.ocsvm import detect_ocsvm, solve_dual
from driftwarden.detectors.vote import majority_vote, stack_flags
from driftwarden.operators import dense
from driftwarden.operators.neighbours import nearest_segments
from tests.helpers import as_rows, brute_lof, distance_matrix, unit_rows, vectors_frame


@pytest.fixture(scope="module")
def data():
    """A big entity with many copies of one vector, a small one, and one of identical vectors."""
    return {1: unit_rows(1, 60, 12, copies=20), 2: unit_rows(2, 9, 12), 3: np.ones((6, 2)) / np.sqrt(2)}


@pytest.fixture(scope="module")
def vectors(spark, data):
    return vectors_frame(spark, data, n_genuine=3).cache()


@pytest.mark.parametrize("largest", [None, 10**9])
def test_centroid(spark, data, vectors, largest):
    got = {(r.entity, r.seg): (r.score, r.flag) for r in detect_centroid(vectors, largest=largest).collect()}
    for entity, x in data.items():
        dist = np.sqrt(((x - x.mean(0)) ** 2).sum(1))[3:]
        for i, d in enumerate(dist):
            score, flag = got[(entity, i + 3)]
            assert score == pytest.approx(d, abs=1e-7)
            assert flag == int(dist.mean() > 1e-6 and d / dist.mean() > 1.15)
    assert all(flag == 0 for (entity, _), (_, flag) in got.items() if entity == 3)


@pytest.mark.parametrize("block_vectors", [1024, 8])
def test_nearest_segments_against_all_pairs(data, vectors, block_vectors):
    got = {}
    for r in nearest_segments(vectors, ["entity"], "seg", 5, block_vectors).orderBy("rank").collect():
        got.setdefault((r.entity, r.seg), []).append((r.neighbour, r.dist))
    for entity, x in data.items():
        d = distance_matrix(x)
        for i in range(len(x)):
            order = [j for j in np.lexsort((np.arange(len(x)), d[i])) if j != i][:5]
            assert [j for j, _ in got[(entity, i)]] == order
            assert [v for _, v in got[(entity, i)]] == pytest.approx([d[i, j] for j in order], abs=2e-9)


@pytest.mark.parametrize("k", [5, 40])
@pytest.mark.parametrize("block_vectors", [1024, 8])
def test_lof_against_brute_force(data, vectors, k, block_vectors):
    got = {(r.entity, r.seg): (r.score, r.flag) for r in detect_lof(vectors, k=k, block_vectors=block_vectors).collect()}
    for entity, x in data.items():
        scores, flags = brute_lof(x, k, 0.25, 3)
        for i, (s, f) in enumerate(zip(scores, flags)):
            assert got[(entity, i + 3)] == (pytest.approx(s, rel=1e-6), f)


def test_forest_scores_do_not_depend_on_partitions(spark, vectors):
    settings = {"trees": 8, "samples": 16, "features": 6}
    one = as_rows(detect_iforest(vectors, **settings), "entity", "seg", "score", "flag")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        many = as_rows(detect_iforest(vectors.repartition(13), largest=10**9, **settings), "entity", "seg", "score", "flag")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert one == many
    assert all(0 < r[2] < 1 for r in one)
    assert average_path(2) == 1.0 and average_path(1) == 0.0
    assert average_path(256) == pytest.approx(10.244770920, abs=1e-6)


def test_forest_isolates_a_far_row(spark):
    x = np.full((40, 3), 0.5) + np.random.default_rng(0).normal(0, 0.01, (40, 3))
    x[39] = [5, 5, 5]
    scores = detect_iforest(vectors_frame(spark, {1: x}), trees=30, samples=32, features=3).orderBy(F.desc("score"))
    assert scores.first().seg == 39


@pytest.mark.parametrize("nu", [0.1, 0.3, 1.0])
@pytest.mark.parametrize("working_set", [512, 16])
def test_svm_dual_is_optimal(data, vectors, nu, working_set, monkeypatch):
    monkeypatch.setattr(ocsvm, "KERNEL_ROWS", 20)
    if nu == 0.1 and working_set == 16:
        pytest.skip("one small working set is enough")
    solved = solve_dual(vectors, ["entity"], "seg", nu, 0.4, working_set=working_set).toPandas()
    for entity, x in data.items():
        part = solved[solved.entity == entity]
        assert part.alpha.sum() == pytest.approx(nu * len(x), abs=1e-9)
        assert (part.alpha >= 0).all() and (part.alpha <= part.copies).all()
        low, high = part[part.alpha < part.copies], part[part.alpha > 0]
        if len(low):
            assert high.grad.max() - low.grad.min() <= 1.1e-6
        assert part.copies.sum() == len(x)


def test_forest_with_replacement(vectors):
    from driftwarden.detectors.iforest import draw_with_replacement

    drawn = draw_with_replacement(vectors, ["entity"], "seg", 3, 16, 60)
    sizes = as_rows(drawn.groupBy("entity", "tree").count(), "entity", "tree", "count")
    assert sizes == [(e, t, n) for e, n in ((1, 16), (2, 9), (3, 6)) for t in range(3)]
    assert drawn.count() > drawn.distinct().count()
    settings = {"trees": 5, "samples": 16, "features": 6, "bootstrap": True}
    assert detect_iforest(vectors, **settings).count() == 57 + 6 + 3


def test_envelope_around_zero(spark):
    x = np.random.default_rng(8).normal(0, 1, (30, 2)) + 3
    got = detect_envelope(vectors_frame(spark, {1: x}), support=1.0, steps=1, reweight=False, centered=True)
    inverse = np.linalg.inv(x.T @ x / len(x))
    for r in got.collect():
        assert r.score == pytest.approx(x[r.seg] @ inverse @ x[r.seg], abs=1e-5)


def test_svm_flags_at_most_nu(data, vectors):
    flags = detect_ocsvm(vectors.withColumn("is_scored", F.lit(True)), nu=0.3)
    for r in flags.groupBy("entity").agg(F.avg("flag").alias("share")).collect():
        assert r.share <= 0.3


def test_svm_full_nu_is_a_kernel_mean(data, vectors):
    got = {(r.entity, r.seg): r.score for r in detect_ocsvm(vectors, nu=1.0).collect()}
    for entity, x in data.items():
        g = np.exp(-0.4 * ((x[:, None] - x[None]) ** 2).sum(2)).sum(1)
        for i in range(3, len(x)):
            assert got[(entity, i)] == pytest.approx(g.max() - g[i], abs=1e-8)


def brute_envelope(x, steps=30, contamination=0.1):
    n, h = len(x), len(x) // 2
    d = np.round(((x - np.median(x, 0)) ** 2).sum(1), 6)
    for _ in range(steps):
        rows = x[np.lexsort((np.arange(n), d))[:h]]
        cov = np.cov(rows.T, bias=True)
        z = x - rows.mean(0)
        d = np.round(np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z), 6)
    return d, (-d < np.percentile(-d, 100 * contamination)).astype(int)


@pytest.mark.parametrize("largest", [None, 10**9])
def test_envelope_against_brute_force(spark, largest):
    rng = np.random.default_rng(5)
    data = {e: rng.normal(0, 1, (40, 3)) @ rng.normal(0, 1, (3, 3)) + 2 for e in (1, 2)}
    got = detect_envelope(vectors_frame(spark, data), reweight=False, largest=largest)
    got = {(r.entity, r.seg): (r.score, r.flag) for r in got.collect()}
    for entity, x in data.items():
        d, flags = brute_envelope(x)
        for i in range(len(x)):
            assert got[(entity, i)] == (pytest.approx(d[i], abs=1e-4), flags[i])


def test_envelope_with_more_terms_than_rows(spark, monkeypatch):
    from driftwarden.detectors import envelope

    x = np.random.default_rng(11).normal(0, 1, (24, 40)) + 1
    for ridge, centered in ((0.0, False), (0.5, False), (0.5, True)):
        plain = as_rows(detect_envelope(vectors_frame(spark, {1: x}), ridge=ridge, centered=centered), "seg", "score", "flag")
        monkeypatch.setattr(envelope, "MAX_DIMS", 8)  # the rows' own products instead of terms x terms
        own = as_rows(detect_envelope(vectors_frame(spark, {1: x}), ridge=ridge, centered=centered), "seg", "score", "flag")
        monkeypatch.undo()
        assert [(s, pytest.approx(d, abs=1e-4, rel=1e-6), f) for s, d, f in plain] == own


def test_chi_square_quantiles():
    from driftwarden.detectors.envelope import chi_square_quantile

    known = {(1, 0.5): 0.454936423, (2, 0.5): 1.386294361, (2, 0.975): 7.377758908, (10, 0.975): 20.483177350,
             (100, 0.5): 99.334129235, (500, 0.975): 563.851529588}
    for (dims, share), value in known.items():
        assert chi_square_quantile(dims, share) == pytest.approx(value, abs=1e-6)
    assert chi_square_quantile(60_000, 0.5) == pytest.approx(60_000 * (1 - 2 / (9 * 60_000)) ** 3, rel=1e-7)


def test_small_and_large_groups_meet_in_one_call(spark, monkeypatch):
    from driftwarden.operators import blocks

    data = {1: unit_rows(1, 30, 6), 2: unit_rows(2, 9, 6)}
    vectors = vectors_frame(spark, data, 3)
    settings = {"trees": 6, "samples": 8, "features": 4}
    for detect in (lambda: detect_iforest(vectors, **settings), lambda: detect_iforest(vectors, bootstrap=True, **settings),
                   lambda: detect_envelope(vectors, ridge=0.1)):
        whole = as_rows(detect(), "entity", "seg", "score", "flag")
        monkeypatch.setattr(blocks, "SCORE_ROWS", 16)
        assert as_rows(detect(), "entity", "seg", "score", "flag") == [pytest.approx(r, abs=1e-5) for r in whole]
        monkeypatch.undo()


def test_solver_names_a_dual_that_stays_open():
    from driftwarden.detectors.ocsvm import descend

    kernel = np.eye(3)
    with pytest.raises(RuntimeError, match="did not converge"):
        descend(kernel, np.array([1.0, 0.0, 0.0]), np.array([5.0, 0.0, 0.0]), np.ones(3), -1.0)


def test_optimality_is_certified_for_split_groups(spark):
    from driftwarden.detectors.ocsvm import optimality

    vectors = vectors_frame(spark, {1: unit_rows(3, 90, 6), 2: unit_rows(4, 12, 6, copies=4)})
    for row in optimality(vectors, working_set=16).collect():
        assert row.total == pytest.approx(0.3 * row.n) and row.gap <= 1.1e-6
        assert row.n == {1: 90, 2: 12}[row.entity]


def test_envelope_with_singular_covariance(spark, vectors):
    rows = detect_envelope(vectors).collect()
    assert len(rows) == 57 + 6 + 3
    assert all(r.score >= 0 and r.flag in (0, 1) for r in rows)


def test_majority(spark):
    frames = {n: spark.createDataFrame([(1, 0, f)], "entity long, seg int, flag int")
              for n, f in zip("abcde", (1, 1, 1, 0, 0))}
    keys = ["entity", "seg"]
    assert as_rows(majority_vote(stack_flags(frames, keys), keys), "votes", "flag") == [(3, 1)]
    assert as_rows(majority_vote(stack_flags(frames, keys), keys, 3), "votes", "flag") == [(3, 0)]


@pytest.mark.parametrize("large", [False, True])
def test_forest_takes_values_that_are_neighbours_in_double_precision(spark, monkeypatch, large):
    """1/sqrt(2) and 3/sqrt(18) differ in their last bit, so a split between them rounds to one of the two."""
    low, high = sorted([1 / 2 ** 0.5, 3 / 18 ** 0.5])
    assert low < high and np.nextafter(low, 1) == high
    rows = [(e, s, ["a"], [x], s < 2, True) for e in range(8) for s, x in enumerate([low, high, 0.9])]
    frame = spark.createDataFrame(
        rows, "entity long, seg int, terms array<string>, vals array<double>, is_fit boolean, is_scored boolean")
    if large:
        monkeypatch.setattr(iforest.blocks, "SCORE_ROWS", 1)
    got = {(r.entity, r.seg): r.score for r in detect_iforest(frame, trees=6, samples=2, features=1).collect()}
    for entity in range(8):
        paths = {0: [], 1: [], 2: []}
        for tree in range(6):
            split = low + iforest._uniform(entity, tree, 0, "split") * (high - low)
            together = split >= high  # both fitted rows go left; the third one leaves where no fitted row is
            for seg in range(2 if together else 3):
                paths[seg].append(2.0 if together else 1.0)
        for seg, found in paths.items():
            assert got[(entity, seg)] == pytest.approx(2.0 ** (-(np.mean(found) if found else 0.0)), abs=1e-9)


def test_trees_grown_together_equal_trees_grown_alone():
    x = np.random.default_rng(5).integers(0, 4, (7, 13, 5)).astype(float)
    together = iforest._grow_trees(x, [("k", t) for t in range(7)], 4)
    for t in range(7):
        for a, b in zip(together, iforest._grow_trees(x[t:t + 1], [("k", t)], 4)):
            np.testing.assert_array_equal(a[t], b[0])


def test_support_sums_multiply_batches_of_rows(spark, data):
    support = vectors_frame(spark, data)
    sums = support_sums(support, ["entity"])
    # a row per pair of a row's terms made 64 dimensions cost 2,145 rows each
    assert "Generate" not in sums._jdf.queryExecution().toString()
    got = {(r.entity, r.i, r.j): r.s for r in sums.collect()}
    for entity, x in data.items():
        x = np.column_stack([np.ones(len(x)), x])
        full, names = x.T @ x, ["", *[f"t{i:03d}" for i in range(x.shape[1] - 1)]]
        for i, a in enumerate(names):
            for j, b in enumerate(names[i:], i):
                assert got.get((entity, a, b), 0.0) == pytest.approx(full[i, j], abs=1e-9)
    assert all((e, "", n) in got for e, n, _ in got)


def test_dot_products_take_only_shared_terms():
    rng = np.random.default_rng(3)
    a, b = (pd.DataFrame({"terms": [list(rng.choice(names, 4, replace=False)) for _ in range(6)],
                          "vals": [rng.random(4).tolist() for _ in range(6)]}) for names in (list("abcdef"), list("defghi")))
    a.at[0, "terms"], a.at[0, "vals"] = [None], [5.0]
    b.at[0, "terms"], b.at[0, "vals"] = [None], [7.0]
    for left, right in ((a, b), (b, a), (a, a), (a, a.iloc[2:4]), (a.iloc[:0], b)):
        expected = [[sum(v * w for t, v in zip(*l) for u, w in zip(*r) if t == u and t is not None)
                     for r in right[["terms", "vals"]].itertuples(index=False)]
                    for l in left[["terms", "vals"]].itertuples(index=False)]
        np.testing.assert_allclose(dense.dot_products(left, right), np.array(expected).reshape(len(left), len(right)), atol=1e-12)
