"""Small fixtures and brute-force versions to compare with."""

import numpy as np


def as_rows(df, *order):
    return sorted(tuple(r) for r in df.select(*order).collect())


def vectors_frame(spark, matrix_by_entity, n_genuine=0):
    """Packed vectors from {entity: dense matrix}; zero cells are left out."""
    rows = []
    for entity, matrix in matrix_by_entity.items():
        for seg, row in enumerate(np.asarray(matrix, dtype=float)):
            at = np.flatnonzero(row)
            rows.append((entity, seg, [f"t{i:03d}" for i in at], [float(row[i]) for i in at], True, seg >= n_genuine))
    return spark.createDataFrame(
        rows, "entity long, seg int, terms array<string>, vals array<double>, is_fit boolean, is_scored boolean")


def unit_rows(seed, n, dims, copies=0):
    """Random sparse count rows of length 1; the first row is repeated ``copies`` times."""
    rng = np.random.default_rng(seed)
    x = rng.poisson(0.8, (n, dims)).astype(float)
    x[x.sum(1) == 0, 0] = 1.0
    if copies:
        x[1:copies + 1] = x[0]
    return x / np.sqrt((x * x).sum(1))[:, None]


def distance_matrix(x):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    return np.round(d, 9)


def brute_lof(x, k, contamination, n_genuine=0):
    """(factor of scored rows, flags) with every row fitted."""
    d, n = distance_matrix(x), len(x)
    k = max(min(k, n - 1), 1)
    fit = [[j for j in np.lexsort((np.arange(n), d[i])) if j != i][:k] for i in range(n)]
    kd = np.array([d[i, fit[i][-1]] for i in range(n)])
    lrd = np.array([1 / (np.mean(np.maximum(d[i, fit[i]], kd[fit[i]])) + 1e-10) for i in range(n)])
    factor = np.round([lrd[fit[i]].mean() / lrd[i] for i in range(n)], 9)
    offset = np.percentile(-factor, 100 * contamination)
    new = [list(np.lexsort((np.arange(n), d[i])))[:k] for i in range(n)]
    new_lrd = np.array([1 / (np.mean(np.maximum(d[i, new[i]], kd[new[i]])) + 1e-10) for i in range(n)])
    scores = np.round([lrd[new[i]].mean() / new_lrd[i] for i in range(n)], 9)
    return scores[n_genuine:], (-scores < offset).astype(int)[n_genuine:]
