"""Isolation forest per entity: random splits isolate outliers after few steps."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from functools import lru_cache, reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.functions.hashing import DENOMINATOR, hash_key, uniform
from driftwarden.operators import blocks
from driftwarden.operators.blocks import apply_model, by_group, by_size, typed
from driftwarden.operators.dense import PIECE_CELLS, matrix, row_pieces
from driftwarden.operators.features import unpack_vectors
from driftwarden.operators.ranking import group_percentile, with_position
from driftwarden.operators.skew import join_scalars, largest_group
from driftwarden.runtime import cut

TREES = 100
SAMPLES = 100
FEATURES = 60
CONTAMINATION = 0.25
DIGITS = 9
EULER = 0.5772156649015329  # Fixed value: the Euler-Mascheroni constant.


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _uniform(*parts) -> float:
    digest = hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()
    return int(digest[:8], 16) / DENOMINATOR


def draw_samples(vectors: DataFrame, keys: list[str], id_col: str, trees: int, samples: int,
                 largest: int) -> DataFrame:
    """Per tree ``samples`` fitted rows without replacement, the ones with the lowest hash.

    In groups much bigger than a sample only rows whose hash is below a limit are
    sorted. The limit lets some ten standard deviations more rows through than needed;
    should a tree still come up short, the draw is repeated without it.
    """
    fitted = vectors.filter("is_fit").select(*keys, id_col)
    order = Window.partitionBy(*keys, "tree").orderBy("_hash", id_col)

    def draw(rows: DataFrame) -> DataFrame:
        tried = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        hashed = tried.withColumn("_hash", hash_key(*[F.col(k) for k in keys], F.col("tree"), "row", F.col(id_col)))
        if "_limit" in rows.columns:
            hashed = hashed.filter(F.col("_hash") < F.col("_limit"))
        return (hashed.select(*keys, "tree", id_col, "_hash").withColumn("_r", F.row_number().over(order))
                .filter(F.col("_r") <= samples).select(*keys, "tree", id_col))

    if largest <= 20 * samples:
        return draw(fitted)
    share = (samples + 10 * math.sqrt(samples) + 30) / F.col("_n")
    prefix = F.lpad(F.lower(F.hex(F.floor(share * F.lit(DENOMINATOR)).cast("long"))), 8, "0")
    sizes = fitted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    limits = sizes.withColumn("_limit", F.when(share < 1, prefix).otherwise(F.lit("g")))
    drawn = cut(draw(join_scalars(fitted, limits, keys, [id_col]).drop("_n")), "samples")
    found = drawn.groupBy(*keys).agg(F.count(F.lit(1)).alias("_found"))
    short = sizes.join(found, keys, "left").filter(
        F.coalesce("_found", F.lit(0)) < trees * F.least(F.col("_n"), F.lit(samples)))
    return draw(fitted) if short.take(1) else drawn


def draw_with_replacement(vectors: DataFrame, keys: list[str], id_col: str, trees: int, samples: int,
                          largest: int) -> DataFrame:
    """Per tree ``min(samples, n)`` draws from the n fitted rows; a row may be drawn more than once."""
    fitted = vectors.filter("is_fit").select(*keys, id_col)
    placed = with_position(fitted, keys, [id_col], "_pos", largest)
    sizes = fitted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    turns = sizes.select(*keys, "_n", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    turns = turns.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("_n"), F.lit(samples)) - 1)).alias("draw"))
    spot = F.floor(uniform(*[F.col(k) for k in keys], F.col("tree"), "draw", F.col("draw")) * F.col("_n"))
    drawn = turns.select(*keys, "tree", spot.cast("long").alias("_pos"))
    return drawn.join(placed, [*keys, "_pos"]).select(*keys, "tree", id_col)


def draw_features(vectors: DataFrame, keys: list[str], trees: int, features: int) -> DataFrame:
    """Per tree the ordered names of ``features`` of the group's terms (all of them if it has fewer)."""
    terms = unpack_vectors(vectors.filter("is_fit"), keys).select(*keys, "term").distinct()
    tried = terms.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    order = Window.partitionBy(*keys, "tree").orderBy(
        hash_key(*[F.col(k) for k in keys], F.col("tree"), "term", F.col("term")), "term")
    ranked = tried.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= features)
    listed = F.sort_array(F.collect_list(F.struct("_r", "term")))
    return ranked.groupBy(*keys, "tree").agg(listed["term"].alias("names"))


def _grow_trees(x: np.ndarray, seeds: Sequence[tuple], depth_limit: int,
                uniforms: Callable[..., float] = _uniform) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column or -1, split, path) per tree and node from ``x`` (trees x rows x columns); children of node i are 2i+1, 2i+2.

    All trees grow a level at a time. Where values are so close that the split rounds to the upper one, all rows go left
    and the right child is no node: its path is NaN, as everywhere where no sampled row came by.
    """
    trees, size = x.shape[:2]
    last = 2 ** (depth_limit + 1) - 1
    column, split, path = np.full((trees, last), -1), np.zeros((trees, last)), np.full((trees, last), np.nan)
    tree, row = np.repeat(np.arange(trees), size), np.tile(np.arange(size), trees)
    node = np.zeros(trees * size, dtype=int)
    for depth in range(depth_limit + 1):
        order = np.lexsort((node, tree))
        tree, row, node = tree[order], row[order], node[order]
        starts = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])][:len(tree)])
        if not len(starts):
            break
        counts, at_tree, at_node = np.diff(np.r_[starts, len(tree)]), tree[starts], node[starts]
        inner = np.zeros(len(starts), bool)
        if depth < depth_limit and x.shape[2]:
            values = x[tree, row]
            low, high = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
            usable = low < high
            many = usable.sum(1)
            inner = many > 0
            at = np.flatnonzero(inner)
            draws = np.array([(uniforms(*seeds[t], n, "feature"), uniforms(*seeds[t], n, "split"))
                              for t, n in zip(at_tree[at].tolist(), at_node[at].tolist())]).reshape(-1, 2)
            place = np.floor(draws[:, 0] * many[at]).astype(int)
            chosen = (np.cumsum(usable[at], axis=1) > place[:, None]).argmax(1)
            column[at_tree[at], at_node[at]] = chosen
            split[at_tree[at], at_node[at]] = low[at, chosen] + draws[:, 1] * (high[at, chosen] - low[at, chosen])
        for n in np.unique(counts[~inner]):
            here = ~inner & (counts == n)
            path[at_tree[here], at_node[here]] = depth + average_path(int(n))
        kept = np.repeat(inner, counts)
        tree, row, node = tree[kept], row[kept], node[kept]
        node = 2 * node + 1 + (x[tree, row, column[tree, node]] > split[tree, node])
    return column, split, path


def grow_forest(vectors: DataFrame, group: Sequence[str], id_col: str, trees: int, samples: int, features: int,
                largest: int, bootstrap: bool = False) -> DataFrame:
    """(group, tree, size, node, term, split, path).

    Growing takes one task per group, which gets trees x samples rows with only the
    tree's own features.
    """
    keys = list(group)
    draw = draw_with_replacement if bootstrap else draw_samples
    sampled = draw(vectors, keys, id_col, trees, samples, largest)
    sampled = sampled.join(vectors.select(*keys, id_col, "terms", "vals"), [*keys, id_col])
    row = F.map_from_arrays("terms", "vals")
    joined = (sampled.join(draw_features(vectors, keys, trees, features), [*keys, "tree"])
              .select(*keys, "tree", id_col, "names", row.alias("_m"))
              .select(*keys, "tree", id_col, "names",
                      F.transform("names", lambda n: F.coalesce(F.col("_m")[n], F.lit(0.0))).alias("x")))
    head = typed(joined, [*keys, "tree"])

    def grow(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, rows in pdf.groupby("tree"):
            columns = list(rows["names"].iloc[0])
            x = np.vstack(rows["x"])
            limit = math.ceil(math.log2(max(len(x), 2)))
            grown = [part[0] for part in _grow_trees(x[None], [(*key, tree)], limit)]
            for node in np.flatnonzero((grown[0] >= 0) | ~np.isnan(grown[2])).tolist():
                column, split, path = (part[node] for part in grown)
                out.append((*key, tree, len(x), node, columns[column] if column >= 0 else None, split,
                            0.0 if column >= 0 else path))
        return pd.DataFrame(out, columns=[*keys, "tree", "size", "node", "term", "split", "path"])

    return by_group(joined, keys).applyInPandas(
        grow, head + ", size int, node int, term string, split double, path double")


def _path_lengths(rows: pd.DataFrame, forest: pd.DataFrame) -> np.ndarray:
    """Mean path length of every row over the trees."""
    index = pd.Index(forest["term"].dropna().unique())
    tree = pd.factorize(forest["tree"], sort=True)[0]
    trees, last = int(tree.max()) + 1, 2 * int(forest["node"].max()) + 3  # room for children that are no nodes
    column, split, path = np.full((trees, last), -1), np.zeros((trees, last)), np.full((trees, last), np.nan)
    node = forest["node"].to_numpy()
    column[tree, node] = index.get_indexer(forest["term"])
    split[tree, node], path[tree, node] = forest["split"], forest["path"]
    return np.concatenate([_walk(matrix(part["terms"], part["vals"], index), column, split, path)[-1]
                           for part in row_pieces(rows, max(len(index), trees))])


def _walk(x: np.ndarray, column: np.ndarray, split: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Mean path length over the first tree, the first two, ... (trees x rows).

    A row counts in the trees where it ends in a leaf, so not where it passes beyond the values of all sampled rows.
    """
    trees, cases = np.arange(len(column))[:, None], np.arange(len(x))[None, :]
    at = np.zeros((len(column), len(x)), dtype=int)
    while True:
        here = column[trees, at]
        moving = here >= 0
        if not moving.any():
            break
        at = np.where(moving, 2 * at + 1 + (x[cases, here] > split[trees, at]), at)
    paths = path[trees, at]
    found = ~np.isnan(paths)
    return np.cumsum(np.where(found, paths, 0.0), axis=0) / np.maximum(np.cumsum(found, axis=0), 1)


def _by_hash(parts: Sequence, ids: Sequence) -> np.ndarray:
    """Places of the ids in the order of their md5, ties by id."""
    head = "|".join(str(p) for p in parts)
    hashed = sorted((hashlib.md5(f"{head}|{i}".encode()).hexdigest(), i, at) for at, i in enumerate(ids))
    return np.array([at for _, _, at in hashed], dtype=int)


def group_forest(key: tuple, rows: pd.DataFrame, id_col: str, settings: Sequence[tuple]) -> dict[tuple, np.ndarray]:
    """{(trees, samples, features, bootstrap): score of every row}, all rows of a small group at hand.

    Settings that differ in their number of trees share one forest. Rows and terms are drawn by the same hashes as in
    groups that no task holds, and each hash is taken once for all settings.
    """
    rows = rows.reset_index(drop=True)
    places = rows.loc[rows["is_fit"], id_col].sort_values(kind="stable").index.to_numpy()
    ids = rows[id_col].iloc[places].tolist()
    terms = sorted(set().union(*rows["terms"].iloc[places]))
    key = tuple(k for k in key if k is not None)
    uniforms = lru_cache(maxsize=None)(_uniform)
    row_order = lru_cache(maxsize=None)(lambda tree: _by_hash((*key, tree, "row"), ids))
    term_order = lru_cache(maxsize=None)(lambda tree: _by_hash((*key, tree, "term"), terms))
    index, scores = pd.Index(terms), {}
    whole = matrix(rows["terms"], rows["vals"], index) if len(rows) * len(terms) <= PIECE_CELLS else None

    def values(chosen: np.ndarray, names: np.ndarray) -> np.ndarray:
        if whole is not None:
            return whole[places[chosen][:, None], names]
        part = rows.iloc[places[chosen]]
        return matrix(part["terms"], part["vals"], index[names])

    # samples and terms beyond what the group has make the same forest
    drawn = {s: (min(s[1], len(ids)), min(s[2], len(terms)), s[3]) for s in settings}
    for draw in sorted(set(drawn.values())):
        size, wide, bootstrap = draw
        counts = {s[0] for s in settings if drawn[s] == draw}
        numbers = range(max(counts) if size else 0)
        grown = []
        step = max(1, PIECE_CELLS // max(size * wide, 1))
        for start in range(0, len(numbers), step):
            part, xs, named = numbers[start:start + step], [], []
            for tree in part:
                chosen = row_order(tree)[:size] if not bootstrap else np.array(
                    [math.floor(uniforms(*key, tree, "draw", i) * len(ids)) for i in range(size)], dtype=int)
                named.append(term_order(tree)[:wide])
                xs.append(values(chosen, named[-1]))
            column, split, path = _grow_trees(np.stack(xs), [(*key, t) for t in part], math.ceil(math.log2(max(size, 2))), uniforms)
            inner = column >= 0
            column[inner] = np.array(named)[np.nonzero(inner)[0], column[inner]]
            grown.append((column, split, path))
        norm = average_path(size) or 1.0
        if not grown:
            scores |= {(count, *draw): np.ones(len(rows)) for count in counts}
            continue
        column, split, path = (np.concatenate(parts) for parts in zip(*grown))
        if whole is None:
            used = np.unique(column[column >= 0])
            column[column >= 0] = np.searchsorted(used, column[column >= 0])
            means = [_walk(matrix(part["terms"], part["vals"], index[used]), column, split, path)
                     for part in row_pieces(rows, max(len(used), len(column)))]
        else:
            step = max(1, PIECE_CELLS // len(column))
            means = [_walk(whole[at:at + step], column, split, path) for at in range(0, len(rows), step)]
        mean = np.concatenate(means, axis=1)
        for count in counts:
            scores[count, *draw] = np.round(2.0 ** (-mean[count - 1] / norm), DIGITS)
    return {s: scores[s[0], *drawn[s]] for s in settings}


def forest_scores(vectors: DataFrame, forest: DataFrame, group: Sequence[str], id_col: str,
                  largest: int | None = None) -> DataFrame:
    """Anomaly score 2^(-mean path / average path) of every row, rounded to 9 digits."""
    keys = list(group)
    columns = [*keys, id_col, "is_fit", "is_scored", "score"]

    def score(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        norm = average_path(int(trees["size"].iloc[0])) or 1.0
        return rows.assign(score=np.round(2.0 ** (-_path_lengths(rows, trees) / norm), DIGITS))[columns]

    return apply_model(vectors, forest, keys, id_col, score, typed(vectors, columns[:-1]) + ", score double", largest)


def flag_above(scores: DataFrame, group: Sequence[str], id_col: str, contamination: float,
               largest: int | None = None) -> DataFrame:
    """Flag scored rows beyond the share ``contamination`` of the fitted rows' scores, highest first."""
    keys = list(group)
    fitted = scores.filter("is_fit").withColumn("_negative", -F.col("score"))
    limits = group_percentile(fitted, keys, "_negative", contamination, "_offset", largest=largest)
    rated = join_scalars(scores.filter("is_scored"), limits, keys, [id_col], largest=largest)
    return rated.select(*keys, id_col, "score", (-F.col("score") < F.col("_offset")).cast("int").alias("flag"))


def detect_iforest(vectors: DataFrame, group: Sequence[str] = ("entity",), id_col: str = "seg", trees: int = TREES,
                   samples: int = SAMPLES, features: int = FEATURES, contamination: float = CONTAMINATION,
                   bootstrap: bool = False, largest: int | None = None) -> DataFrame:
    """(group, id, score, flag).

    Trees of a group that a task takes are grown and walked where its rows are; only bigger groups ship samples.
    """
    keys = list(group)
    largest = largest_group(vectors, keys) if largest is None else largest
    columns = [*keys, id_col, "is_fit", "is_scored"]
    setting = (trees, samples, features, bootstrap)

    def whole(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        return rows[columns].assign(score=group_forest(key, rows, id_col, [setting])[setting])

    small, large = by_size(vectors, keys, blocks.SCORE_ROWS, largest)
    parts = []
    if small is not None:
        used = small.select(*columns, "terms", "vals")
        parts.append(by_group(used, keys).applyInPandas(whole, typed(vectors, columns) + ", score double"))
    if large is not None:
        forest = grow_forest(large, keys, id_col, trees, samples, features, largest, bootstrap)
        parts.append(forest_scores(large, forest, keys, id_col, largest))
    scores = cut(reduce(DataFrame.unionByName, parts), "forest_scores")
    return flag_above(scores, keys, id_col, contamination, largest)
