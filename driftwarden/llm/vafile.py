"""Centroid clustering over a VA-file: few-bit cells per dimension stand in for the vectors.

A table holds each vector twice: as cells of ``bits`` per dimension with its squared length, and in full. For a round,
lookup tables give what a cell adds at least and at most to the squared distance to each centroid. Where one centroid's
interval lies below all others the vector's cluster is settled by its cells alone. Full vectors are fetched by key only
where intervals overlap, or where a settled cluster changed and its sums must follow. All numbers are integers, so sums,
centroids and ties are exact, whatever the partitioning.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.runtime import cut

#: Integers below this: a squared distance over 256 dimensions fits 64 bits.
MAX_VALUE = 2 ** 27
#: Width, in standard deviations, of the part of a dimension that is cut into equal cells.
SPREAD = 4.0
_STATE = pa.schema([("row", pa.int64()), ("cells", pa.binary()), ("norm", pa.int64()), ("cluster", pa.int32()),
                    ("was", pa.int32()), ("sums", pa.list_(pa.int64()))])
_STATE_TYPES = "row long, cells binary, norm long, cluster int, was int, sums array<long>"


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """row, vec_id, q: floor(scale * x) of the usable vectors, under a row number that stays."""
    x = F.col("embedding").cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < MAX_VALUE // scale))
    kept = vectors.select("vec_id", "embedding").where((F.size("embedding") == dims) & usable)
    q = F.transform(x, lambda v: F.floor(v * scale).cast("int"))
    return kept.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def cell_edges(table: DataFrame, dims: int, bits: int) -> np.ndarray:
    """(dims, 2^bits + 1): first value of every cell, and one past the last. End cells reach the least and largest value."""
    def measure(batches):
        for batch in batches:
            if batch.num_rows:
                q = _matrix(batch.column(0), dims)
                f = q.astype(float)
                rows = [q.min(0), q.max(0), f.sum(0), (f * f).sum(0), np.full(dims, len(q))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(dims), pa.int32())] + [pa.array(r.astype(float)) for r in rows],
                    ["dim", "least", "most", "total", "squares", "n"])

    parts = table.select("q").mapInArrow(measure, "dim int, least double, most double, total double, squares double, n double")
    stats = parts.groupBy("dim").agg(F.min("least"), F.max("most"), F.sum("total"), F.sum("squares"), F.sum("n"))
    edges = np.zeros((dims, (1 << bits) + 1), np.int64)
    for dim, least, most, total, squares, n in stats.collect():  # one row per dimension
        mean = total / n
        reach = SPREAD * np.sqrt(max(squares / n - mean * mean, 0.0))
        inner = np.linspace(max(mean - reach, least), min(mean + reach, most + 1), (1 << bits) + 1).astype(np.int64)
        edges[dim] = np.clip(inner, least, most + 1)
        edges[dim, 0], edges[dim, -1] = least, most + 1
    return edges


def pack_cells(q: np.ndarray, edges: np.ndarray, bits: int) -> list[bytes]:
    cells = np.stack([np.searchsorted(e[1:-1], q[:, d], side="right") for d, e in enumerate(edges)], 1).astype(np.uint8)
    planes = (cells[:, :, None] >> np.arange(bits, dtype=np.uint8)) & 1
    return [row.tobytes() for row in np.packbits(planes.reshape(len(q), -1), axis=1)]


def unpack_cells(rows: list[bytes], dims: int, bits: int) -> np.ndarray:
    data = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    planes = np.unpackbits(data, axis=1, count=dims * bits).reshape(len(rows), dims, bits)
    return (planes << np.arange(bits, dtype=np.uint8)).sum(2, dtype=np.uint8)


class Intervals:
    """Least and largest squared distance to each centroid, looked up by cell.

    |x - c|^2 = |x|^2 + |c|^2 - 2 x c with |x|^2 known, so a cell bounds only its own products.
    """

    def __init__(self, edges: np.ndarray, centroids: np.ndarray):
        ends = np.stack([edges[:, :-1], np.maximum(edges[:, 1:] - 1, edges[:, :-1])])  # (2, dims, cells)
        products = -2 * ends[:, :, :, None] * centroids.T[None, :, None, :]  # (2, dims, cells, k)
        self.least, self.most = products.min(0), products.max(0)
        self.squares = (centroids * centroids).sum(1)

    def candidates(self, cells: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Per vector and centroid: whether no other centroid is surely nearer."""
        low = norm[:, None] + self.squares
        high = low.copy()
        for d in range(cells.shape[1]):
            low += self.least[d][cells[:, d]]
            high += self.most[d][cells[:, d]]
        return low <= high.min(1)[:, None]


def _distances(q: np.ndarray, norm: np.ndarray, centroids: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Squared distances; those to centroids that the intervals rule out are left at the largest number."""
    exact = norm[:, None] + (centroids * centroids).sum(1) - 2 * (q @ centroids.T)
    return np.where(open_, exact, np.iinfo(np.int64).max)


def _state(row, cells, norm, cluster, was, sums=None) -> pa.RecordBatch:
    sums = [None] * len(row) if sums is None else sums
    columns = [row, cells, norm, cluster, was, sums]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _STATE.types)], schema=_STATE)


def _settled(state: DataFrame, edges: np.ndarray, centroids: np.ndarray, bits: int) -> DataFrame:
    """Every vector with the cluster that its cells give, -1 where intervals overlap; ``was`` is the cluster before."""
    dims = len(edges)

    def judge(batches):
        tables = Intervals(edges, centroids)
        for batch in batches:
            if batch.num_rows:
                cells, norm = batch.column("cells").to_pylist(), batch.column("norm").to_numpy()
                open_ = tables.candidates(unpack_cells(cells, dims, bits), norm)
                cluster = np.where(open_.sum(1) == 1, open_.argmax(1), -1)
                yield _state(batch.column("row").to_numpy(), cells, norm, cluster, batch.column("cluster").to_numpy())

    return state.select("row", "cells", "norm", "cluster").mapInArrow(judge, _STATE_TYPES)


def _fetched(rows: DataFrame, edges: np.ndarray, centroids: np.ndarray, bits: int) -> DataFrame:
    """``rows`` (row, cells, norm, was, q) with their exact cluster, and a row per task and cluster with what its sums
    gain or lose; the last sum counts vectors."""
    dims, k = len(edges), len(centroids)

    def judge(batches):
        tables, change = Intervals(edges, centroids), np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            q, norm = _matrix(batch.column("q"), dims), batch.column("norm").to_numpy()
            cells, was = batch.column("cells").to_pylist(), batch.column("was").to_numpy()
            cluster = _distances(q, norm, centroids, tables.candidates(unpack_cells(cells, dims, bits), norm)).argmin(1)
            counted = np.concatenate([q, np.ones((len(q), 1), np.int64)], 1)
            moved = cluster != was
            np.add.at(change, cluster[moved], counted[moved])
            left = moved & (was >= 0)
            np.subtract.at(change, was[left], counted[left])
            yield _state(batch.column("row").to_numpy(), cells, norm, cluster, was)
        used = np.flatnonzero(change.any(1))
        nothing = [None] * len(used)
        yield _state(nothing, nothing, nothing, used, nothing, change[used].tolist())

    return rows.select("row", "cells", "norm", "was", "q").mapInArrow(judge, _STATE_TYPES)


def _add_up(totals: list[list[int]], fetched: DataFrame) -> list[list[int]]:
    """Sums of every cluster after the changes; at most clusters x dimensions numbers reach the driver."""
    parts = fetched.where("row is null").select("cluster", F.posexplode("sums").alias("at", "value"))
    for r in parts.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        totals[r["cluster"]][r["at"]] += int(r["value"])
    return totals


def cluster_vectors(spark: SparkSession, vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64,
                    scale: int = 256, seed: int = 2, bits: int = 6) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector.

    The first centroids are the ``k`` vectors of least sha256 of ``seed:vec_id`` (equal ids in the order of their
    components; a null id counts as the word null), all of them if there are fewer. Vectors that are null, of another
    length, or hold null or non-finite components are left out; so are those with a component of 2^27 / ``scale`` or
    more, whose squared distances fit no long. Repeated rows are vectors of their own. An inertia beyond a long is null.
    Extra columns are ignored; an empty table gives an empty result. ``k`` x ``dims`` numbers are held by every task.
    """
    whole = cut(whole_vectors(vectors, dims, scale), "whole-vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = whole.orderBy(name, "q").limit(k).select("q").collect()
    centroids = np.array([r["q"] for r in first], np.int64).reshape(-1, dims)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    edges = cell_edges(whole, dims, bits)

    def approximate(batches):
        for batch in batches:
            q = _matrix(batch.column("q"), dims)
            cells = pa.array(pack_cells(q, edges, bits) if len(q) else [], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), cells,
                                              pa.array((q * q).sum(1), pa.int64()), batch.column("q")],
                                             ["row", "vec_id", "cells", "norm", "q"])

    file = cut(whole.mapInArrow(approximate, "row long, vec_id long, cells binary, norm long, q array<int>"), "va-file")
    totals = [[0] * (dims + 1) for _ in centroids]
    state = None
    for _ in range(rounds):
        if state is None:  # every vector enters a sum for the first time
            judged, rows = None, file.withColumn("was", F.lit(-1))
        else:
            judged = cut(_settled(state, edges, centroids, bits), "settled")
            rows = judged.where("cluster <> was").select("row", "cells", "norm", "was").join(file.select("row", "q"), "row")
        fetched = cut(_fetched(rows, edges, centroids, bits), "fetched")
        totals = _add_up(totals, fetched)
        state = fetched.where("row is not null")
        if judged is not None:
            state = judged.where("cluster = was").unionByName(state)
        new = np.array([[s // t[-1] for s in t[:-1]] if t[-1] else old for t, old in zip(totals, centroids.tolist())])
        if (new == centroids).all():
            break  # later rounds would repeat this one
        centroids = new
    found = cut(_last(file, edges, centroids, bits), "clusters")
    return _with_inertia(spark, found, centroids)


def _last(file: DataFrame, edges: np.ndarray, centroids: np.ndarray, bits: int) -> DataFrame:
    """vec_id, cluster, distance; the distance needs every full vector once, the intervals still rule out centroids."""
    dims = len(edges)

    def judge(batches):
        tables = Intervals(edges, centroids)
        for batch in batches:
            if batch.num_rows:
                norm = batch.column("norm").to_numpy()
                open_ = tables.candidates(unpack_cells(batch.column("cells").to_pylist(), dims, bits), norm)
                distance = _distances(_matrix(batch.column("q"), dims), norm, centroids, open_)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(distance.argmin(1), pa.int32()), pa.array(distance.min(1), pa.int64())],
                    ["vec_id", "cluster", "distance"])

    return file.select("vec_id", "cells", "norm", "q").mapInArrow(judge, "vec_id long, cluster int, distance long")


def _with_inertia(spark: SparkSession, found: DataFrame, centroids: np.ndarray) -> DataFrame:
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in sums}  # at most k rows
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, *[v if v < 2 ** 63 else None for v in (s, sum(inertia.values()))], names[c]) for c, s in inertia.items()]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
