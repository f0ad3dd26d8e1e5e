"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation learned on a bounded sample turns vectors into balanced binary codes. Two codes at most ``radius`` bits
apart agree up to ``reach`` bits in one of their substrings, so looking up every substring and its neighbours finds
all such pairs; they are then reranked with the original vectors. The first substring in which a pair meets counts it.

Equal vectors of a label are one node with a copy count. The lookup runs on codes alone; only nodes that met a
candidate in a bucket send their vector there. Links are counted where they are found and leave the task as one count
and one local component per node, never as pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.llm.components import connected
from driftwarden.runtime import cut

BITS = 64
RADIUS = 15
BLOCK = 4096
TILE = 1024


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 40, seed: int = 7) -> np.ndarray:
    """Projection: principal directions turned so that the signs lose as little as possible.

    The vectors are not centred: cosines are angles at the origin, and where near copies make up much of the sample
    their common direction would vanish, and with it what their codes share.
    """
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    _, _, directions = np.linalg.svd(x, full_matrices=False)
    base = directions[:bits].T
    rng = np.random.default_rng(seed)
    if base.shape[1] < bits:  # fewer directions than bits: the rest are seeded ones
        base = np.hstack([base, rng.standard_normal((x.shape[1], bits - base.shape[1])) / np.sqrt(x.shape[1])])
    v = x @ base
    turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        code = np.where(v @ turn >= 0, 1.0, -1.0)
        a, _, b = np.linalg.svd(code.T @ v)
        turn = b.T @ a.T
    return base @ turn


def codes_of(x: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """The signs of the rotated vectors as unsigned 64-bit numbers."""
    signs = x @ projection >= 0
    return np.packbits(signs, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def _usable(vector: Column) -> Column:
    """Has components, all finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def encode(nodes: DataFrame, sample_rows: int) -> DataFrame:
    """``nodes`` plus code (long). The model of each dimension comes from the ``sample_rows`` nodes of least key."""
    sample = nodes.orderBy("node").select("embedding").limit(sample_rows).toPandas()
    widths = sample["embedding"].map(len) if len(sample) else pd.Series(dtype=int)
    models = {}
    for d in widths.unique():
        x = np.array(sample["embedding"][widths == d].tolist(), dtype=float)
        models[int(d)] = learn_rotation(x)
    shared = nodes.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("long")
    def code(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), np.int64)
        widths = vectors.map(len).to_numpy()
        for d in np.unique(widths):
            model = shared.value.get(int(d))
            if model is None:  # a dimension outside the sample gets a seeded rotation
                rng = np.random.default_rng(int(d))
                model = rng.standard_normal((d, BITS))
            at = np.flatnonzero(widths == d)
            out[at] = codes_of(np.array(vectors.iloc[at].tolist(), dtype=float), model).view(np.int64)
        return pd.Series(out)

    return nodes.withColumn("code", code("embedding"))


def _entries(coded: DataFrame, length: int, reach: int) -> DataFrame:
    """group, table, sub, block, role, node, code: each node once in the bucket of every substring (role 0), and as a
    visitor (role 1) in the buckets within ``reach`` bits that come before its own."""
    tables, mask = BITS // length, (1 << length) - 1
    flips = [0] + [f for f in range(1, 1 << length) if bin(f).count("1") <= reach]
    rows = coded.withColumn("table", F.explode(F.array(*[F.lit(t) for t in range(tables)])))
    own = rows.withColumn("sub", F.expr(f"shiftrightunsigned(code, table * {length})").bitwiseAND(F.lit(mask)).cast("int"))
    counts = own.groupBy("group", "table", "sub").agg(F.count(F.lit(1)).alias("of")).withColumn(
        "blocks", F.ceil(F.col("of") / BLOCK).cast("int")).drop("of")
    counts = cut(counts, "bucket-sizes")
    visits = own.withColumn("home", F.col("sub")).withColumn("flip", F.explode(F.array(*[F.lit(f) for f in flips])))
    visits = visits.withColumn("sub", F.col("home").bitwiseXOR(F.col("flip"))).where("sub <= home").join(
        counts, ["group", "table", "sub"])
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = visits.withColumn("mine", F.when(F.col("flip") == 0, block)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("mine"), F.col("blocks") - 1))))
    role = F.when((F.col("flip") == 0) & (F.col("block") == F.col("mine")), 0).otherwise(1)
    return spread.select("group", "table", "sub", "block", role.alias("role"), "node", "code")


def _meetings(frame: pd.DataFrame, length: int, reach: int):
    """(rows, residents, visitors) per bucket: index pairs whose codes are near and that meet here first."""
    code = frame["code"].to_numpy().view(np.uint64)
    role = frame["role"].to_numpy()
    table = int(frame["table"].iloc[0])
    mask = np.uint64((1 << length) - 1)
    keys = frame["sub"].to_numpy().astype(np.int64) << 32 | frame["block"].to_numpy()
    order = np.lexsort((role, keys))
    bounds = np.concatenate(([0], np.flatnonzero(np.diff(keys[order])) + 1, [len(order)]))
    left, right = [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        rows = order[a:b]
        home = int((role[rows] == 0).sum())
        if not home or len(rows) < 2:
            continue
        for i in range(0, home, TILE):
            mine = rows[i:min(i + TILE, home)]
            for j in range(i, len(rows), TILE):
                other = rows[j:j + TILE]
                apart = code[mine][:, None] ^ code[other][None, :]
                near = np.bitwise_count(apart) <= RADIUS
                if j < home:
                    near &= np.arange(i, i + len(mine))[:, None] < np.arange(j, j + len(other))[None, :]
                x, y = np.nonzero(near)
                if not len(x):
                    continue
                apart, first = apart[x, y], np.ones(len(x), bool)
                for t in range(table):
                    first &= np.bitwise_count(apart >> np.uint64(t * length) & mask) > reach
                left.append(mine[x[first]])
                right.append(other[y[first]])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable, by minima over edges and pointer jumps."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, sample_rows: int = 4096,
                    length: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Only rows with equal, non-null labels and equal dimension are compared. Null or zero vectors and those with null
    or non-finite components link with nothing. Equal vectors link (cosine 1). Repeated rows are vectors of their
    own, with a shared id. ``length`` is the substring length (8 or 16 bits; by default 16 from a million vectors of
    a label on): the pairs found are the same, those within RADIUS bits. An empty table gives no rows.
    """
    rows = vectors.select("vec_id", "label", "embedding")
    usable = F.col("label").isNotNull() & _usable(F.col("embedding"))
    both = F.format_string("%016x%016x", F.xxhash64("label", "embedding"), F.xxhash64(F.lit(1), "embedding", "label"))
    rows = rows.withColumn("node", F.when(usable, both))
    members = cut(rows.select("vec_id", "node"), "vector-members")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"))
    nodes = nodes.withColumn("group", F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string")))
    nodes = cut(nodes, "vector-nodes")
    coded = cut(encode(nodes, sample_rows), "vector-codes")
    if length is None:
        largest = coded.groupBy("group").count().agg(F.max("count")).first()[0] or 0
        length = 8 if largest < 1_000_000 else 16
    reach = (RADIUS + 1) // (BITS // length) - 1
    entries = _entries(coded.select("group", "node", "code"), length, reach)
    parts = F.shiftright("sub", max(0, length - 4))
    keys = ["group", "table", "part"]

    def flag(frame):
        a, b = _meetings(frame, length, reach)
        at = np.unique(np.concatenate([a, b]))
        return frame.iloc[at]

    fields = "group string, table int, sub int, block int, role int, node string, code long, part int"
    met = cut(entries.withColumn("part", parts).groupBy(*keys, "block").applyInPandas(flag, fields), "vector-meetings")
    full = met.join(nodes.select("node", "embedding", "copies"), "node")

    def link(frame):
        a, b = _meetings(frame, length, reach)
        x = np.array(frame["embedding"].tolist(), dtype=float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        good = np.zeros(len(a), bool)
        for i in range(0, len(a), 65536):
            piece = slice(i, i + 65536)
            good[piece] = np.einsum("ij,ij->i", x[a[piece]], x[b[piece]]) >= threshold
        a, b = a[good], b[good]
        copies = frame["copies"].to_numpy()
        links = np.bincount(a, copies[b], len(frame)) + np.bincount(b, copies[a], len(frame))
        root = _local_components(len(frame), a, b)
        at = np.flatnonzero(links > 0)
        names = frame["node"].to_numpy()
        return pd.DataFrame({"node": names[at], "links": links[at].astype(np.int64), "root": names[root[at]]})

    found = cut(full.groupBy(*keys, "block").applyInPandas(link, "node string, links long, root string"), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected(found.select("node", "root"), "node", "root")
    known = nodes.select("node", "copies").join(links, "node", "left").join(components, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component"))
    placed = members.join(known, "node", "left")
    least = placed.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(least, "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
