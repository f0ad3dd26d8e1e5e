"""N-gram Jaccard join: rare-first prefix filter with length, positional and suffix filters.

A document's set of word shingles is ordered rare-first: by the frequency of a shingle's hash class, counted over all
documents in a table of fixed size, then by its hash. Two sets of similarity t or more share a shingle in
their first ``n - ceil(t n) + 1``. These prefixes meet by shingle. Equal sets are one node throughout, under a 128-bit
key, so exact copies cost nothing.

Only components are asked for, so a list of sets that share a shingle is first linked along chains, an edge or two per
set, then among the nearest few in a fixed order; pairs that still lie in different components after that are then
formed, filtered and verified, all of them. Texts are read and moved only for pairs that pass every filter.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import by_bytes, mix64, pack, partitions, ranges, unpack
from driftwarden.llm.components import connected, joined
from driftwarden.runtime import cut

SKETCH_BITS, SKETCH_SLICES = 20, 16
SIGNATURE_WORDS = 8
BATCH_BYTES = 1_000_000
#: Bytes of text whose prefix shingles share a bucket, on average.
BUCKET_BYTES = 8_000_000
#: Postings that a task deals to the buckets together.
DEALT_POSTINGS = 250_000
_PRIMES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_INVERSE = pow(_PRIMES[3], -1, 1 << 64)


def _is_space() -> np.ndarray:
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return space


def _byte_values() -> np.ndarray:
    """A 64-bit number per byte, the same for A-Z as for a-z."""
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_PRIMES[0]))
    values[65:91] = values[97:123]
    return values


@functools.cache
def _powers(base: int) -> tuple[np.ndarray, np.uint64]:
    """The first 4096 powers of an odd number modulo 2^64, and the next one."""
    powers = np.cumprod(np.r_[np.uint64(1), np.full(4096, np.uint64(base))])
    return powers[:-1], powers[-1]


def _power(base: int, at: np.ndarray) -> np.ndarray:
    """base^at modulo 2^64, from the powers of 4096 and the rest."""
    low, step = _powers(base)
    high = np.cumprod(np.r_[np.uint64(1), np.full(int(at.max(initial=0)) >> 12, step)])
    return high[at >> 12] * low[at & 4095]


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(words of each text, their hashes in order): lower-cased words between whitespace.

    A word's hash is a polynomial of its bytes, taken from running sums over all texts at once.
    """
    raw = [t.encode() if t else b"" for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])  # a space closes every text
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    inside = ~_is_space()[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    start, stop = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = _byte_values()[data]
        sums *= _power(_PRIMES[3], np.arange(len(data)))
        np.cumsum(sums, out=sums)
        before = np.where(start > 0, sums[start - 1], np.uint64(0))
        hashes = mix64((sums[stop - 1] - before) * _power(_INVERSE, start) + (stop - start).astype(np.uint64))
    return np.diff(np.searchsorted(start, ends), prepend=0), hashes


def shingle_sets(texts: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, hashes): each text's distinct shingle hashes, ascending, one text after the other."""
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lengths, word = word_hashes(texts)
    if not len(word):
        return np.zeros(len(texts), np.int64), np.zeros(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    counts = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    at = ranges(starts, counts)
    left = np.repeat(starts + lengths, counts) - at  # words from here to the text's end
    with np.errstate(over="ignore"):
        total = np.zeros(len(at), np.uint64)
        for i in range(width):
            multiplier = _PRIMES[i % 4] + 2 * i & 0xFFFFFFFFFFFFFFFF | 1
            part = mix64(word + np.uint64(i + 1)) * np.uint64(multiplier)
            total += np.where(left > i, part[np.minimum(at + i, len(word) - 1)], np.uint64(0))
    hashes = mix64(total)
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        hashes[a:b].sort()
    doc = np.repeat(np.arange(len(texts)), counts)
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return np.bincount(doc[first], minlength=len(texts)).astype(np.int64), hashes[first]


def set_keys(sizes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of every set."""
    out = []
    with np.errstate(over="ignore"):
        for salt in (np.uint64(0x51ED270B), np.uint64(0xA24BAED4963EE407)):
            each = np.concatenate(([np.uint64(0)], np.cumsum(mix64(hashes ^ salt), dtype=np.uint64)))
            ends = np.cumsum(sizes)
            out.append(mix64((each[ends] - each[ends - sizes]) ^ sizes.astype(np.uint64) ^ salt))
    return out[0], out[1]


def _batches(frames, column="text"):
    """Pieces of the incoming frames whose texts stay below a bound."""
    for frame in frames:
        for a, b in by_bytes([len(t) if t else 0 for t in frame[column]], BATCH_BYTES):
            yield frame.iloc[a:b]


def nodes_of(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, node (a string, the set's key; null for an empty set), sig, and the counts of hash classes.

    The counts, rows with a ``slice``, come from the same shingles, so texts are gone through once for both.
    """

    def keys(frames):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for frame in _batches(frames):
            sizes, hashes = shingle_sets(list(frame["text"]), width)
            total += _class_counts(hashes)
            a, b = set_keys(sizes, hashes)
            node = [f"{x:016x}{y:016x}" if n else None for x, y, n in zip(a.tolist(), b.tolist(), sizes.tolist())]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "text_key": frame["text_key"], "n_shingles": sizes,
                                "node": pd.Series(node, frame.index, dtype=object),
                                "sig": pd.Series(list(signatures(sizes, hashes)), frame.index, dtype=object),
                                "slice": pd.array([None] * len(frame), "Int32"),
                                "counts": pd.Series([None] * len(frame), frame.index, dtype=object)})
        parts = _slices(total)
        nothing = pd.Series([None] * len(parts), dtype=object)
        yield parts.assign(doc_id=nothing, text_key=0, n_shingles=0, node=nothing, sig=nothing)[
            ["doc_id", "text_key", "n_shingles", "node", "sig", "slice", "counts"]]

    # ids as text: a null among them would turn the others into floating point
    named = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    return named.mapInPandas(
        keys, "doc_id string, text_key long, n_shingles long, node string, sig array<bigint>, slice int, "
        "counts binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def _class_counts(hashes: np.ndarray) -> np.ndarray:
    return np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)


def _slices(total: np.ndarray) -> pd.DataFrame:
    parts = total.reshape(SKETCH_SLICES, -1)
    return pd.DataFrame({"slice": pd.array(range(SKETCH_SLICES), "Int32"), "counts": [pack(p) for p in parts]})


def add_sketches(rows: DataFrame) -> np.ndarray:
    """Frequency of every hash class of shingles (65535 at most), from the counts (slice, counts) of all tasks."""
    def add(key, frame):
        return pd.DataFrame({"slice": [key[0]], "counts": [pack(sum(unpack(c, np.int64) for c in frame["counts"]))]})

    total = np.zeros((SKETCH_SLICES, (1 << SKETCH_BITS) // SKETCH_SLICES), np.int64)
    for row in rows.select("slice", "counts").groupBy("slice").applyInPandas(add, "slice int, counts binary").collect():
        total[row["slice"]] = unpack(row["counts"], np.int64)  # a table of fixed size
    return np.minimum(total.reshape(-1), 65535).astype(np.uint16)


def prefix_postings(docs: DataFrame, width: int, percent: int, buckets: int,
                    frequency: np.ndarray | None = None) -> DataFrame:
    """(bucket, payload): prefix shingles with node key, set size and place, distinct within a batch of texts.

    ``frequency`` has a number per hash class, counted here if not given; rarer classes come first.
    """
    if frequency is None:
        counted = nodes_of(docs.withColumn("text_key", F.xxhash64("text")), width).where("slice is not null")
        frequency = add_sketches(counted)
    classes = docs.sparkSession.sparkContext.broadcast(frequency)

    def deal(held):
        hashes, a, b, n, place = (np.concatenate(x) for x in zip(*held))
        bucket = (mix64(hashes) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        out = []
        for k in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[k]:cuts[k + 1]]
            out.append((int(k), pack(hashes[at]), pack(a[at]), pack(b[at]), pack(n[at]), pack(place[at])))
        return pd.DataFrame(out, columns=["bucket", "gram", "a", "b", "n", "place"])

    def postings(frames):
        frequency, held = classes.value, []
        for frame in _batches(frames):
            sizes, hashes = shingle_sets(list(frame["text"]), width)
            a, b = set_keys(sizes, hashes)
            _, once = np.unique(a, return_index=True)  # equal sets of a batch once
            keep = np.zeros(len(sizes), bool)
            keep[once] = True
            keep &= sizes > 0
            doc = np.repeat(np.arange(len(sizes)), sizes)
            hashes, doc = hashes[keep[doc]], doc[keep[doc]]
            if not len(doc):
                continue
            rare = frequency[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            order = np.lexsort((hashes, rare, doc))
            hashes, doc = hashes[order], doc[order]
            kept = sizes[keep]
            place = ranges(np.zeros(len(kept), np.int64), kept)
            n = sizes[doc]
            first = place < n - -(-n * percent // 100) + 1
            doc = doc[first]
            held.append((hashes[first], a[doc], b[doc], n[first].astype(np.int32), place[first].astype(np.int32)))
            if sum(len(x[0]) for x in held) >= DEALT_POSTINGS:
                yield deal(held)
                held = []
        if held:
            yield deal(held)

    return docs.select("text").mapInPandas(
        postings, "bucket int, gram binary, a binary, b binary, n binary, place binary")


def _gather(frame: pd.DataFrame):
    """The distinct postings of a bucket, by gram; only grams of two sets or more."""
    cols = [np.concatenate([unpack(x, t) for x in frame[c]]) for c, t in (
        ("gram", np.uint64), ("a", np.uint64), ("b", np.uint64), ("n", np.int32), ("place", np.int32))]
    order = np.lexsort((cols[2], cols[1], cols[0]))
    cols = [c[order] for c in cols]
    new = np.ones(len(order), bool)
    new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
    cols = [c[new] for c in cols]
    _, inverse, counts = np.unique(cols[0], return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    return [c[shared] for c in cols]


def shared_postings(postings: DataFrame) -> DataFrame:
    """gram, node, n, place of the prefix shingles that two different sets share."""

    def merge(frame):
        gram, a, b, n, place = _gather(frame)
        node = pd.Series([f"{x:016x}{y:016x}" for x, y in zip(a.tolist(), b.tolist())], dtype=object)
        return pd.DataFrame({"gram": gram.view(np.int64), "node": node, "n": n, "place": place})

    return postings.groupBy("bucket").applyInPandas(merge, "gram long, node string, n int, place int")


def chains(shared: DataFrame, orders: int = 1, salts: int = 64) -> DataFrame:
    """a, b: neighbours within each list of sets that share a shingle, under a few fixed orders of the sets.

    A list is cut into ``salts`` runs by the order itself, so no task holds a whole long list; the runs' first
    members are chained in turn.
    """
    out = None
    for k in range(orders):
        key = F.xxhash64(F.lit(k), F.col("node"))
        run = F.pmod(F.shiftright(key, 58), F.lit(salts))
        rows = shared.select("gram", "node", key.alias("_k"), run.alias("_run"))
        inner = Window.partitionBy("gram", "_run").orderBy("_k", "node")
        linked = rows.withColumn("b", F.lead("node").over(inner)).select(F.col("node").alias("a"), "b")
        heads = rows.groupBy("gram", "_run").agg(F.min_by("node", F.struct("_k", "node")).alias("node"))
        across = heads.withColumn("b", F.lead("node").over(Window.partitionBy("gram").orderBy("_run"))).select(
            F.col("node").alias("a"), "b")
        both = linked.unionByName(across).where("b is not null")
        out = both if out is None else out.unionByName(both)
    edges = out.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    edges = cut(edges, "jaccard-edges")
    # each set keeps the neighbour it has in most lists; what that leaves unlinked is found among the cross pairs
    left = edges.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b"))
    right = edges.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
    return left.select("a", "b").unionByName(right.select("a", "b")).distinct()


def signatures(sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A row of SIGNATURE_WORDS 64-bit numbers per set: bit k says whether an odd number of its hashes fall in class k.

    Two signatures differ in no more bits than the sets differ in members.
    """
    bits = 64 * SIGNATURE_WORDS
    doc = np.repeat(np.arange(len(sizes)), sizes)
    kind = (mix64(hashes) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(doc * bits + kind, minlength=len(sizes) * bits).reshape(-1, bits) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _need(percent: int):
    """Overlap of a link between x and y."""
    return F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent) - 1e-9)


def _alike(percent: int):
    """Length and suffix filter of x and y: false only where their sets can't be similar enough."""
    near = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    apart = sum((F.bit_count(F.get("x.sig", F.lit(i)).bitwiseXOR(F.get("y.sig", F.lit(i))))
                 for i in range(SIGNATURE_WORDS)), F.lit(0))
    return near & (apart <= F.col("x.n") + F.col("y.n") - 2 * _need(percent))


def _possible(percent: int):
    """Length, positional and suffix filter of x and y: false only where their sets can't be similar enough."""
    rest = 1 + F.least("x.place", "y.place") + F.least(F.expr("x.n - x.place - 1"), F.expr("y.n - y.place - 1"))
    return _alike(percent) & (rest >= _need(percent))


def alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass length and suffix filter, by sizes and signatures of ``sets`` (node, n, sig)."""
    x = sets.select(F.col("node").alias("a"), F.struct("n", "sig").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.struct("n", "sig").alias("y"))
    return pairs.join(x, "a").join(y, "b").where(_alike(percent)).select("a", "b")


def near_neighbours(shared: DataFrame, percent: int, reach: int = 8, run: int = 1024) -> DataFrame:
    """a, b: for each set its ``reach`` partners that stand near it in most lists, in one fixed order of the sets.

    Only sets of different components that pass length, positional and suffix filter. These are pairs to try first:
    whatever they leave unlinked is still found among the cross pairs. Lists longer than ``run`` are cut by hash.
    """
    spread = shared.groupBy("gram").agg(F.count(F.lit(1)).alias("of"), F.min("component").alias("lo"),
                                        F.max("component").alias("hi")).where("lo <> hi").select("gram", "of")
    runs = F.ceil(F.col("of") / run)
    rows = shared.join(spread, "gram").withColumn("_run", F.pmod(F.xxhash64(F.lit(-2), "node"), runs))
    order = Window.partitionBy("gram", "_run").orderBy(F.xxhash64(F.lit(-1), "node"), "node")
    me = F.struct("node", "component", "n", "place", "sig")
    met = rows.select(me.alias("x"), F.collect_list(me).over(order.rowsBetween(1, reach)).alias("ys"))
    met = met.select("x", F.explode("ys").alias("y"))
    pairs = met.where((F.col("x.component") != F.col("y.component")) & _possible(percent)).groupBy(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).agg(
        F.count(F.lit(1)).alias("lists"))
    best = Window.partitionBy("a").orderBy(F.desc("lists"), "b")
    return pairs.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= reach).select("a", "b")


def cross_pairs(shared: DataFrame, percent: int, block: int = 512) -> DataFrame:
    """a, b: the pairs of every list that lie in different components and pass length, positional and suffix filter.

    Lists of up to ``block`` sets are joined with themselves. A longer one is dealt in blocks of sets; every pair of
    blocks meets once, so it is spread over many tasks. Without a column ``sig`` the suffix filter lets all pairs pass.
    """
    if "sig" not in shared.columns:
        shared = shared.withColumn("sig", F.array_repeat(F.lit(0).cast("long"), SIGNATURE_WORDS))
    spread = shared.groupBy("gram").agg(F.count(F.lit(1)).alias("of"), F.min("component").alias("lo"),
                                        F.max("component").alias("hi")).where("lo <> hi").select("gram", "of")
    rows = cut(shared.join(spread, "gram"), "jaccard-lists")
    short = rows.where(F.col("of") <= block).select("gram", "node", "component", "n", "place", "sig")
    x, y = short.alias("x"), short.alias("y")
    joined = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.node") < F.col("y.node"))
                    & (F.col("x.component") != F.col("y.component")) & _possible(percent))
    joined = joined.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    rows = rows.where(F.col("of") > block)
    blocks = F.greatest(F.ceil(F.col("of") / block), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.withColumn("_of", blocks).withColumn("_mine", mine)
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    rows = rows.select("gram", F.least("_mine", "_other").alias("i"), F.greatest("_mine", "_other").alias("j"),
                       "_mine", "node", "component", "n", "place", "sig")

    def meet(key, frame):
        _, i, j = key
        left, right = frame[frame["_mine"] == i], frame[frame["_mine"] == j]
        ln, rn = left["n"].to_numpy()[:, None].astype(np.int64), right["n"].to_numpy()[None, :].astype(np.int64)
        lp, rp = left["place"].to_numpy()[:, None], right["place"].to_numpy()[None, :]
        need = -(-percent * (ln + rn) // (100 + percent))  # overlap of a link
        rest = 1 + np.minimum(lp, rp) + np.minimum(ln - lp - 1, rn - rp - 1)
        ok = (np.minimum(ln, rn) * 100 >= percent * np.maximum(ln, rn)) & (rest >= need)
        ok &= left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :]
        ok &= left["node"].to_numpy()[:, None] < right["node"].to_numpy()[None, :] if i == j else True
        x, y = np.nonzero(ok)
        if len(x):
            ls, rs = np.stack(left["sig"].to_list()), np.stack(right["sig"].to_list())
            apart = sum(np.bitwise_count((ls[x, k] ^ rs[y, k]).view(np.uint64)).astype(np.int64)
                        for k in range(ls.shape[1]))
            fits = apart <= (ln + rn - 2 * need)[x, y]
            x, y = x[fits], y[fits]
        a, b = left["node"].to_numpy()[x], right["node"].to_numpy()[y]
        low = a < b
        return pd.DataFrame({"a": np.where(low, a, b), "b": np.where(low, b, a)})

    return joined.unionByName(rows.groupBy("gram", "i", "j").applyInPandas(meet, "a string, b string")).distinct()


def verify(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The stored pairs whose sets' similarity reaches ``percent``, by their whole intersection.

    Compressed texts travel, being a third of their sets' size, and only those of sets in a pair.
    """
    met = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    texts = cut(texts_of(docs, sets.join(met.distinct(), "node", "left_semi"), width), "jaccard-texts")
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("ta")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("packed").alias("tb")), "b")

    def check(frames):
        unzip = zstandard.ZstdDecompressor().decompress
        for frame in frames:
            for i, j in by_bytes([len(x) + len(y) for x, y in zip(frame["ta"], frame["tb"])], BATCH_BYTES // 4):
                part = frame.iloc[i:j]
                known = {n: unzip(t).decode() for c, d in (("a", "ta"), ("b", "tb")) for n, t in zip(part[c], part[d])}
                sizes, hashes = shingle_sets(list(known.values()), width)
                ends = np.cumsum(sizes)
                sets = {n: hashes[e - k:e] for n, e, k in zip(known, ends, sizes)}
                keep = [_similar(sets[x], sets[y], percent) for x, y in zip(part["a"], part["b"])]
                yield part.loc[keep, ["a", "b"]]

    return both.select("a", "b", "ta", "tb").mapInPandas(check, "a string, b string")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    need = -(-percent * (len(x) + len(y)) // (100 + percent))
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)) or _bound(x, y) < need:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= need


def _bound(x: np.ndarray, y: np.ndarray, parts: int = 8) -> int:
    """Most shingles that two sorted sets can share, from how many each has in every part of the hash range."""
    edges = np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - parts.bit_length() + 1)
    cx = np.diff(np.searchsorted(x, edges), prepend=0, append=len(x))
    cy = np.diff(np.searchsorted(y, edges), prepend=0, append=len(y))
    return int(np.minimum(cx, cy).sum())


def texts_of(docs: DataFrame, wanted: DataFrame, width: int, most: int = 2_000_000) -> DataFrame:
    """node, packed (a compressed text) of the wanted (node, text_key): one text of each is read again.

    Up to ``most`` keys are broadcast; beyond, the texts are shuffled to them.
    """
    wanted = cut(wanted.select("text_key").distinct(), "jaccard-wanted")
    keys = F.broadcast(wanted) if wanted.count() <= most else wanted

    def build(frames):
        for frame in _batches(frames):
            sizes, hashes = shingle_sets(list(frame["text"]), width)
            a, b = set_keys(sizes, hashes)
            node = [f"{x:016x}{y:016x}" for x, y in zip(a.tolist(), b.tolist())]
            zip_up = zstandard.ZstdCompressor(level=3).compress
            yield pd.DataFrame({"node": node, "packed": [zip_up(t.encode()) for t in frame["text"]]})

    found = docs.select("text", F.xxhash64("text").alias("text_key")).join(keys, "text_key", "left_semi")
    return found.select("text").mapInPandas(build, "node string, packed binary").groupBy("node").agg(
        F.min("packed").alias("packed"))


def _id_key():
    """doc_id with a value of its own for null."""
    return F.coalesce("doc_id", F.lit(-2 ** 63).cast("long"))


def _placed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, _id, text_key, n_shingles, node, component (null for an empty set) of every row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    found = cut(nodes_of(docs.withColumn("text_key", F.xxhash64("text")), width), "jaccard-nodes")
    nodes = found.where("slice is null").drop("slice", "counts", "sig")
    frequency = add_sketches(found.where("slice is not null"))
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    postings = prefix_postings(docs, width, percent, max(4 * partitions(spark), -(-held // BUCKET_BYTES)), frequency)
    shared = cut(shared_postings(postings), "jaccard-shared")
    members = found.where("node is not null").join(shared.select("node").distinct(), "node", "left_semi")
    one = F.min_by(F.struct("text_key", F.col("n_shingles").alias("n"), "sig"), "text_key")
    sets = cut(members.groupBy("node").agg(one.alias("one")).select("node", "one.*"), "jaccard-sets")

    def labelled():
        known = shared.join(components, "node", "left").join(sets.select("node", "sig"), "node")
        return known.withColumn("component", F.coalesce("component", "node"))

    # pairs that fail length or suffix filter here fail it below, too
    tried = cut(alike(chains(shared), sets, percent), "jaccard-chains")
    components = cut(connected(cut(verify(tried, docs, sets, width, percent), "jaccard-links")), "jaccard-components")
    near = cut(near_neighbours(labelled(), percent).join(tried, ["a", "b"], "left_anti"), "jaccard-near")
    if not near.isEmpty():
        tried = tried.unionByName(near)
        components = joined(components, cut(verify(near, docs, sets, width, percent), "jaccard-links"))
    rest = cut(cross_pairs(labelled(), percent).join(tried, ["a", "b"], "left_anti"), "jaccard-rest")
    if not rest.isEmpty():
        more = cut(verify(rest, docs, sets, width, percent), "jaccard-links")
        if not more.isEmpty():
            components = joined(components, more)
    return nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node")).withColumn(
        "_id", _id_key())


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id.

    Two documents link when 100 * |intersection| >= percent * |union| of their word shingles. Texts with fewer words
    than ``width`` are one shingle; null texts and texts without words have an empty set, link with nothing and are
    their own component. Equal texts link. Repeated rows are judged by their texts, one by one; a null id never becomes
    a component unless all ids of it are null. An empty table gives no rows.
    """
    placed = _placed(docs, width, percent)
    smallest = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return placed.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each component: that of least id, and of rows alike in id and text one.

    Documents without words are components of their own and stay.
    """
    found = cut(_placed(docs, width, percent), "jaccard-components")
    first = found.groupBy(F.coalesce("component", F.concat(F.lit("-"), "_id", F.lit(":"), "text_key")).alias("c")).agg(
        F.min(F.struct("_id", "text_key")).alias("least"))
    kept = cut(first.select("least.*").distinct(), "jaccard-kept")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), _id_key().alias("_id"),
                        F.xxhash64("text").alias("text_key"))
    one = Window.partitionBy("_id", "text_key").orderBy("_id", "text_key")
    return keyed.join(kept, ["_id", "text_key"], "left_semi").withColumn("_copy", F.row_number().over(one)).where(
        "_copy = 1").select("row.*")
