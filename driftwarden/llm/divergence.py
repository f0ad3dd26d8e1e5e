"""Source divergence audit: terms of each source against other sources and against its whole language.

First pass: exact document counts of every term of a language, added up per task before they are shuffled; the frequent
ones are kept. They are dealt into shards of bounded size by hash, and each shard becomes a minimal perfect hash: levels
of bit tables in which a key owns the bit that no other key of its level wants, its slot being the bit's rank. The terms
stand in slot order beside the bits, so a stranger that meets a bit is told apart by its letters.

Second pass: as many shards as a bound on their bytes allows are broadcast, and tasks raise the slots of dense arrays, one
per group and shard. More shards mean more passes, not more memory. The arrays are added up in trees of bounded width,
and everything after that works on one shard of some sources at a time.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import by_bytes, mix64, pack, ranges, unpack
from driftwarden.operators.skew import fresh, join_scalars
from driftwarden.runtime import cut

#: Terms a shard holds on average, and sources that meet in a task.
SHARD_TERMS, TILE = 8_192, 32
#: Bytes of shards that are broadcast in one pass over the texts.
PASS_BYTES = 64_000_000
#: Terms counted, and bytes of slots filled, in a task before they are passed on.
HELD_TERMS, HELD_SLOT_BYTES = 200_000, 48_000_000
#: Arrays added up in one task.
FAN_IN = 64
BATCH_BYTES = 1_000_000
_SEED, _LEVELS, _ROOM = 42, 12, 2
_BLANK, _KEEP = 32, [*range(97, 123), *range(128, 256)]
#: Bytes to lower-case letters, bytes of other alphabets as they are, and blanks.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else _BLANK for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters A-Z, lower-cased, and of characters beyond ASCII."""
    return text.translate(LETTERS).split()


def _texts(docs: DataFrame) -> DataFrame:
    """lang, source (never null) and the bytes of text."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.col("text").cast("binary").alias("text"))


def _pieces(batches):
    """(lang, source, text) lists whose texts stay below a bound."""
    for batch in batches:
        lang, source, text = (batch.column(c) for c in ("lang", "source", "text"))
        for a, b in by_bytes(pc.binary_length(text).fill_null(0).to_pylist(), BATCH_BYTES):
            rows = [t or b"" for t in text.slice(a, b - a).to_pylist()]
            yield lang.slice(a, b - a).to_pylist(), source.slice(a, b - a).to_pylist(), rows


def frequent_terms(texts: DataFrame, least: int) -> DataFrame:
    """lang, term (bytes): the terms in at least ``least`` rows of the language, counted exactly."""
    def count(batches):
        held = defaultdict(Counter)
        for langs, _, rows in _pieces(batches):
            for lang, text in zip(langs, rows):
                held[lang].update(set(terms_of(text)))
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from _counted(held)
                held = defaultdict(Counter)
        yield from _counted(held)

    counted = texts.mapInArrow(count, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def _counted(held):
    for lang, terms in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), pa.array(list(terms), pa.binary()),
                                          pa.array(list(terms.values()), pa.int64())], ["lang", "term", "n"])


def _places(hashes: np.ndarray, level: int, bits) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(hashes + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)) % np.asarray(bits, np.uint64)).astype(np.int64)


def build_hash(terms: list[bytes]) -> dict:
    """A minimal perfect hash: bits of all levels, their sizes, and the terms in slot order.

    Keys that no level tells apart (two terms of one 64-bit hash) come last, in byte order, and are looked up by letters.
    """
    terms = sorted(terms)
    hashes = np.array([xxhash.xxh64_intdigest(t, _SEED) for t in terms], np.uint64)
    left, sizes, tables, order = np.arange(len(terms)), [], [], []
    for level in range(_LEVELS):
        size = max(_ROOM * len(left), 1) if len(left) else 0
        sizes.append(size)
        at = _places(hashes[left], level, max(size, 1))
        alone = np.bincount(at, minlength=size)[:size] == 1 if size else np.zeros(0, bool)
        tables.append(alone)
        mine = alone[at] if size else np.zeros(0, bool)
        order.extend(left[mine][np.argsort(at[mine])].tolist())
        left = left[~mine]
    order.extend(left.tolist())
    stored = [terms[i] for i in order]
    return {"n": len(terms), "rest": len(left), "sizes": sizes, "bits": np.packbits(np.concatenate(tables)).tobytes(),
            "lengths": [len(t) for t in stored], "letters": b"".join(stored)}


class PerfectHashes:
    """Shards of minimal perfect hashes side by side, looked up for many terms at once."""

    def __init__(self, shards: list[dict]):
        self.names = [(s["lang"], s["shard"]) for s in shards]
        self.of: dict[str, np.ndarray] = {}  # numbers of a language's shards, -1 where one is not here
        for i, s in enumerate(shards):
            self.of.setdefault(s["lang"], np.full(s["shards"], -1))[s["shard"]] = i
        self.n = np.array([s["n"] for s in shards], np.int64)
        self.sizes = np.array([s["sizes"] for s in shards], np.int64).reshape(-1, _LEVELS)
        bits = [np.unpackbits(np.frombuffer(s["bits"], np.uint8), count=sum(s["sizes"])) for s in shards]
        self.bits = np.concatenate([*bits, np.zeros(1, np.uint8)]).astype(bool)
        self.rank = np.cumsum(self.bits, dtype=np.int64) - self.bits  # bits before each
        first = np.cumsum([0, *self.sizes.sum(1)])[:-1]
        self.first = first
        self.level = first[:, None] + np.cumsum(self.sizes, axis=1) - self.sizes
        self.letters = np.frombuffer(b"".join(s["letters"] for s in shards), np.uint8)
        lengths = np.concatenate([np.zeros(0, np.int64), *[np.array(s["lengths"], np.int64) for s in shards]])
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.slot0 = np.cumsum(self.n) - self.n  # number of a shard's first slot among all stored terms
        self.rest = {}
        for i, s in enumerate(shards):
            for slot in range(s["n"] - s["rest"], s["n"]):
                at = self.starts[self.slot0[i] + slot]
                self.rest[i, self.letters[at:at + lengths[self.slot0[i] + slot]].tobytes()] = slot

    def look_up(self, lang: str, terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(shard's number, slot) of each term, -1 where it is not held; found terms are compared letter by letter."""
        here = self.of.get(lang)
        shard, slot = np.full(len(terms), -1), np.full(len(terms), -1)
        if here is None or not terms:
            return shard, slot
        hashes = np.array([xxhash.xxh64_intdigest(t, _SEED) for t in terms], np.uint64)
        shard = here[shard_of(hashes, len(here))]
        open_ = np.flatnonzero(shard >= 0)
        for level in range(_LEVELS):
            sizes = self.sizes[shard[open_], level]
            open_, sizes = open_[sizes > 0], sizes[sizes > 0]  # a level without bits is the end of its shard
            at = self.level[shard[open_], level] + _places(hashes[open_], level, sizes)
            hit = self.bits[at]
            slot[open_[hit]] = self.rank[at[hit]] - self.rank[self.first[shard[open_[hit]]]]
            open_ = open_[~hit]
        found = np.flatnonzero(slot >= 0)
        own = np.array([len(terms[i]) for i in found], np.int64)
        stored = self.slot0[shard[found]] + slot[found]
        same = self.lengths[stored] == own
        slot[found[~same]] = -1
        found, own, stored = found[same], own[same], stored[same]
        if len(found):
            letters = np.frombuffer(b"".join(terms[i] for i in found), np.uint8)
            equal = letters == self.letters[ranges(self.starts[stored], own)]
            slot[found[~np.logical_and.reduceat(equal, np.cumsum(own) - own)]] = -1
        if self.rest:
            for i in np.flatnonzero((slot < 0) & (shard >= 0)).tolist():
                slot[i] = self.rest.get((int(shard[i]), terms[i]), -1)
        return np.where(slot >= 0, shard, -1), slot


def shard_of(hashes: np.ndarray, count: int) -> np.ndarray:
    """As pmod(xxhash64(term), count) in Spark."""
    return np.mod(hashes.view(np.int64), count)


def perfect_hashes(terms: DataFrame) -> DataFrame:
    """lang, shards (of the language), shard, n, rest, sizes, bits, lengths, letters, bytes: one row per shard."""
    count = F.ceil(F.count(F.lit(1)) / SHARD_TERMS).cast("long").alias("shards")
    dealt = join_scalars(terms, terms.groupBy("lang").agg(count), ["lang"], ["term"])
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")))

    def build(key, frame):
        built = build_hash([bytes(t) for t in frame["term"]])
        row = {"lang": key[0], "shards": key[1], "shard": key[2], **built}
        return pd.DataFrame({k: [v] for k, v in row.items()}).assign(bytes=len(built["letters"]) + 12 * built["n"])

    return dealt.groupBy("lang", "shards", "shard").applyInPandas(
        build, "lang string, shards long, shard long, n long, rest long, sizes array<long>, bits binary, "
               "lengths array<int>, letters binary, bytes long")


def recount(spark: SparkSession, texts: DataFrame, shards: DataFrame) -> DataFrame:
    """lang, source, shard, counts (packed): the slots of every group and shard that it has terms of."""
    passes = -(-(shards.agg(F.sum("bytes")).first()[0] or 0) // PASS_BYTES)
    parts = []
    for i in range(passes):
        here = shards.where(F.pmod(F.xxhash64("lang", "shard"), F.lit(passes)) == i)
        rows = [r.asDict() for r in here.drop("bytes").collect()]  # about PASS_BYTES, shards being small against it
        held = spark.sparkContext.broadcast(rows)
        parts.append(cut(_slots(texts, held), "slots"))
        held.unpersist()
    if not parts:
        return spark.createDataFrame([], "lang string, source string, shard long, counts binary")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return add_up(found, ["lang", "source", "shard"])


def _slots(texts: DataFrame, held) -> DataFrame:
    def raise_slots(batches):
        hashes, part, slots, size = PerfectHashes(held.value), TaskContext.get().partitionId(), {}, 0
        for langs, sources, rows in _pieces(batches):
            counted = defaultdict(Counter)
            for lang, source, text in zip(langs, sources, rows):
                if lang in hashes.of:
                    counted[lang, source].update(terms_of(text))
            for (lang, source), terms in counted.items():
                shard, slot = hashes.look_up(lang, list(terms))
                times = np.fromiter(terms.values(), np.int64, len(terms))
                for s in np.unique(shard[shard >= 0]).tolist():
                    key = lang, source, s
                    if key not in slots:
                        slots[key] = np.zeros(hashes.n[s], np.int64)
                        size += slots[key].nbytes
                    mine = shard == s
                    np.add.at(slots[key], slot[mine], times[mine])
            if size > HELD_SLOT_BYTES:
                yield _filled(hashes, slots, part)
                slots, size = {}, 0
        yield _filled(hashes, slots, part)

    return texts.mapInArrow(raise_slots, "lang string, source string, shard long, part long, counts binary")


def _filled(hashes: PerfectHashes, slots: dict, part: int) -> pa.RecordBatch:
    columns = [[k[0] for k in slots], [k[1] for k in slots], [hashes.names[k[2]][1] for k in slots], [part] * len(slots),
               [pack(v) for v in slots.values()]]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      ["lang", "source", "shard", "part", "counts"])


def add_up(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The sum of the packed counts of each key over ``part``, in rounds; a task adds some ``FAN_IN`` arrays."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.select(*keys).schema)

    def add(key, frame):
        total = unpack(frame["counts"].iloc[0], np.int64).copy()
        for data in frame["counts"].iloc[1:]:
            total += unpack(data, np.int64)
        return pd.DataFrame({**{k: [v] for k, v in zip([*keys, "part"], key)}, "counts": [pack(total)]})

    while True:
        most = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return parts.select(*keys, "counts")
        spread = parts.withColumn("part", F.pmod("part", F.lit(-(-most // FAN_IN))))
        parts = cut(spread.groupBy(*keys, "part").applyInPandas(
            lambda k, f: add(k, f), schema + ", part long, counts binary"), "added")


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), by long division in three steps of three digits; exact up to 9e15."""
    rest, below, out = counts + 5, total + 5 * terms, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


def audit_sources(spark: SparkSession, docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the language's other sources, and the ``top`` terms that a
    source uses more than its language.

    A null text, language or source is the empty text. A source without kept terms has the smoothing alone; a language
    without kept terms has distances of 0. Repeated rows count each. Extra columns are ignored; an empty table gives an
    empty result. A pair of sources is a row of the result, so rows grow with the square of a language's sources; texts,
    terms and sources may be skewed at will.
    """
    texts = _texts(docs)
    shards = cut(perfect_hashes(cut(frequent_terms(texts, least), "frequent-terms")), "perfect-hashes")
    counts = cut(recount(spark, texts, shards), "counts")
    groups = cut(_groups(texts, counts, shards), "groups")
    dense = cut(_dense(groups, shards, counts), "dense")
    pairs = _ranked(_distances(groups, dense), "pair")
    terms = _ranked(_over_used(dense, shards, counts, top), "term").where(F.col("rank") <= top)
    return pairs.unionByName(terms)


def _groups(texts: DataFrame, counts: DataFrame, shards: DataFrame) -> DataFrame:
    """lang, source, tile, at (place in the tile), total (occurrences of kept terms), terms (kept in the language)."""
    add = F.udf(lambda c: int(unpack(c, np.int64).sum()), "long")
    totals = counts.groupBy("lang", "source").agg(F.sum(add("counts")).alias("total"))
    kept = shards.groupBy("lang").agg(F.sum("n").alias("terms"))
    found = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return found.select("lang", "source", F.floor(place / TILE).alias("tile"), (place % TILE).alias("at"),
                        F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))


def _dense(groups: DataFrame, shards: DataFrame, counts: DataFrame) -> DataFrame:
    """A row per group and shard of its language, with packed counts where it has any."""
    each = groups.join(shards.select("lang", "shard", "n"), "lang")
    return each.join(counts, ["lang", "source", "shard"], "left")


def _vector(counts, n: int) -> np.ndarray:
    return np.zeros(n, np.int64) if counts is None else unpack(counts, np.int64)


def _distances(groups: DataFrame, dense: DataFrame) -> DataFrame:
    """lang, source, item, value of every two sources of a language, tile against tile."""
    tiles = groups.select("lang", "tile").distinct()
    meetings = tiles.alias("a").join(tiles.alias("b"), "lang").where("a.tile <= b.tile").select(
        "lang", F.col("a.tile").alias("first"), F.col("b.tile").alias("second"))
    sides = [meetings.withColumn("tile", F.col("first")),
             meetings.where("first < second").withColumn("tile", F.col("second"))]
    rows = sides[0].unionByName(sides[1]).join(dense, ["lang", "tile"])

    def measure(key, frame):
        p = np.stack([shares(_vector(c, n), total, terms) for c, n, total, terms
                      in zip(frame["counts"], frame["n"], frame["total"], frame["terms"])])
        tile, source = frame["tile"].to_numpy(), frame["source"].to_numpy()
        out = [(i, j, int(np.abs(p[i] - p[j]).sum())) for i in np.flatnonzero(tile == key[1])
               for j in np.flatnonzero(tile == key[2]) if tile[i] < tile[j] or i < j]
        i, j, value = (list(c) for c in zip(*out)) if out else ([], [], [])
        return pd.DataFrame({"lang": key[0], "a": source[i], "b": source[j], "value": np.array(value, np.int64)},
                            columns=["lang", "a", "b", "value"])

    parts = rows.groupBy("lang", "first", "second", "shard").applyInPandas(
        measure, "lang string, a string, b string, value long")
    found = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    bare = groups.where("terms = 0").select("lang", "source")  # languages without kept terms
    empty = bare.withColumnRenamed("source", "a").join(bare.withColumnRenamed("source", "b"), "lang").where("a < b")
    found = found.unionByName(empty.select("lang", "a", "b", F.lit(0).cast("long").alias("value")))
    return found.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p"),
                        "value").select("lang", "p.source", "p.item", "value")


def _over_used(dense: DataFrame, shards: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value: of each group and shard the first ``top`` terms used more than in the language."""
    whole = add_up(counts.select("lang", "shard", F.xxhash64("source").alias("part"), "counts"), ["lang", "shard"])
    add = F.udf(lambda c: int(unpack(c, np.int64).sum()), "long")
    total = whole.groupBy("lang").agg(F.sum(add("counts")).alias("all"))
    language = whole.withColumnRenamed("counts", "whole").join(total, "lang").join(
        shards.select("lang", "shard", "lengths", "letters"), ["lang", "shard"])
    used = dense.where("counts is not null").drop("at")
    tiles = used.select("lang", "shard", "tile").distinct().join(language, ["lang", "shard"])

    def compare(key, frame, words):
        out = []
        if len(frame) and len(words):
            w, n, terms = words.iloc[0], int(frame["n"].iloc[0]), int(frame["terms"].iloc[0])
            q = shares(unpack(w["whole"], np.int64), int(w["all"]), terms)
            ends = np.cumsum(np.array(w["lengths"], np.int64))
            for source, data, total_ in zip(frame["source"], frame["counts"], frame["total"]):
                own = unpack(data, np.int64)
                value = shares(own, total_, terms) - q
                at = np.flatnonzero((own > 0) & (value > 0))
                if len(at) > top:  # all that are no smaller than the last of the first ones
                    at = at[value[at] >= np.partition(value[at], len(at) - top)[len(at) - top]]
                named = sorted((-int(value[i]), bytes(w["letters"][ends[i] - w["lengths"][i]:ends[i]])) for i in at)
                out += [(key[0], source, term.decode("utf-8", "replace"), -v) for v, term in named[:top]]
        return pd.DataFrame(out, columns=["lang", "source", "item", "value"])

    return used.groupBy("lang", "shard", "tile").cogroup(fresh(tiles).groupBy("lang", "shard", "tile")).applyInPandas(
        compare, "lang string, source string, item string, value long")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))
