"""Benchmark decontamination by a hash set of test n-grams.

The windows of all benchmark items form a hash set that is broadcast while its size allows. Every window of a document
is looked up in it by one 64-bit hash and verified by a second, independent one, so only hits leave the scan and no text
is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.runtime import cut

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what words, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, are divided by
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words; none for a null text."""
    return F.coalesce(F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAP), ""), F.array().cast("array<string>"))


def _key(hashes: list[Column]) -> Column:
    """(hash, check) of a window, told apart by its number of words."""
    return F.struct(F.xxhash64(F.lit(len(hashes)), *hashes).alias("hash"),
                    F.xxhash64(*reversed(hashes), F.lit(-len(hashes))).alias("check"))


def item_windows(benchmark: DataFrame, length: int) -> DataFrame:
    """item_id, n (words of the window), hash, check; an item shorter than ``length`` is one window."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("n", F.least(F.size("w"), F.lit(length)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    grams = items.select("item_id", "n", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.col("n")))).alias("g"))
    hashes = [F.xxhash64(F.get("g", F.lit(k))) for k in range(length)]
    key = F.coalesce(*[F.when(F.col("n") == n, _key(hashes[:n])) for n in range(1, length + 1)])
    return cut(grams.select("item_id", "n", key.alias("key")).select("item_id", "n", "key.*").distinct(), "benchmark-grams")


def _keys() -> list[Column]:
    """A document's id, with a value of its own for null, and the hash of its text."""
    return [F.coalesce("doc_id", F.lit(-2 ** 63).cast("long")).alias("_id"), F.xxhash64("text").alias("_text")]


def look_up(docs: DataFrame, grams: DataFrame, set_size: int) -> DataFrame:
    """The columns of ``docs`` but text, with n_words, n, start, hash, check: a row for each place where a window of
    the benchmark stands, and one with a null n for every document.

    The set is broadcast up to ``set_size`` windows; beyond, both sides are shuffled by hash.
    """
    others = [c for c in docs.columns if c != "text"]
    known = grams.select("hash", F.col("check").alias("known"), "n").distinct()
    sizes = sorted(r["n"] for r in grams.select("n").distinct().collect())  # at most as many as a window has words
    if known.count() <= set_size:
        known = F.broadcast(known)
    found = docs.select(*others, F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h"))

    def windows(n: int) -> Column:
        return F.transform("h", lambda x, i: F.when(i + n <= F.size("h"), _key([F.get("h", i + k) for k in range(n)])))

    own = F.array(F.lit(None).cast("struct<hash:bigint,check:bigint>"))  # the document's own row comes last
    found = found.select(*others, F.size("h").alias("n_words"), F.concat(*[windows(n) for n in sizes], own).alias("keys"))
    # outer, though never empty: else a test of the size is pushed down, with all of the array's making in it
    found = found.select(*others, "n_words", F.posexplode_outer("keys").alias("at", "key"))
    found = found.select(*others, "n_words", "at", "key.*")
    found = found.where(F.col("hash").isNotNull() | (F.col("at") == F.col("n_words") * len(sizes)))
    found = found.join(known, "hash", "left").where("check = known or hash is null")
    return found.select(*others, F.col("n_words").cast("long").alias("n_words"), "n",
                        F.when(F.col("n").isNotNull(), F.col("at") % F.col("n_words")).alias("start"), "hash", "check")


def _covered(spans: Column) -> Column:
    """Words covered by sorted [start, start + n) spans."""
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("upto"))
    return F.aggregate(
        F.array_sort(spans), zero,
        lambda acc, s: F.struct(
            (acc["total"] + F.greatest(F.lit(0).cast("bigint"), s["start"] + s["n"] - F.greatest(acc["upto"], s["start"].cast("bigint")))
             ).alias("total"),
            F.greatest(acc["upto"], (s["start"] + s["n"]).cast("bigint")).alias("upto")),
        lambda acc: acc["total"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10, set_size: int = 50_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans [(start, n)] in words.

    Null texts have no words and no hits. Items without words or with a null text give no window; equal items are
    separate ids. Repeated document rows are judged one by one. An empty benchmark or table is fine; extra columns
    are ignored.
    """
    grams = item_windows(benchmark, length)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    items = grams.groupBy("n", "hash", "check").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    hits = look_up(rows, grams, set_size).join(items, ["n", "hash", "check"], "left")
    out = hits.groupBy("row", "doc_id", "n_words").agg(
        F.collect_list(F.when(F.col("n").isNotNull(), F.struct("start", "n"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("ids"))
    out = out.withColumn("n_hit", _covered(F.col("spans")))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, length: int = 10, set_size: int = 50_000) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark; only their keys leave the scan."""
    grams = item_windows(benchmark, length)
    keys = docs.select("text", *_keys())
    bad = cut(look_up(keys, grams, set_size).where("n is not null").select("_id", "_text").distinct(), "contaminated")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *_keys())
    return rows.join(bad, ["_id", "_text"], "left_anti").select("row.*")
