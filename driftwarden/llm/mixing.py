"""Mixing sources to target weights by hash thresholds.

Every document has a hash of its id and text. A source's budget of words becomes a threshold on that hash: sizes are summed by
source and hash bucket, the running sum finds the bucket in which the budget ends, and only that bucket is divided
again, until the threshold separates two documents. Filtering by threshold then needs no sort, and a larger budget
always takes a superset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import WHITESPACE_WORD, source_key
from driftwarden.operators.ranking import with_position
from driftwarden.runtime import cut

HASH_BITS = 60
LEVEL_BITS = 12


def doc_hash(seed: str):
    """The first 60 bits of an md5 of id and text: rows without an id, or with the same one, still differ by their text."""
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, _source, size (words; null: 0) and hash, written once."""
    size = F.coalesce(F.regexp_count("text", F.lit(WHITESPACE_WORD)), F.lit(0)).cast("long")
    return cut(docs.select("doc_id", "source", source_key(F.col("source")).alias("_source"), size.alias("size"),
                           doc_hash(seed).alias("hash")), "mix-sizes")


def source_targets(sizes: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """_source, source_size, target: ``share`` of all words by weight, none above ``most`` times its source.

    Sources are ordered by code point with null last, and take the weights in turn. What a full source can't take is
    shared again among the others by weight.
    """
    sources = sizes.groupBy("_source", F.col("source").isNull().alias("_missing")).agg(
        F.sum("size").alias("source_size"))
    placed = with_position(cut(sources, "mix-sources"), [], ["_missing", "_source"], "_place")
    first = placed.agg(F.min("_place").alias("m")).first()["m"] or 0
    table = F.array(*[F.lit(float(w)) for w in weights])
    placed = cut(placed.select(
        "_source", "source_size", (F.col("source_size") * most).alias("_limit"),
        F.element_at(table, ((F.col("_place") - first) % len(weights) + 1).cast("int")).alias("_weight")), "mix-weights")
    total = placed.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level = -1.0  # words per unit of weight; sources whose limit it passes are full
    while True:
        full = F.col("_limit") <= F.col("_weight") * level
        row = placed.agg(F.sum(F.when(full, F.col("_limit"))).alias("taken"),
                         F.sum(F.when(~full, F.col("_weight"))).alias("open")).first()
        if not row["open"]:
            level = float("inf")
            break
        raised = (share * total - (row["taken"] or 0.0)) / row["open"]
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("_limit"), F.col("_weight") * level) if level != float("inf") else F.col("_limit")
    return placed.select("_source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """_source, threshold: documents with hash below it hold as near ``budget`` words as whole documents allow.

    Each round divides the boundary bucket of every source into 2**LEVEL_BITS parts.
    """
    state = budgets.select("_source", F.col("budget").alias("_left"), F.lit(0).cast("long").alias("_low"))
    done = None
    shift = HASH_BITS
    while True:
        shift -= LEVEL_BITS
        inside = sizes.join(state, "_source").where(
            F.shiftright("hash", shift + LEVEL_BITS) == F.shiftright("_low", shift + LEVEL_BITS))
        bucket = F.shiftright("hash", shift)
        sums = inside.groupBy("_source", bucket.alias("_bucket")).agg(
            F.sum("size").alias("_size"), F.first("_left").alias("_left"),
            F.min("hash").alias("_least"), F.max("hash").alias("_most"))
        running = Window.partitionBy("_source").orderBy("_bucket")
        sums = sums.withColumn("_upto", F.sum("_size").over(running))
        over = sums.where(F.col("_upto") > F.col("_left")).groupBy("_source").agg(
            F.min_by(F.struct("_bucket", "_size", "_upto", "_left", "_least", "_most"), "_bucket").alias("b"))
        ends = cut(state.join(over, "_source", "left").select(
            "_source", F.col("_left").alias("_all"), "b.*"), "mix-boundary")
        # a source without a boundary takes all that is left of its range
        whole = ends.where(F.col("_bucket").isNull()).select(
            "_source", F.lit(2 ** HASH_BITS).alias("threshold"))
        before = F.col("_left") - (F.col("_upto") - F.col("_size"))
        single = ends.where(F.col("_bucket").isNotNull() & (F.col("_least") == F.col("_most"))).select(
            "_source", (F.col("_least") + F.when(F.col("_size") - before < before, 1).otherwise(0)).alias("threshold"))
        found = whole.unionByName(single)
        done = found if done is None else done.unionByName(found)
        state = ends.where(F.col("_bucket").isNotNull() & (F.col("_least") < F.col("_most"))).select(
            "_source", before.alias("_left"), F.shiftleft("_bucket", shift).alias("_low"))
        if shift == 0 or state.isEmpty():
            return done


def mix_plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """_source, source_size, target, _whole (times every document is taken), threshold (below it, once more)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = cut(targets.withColumn("_whole", whole), "mix-targets")
    limits = thresholds(sizes, targets.select(
        "_source", (F.col("target") - F.col("_whole") * F.col("source_size")).alias("budget")))
    return targets.join(limits, "_source", "left")


def copies():
    """Times the mix takes a document, once its source's plan is joined."""
    extra = F.when((F.col("_whole") < 2) & (F.col("hash") < F.col("threshold")), 1).otherwise(0)
    return (F.col("_whole") + extra).cast("int")


def mix_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies.

    Null or blank texts have size 0 and take nothing; a null source is a source of its own; rows with null or
    equal ids are told apart by their text, and only rows equal in both are taken or left together. An empty table gives
    no rows.
    """
    sizes = sized(docs, seed)
    plan = mix_plan(sizes, source_targets(sizes))
    return sizes.join(plan, "_source").withColumn("copies", copies()).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def apply_mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; the texts stay where they are read."""
    sizes = sized(docs, seed)
    plan = cut(mix_plan(sizes, source_targets(sizes)).select("_source", "_whole", "threshold"), "mix-plan")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                        source_key(F.col("source")).alias("_source"), doc_hash(seed).alias("hash"))
    taken = keyed.join(plan, "_source").select("row", copies().alias("times")).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")).select("row.*")
