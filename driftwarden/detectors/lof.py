"""Local outlier factor of new rows against the fitted rows of the same entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.operators.neighbours import DIGITS, nearest_fitted, with_vector_key
from driftwarden.operators.ranking import group_percentile
from driftwarden.operators.skew import attach, join_scalars, largest_group
from driftwarden.runtime import cut

NEIGHBOURS = 40
CONTAMINATION = 0.25
# Members of a vector that are not single fitted rows.
REST = -1
QUERY = -2


def neighbour_pairs(near: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(group, vkey, member, copies, kdist, pairs): the neighbours used for each member of a vector.

    A fitted row is not its own neighbour, so each row in a vector's head is a member
    of its own. All further copies share their neighbours (``REST``), and so do all
    scored rows with that vector (``QUERY``), which may have themselves as neighbour.
    """
    one = F.lit(1).cast("long")
    member = "array<struct<member:bigint,copies:bigint>>"
    rest = F.col("copies") - F.size("head")
    members = F.concat(
        F.transform("head", lambda h: F.struct(h.alias("member"), one.alias("copies"))),
        F.when(rest > 0, F.array(F.struct(F.lit(REST).cast("long").alias("member"), rest.alias("copies"))))
        .otherwise(F.array().cast(member)),
        F.when(F.col("scored"), F.array(F.struct(F.lit(QUERY).cast("long").alias("member"), one.alias("copies"))))
        .otherwise(F.array().cast(member)))
    wanted = F.greatest(F.least(F.lit(k), F.size("ids") - 1), F.lit(1))
    listed = near.select(*keys, "vkey", F.arrays_zip("dists", "ids").alias("_near"), wanted.alias("_k"),
                         F.explode(members).alias("_m"))
    others = F.filter("_near", lambda e: e["ids"] != F.col("_m.member"))
    rows = listed.select(*keys, "vkey", "_m.member", "_m.copies", F.slice(others, F.lit(1), F.col("_k")).alias("pairs"))
    return rows.withColumn("kdist", F.element_at("pairs.dists", -1))


def lof_factors(near: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(group, vkey, member, copies, factor) for fitted rows and scored vectors alike."""
    rows = neighbour_pairs(near, keys, k).filter(F.size("pairs") > 0)
    own = [*keys, "vkey", "member"]
    pairs = (rows.select(*own, "copies", F.explode("pairs").alias("_p"))
             .select(*own, "copies", F.col("_p.dists").alias("dist"), F.col("_p.ids").alias("id")))
    fitted = rows.filter(F.col("member") >= 0)
    reach = F.greatest("dist", "_kdist")
    kdist = fitted.select(*keys, F.col("member").alias("id"), F.col("kdist").alias("_kdist"))
    density = cut(pairs.join(kdist, [*keys, "id"]).groupBy(*own, "copies").agg(
        (F.lit(1.0) / (F.avg(reach) + F.lit(1e-10))).alias("_lrd"), F.collect_list("id").alias("_ids")), "density")
    around = density.filter(F.col("member") >= 0).select(*keys, F.col("member").alias("id"), F.col("_lrd").alias("_near"))
    spread = density.select(*own, "copies", "_lrd", F.explode("_ids").alias("id")).join(around, [*keys, "id"])
    return spread.groupBy(*own, "copies").agg(
        F.round(F.avg("_near") / F.first("_lrd"), DIGITS).alias("factor"))


def lof_neighbours(vectors: DataFrame, group: Sequence[str], id_col: str, k: int,
                   block_vectors: int | None = None, largest: int | None = None) -> DataFrame:
    """Neighbour lists that serve every number of neighbours up to ``k``."""
    near = nearest_fitted(with_vector_key(vectors), group, id_col, k + 1, block_vectors, largest=largest)
    return cut(near, "near")


def lof_limits(factors: DataFrame, keys: list[str], contamination: float, largest: int | None) -> DataFrame:
    """Threshold per group: the share ``contamination`` of the fitted rows lies above it."""
    negative = factors.filter(F.col("member") != QUERY).withColumn("_negative", -F.col("factor"))
    return group_percentile(negative, keys, "_negative", contamination, "_offset", weight="copies", largest=largest)


def detect_lof(vectors: DataFrame, group: Sequence[str] = ("entity",), id_col: str = "seg", k: int = NEIGHBOURS,
               contamination: float = CONTAMINATION, block_vectors: int | None = None,
               largest: int | None = None) -> DataFrame:
    """(group, id, score, flag): flagged when the factor exceeds the fitted rows' threshold."""
    keys = list(group)
    largest = largest_group(vectors, keys) if largest is None else largest
    factors = cut(lof_factors(lof_neighbours(vectors, keys, id_col, k, block_vectors, largest), keys, k), "factors")
    limits = lof_limits(factors, keys, contamination, largest)
    asked = factors.filter(F.col("member") == QUERY).select(*keys, "vkey", "factor")
    flagged = join_scalars(asked, limits, keys, ["vkey"], largest=largest).select(
        *keys, "vkey", F.col("factor").alias("score"), (-F.col("factor") < F.col("_offset")).cast("int").alias("flag"))
    scored = with_vector_key(vectors.filter("is_scored")).select(*keys, "vkey", id_col)
    return attach(scored, flagged, [*keys, "vkey"], id_col, largest).select(*keys, id_col, "score", "flag")
