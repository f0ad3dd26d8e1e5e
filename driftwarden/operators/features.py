"""Sparse term vectors in long form, and packed one row per segment or document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.functions.text import terms_of
from driftwarden.operators.ranking import with_position
from driftwarden.operators.skew import attach_frequent, is_bounded, join_scalars, pieces_for
from driftwarden.runtime import cut


def tokenize(docs: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """One row per term occurrence with its place in the document."""
    return docs.select(*keys, F.posexplode(terms_of(text)).alias("idx", "term"))


def term_counts(terms: DataFrame, keys: Sequence[str]) -> DataFrame:
    return terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_vocabulary(counts: DataFrame, group: Sequence[str], largest: int | None = None,
                   max_window_rows: int | None = None) -> DataFrame:
    """Distinct terms per group with their alphabetical index."""
    distinct = counts.select(*group, "term").distinct()
    if largest is None:
        distinct = cut(distinct, "terms")
    return with_position(distinct, group, ["term"], "term_id", largest, max_window_rows)


def _attach_terms(counts: DataFrame, table: DataFrame, group: Sequence[str], largest: int | None, n_rows: int) -> DataFrame:
    """Join a table by (group, term); the terms of one bounded group have few rows each, those of a whole corpus do not."""
    keys = [*group, "term"]
    if not group or not is_bounded(largest):
        return attach_frequent(counts, table, keys, n_rows)
    pieces = pieces_for(counts, n_rows)
    return counts.repartition(pieces, *keys).join(table.repartition(pieces, *keys), keys)


def known_terms(counts: DataFrame, vocabulary: DataFrame, group: Sequence[str], id_col: str,
                largest: int | None = None) -> DataFrame:
    """Counts of the terms in the vocabulary only, with their index."""
    return _attach_terms(counts, vocabulary, group, largest, counts.count())


def l2_normalise(weights: DataFrame, keys: Sequence[str], weight: str, out: str = "value") -> DataFrame:
    """Divide by the Euclidean norm of the row; a window never exceeds one document's terms."""
    norm = F.sqrt(F.sum(F.col(weight) * F.col(weight)).over(Window.partitionBy(*keys)))
    return weights.withColumn(out, F.col(weight) / norm)


def fit_idf(counts: DataFrame, docs: DataFrame, group: Sequence[str]) -> DataFrame:
    """Smoothed inverse document frequency ln((1 + n) / (1 + df)) + 1 per (group, term).

    ``docs`` lists every document, also those without a single term.
    """
    n_docs = docs.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    df = counts.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((F.lit(1.0) + F.col("_n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return join_scalars(df, n_docs, group, ["term"]).select(*group, "term", idf.alias("idf"))


def apply_idf(counts: DataFrame, idf: DataFrame, group: Sequence[str], id_col: str,
              largest: int | None = None) -> DataFrame:
    """Weight counts by a fitted table (terms it lacks are ignored) and normalise each row.

    ``largest`` bounds the documents per group, and so the rows per (group, term).
    """
    n_rows = counts.count()
    weighted = _attach_terms(counts, idf, group, largest, n_rows).withColumn("_w", F.col("tf") * F.col("idf"))
    weighted = weighted.repartition(pieces_for(counts, n_rows), *group, id_col)
    return l2_normalise(weighted, [*group, id_col], "_w").drop("_w")


def pack_vectors(features: DataFrame, keys: Sequence[str], rows: DataFrame | None = None) -> DataFrame:
    """One row per segment: sorted ``terms`` and their ``vals``.

    ``rows`` lists all segments and is needed only where some may hold no term at
    all; those get empty arrays.
    """
    packed = features.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("term", "value"))).alias("_v"))
    if rows is None:
        return packed.select(*keys, F.col("_v.term").alias("terms"), F.col("_v.value").alias("vals"))
    joined = rows.join(packed, list(keys), "left")
    return joined.select(
        *rows.columns,
        F.coalesce(F.col("_v.term"), F.array().cast("array<string>")).alias("terms"),
        F.coalesce(F.col("_v.value"), F.array().cast("array<double>")).alias("vals"),
    )


def unpack_vectors(vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Long form (``term``, ``value``) of packed vectors."""
    pairs = F.explode(F.arrays_zip("terms", "vals"))
    return vectors.select(*keep, pairs.alias("_p")).select(*keep, F.col("_p.terms").alias("term"),
                                                           F.col("_p.vals").alias("value"))
