"""Registered queries of the package."""

from __future__ import annotations

import public_tokenizers

from driftwarden.llm import (decontamination, divergence, embeddings, jaccard, language, lm, mixing, packing, repeats,
                             secret_scan, sharding, urls, vafile)
from driftwarden.llm.common import read
from driftwarden.llm.oracles import ORACLES  # noqa: F401


def op1_embedding_neardup(spark, sf_dir):
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_lm_scoring(spark, sf_dir):
    return lm.score_documents(read(spark, sf_dir, "documents"))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.scan_documents(read(spark, sf_dir, "documents"))


def op4_sharding(spark, sf_dir):
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op5_decontamination(spark, sf_dir):
    return decontamination.find_contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("spans")


def op6_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"))


def op7_url_filter(spark, sf_dir):
    return urls.judge_pages(read(spark, sf_dir, "pages"))


def op8_source_mix(spark, sf_dir):
    return mixing.mix_documents(read(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return language.identify_pages(read(spark, sf_dir, "pages"))


def op10_repeated_bytes(spark, sf_dir):
    return repeats.remove_repeats(read(spark, sf_dir, "documents"))


def op11_source_divergence(spark, sf_dir):
    return divergence.audit_sources(spark, read(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark, sf_dir):
    return vafile.cluster_vectors(spark, read(spark, sf_dir, "embeddings"))


def op13_best_fit_packing(spark, sf_dir):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(spark, read(spark, sf_dir, "documents"), vocabulary)


QUERIES = {f.__name__: f for f in (
    op1_embedding_neardup, op2_lm_scoring, op3_secret_scan, op4_sharding, op5_decontamination, op6_jaccard_join,
    op7_url_filter, op8_source_mix, op9_language_id, op10_repeated_bytes, op11_source_divergence,
    op12_centroid_clustering, op13_best_fit_packing)}
