"""The subpackage's registered queries and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridflux.llm import bpe, decontaminate, fingerprint, line_dedup, merkle_manifest, minhash, packing, quality_classifier, quality_rules, token_store, toxicity, url_rules, whitening
from gridflux.llm.common import table


def op1_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"))


def op3_association_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_store.write_store(table(spark, sf_dir, "documents"))
    return token_store.read_checksums(spark, store)


def op7_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(table(spark, sf_dir, "documents"))


def op10_bagminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op11_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op12_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verify_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_compression_classifier,
        op2_pair_index_bpe,
        op3_association_url_rules,
        op4_fingerprints,
        op5_best_fit_packing,
        op6_token_store,
        op7_factorization_machine,
        op8_quality_rules,
        op9_line_dedup,
        op10_bagminhash_classes,
        op11_jacobi_davidson_whitening,
        op12_fm_index_decontamination,
        op13_merkle_manifest,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op8_quality_rules": quality_rules.JUDGE_SQL,
    "op12_fm_index_decontamination": decontaminate.CONTAMINATION_SQL,
    "op13_merkle_manifest": merkle_manifest.VERIFY_SQL,
}
