"""The corpus pipeline: STAGES of training-data operators, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridflux.llm import line_dedup, minhash, packing, quality_rules, toxicity
from gridflux.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't reject; it learns from the labelled rows of
    the whole table, not of the stage's input. Null and empty texts are scored like any other; labels of
    unknown, null or doubly labelled ids and an empty table crash nothing. All columns stay."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.keep_clean(docs, toxicity.fit(table(spark, sf_dir, "documents"), labels))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule; null, empty and blank texts have no words and go. Equal rows share
    one verdict."""
    return quality_rules.filter_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that match an earlier one; a text may become empty, a null stays."""
    return line_dedup.remove_repeats(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies; rows without an id are kept or dropped by their own text."""
    return minhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; an empty text is its end token alone."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("quality rules", apply_rules), ("line dedup", dedup_lines), ("near-dedup", dedup_near), ("packing", pack)]
#: No SQL expresses the learnt stage and the packing; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "_"))
    return docs
