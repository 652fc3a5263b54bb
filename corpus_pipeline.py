"""Corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame.  ``run`` writes each stage's result as Parquet in the
shared checkpoint folder and rereads it as the next stage's ``docs``.  All stages
but the last return the columns of ``docs``, extra ones included.  A stage's result
is to be written before the next stage is called, which deletes the tables the
stage made on its way.

Rows without a doc_id pass the stages that tell documents by id and are packed;
null text is empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import ngram_join, packing, recompression, secrets, toxicity
from riskspark.llm.common import documents, read_table, stage_of, written


@stage_of
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring as toxic go; the machine is fitted on labelled documents among ``docs``."""
    return toxicity.without_toxic(docs, toxicity.fit_machine(docs, read_table(spark, sf_dir, "labels")))


@stage_of
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: five-word shingles, similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


@stage_of
def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id has, too, are cut out."""
    return recompression.deduplicated(docs)


@stage_of
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text."""
    return secrets.redacted(docs)


@stage_of
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", passage_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Trained models, tokenizers and learned thresholds have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
