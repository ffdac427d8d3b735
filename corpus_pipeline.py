"""Corpus pipeline: the operators of ``quarry.llm`` in sequence over ``documents``.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet to the
shared checkpoint folder and read back as the next stage's documents, so a lost executor costs
one stage at most. All stages but the last return the columns of ``documents``.

Null and empty texts fail the quality rules and leave in the first stage; an empty table stays
empty; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, jaccard, pieces_codec, pii, quality
from quarry.llm.common import materialize, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of every group of near duplicates."""
    return jaccard.keep_one_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with number and digest of ids and digest of the decoded text."""
    return pieces_codec.encode_stage(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("redact_personal_data", redact_personal_data),
    ("sentencepiece_ids", sentencepiece_ids),
]

#: No SQL: language references, boosted trees and the tokenizer are outside its reach; the test
#: compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
