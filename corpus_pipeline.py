"""The corpus pipeline: documents through the stages in order, each stage over all rows that its predecessor kept.

Defined cases, for every stage: an empty table gives an empty table; very long texts are taken whole; null ids, sources
and languages and columns of any other name stay as they are. What a stage does with null and empty texts, ties and
repeated rows, it says itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.llm import decontaminate, mixing, neardup, quality, secrets
from spanledger.llm.common import fresh, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects. Null and empty texts are scored like any other; repeated rows fare alike."""
    score = fresh(docs, "score")
    return quality.quality_scores(docs, table(spark, sf_dir, "labels"), into=score).filter(F.col(score) >= 0.3).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the least id: words in shingles of five, similarity of 0.8 or more. Null and empty texts are groups of their own; of rows that repeat id and text one stays."""
    return neardup.deduplicate(docs, words=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents. Null and empty texts stay; repeated rows fare alike."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With live secrets replaced in the texts. Null and empty texts stay as they are; repeated rows are changed alike; overlapping secrets are replaced as one."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by the target weights of the sources, shuffled, numbered in one more column. Null and empty texts are drawn like others; a null source is a source; repeated rows get equal counts."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
]

#: The trained classifier, the compressor and the sketches have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
