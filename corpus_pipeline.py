"""Corpus pipeline: quality rules, near duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes
as Parquet into the shared folder and reads again as the next stage's docs. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epistar.llm.common import table
from epistar.llm.decontaminate import drop_contaminated
from epistar.llm.mixing import mix
from epistar.llm.ngram_join import keep_first
from epistar.llm.quality_rules import keep_good
from epistar.llm.secrets import redact_secrets
from epistar.session import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; the documents stay."""
    return redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row per repetition."""
    return mix(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("mixing", mixing_stage),
]

# The secret stage scores with a trained forest, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
