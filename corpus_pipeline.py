"""A training-data pipeline of the operators in ``tidemark.llm``.

Each stage takes (spark, docs, sf_dir) and gives a frame that is written and
read again as the next one's ``docs``.  Nulls, empty and repeated texts are
treated as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import credentials, decontamination, mixing, quality, simhash
from tidemark.llm.tables import read_table, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within their group's fences."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every found secret replaced by a mark; n_chars follows."""
    return credentials.redact_secrets(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies``, how often each is to be read."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
]

# SimHash needs a 64-bit hash that DuckDB does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
