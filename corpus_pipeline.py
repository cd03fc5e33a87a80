"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Every stage works on all rows of the one before, whatever further columns they have and whatever those are called. Null ids
are kept apart from each other only where their texts differ; null, empty and blank texts are judged like any others (the
quality rules reject them, as they have under 50 words); repeated rows fall together in the near-dedup, which keeps the
first; an empty table stays empty to the end.
"""

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import cotraining, packing, rules, secrets, simhash
from wordloom.sources.workspace import staged


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for good, learnt from the labels beside the documents."""
    return cotraining.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' label model takes for good."""
    return rules.good_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash.without_near_duplicates(docs, width=4, distance=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced by a mark."""
    return secrets.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2,048 tokens."""
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: The stages learn models and follow links, which SQL cannot state; tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
