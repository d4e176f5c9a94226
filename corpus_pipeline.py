"""From raw documents to shards: five stages, each one operator of ``civicmart.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicmart.llm import bagminhash, decontaminate, mixing, quality, sharding
from civicmart.llm.common import ship_package
from civicmart.plans.registry import load
from civicmart.session import materialise


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship_package(spark)
    return quality.accept(docs, load(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    ship_package(spark)
    return bagminhash.drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.remove_documents(docs, load(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard_report(docs)


STAGES = [
    ("quality", accept),
    ("near_dedup", dedup),
    ("decontaminate", clean),
    ("mix", mix),
    ("shard", shard),
]

# The classifier and the hash functions of the signatures have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
