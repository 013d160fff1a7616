"""Corpus pipeline: documents -> quality rules -> near-duplicates -> decontamination ->
mix -> shards. Each stage is one operator of ``tidemark.llm`` on all rows that its
predecessor kept; all but the last return the columns of ``documents``.

The benchmark of the decontamination stage is read from ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import adaptive_quality, icws_dedup, jump_shards, tree_mix, winnowing
from tidemark.llm.queries import MIX_WEIGHTS, SHARDS, domain
from tidemark.session import scratch_path

#: One epoch at most, so that no document is repeated in the output.
PIPELINE_MIX = tree_mix.Mix(weights=MIX_WEIGHTS, default_weight=10, budget_percent=80, max_epochs=1, seed=23)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    return adaptive_quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each class of equal or similar texts."""
    return icws_dedup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return winnowing.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to meet the target weights of domains, languages and sources."""
    levels = {"domain": domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    return tree_mix.mixed(docs, levels, PIPELINE_MIX)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left."""
    return jump_shards.shard_rows(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: The near-duplicate stage has no SQL form; the pipeline is tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
