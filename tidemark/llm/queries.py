"""One query per operator of this package over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

from . import (adaptive_quality, chunk_dedup, conversation_repair, html_text, icws_dedup, jump_shards, langid,
               markov_secrets, merkle_manifest, oracles, pairwise_quality, token_store, tree_mix, winnowing)
from .common import table

SHARDS = 8
VOCABULARY = "word_bpe_49k.json"


def domain(source: Column) -> Column:
    """Production parameter: which domain a source belongs to, by its number."""
    n = F.regexp_extract(source, r"^src([0-9]{1,6})$", 1)
    n = F.when(n != "", n.cast("int"))
    return F.when(n < 8, "web").when(n < 14, "books").when(n < 20, "forums").otherwise("other")


MIX_WEIGHTS = {
    "web": 50, "books": 30, "forums": 20, "other": 5,
    **{f"{d}/{x}": w for d in ("web", "books", "forums") for x, w in (("en", 40), ("de", 20), ("fr", 20), ("es", 20))},
}
MIX = tree_mix.Mix(weights=MIX_WEIGHTS, default_weight=10, budget_percent=60, max_epochs=2, seed=17)


def mix_levels() -> dict[str, Column]:
    return {"domain": domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_rows(table(spark, sf_dir, "documents"))


def op2_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted_rows(table(spark, sf_dir, "pages"))


def op3_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeat_rows(table(spark, sf_dir, "documents"))


def op4_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_quality.quality_rows(table(spark, sf_dir, "documents"))


def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.shard_rows(table(spark, sf_dir, "documents"), SHARDS)


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.decontamination_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op7_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return markov_secrets.secret_rows(docs, samples=markov_secrets.labelled_samples(docs))


def op8_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_mix.mix_rows(table(spark, sf_dir, "documents"), mix_levels(), MIX)


def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_icws_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return icws_dedup.near_duplicate_rows(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest_rows(table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    vocabulary = token_store.Vocabulary(public_tokenizers.path(VOCABULARY), end_id=1, by_piece=True)
    token_store.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary)
    return token_store.token_rows(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_html_layout": op2_html_layout,
    "op3_chunk_dedup": op3_chunk_dedup,
    "op4_adaptive_quality": op4_adaptive_quality,
    "op5_jump_shards": op5_jump_shards,
    "op6_winnowing": op6_winnowing,
    "op7_markov_secrets": op7_markov_secrets,
    "op8_tree_mix": op8_tree_mix,
    "op9_pairwise_quality": op9_pairwise_quality,
    "op10_icws_near_dedup": op10_icws_near_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_files": op13_token_files,
}
_DOMAIN_SQL = """CASE WHEN regexp_matches(source, '^src[0-9]{1,6}$') THEN
  CASE WHEN substr(source, 4)::INT < 8 THEN 'web' WHEN substr(source, 4)::INT < 14 THEN 'books'
       WHEN substr(source, 4)::INT < 20 THEN 'forums' ELSE 'other' END ELSE 'other' END"""

#: The other queries learn models, hash at random or build trees: they are tested against
#: brute force, held-out accuracy or fixtures instead.
ORACLES: dict[str, str] = {
    "op4_adaptive_quality": oracles.OP4,
    "op5_jump_shards": oracles.OP5,
    "op6_winnowing": oracles.OP6,
    "op7_markov_secrets": oracles.OP7,
    "op8_tree_mix": oracles.op8(MIX, _DOMAIN_SQL),
    "op12_merkle_manifest": oracles.op12(merkle_manifest.FIELDS),
}
