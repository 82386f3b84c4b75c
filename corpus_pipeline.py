"""Documents to training tokens: rules, toxicity, near duplicates, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result and reads it back as the next one's docs.
All stages but the last return the columns of `documents`, whatever further columns the table has.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigauge.llm import bpe, mixing, rules, simhash, toxicity
from lexigauge.sources.scratch import materialize

#: Neither the toxicity model nor near-duplicate search has an SQL form; tests/llm/test_pipeline.py holds `run` to brute force.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return rules.apply_rules(docs, _labels(spark, sf_dir)).filter("kept").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights: documents are left out, cut at a budget's end, or repeated."""
    return mixing.draw(mixing.mix(docs)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the hash of the decoded text of every row."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    # Written in between, so that a task needs one Python worker at a time.
    encoded = materialize(bpe.encode(docs, path, public_tokenizers.PATTERN, keep=["doc_id"]), "ids")
    decoded = bpe.decode(encoded, path, public_tokenizers.PATTERN, keep=["doc_id", "ids"])
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
