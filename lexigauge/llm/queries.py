"""The registered queries of this subpackage: thin readers of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigauge.llm import (
    alignment, bpe, chat, factorisation, language, lexical, licenses, mixing, nearest, rules, sharding, simhash, toxicity,
)

VOCABULARY = "byte_bpe_50k.tiktoken"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _fold(n: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(0))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    encoded = bpe.encode(_read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep=["doc_id"]).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
    )
    decoded = bpe.decode(encoded, path, public_tokenizers.PATTERN, keep=["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    given = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = chat.read_back(*chat.pack(given.unionByName(extra)))
    learned = F.array_join(F.transform("turns", lambda t: F.coalesce(t.learned, F.lit(""))), "")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"), keep=["doc_id"])


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents")).drop("spans")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.withColumn("fingerprint", simhash.hex_of(F.col("fingerprint")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    meta = [F.floor(F.log2(F.col("n_chars") + 1))]
    model = factorisation.fit(docs, _read(spark, sf_dir, "labels"), meta=meta, train_rows=_fold(3) != 1)
    scored = factorisation.score(docs, model, meta=meta)
    return scored.select("doc_id", (_fold(3) == 1).alias("held_out"), "score", "predicted")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"), train=_fold(4) != 2)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (_fold(4) == 2).alias("held_out"), "score", "predicted")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_read(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.apply_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), keep=["doc_id"])
    return judged.select("doc_id", *rules.STATISTICS[:5], "base_failed", "kept")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), 10)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_documents(_read(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN, keep=["doc_id"])


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = language.identify(_read(spark, sf_dir, "documents"), train=_fold(4) != 2, keep=["doc_id"])
    return told.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_chat, op3_nearest, op4_mixing, op5_licenses, op6_simhash, op7_quality, op8_toxicity, op9_sharding,
        op10_quality_rules, op11_lexical_search, op12_alignment, op13_language_id, pipeline,
    )
}
