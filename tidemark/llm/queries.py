"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, cascade, dialogue, extraction, gains, licenses, minhash, packing, pii, quality, sharding, sql, topk, vectors
from tidemark.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query()
def op1_license_scan(spark: SparkSession, path: str) -> DataFrame:
    found = licenses.scan(read(spark, path, "documents"))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses"),
        F.coalesce(F.array_max("containment"), F.lit(0.0)).alias("containment"),
    )


@query(sql.TOP_K)
def op2_histogram_top_k(spark: SparkSession, path: str) -> DataFrame:
    return topk.exact_top_k(read(spark, path, "embeddings"), "id % 100 = 0", k=10, scale=1024)


@query(sql.NEAR_VECTORS)
def op3_pivot_permutation(spark: SparkSession, path: str) -> DataFrame:
    return vectors.near_vectors(read(spark, path, "embeddings"), least=0.95)


@query()
def op4_byte_bpe(spark: SparkSession, path: str) -> DataFrame:
    docs = read(spark, path, "documents")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(sql.NEAR_DUPLICATES)
def op5_minhash_forest(spark: SparkSession, path: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, path, "documents"), width=4, percent=80)


@query()
def op6_importance_resampling(spark: SparkSession, path: str) -> DataFrame:
    return quality.resample(read(spark, path, "documents"), read(spark, path, "labels"))


@query()
def op7_host_suffix_array(spark: SparkSession, path: str) -> DataFrame:
    text = extraction.main_text(read(spark, path, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


@query()
def op8_skip_chain_crf(spark: SparkSession, path: str) -> DataFrame:
    found = pii.find(read(spark, path, "documents"))

    def joined(column: str) -> F.Column:
        parts = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query()
def op9_cutting_stock(spark: SparkSession, path: str) -> DataFrame:
    return packing.pack(
        read(spark, path, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0,
        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN,
    )


@query()
def op10_sampled_splitters(spark: SparkSession, path: str) -> DataFrame:
    placed = sharding.shard_by_bytes(read(spark, path, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(sql.CASCADE)
def op11_rule_cascade(spark: SparkSession, path: str) -> DataFrame:
    return cascade.judge(read(spark, path, "documents")).drop("rejected_by")


@query(sql.GAINS)
def op12_gain_resampling(spark: SparkSession, path: str) -> DataFrame:
    setup = gains.Setup(longest=1, buckets=10_000, least=20, percent=10, seed=2024)
    return gains.resample(read(spark, path, "documents"), read(spark, path, "benchmark"), setup)


@query(sql.DIALOGUE)
def op13_dialogue_repair(spark: SparkSession, path: str) -> DataFrame:
    return dialogue.repair_damaged(read(spark, path, "conversations"))
