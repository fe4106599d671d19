"""Each operator, with production parameters, over the whole benchmark tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import (
    cutting,
    embedding_dedup,
    licenses,
    neighbours,
    ngram_join,
    packing,
    periods,
    phrases,
    pieces,
    quality,
    sharding,
    suffixes,
    toxicity,
)
from sedimenta.llm.common import read


def _fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = _fold(F.col("doc_id"), 5)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), fold != 0)
    held_out = F.coalesce(fold == 0, F.lit(False)).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = _fold(F.col("doc_id"), 3)
    model = quality.fit(docs, read(spark, sf_dir, "labels"), fold != 1)
    held_out = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return quality.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.shard(rows).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_classes(read(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(read(spark, sf_dir, "documents"), model)
    return pieces.decode(encoded, model).select(
        "doc_id",
        "chunk",
        "start",
        "length",
        "n_ids",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"),
    )


def _planted(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """The contract's repeats: a tenth of the documents become periodic from some word on."""
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((words[:a], words[a + np.arange(n - a) % p]))


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.runs(read(spark, sf_dir, "documents"), rewrite=_planted)
    listed = F.arrays_zip("starts", "lengths", "periods")
    told = F.transform(listed, lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"]))
    told = F.array_join(F.transform(told, lambda r: F.concat(r, F.lit("\n"))), "")
    # The greatest length, then the smallest start and period.
    ordered = F.transform(listed, lambda r: F.struct(-r["lengths"], r["starts"], r["periods"]))
    best = F.array_min(ordered)
    found = found.withColumn("best", best).select(
        "doc_id",
        F.size("starts").cast("long").alias("n_runs"),
        F.col("best")["starts"].alias("start"),
        (-F.col("best")["col1"]).alias("length"),
        F.col("best")["periods"].alias("period"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return found.withColumn("exponent_milli", F.expr("(1000 * length) div period"))


def op12_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return cutting.pack(read(spark, sf_dir, "documents"), tokenizer, size=1024)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"), threshold=100, longest=5, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_toxicity": op4_toxicity,
    "op6_quality": op6_quality,
    "op5_sharding": op5_sharding,
    "op2_licenses": op2_licenses,
    "op7_packing": op7_packing,
    "op8_pieces": op8_pieces,
    "op10_ngram_join": op10_ngram_join,
    "op11_periods": op11_periods,
    "op12_cutting_stock": op12_cutting_stock,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op2_licenses": licenses.oracle_sql(),
    "op3_suffix_dedup": suffixes.ORACLE_SQL,
    "op9_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op10_ngram_join": ngram_join.ORACLE_SQL,
    "op13_collocations": phrases.oracle_sql(),
}
