"""The corpus pipeline: stages over `documents`, each written as Parquet and read by the next.

A stage takes what the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import ngram_join, packing, quality, suffixes, toxicity
from sedimenta.llm.common import read, spare, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of `labels.toxic`, learned from labelled ones, does not reject."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), F.lit(True))
    return docs.filter(toxicity.scorer(spark, model)(F.col("text")) < 0.5)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of `labels.quality`, learned from labelled ones, accepts."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"), F.lit(True))
    return docs.filter(quality.scorer(spark, model)(F.col("text")) >= 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: that with the smallest doc_id, rows without one last.

    Each row is judged by itself under a key of its own, also where ids are repeated or null. Texts
    without words are like no other and stay.
    """
    # The key is written, so that all that reads it, also again after a failure, reads the same one.
    (key,) = spare(docs.columns, "_row")
    keyed = staged(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    classes = ngram_join.join_classes(keyed.select(F.col(key).alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("class"))
    rows = keyed.select(F.col(key).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = staged(rows.join(classes, "_row"), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row"))["_row"]
    groups = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
    copies = rows.join(groups.filter("n > 1"), "class").filter("_row <> first")
    kept = keyed.join(copies.select(F.col("_row").alias(key)), key, "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller doc_id also holds."""
    cut = suffixes.remove_repeats(docs, carry=docs.columns)
    # A passage may end within a character; what is left of one is dropped.
    kept = F.col("kept").cast("string")
    halves = F.regexp_replace(F.make_valid_utf8(kept), "\ufffd", "")
    cut = cut.withColumn("_cut", F.coalesce(F.try_validate_utf8(kept), halves))
    columns = []
    for name in docs.columns:
        value = F.col("carried")[name]
        if name == "text":
            value = F.when(F.col("n_removed") > 0, F.col("_cut")).otherwise(value)
        elif name == "n_chars":
            value = F.when(F.col("n_removed") > 0, F.length("_cut")).otherwise(value)
        columns.append(value.cast(docs.schema[name].dataType).alias(name))
    return cut.select(*columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack_tokens),
]

# The classifiers are trained in numpy, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
