"""Helpers the operators share: written intermediates, gapless ranks, packed arrays, components."""

from __future__ import annotations

import ctypes
import os
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import wraps
from pathlib import Path
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DOC_ID, TEXT = "doc_id", "text"

# Workers return the memory of large arrays as soon as these are freed, so what one operator's
# tasks needed at their peak does not stay taken while the next one's run in the same processes.
_WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "2097152", "MALLOC_TRIM_THRESHOLD_": "16777216", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it."""
    spark.sparkContext.environment.update(_WORKER_MEMORY)
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """What a worker process keeps between tasks, of one operator at a time."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def forget() -> None:
    """Drop what another operator's tasks kept in this worker process."""
    _KEPT.clear()


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`work` over a task's batches, after which its process returns the memory it freed.

    Spark may keep more worker processes than it has tasks to run, and an idle one would hold the
    gaps that many small objects leave for as long as the application runs.
    """

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
            if trim:
                trim(0)

    return run


def documents(docs: DataFrame, *more: Column) -> DataFrame:
    """`doc_id` and whole `text` (null: empty) and nothing else but `more`, whatever the table holds."""
    text = F.coalesce(F.col(TEXT), F.lit("")).alias(TEXT)
    return docs.select(F.col(DOC_ID).cast("long").alias(DOC_ID), text, *more)


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which every executor reaches. Only where the session
    names none (a test on one machine) a folder beside the warehouse is used."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a result that is read more than once to the shared folder and return it as a scan.

    It cuts the lineage, and survives lost executors and retried tasks.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def membership(keys: DataFrame, name: str, bits: int = 1 << 24) -> Callable[[Column], Column]:
    """A test that all keys pass and, while they are few beside `bits`, little else does.

    Its table of `bits` bits has the same size for any number of keys; with many it lets more
    through, so an exact join must follow.
    """

    def places(key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(bits)).cast("int") for k in (0, 1)]

    at = keys.select(F.explode(F.array(*places(F.col(name)))).alias("at"))
    word, bit = F.shiftright("at", 5).alias("word"), F.expr("shiftleft(1, at & 31)")
    words = at.groupBy(word).agg(F.bit_or(bit).alias("held")).toPandas()  # at most bits / 32 rows
    table = np.zeros(bits // 32, dtype=np.uint32)
    table[words["word"].to_numpy().astype(np.int64)] = words["held"].to_numpy().astype(np.int64) & 0xFFFFFFFF
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def held(first: pd.Series, second: pd.Series) -> pd.Series:
        both = [(shared.value[p.to_numpy() >> 5] >> (p.to_numpy() & 31).astype(np.uint32)) & 1 for p in (first, second)]
        return pd.Series((both[0] & both[1]).astype(bool))

    return lambda key: held(*places(key))


def spare(taken: Sequence[str], *names: str) -> list[str]:
    """Column names like `names` that no column of `taken` has, in any case of letters."""
    known, found = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in known:
            name = f"_{name}"
        found.append(name)
    return found


def gapless_rank(df: DataFrame, group: str, by: Sequence[Column], rank: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, though a group may hold all rows.

    Rows go to about sqrt(rows) buckets by a hash of `by`; rows are numbered within a bucket and
    buckets are numbered by running sums of their counts, so rows of a group are dealt to many
    tasks. Rows equal in every column of `by` are interchangeable, share a bucket and take
    neighbouring numbers.
    """
    bucket, row, of_group, of_bucket, n, offset = spare(
        [*df.columns, rank], "_bucket", "_row", "_group", "_of", "_n", "_offset"
    )
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias(n))
    buckets = counted.agg(F.greatest(F.lit(1), F.ceil(F.sqrt(F.coalesce(F.sum(n), F.lit(0))))))
    n_buckets = int(buckets.first()[0])
    bucketed = df.withColumn(bucket, F.pmod(F.xxhash64(*by), F.lit(n_buckets)).cast("int"))
    counts = bucketed.groupBy(group, bucket).agg(F.count(F.lit(1)).alias(n))
    running = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias(of_group),
        F.col(bucket).alias(of_bucket),
        F.coalesce(F.sum(n).over(running), F.lit(0)).alias(offset),
    )
    within = Window.partitionBy(group, bucket).orderBy(*by)
    numbered = bucketed.withColumn(row, F.row_number().over(within).cast("long") - 1)
    matched = F.col(group).eqNullSafe(F.col(of_group)) & (F.col(bucket) == F.col(of_bucket))
    return numbered.join(offsets, matched).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col(row) + F.col(offset)).alias(rank)
    )


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers as byte planes, deflated; ascending ones as differences."""
    values = np.asarray(values, dtype=np.uint64)
    if ascending and values.size:
        values = np.concatenate((values[:1], values[1:] - values[:-1]))
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zlib.compress(planes.tobytes(), 1)


def unpack(blob: bytes, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), dtype=np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view("<u8").reshape(-1)
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A full-avalanche bijection on unsigned 64-bit numbers (xor-shift and multiply)."""
    x = values.astype(np.uint64) + np.uint64((seed * 2654435769 + 11400714819323198485) % 2**64)
    shifted = x >> np.uint64(31)
    x ^= shifted
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= np.right_shift(x, np.uint64(27), out=shifted)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= np.right_shift(x, np.uint64(33), out=shifted)
    return x


def segment_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ranges start, start + 1, ... of the given lengths."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(
        np.asarray(starts, dtype=np.int64) - (ends - lengths), lengths
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """`node` and its `component` (the smallest node reachable) for every node with an edge.

    Each round every node takes its smallest neighbour, pointers are doubled, and the edges are
    contracted to the nodes pointed at; each connected piece at least halves, so the rounds are
    logarithmic. Only minima are taken over neighbours, which combine before the shuffle, and
    everything stays distributed and written to the shared folder.
    """
    pairs = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
    pairs = staged(pairs.filter("u < v").distinct(), "edges")
    labels = None
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy("u").agg(F.min("v").alias("v"))
        hooks = staged(hooks.select("u", F.least("u", "v").alias("p")), "hooks")
        # A pointer leads to a smaller node, so chains end; doubling shortens them.
        for _ in range(3):
            far = hooks.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            hooks = hooks.join(far, "p").select("u", F.col("pp").alias("p"))
        hooks = staged(hooks, "pointers")
        of = lambda x: hooks.select(F.col("u").alias(x), F.col("p").alias(f"p{x}"))
        contracted = pairs.join(of("u"), "u").join(of("v"), "v")
        contracted = contracted.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
        pairs = staged(contracted.filter("u < v").distinct(), "edges")
        if labels is None:
            labels = hooks.select(F.col("u").alias("node"), F.col("p").alias("component"))
        else:
            onward = hooks.select(F.col("u").alias("component"), F.col("p").alias("next"))
            labels = labels.join(onward, "component", "left").select(
                "node", F.coalesce("next", "component").alias("component")
            )
        labels = staged(labels, "labels")
    if labels is None:
        schema = f"node {dict(edges.dtypes)[a]}, component {dict(edges.dtypes)[b]}"
        return edges.sparkSession.createDataFrame([], schema)
    return labels
