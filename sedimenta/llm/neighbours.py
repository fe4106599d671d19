"""Approximate nearest neighbours over balanced posting lists.

A bounded sample is halved again and again into equal parts; the parts' means are the centroids,
few enough to stay in memory with a graph of their neighbours. A search walks that graph from a
few entries towards the vector. Every vector goes to the list of its nearest centroid, and
vectors near a boundary also to the lists beyond it. A query reads the lists whose centroids are
not much farther than its nearest. Lists are compared with their queries exactly, in many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import staged
from sedimenta.llm.vectors import rows_of, vectors

SALTS = 32
BLOCK = 5000


@dataclass(frozen=True)
class Lists:
    """`sample` bounds the vectors that centroids are fitted on, and so do the centroids:
    one for `per_list` sampled vectors. `copies` and `boundary` say to how many lists, and up to
    which ratio of distances, a vector is replicated, beside the nearest that always takes it. A
    query reads its `least` nearest lists and all others up to `ratio` times as far as the nearest;
    a search opens `beam` centroids and those within the ratio."""

    sample: int = 20_000
    per_list: int = 80
    copies: int = 3
    boundary: float = 1.15
    least: int = 16
    ratio: float = 1.15
    beam: int = 64
    neighbours: int = 24
    seed: int = 1


def balanced(sample: np.ndarray, per_list: int, seed: int) -> np.ndarray:
    """Means of equal parts: each part is cut at the median between two of its own means."""
    rng = np.random.default_rng(seed)
    parts, done = [np.arange(len(sample))], []
    while parts:
        part = parts.pop()
        if len(part) <= per_list:
            done.append(part)
            continue
        x = sample[part]
        pair = x[rng.choice(len(part), 2, replace=False)]
        for _ in range(4):
            side = ((x - pair[0]) ** 2).sum(1) > ((x - pair[1]) ** 2).sum(1)
            if side.all() or not side.any():
                break
            pair = np.stack([x[~side].mean(0), x[side].mean(0)])
        order = np.argsort(x @ (pair[1] - pair[0]), kind="stable")
        parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return np.stack([sample[part].mean(0) for part in done])


@dataclass(frozen=True)
class Graph:
    """Centroids with their nearest neighbours and some far ones, and where searches begin."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray


def graph(centroids: np.ndarray, neighbours: int, seed: int) -> Graph:
    n = len(centroids)
    middle = centroids - centroids.mean(0)  # so that far from 0 no digits are lost below
    square = (middle**2).sum(1)
    near = np.empty((n, min(neighbours, n)), dtype=np.int64)
    for lo in range(0, n, 1024):
        d = square[None] - 2 * middle[lo : lo + 1024] @ middle.T
        near[lo : lo + 1024] = np.argsort(d, axis=1, kind="stable")[:, : near.shape[1]]
    rng = np.random.default_rng(seed)
    far = rng.integers(0, n, (n, min(8, n)))
    return Graph(centroids, np.hstack([near, far]), np.unique(rng.integers(0, n, 16)))


def search(index: Graph, x: np.ndarray, beam: int, ratio: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """For each row the centroids its walk met, nearest first, and their squared distances
    (infinite behind the last one met).

    All rows walk together: each opens its nearest unopened centroid, until `beam` are open and
    the next one is more than `ratio` times as far as the nearest.
    """
    rows = np.arange(len(x))
    met = np.full((len(x), len(index.centroids)), np.inf)
    waiting = met.copy()

    def meet(at: np.ndarray, walkers: np.ndarray) -> None:
        new = np.isinf(met[walkers[:, None], at])
        who, where = np.broadcast_to(walkers[:, None], at.shape)[new], at[new]
        met[who, where] = waiting[who, where] = ((index.centroids[where] - x[who]) ** 2).sum(1)

    meet(np.broadcast_to(index.entries, (len(x), len(index.entries))), rows)
    going, opened = rows, 0
    while len(going):
        pick = waiting[going].argmin(1)
        next_one = waiting[going, pick]
        limit = np.inf if opened < beam else met[going].min(1) * ratio**2
        on = np.isfinite(next_one) & (next_one <= limit)
        going, pick = going[on], pick[on]
        waiting[going, pick] = np.inf
        meet(index.links[pick], going)
        opened += 1
    order = np.argsort(met, axis=1, kind="stable")
    return order, np.take_along_axis(met, order, 1)


def boundary_lists(distance: np.ndarray, lists: Lists) -> np.ndarray:
    """Which of the nearest centroids take a vector: the nearest, and others up to `copies` that
    are almost as near, so a vector by a boundary stands in the lists on both sides."""
    near = distance <= distance[:, :1] * lists.boundary**2
    return near & (np.arange(distance.shape[1]) < lists.copies) & np.isfinite(distance)


def lists_to_read(distance: np.ndarray, lists: Lists) -> np.ndarray:
    near = distance <= distance[:, :1] * lists.ratio**2
    return (near | (np.arange(distance.shape[1]) < lists.least)) & np.isfinite(distance)


def closest(asked: np.ndarray, held: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each asked vector places and distances of the `k` nearest held ones, ties by `least`.

    A quick form over vectors moved to the middle of the held ones leaves out only what is farther
    than the k-th by more than its rounding can amount to; the distances of the rest, as many as
    they are, are taken from the original vectors.
    """
    middle = held.mean(0)
    v = held - middle
    square = (v**2).sum(1)
    far = np.sqrt(square.max())
    k = min(k, len(held))
    for lo in range(0, len(asked), 500):
        q = asked[lo : lo + 500] - middle
        with np.errstate(over="ignore", invalid="ignore"):
            quick = square[None] - 2 * q @ v.T
            slack = 8 * (held.shape[1] + 8) * np.finfo(float).eps * (np.sqrt((q**2).sum(1)) + far) ** 2
            bound = np.partition(quick, k - 1, axis=1)[:, k - 1] + 2 * slack
        for one, row, limit in zip(asked[lo : lo + 500], quick, bound):
            # Where squares are no longer finite, everything is compared.
            near = np.flatnonzero(~(row > limit))
            exact = np.sqrt(((held[near] - one) ** 2).sum(1))
            order = np.lexsort((least[near], exact))[:k]
            yield near[order], exact[order]


def _distinct(usable: DataFrame, keep: int) -> DataFrame:
    """Each distinct vector once, with its `keep` smallest numbers, ascending.

    A vector may hold a third of all rows, so numbers are first reduced within SALTS parts of it.
    """
    salted = Window.partitionBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).orderBy("vec_id")
    whole = Window.partitionBy("vector").orderBy("vec_id")
    few = usable.withColumn("_rank", F.row_number().over(salted)).filter(F.col("_rank") <= keep)
    few = few.withColumn("_rank", F.row_number().over(whole)).filter(F.col("_rank") <= keep)
    ids = F.sort_array(F.collect_list("vec_id")).alias("ids")
    grouped = few.groupBy("vector", "width").agg(ids)
    return grouped.withColumn("node", F.xxhash64("vector"))


def nearest(
    table: DataFrame,
    is_query,
    k: int = 10,
    id_column: str = "vec_id",
    vector: str = "embedding",
    lists: Lists = Lists(),
) -> DataFrame:
    """The `k` nearest rows found for every row for which `is_query` (a column) holds.

    Returns query_id, rank (from 1), vec_id, score (Euclidean distance in double precision on the
    original vectors), nearest first, ties to the smaller vec_id; a row is no candidate of its
    own number, copies of it are. Vectors that are null, zero or hold null or non-finite
    components and rows without a number take no part; vectors of another length than a query's
    are no candidates of it. Fewer candidates give fewer rows; an empty table gives none; other
    columns are ignored.
    """
    spark = table.sparkSession
    usable = vectors(table, id_column, vector)
    distinct = staged(_distinct(usable, k + 1), "distinct")
    asked = vectors(table.filter(is_query), id_column, vector)
    asked = staged(asked.select(F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("node")), "asked")

    fitted = {}
    for row in distinct.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect():
        # One graph for each length of vectors, each fitted on a sample of bounded size.
        sample = distinct.filter(F.col("width") == row.width).orderBy(F.xxhash64("node", F.lit(lists.seed)))
        x = rows_of(sample.limit(lists.sample).select("vector").toPandas()["vector"])
        fitted[row.width] = graph(balanced(x, lists.per_list, lists.seed), lists.neighbours, lists.seed)
    shared = spark.sparkContext.broadcast(fitted)

    def assign(beam: int, ratio: float, chosen):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for width, rows in batch.groupby("width"):
                    index = shared.value[width]
                    for lo in range(0, len(rows), 1000):
                        part = rows.iloc[lo : lo + 1000]
                        best, distance = search(index, rows_of(part["vector"]), beam, ratio)
                        take = chosen(distance)
                        yield pd.DataFrame(
                            {
                                "node": np.repeat(part["node"].to_numpy(), take.sum(1)),
                                "width": np.int32(width),
                                "list": best[take],
                            }
                        )

        return run

    def blocks_of(lists_of: DataFrame, name: str) -> DataFrame:
        # A row per centroid, so bounded by the sample.
        n = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")
        return F.broadcast(lists_of.groupBy("width", "list").agg(n.alias(name)))

    schema = "node long, width int, list int"
    columns = distinct.select("node", "width", "vector")
    placing = assign(4 * lists.copies, 1.0, lambda distance: boundary_lists(distance, lists))
    postings = staged(columns.mapInPandas(placing, schema), "postings")
    wanted = columns.join(asked.select("node").distinct(), "node", "left_semi")
    reading = assign(max(lists.beam, lists.least), lists.ratio, lambda distance: lists_to_read(distance, lists))
    reads = staged(wanted.mapInPandas(reading, schema), "reads")
    # Lists and the queries of a list are both cut into blocks, and blocks meet in pairs.
    have, ask = blocks_of(postings, "have_blocks"), blocks_of(reads, "ask_blocks")

    def side(rows: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        cut = F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        sized = rows.join(have, ["width", "list"]).join(ask, ["width", "list"])
        sized = sized.select("width", "list", cut, every, "node")
        return sized.select("width", "list", "have_block", "ask_block", "node", F.lit(asks).alias("asks"))

    kept = side(postings, "have", "ask", False)
    carried = kept.unionByName(side(reads, "ask", "have", True))
    carried = carried.join(distinct.select("node", "vector", "ids"), "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ask, have = group[group["asks"]], group[~group["asks"]]
        out = {"asked": np.empty(0, np.int64), "node": np.empty(0, np.int64), "score": np.empty(0)}
        if len(ask) and len(have):
            least = np.array([ids[0] for ids in have["ids"]])
            nodes = have["node"].to_numpy()
            found = list(closest(rows_of(ask["vector"]), rows_of(have["vector"]), least, k + 1))
            out["asked"] = np.repeat(ask["node"].to_numpy(), [len(at) for at, _ in found])
            out["node"] = np.concatenate([nodes[at] for at, _ in found])
            out["score"] = np.concatenate([distance for _, distance in found])
        return pd.DataFrame(out)

    meetings = carried.groupBy("width", "list", "have_block", "ask_block")
    found = meetings.applyInPandas(compare, "asked long, node long, score double")
    found = found.groupBy("asked", "node").agg(F.min("score").alias("score"))
    # At most (k + 1) vectors of each list read, so a query's rows are bounded by the parameters.
    nearest_first = Window.partitionBy("asked").orderBy("score", "least")
    found = found.join(distinct.select("node", "ids", F.col("ids")[0].alias("least")), "node")
    found = found.withColumn("_rank", F.row_number().over(nearest_first)).filter(F.col("_rank") <= k + 1)
    found = found.select(F.col("asked").alias("node"), "score", F.explode("ids").alias("vec_id"))
    answered = asked.join(found, "node").filter(F.col("vec_id") != F.col("query_id"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = answered.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
