"""Near-duplicate vectors by cross-polytope hashing.

Each table rotates vectors by rounds of random signs and fast Hadamard transforms and hashes them
to the nearest axis, with sign; the next nearest axes are probed as well. Vectors that meet in a
bucket are compared exactly. The more vectors there are, the more rotations a table joins into one
hash, so that buckets do not grow with the table. A pair that meets more than once is counted in the first bucket only,
which both can tell from their own hashes, so buckets return a row per vector instead of pairs.
Equal vectors are one vector with a number of copies. A large bucket is compared in pairs of
blocks, in many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import components, staged
from sedimenta.llm.vectors import rows_of, usable

BLOCK = 1500
LOT = 20_000


@dataclass(frozen=True)
class Hashing:
    """`tables` hashes; a hash joins the nearest axes of one rotation or more, enough of them that
    about `crowd` unlike vectors share a bucket. Vectors meet where the hash of one is that of the
    other, or is so once one axis of the other is replaced by its next nearest of `probes`."""

    tables: int = 6
    probes: int = 2
    rounds: int = 3
    crowd: int = 500
    most_joined: int = 4
    seed: int = 9


def joined_rotations(vectors: Column, width: Column, hashing: Hashing) -> Column:
    """How many rotations a hash joins, for so many vectors of that width."""
    n_axes = F.pow(F.lit(2.0), F.ceil(F.log2(width)) + 1)
    needed = F.ceil(F.ln(F.greatest(vectors, F.lit(1)) / F.lit(hashing.crowd)) / F.ln(n_axes))
    return F.least(F.greatest(needed, F.lit(1)), F.lit(hashing.most_joined)).cast("int")


def rotations(width: int, hashing: Hashing, joined: int = 1) -> np.ndarray:
    size = 1 << max(0, width - 1).bit_length()
    rng = np.random.default_rng(hashing.seed)
    return rng.choice([-1.0, 1.0], (hashing.tables, joined, hashing.rounds, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two."""
    n, size = x.shape
    half = 1
    while half < size:
        pair = x.reshape(n, size // (2 * half), 2, half)
        x = np.concatenate((pair[:, :, :1] + pair[:, :, 1:], pair[:, :, :1] - pair[:, :, 1:]), 2)
        x = x.reshape(n, size)
        half *= 2
    return x


def axes(x: np.ndarray, hashing: Hashing, joined: int = 1) -> np.ndarray:
    """For each row and table its hash, then the hashes with one axis replaced.

    An axis is 0 to 2 * size - 1. Axes of joined rotations are the digits of one number, shortened
    to 31 bits: what falls together by that only meets."""
    signs = rotations(x.shape[1], hashing, joined)
    size = signs.shape[3]
    padded = np.zeros((len(x), size))
    padded[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    probes = min(hashing.probes, size)
    out = np.empty((len(x), hashing.tables, 1 + joined * (probes - 1)), dtype=np.int32)
    for table in range(hashing.tables):
        hashed = np.zeros((len(x), 1 + joined * (probes - 1)), dtype=np.int64)
        for k in range(joined):
            y = padded
            for signs_of_round in signs[table, k]:
                y = hadamard(y * signs_of_round) / np.sqrt(size)
            near = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :probes]
            found = 2 * near + (np.take_along_axis(y, near, 1) < 0)
            digit = np.repeat(found[:, :1], hashed.shape[1], axis=1)
            digit[:, 1 + k * (probes - 1) : 1 + (k + 1) * (probes - 1)] = found[:, 1:]
            hashed = hashed * (2 * size) + digit
        out[:, table] = hashed % (2**31 - 1)
    return out


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of axes (pairs x tables x probes): the first meeting bucket of each pair, as table
    and axis in one number."""
    tables = a.shape[1]
    first = np.full(len(a), np.iinfo(np.int64).max)
    for table in range(tables - 1, -1, -1):
        x, y = a[:, table], b[:, table]
        common = np.concatenate(
            (
                np.where((y == x[:, :1]).any(1), x[:, 0], np.iinfo(np.int32).max)[:, None],
                np.where((x == y[:, :1]).any(1), y[:, 0], np.iinfo(np.int32).max)[:, None],
            ),
            1,
        ).min(1)
        first = np.where(common < np.iinfo(np.int32).max, table * (1 << 32) + common, first)
    return first


def _compare(cell: int, left: pd.DataFrame, right: pd.DataFrame | None, least: float):
    """Links counted in this bucket, and every row's smallest linked node, for one or two blocks."""
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    x = rows_of(both["vector"])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hashes = np.stack([np.asarray(h, dtype=np.int64) for h in both["axes"]])
    hashes = hashes.reshape(len(both), -1, int(both["probes"].iloc[0]))
    copies, node = both["copies"].to_numpy(), both["node"].to_numpy()
    n_left = len(left)
    links = np.zeros(len(both), dtype=np.int64)
    root = np.arange(len(both))
    pairs = []
    for lo in range(0, n_left, 512):
        hi = min(lo + 512, n_left)
        if right is None:
            i, j = np.nonzero(x[lo:hi] @ x[lo:].T >= least)
            i, j = i + lo, j + lo
            keep = i < j
        else:
            i, j = np.nonzero(x[lo:hi] @ x[n_left:].T >= least)
            i, j = i + lo, j + n_left
            keep = np.ones(len(i), dtype=bool)
        i, j = i[keep], j[keep]
        for at in range(0, len(i), 100_000):
            a, b = i[at : at + 100_000], j[at : at + 100_000]
            here = _meet(hashes[a], hashes[b]) == cell
            a, b = a[here], b[here]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            pairs.append((a, b))
    if pairs:
        a, b = (np.concatenate(p) for p in zip(*pairs))
        order = np.argsort(node, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        least_rank = rank.copy()
        while len(a):
            low = np.minimum(least_rank[a], least_rank[b])
            before = least_rank.copy()
            np.minimum.at(least_rank, a, low)
            np.minimum.at(least_rank, b, low)
            if (before == least_rank).all():
                break
        root = order[least_rank]
    return pd.DataFrame({"node": node, "links": links, "root": node[root]})


def lots(sizes: DataFrame) -> int:
    """Parts of about LOT rows for buckets of which each row is placed once for each block."""
    placed = sizes.agg(F.coalesce(F.sum(F.col("size") * F.col("blocks")), F.lit(0))).first()[0]
    return max(64, -(-placed // LOT))


def near_duplicates(
    table: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    within: str = "label",
    cosine: float = 0.98,
    hashing: Hashing = Hashing(),
) -> DataFrame:
    """Links between vectors of one `within` value with at least that cosine, in double precision.

    Returns a row per row: vec_id, n_links (other vectors linked directly), component_id (smallest
    vec_id reachable by links) and kept. Vectors that are null, zero or hold null or non-finite
    components, and those without a number or a `within` value, link with nothing, as do vectors of
    different lengths. Copies of a vector link with each other; repeated rows count as vectors.
    An empty table gives no rows; other columns are ignored. Pairs whose hashes never meet are
    missed; pairs below the cosine are never linked.
    """
    value, part = F.col(vector).cast("array<double>"), F.col(within)
    takes_part = usable(F.col(vector)) & part.isNotNull() & F.col(id_column).isNotNull()
    rows = table.select(
        F.col(id_column).cast("long").alias("vec_id"),
        part.alias("part"),
        F.when(takes_part, value).alias("vector"),
    )
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("part", "vector")))
    whole = rows.filter("node is not null")
    distinct = whole.groupBy("part", "vector", "node").agg(F.count(F.lit(1)).alias("copies"))
    distinct = distinct.withColumn("width", F.size("vector"))
    # A row for each label and width; counted closely enough, and alike whenever it is counted.
    areas = whole.groupBy("part", F.size("vector").alias("width")).agg(F.approx_count_distinct("node").alias("n"))
    areas = areas.select("part", "width", joined_rotations(F.col("n"), F.col("width"), hashing).alias("joined"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (_, n_joined), rows in batch.groupby(["width", "joined"]):
                found = axes(rows_of(rows["vector"]), hashing, n_joined)
                flat = found.reshape(len(rows), -1)
                yield rows[["node", "copies", "vector"]].assign(
                    axes=list(flat), probes=np.int32(found.shape[2]), area=rows["area"]
                )

    area = F.xxhash64("part", "width").alias("area")
    schema = "node long, copies long, vector array<double>, axes array<int>, probes int, area long"
    sized = distinct.join(areas, ["part", "width"])
    indexed = sized.select("node", "copies", "vector", "width", "joined", area).mapInPandas(hashed, schema)
    indexed = staged(indexed, "axes")
    at = F.posexplode("axes").alias("at", "axis")
    cells = indexed.select("node", "area", "probes", at).withColumn(
        "cell", F.floor(F.col("at") / F.col("probes")) * F.lit(1 << 32) + F.col("axis")
    )
    cells = cells.select("node", "area", "cell")
    sizes = cells.groupBy("area", "cell").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.filter("size > 1").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    sizes = staged(sizes, "sizes")
    placed = cells.join(sizes, ["area", "cell"]).select(
        "node", "area", "cell", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    placed = placed.select(
        "node", "area", "cell", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    )
    carried = placed.join(indexed.drop("area"), "node")

    def compare(lot: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")]
        for (_, cell, lo, hi), group in lot.groupby(["area", "cell", "lo", "hi"], sort=False):
            left = group[group["block"] == lo]
            right = None if lo == hi else group[group["block"] == hi]
            if len(left) and (right is None or len(right)):
                found = _compare(cell, left, right, cosine)
                out.append(found[found["links"] > 0])
        return pd.concat(out)

    # Many small buckets go to one task together; a vector stands once for each block it meets.
    n_lots = lots(sizes)
    lot = F.pmod(F.xxhash64("area", "cell", "lo", "hi"), F.lit(n_lots)).alias("lot")
    met = carried.groupBy(lot).applyInPandas(compare, "node long, links long, root long")
    met = staged(met, "met")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(met.filter("node <> root").select("node", "root"), "node", "root")
    described = staged(distinct.select("node", "copies"), "copies").join(links, "node", "left")
    described = described.join(classes, "node", "left").select(
        "node",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("class"),
    )
    # Rows that take no part have a class of their own.
    joined = rows.select("vec_id", "node").join(described, "node", "left")
    least = joined.groupBy("class").agg(F.min("vec_id").alias("least"))
    return joined.join(least, "class", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("least", "vec_id"), F.lit(False)).alias("kept"),
    )


# The links by brute force in the checking engine's SQL.
ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
u AS (SELECT *, sqrt(list_dot_product(x, x)) AS size FROM v),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
      ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.x, b.x) / (a.size * b.size) >= 0.98e0),
r(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings
                     UNION SELECT r.vec_id, e.b FROM r JOIN e ON r.other = e.a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT r.vec_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_links,
  min(other) AS component_id, r.vec_id = min(other) AS kept
FROM r LEFT JOIN n ON n.a = r.vec_id GROUP BY r.vec_id"""
