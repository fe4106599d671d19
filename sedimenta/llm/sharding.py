"""Rendezvous sharding: each record goes to the shard that scores highest for its key.

DataFrame functions only. The score of a shard depends on the key, the shard and its weight, so
a further shard takes records only into itself, about its share of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import gapless_rank

# 52 bits of the hash make a number in (0, 1) that a double holds exactly.
_BITS = 52


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the largest -weight / ln(u), u in (0, 1) from a hash of key and shard; ties
    go to the larger number. A null key is a key of its own."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))

    def score(shard: int, weight: float) -> Column:
        hashed = F.conv(F.substring(F.md5(F.concat_ws(":", text, F.lit(str(shard)))), 1, 13), 16, 10)
        unit = (hashed.cast("double") + F.lit(0.5)) / F.lit(float(2**_BITS))
        # Doubles near 1 may round to it, where the logarithm is 0; such a score is the largest.
        unit = F.least(unit, F.lit(1 - 2.0**-53))
        return F.struct((F.lit(-weight) / F.ln(unit)).alias("score"), F.lit(shard).alias("shard"))

    scores = [score(shard, weight) for shard, weight in enumerate(weights)]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return best["shard"]


def shard(
    rows: DataFrame,
    key: str = "doc_id",
    weights: Sequence[float] = (1.0,) * 8,
    grown_by: float | None = 1.0,
) -> DataFrame:
    """Add `shard`, `slot` (gapless from 0 within the shard) and `grown_shard`, the shard if one of
    weight `grown_by` were added (null without it).

    Equal keys share a shard. Keys may be null or repeated; rows equal in all columns take
    neighbouring slots in either order. A shard that holds all rows is numbered in many tasks.
    Columns of the input that are called as the three added ones are replaced by them.
    """
    grown = shard_of(F.col(key), [*weights, grown_by]) if grown_by else F.lit(None).cast("int")
    added = ("shard", "slot", "grown_shard")
    columns = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in added]
    placed = rows.select(
        *columns, shard_of(F.col(key), weights).alias("shard"), grown.alias("grown_shard")
    )
    return gapless_rank(placed, "shard", columns, "slot")
