"""One radix pass over keys that occur in texts: who shares a key, at a few bytes per occurrence.

Tasks sort the keys of a batch of texts and ship, for each bucket of key values, one packed blob.
Within a batch an owner settles what it can see there, so a key held by a third of all texts
ships one owner per batch; a bucket's task joins what the batches sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import pack, unpack

# Keys per bucket aimed at: some 20 MB in the task that sorts them.
BUCKET_KEYS = 1_000_000
LEAST_BUCKETS = 64
NO_ID = np.iinfo(np.int64).max
_FLIP = np.uint64(1 << 63)


def buckets_for(n_keys: int) -> int:
    return max(LEAST_BUCKETS, -(-n_keys // BUCKET_KEYS))


def bits_for(n_keys: int) -> int:
    """Enough bits that under one key in a hundred meets another by chance."""
    return min(64, max(16, int(max(n_keys, 1)).bit_length() + 7))


def narrowed(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def to_code(ids: np.ndarray) -> np.ndarray:
    """Signed numbers to unsigned ones in the same order."""
    return ids.astype(np.int64).view(np.uint64) ^ _FLIP


def from_code(codes: np.ndarray) -> np.ndarray:
    return (codes ^ _FLIP).view(np.int64)


BLOB_SCHEMA = "bucket int, n int, keys binary, owners binary, variants binary, owner binary, more binary, kind binary"


def blobs(
    n_buckets: int,
    keys: np.ndarray,
    owner: np.ndarray,
    owners: np.ndarray,
    variants: np.ndarray,
    more: list[np.ndarray],
    kind: np.ndarray,
) -> pd.DataFrame:
    """One row per bucket. `owner` are places in `owners` (codes) and `variants`; `more` are further
    whole numbers of each record, `kind` says what a record is."""
    bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
    quotient = keys // np.uint64(n_buckets)
    order = ordered(quotient, owner)
    order = order[np.argsort(bucket[order].astype(np.min_scalar_type(n_buckets)), kind="stable")]
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    rows = []
    for part in np.split(order, cuts) if len(order) else []:
        used, place = np.unique(owner[part], return_inverse=True)
        rows.append(
            (
                int(bucket[part[0]]),
                len(part),
                pack(quotient[part], ascending=True),
                pack(owners[used]),
                pack(variants[used]),
                pack(place),
                pack(np.concatenate([m[part] for m in more])) if more else b"",
                pack(kind[part]),
            )
        )
    return pd.DataFrame(rows, columns=["bucket", "n", "keys", "owners", "variants", "owner", "more", "kind"])


def grouped(
    shipped: DataFrame, n_more: int, settle: Callable[..., pd.DataFrame], schema: str
) -> DataFrame:
    """Join the blobs of each bucket: `settle(keys, codes, variants, more, kind, batch)`."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for number, row in enumerate(group.itertuples(index=False)):
            place = unpack(row.owner).astype(np.int64)
            more = unpack(row.more).reshape(n_more, -1) if n_more else np.empty((0, row.n), np.uint64)
            parts.append(
                (
                    unpack(row.keys, ascending=True),
                    unpack(row.owners)[place],
                    unpack(row.variants)[place],
                    more,
                    unpack(row.kind),
                    np.full(row.n, number),
                )
            )
        keys, codes, variants, more, kind, batch = (np.concatenate(p, axis=-1) for p in zip(*parts))
        return settle(keys, codes, variants, more, kind, batch)

    return shipped.groupBy("bucket").applyInPandas(join, schema)


def runs(*columns: np.ndarray) -> np.ndarray:
    """True where a row of sorted columns differs from the row before it."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
    return new


def ordered(*columns: np.ndarray) -> np.ndarray:
    """The order by the columns, the first one first, then as given; only rows that share the first
    one are compared further."""
    order = np.argsort(columns[0])
    new = runs(columns[0][order])
    tied = ~new
    tied[:-1] |= ~new[1:]
    at = np.flatnonzero(tied)
    rows = order[at]
    order[at] = rows[np.lexsort([rows, *[c[rows] for c in columns[::-1]]])]
    return order


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])


def text_batches(batches: Iterator[pd.DataFrame], chars: int) -> Iterator[pd.DataFrame]:
    """Batches of about `chars` characters of text, or one longer text."""
    held, size = [], 0
    for batch in batches:
        part = (batch["text"].str.len().cumsum() // chars).to_numpy()
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
            if hi > lo:
                rows = batch.iloc[lo:hi]
                held.append(rows)
                size += int(rows["text"].str.len().sum())
                if size >= chars // 2:
                    yield pd.concat(held, ignore_index=True)
                    held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)
