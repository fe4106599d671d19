"""Runs of words that repeat with a period, caught by blocks of a power of two.

Words are appended to a text one after another. At every multiple of h = 2^k a block of 2h words
begins; once it is complete, its catcher watches the words appended next and is caught when they
spell the block again at a distance q of more than h and at most 2h words, a square of period q.
Such a block is at least as long as the period, so within a run it comes again at the smallest
period first, and a run of four periods holds a block that starts at a multiple of h. Blocks next
to each other that are caught at the same distance are one run, whose ends are found by comparing
words with those q before them.

All catchers of one h advance together: the hashes of all blocks are compared with those of the h
places that follow, one place for each word. What hashes say is only a nomination; runs come from
comparing the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from sedimenta.llm.common import documents, mix
from sedimenta.llm.packing import text_batches

MIN_LENGTH, MIN_PERIODS = 6, 4
BATCH_CHARS = 4_000_000
SPLIT_BYTES = 1 << 22  # of a text that is held as words at once


class Vocabulary:
    """Words of a batch as numbers, and back."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}

    def ids(self, text: str) -> np.ndarray:
        data, begin, parts, known = text.encode(), 0, [], self.numbers
        while begin < len(data):
            end = begin + SPLIT_BYTES
            while end < len(data) and data[end : end + 1].strip():
                end = min([at for c in b" \t\n\r\x0b\x0c" if (at := data.find(c, end)) >= 0], default=len(data))
            words = data[begin:end].split()
            for word in dict.fromkeys(words):
                if word not in known:
                    known[word] = len(known)
            parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            begin = end
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def words(self) -> list[bytes]:
        return list(self.numbers)


def _stretches(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], true, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def catch(stream: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of texts, as rows (text, start in it, length, period).

    `stream` holds the texts' words as numbers, longest text first, each with a number of its own
    behind it that occurs nowhere else; `sizes` says how many words each text has. A run has a
    smallest period q and at least max(6, 4 q) words, and no word beside it continues it.
    """
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    found = []
    # Period 1: words equal to the next one.
    first, last = _stretches(stream[:-1] == stream[1:])
    long = last - first + 1 >= max(MIN_LENGTH, MIN_PERIODS)
    found.append(np.stack((first[long], last[long] + 1, np.ones(int(long.sum()), np.int64)), axis=1))
    hashes, h = mix(stream.astype(np.uint64)), 1  # of h words at each place
    while True:
        # Only texts that can hold four periods of more than h words.
        texts = int(np.searchsorted(-sizes, -MIN_PERIODS * (h + 1), "right"))
        if not texts:
            break
        n = int(begins[texts - 1] + sizes[texts - 1] + 1)
        hashes = hashes[: n - h + 1]
        hashes = mix(hashes[:-h] * np.uint64(0xA0761D6478BD642F) + hashes[h:], 3)  # of 2 h words
        blocks = -(-len(hashes) // h)
        after = np.zeros(blocks * h, dtype=np.uint64)  # nothing comes behind the last words
        after[: len(hashes) - h - 1] = hashes[h + 1 :]
        again = after.reshape(blocks, h) == hashes[::h, None]
        caught = np.flatnonzero(again.any(axis=1))
        if len(caught):
            period = h + 1 + again[caught].argmax(axis=1)
            found.append(_joined(stream, caught, period, h))
        h *= 2
    runs = np.concatenate(found)
    # One stretch may be caught at several multiples of its period: the smallest is its own.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    text = np.searchsorted(begins, runs[:, 0], "right") - 1
    return np.stack((text, runs[:, 0] - begins[text], runs[:, 1] - runs[:, 0], runs[:, 2]), axis=1)


def _joined(stream: np.ndarray, caught: np.ndarray, period: np.ndarray, h: int) -> np.ndarray:
    """Runs (start, end, period) around caught blocks of 2 h words at multiples of h."""
    new = np.ones(len(caught), dtype=bool)
    new[1:] = (np.diff(caught) != 1) | (np.diff(period) != 0)
    lead = np.flatnonzero(new)
    tail = np.append(lead[1:], len(caught)) - 1
    runs = []
    # A run ends less than h words before or behind the blocks within it.
    reach = (caught[tail] - caught[lead]) * h + 4 * h + period[lead]
    hopeful = reach >= np.maximum(MIN_LENGTH, MIN_PERIODS * period[lead])
    for first, last, q in zip(caught[lead][hopeful] * h, caught[tail][hopeful] * h, period[lead][hopeful]):
        lo, hi = max(0, first - h), min(len(stream), last + 3 * h + q)
        same = stream[lo : hi - q] == stream[lo + q : hi]
        starts, ends = _stretches(same)
        # Stretches that hold one of the blocks caught, as words and not as hashes.
        block = np.maximum(lo + starts + (first - lo - starts) % h, first)
        holds = (block <= last) & (block + 2 * h <= lo + ends)
        for a, b in zip(starts[holds], ends[holds]):
            if b - a + q >= max(MIN_LENGTH, MIN_PERIODS * q):
                runs.append((lo + a, lo + b + q, q))
    return np.array(runs, dtype=np.int64).reshape(-1, 3)


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words a run (rows of start, length, period) repeats after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def runs(docs: DataFrame, rewrite: Callable[[int | None, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """The periodic runs of every whole text, and the text with each told once.

    Returns doc_id, n_words, starts, lengths, periods (of all runs, by start, then period) and
    collapsed (words joined by one blank, without those a run repeats). Words are what lies
    between ASCII white space. `rewrite(doc_id, words)` may change a text's words, given as
    numbers, before they are looked at. A null or blank text has no words and no runs; rows with
    repeated or null doc_ids are rows of their own; an empty table gives no rows; other columns
    are ignored. A text takes some 50 bytes a word in one task.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in text_batches(batches, BATCH_CHARS):
            known = Vocabulary()
            doc_ids = batch["doc_id"].astype("Int64").tolist()
            texts = [known.ids(text) for text in batch["text"]]
            if rewrite:
                texts = [rewrite(None if i is pd.NA else i, t) for i, t in zip(doc_ids, texts)]
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            order = np.argsort(-sizes, kind="stable")
            marks = len(known.numbers) + np.arange(len(texts))
            stream = np.concatenate([x for k, at in enumerate(order) for x in (texts[at], marks[k : k + 1])])
            caught = catch(stream, sizes[order])
            bounds = np.searchsorted(caught[:, 0], np.arange(len(texts) + 1))
            words, rows = known.words(), []
            for k, at in enumerate(order):
                own, ids = caught[bounds[k] : bounds[k + 1], 1:], texts[at]
                if len(own):
                    own = own[np.lexsort((own[:, 2], own[:, 0]))]
                    ids = ids[~dropped(own, len(ids))]
                kept = b" ".join(map(words.__getitem__, ids.tolist())).decode()
                rows.append((doc_ids[at], len(texts[at]), *own.T.tolist(), kept))
            names = ["doc_id", "n_words", "starts", "lengths", "periods", "collapsed"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_words long, starts array<long>, lengths array<long>, periods array<long>"
    return documents(docs).mapInPandas(find, f"{schema}, collapsed string")
