"""Packing as a cutting-stock problem, planned by column generation over the histogram of lengths.

Documents are tokenized once, in tasks, and cut at `size` tokens. What is planned is the histogram
(at most `size` counts, whatever the number of documents). Columns are patterns, the lengths that
one sequence holds; a sequence costs what it takes with its padding, so a power of two costs only
itself. The linear program over the patterns is solved by a simplex whose next pattern is found by
a knapsack over the lengths at their dual prices. Patterns without padding are used a whole number
of times; the few pieces that rounding leaves over are laid end to end and cut at the sequences'
ends, the last sequences being powers of two, so nothing is padded at all. Pieces then take their
places by their rank within their length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import documents, kept, segment_ranges, staged
from sedimenta.llm.packing import text_batches

# Fixed value: the id put behind a document so that its end can be seen.
END_ID = 0
# How such vocabularies part text into words, but for white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"

SIZE = 1024
BATCH_CHARS = 4_000_000
SEQUENCE_COST = 1.0  # tokens that a sequence is taken to cost beside its room
PIVOTS = 1_000  # steps of the simplex at most, whatever the corpus
CLOSE = 1e-3  # it ends when its cost is this near to the least there can be
_OTHER_SPACES = re.compile(r"[^\S ]")


class ByteTokens:
    """Ids of texts for a vocabulary of byte pairs, the same as the tokenizer's own.

    Where ids follow the order of merges, the vocabulary is used as ranks; and where no two white
    spaces meet, the split into words needs no look ahead, which halves its time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            ranks = _ranks(json.load(file))
        self.narrow = ranks and tiktoken.Encoding(
            "narrow", pat_str=WORDS + r"|\s", mergeable_ranks=ranks, special_tokens={}
        )
        self.wide = ranks and tiktoken.Encoding(
            "wide", pat_str=WORDS + r"|\s+(?!\S)|\s+", mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> list[int]:
        if not self.wide or "<|" in text:  # special tokens are the tokenizer's own matter
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return (self.wide if _spaces_meet(text) else self.narrow).encode_ordinary(text)

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, `end` behind each, and how many each text has."""
        ids, counts = array("I"), np.empty(len(texts), dtype=np.int64)
        for at, text in enumerate(texts):
            own = self.ids(text)
            own.append(end)
            ids.extend(own)
            counts[at] = len(own)
        return np.frombuffer(ids, dtype=np.uint32), counts


def _spaces_meet(text: str) -> bool:
    others = set(_OTHER_SPACES.findall(text))
    return "  " in text or any(f" {c}" in text or f"{c} " in text for c in others) or any(
        c + d in text for c in others for d in others
    )


def _ranks(told: dict) -> dict[bytes, int] | None:
    """A byte-pair vocabulary as ranks, or None where its ids do not follow its merges or it does
    more than split and merge."""
    plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if told.get("pre_tokenizer") != plain or told.get("normalizer"):
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocabulary, merges = told["model"]["vocab"], told["model"]["merges"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    order = [vocabulary["".join(pair)] for pair in pairs]
    if order != sorted(order) or len(vocabulary) != 256 + len(order):
        return None
    return {bytes(byte[c] for c in token): at for token, at in vocabulary.items()}


def tokens(path: str) -> ByteTokens:
    """One tokenizer per worker process, kept between tasks."""
    return kept(f"byte pairs of {path}", lambda: ByteTokens(path))


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """Every document's ids, an end id last, cut into pieces of `size` and a rest.

    `task` and `nth` number the pieces of each length as their task met them; the table must be
    written before it is used, so that all that reads it sees the same numbers.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, task = tokens(tokenizer), TaskContext.get().partitionId()
        met = np.zeros(size + 1, dtype=np.int64)
        for batch in text_batches(batches, BATCH_CHARS):
            ids, counts = words.encode(batch["text"].tolist(), END_ID)
            begins = np.cumsum(counts) - counts
            many = -(-counts // size)
            row = np.repeat(np.arange(len(counts)), many)
            start = size * segment_ranges(np.zeros(len(many)), many)
            length = np.minimum(size, counts[row] - start)
            order = np.argsort(length, kind="stable")
            firsts = np.searchsorted(length[order], length[order])
            nth = np.empty(len(length), dtype=np.int64)
            nth[order] = np.arange(len(length)) - firsts
            nth += met[length]
            met += np.bincount(length, minlength=size + 1)
            data, lo = ids.astype("<u4").tobytes(), 4 * (begins[row] + start)
            held = [data[a : a + 4 * n] for a, n in zip(lo.tolist(), length.tolist())]
            frame = {
                "doc_id": batch["doc_id"].astype("Int64").take(row).to_numpy(),
                "start": start,
                "length": length,
                "doc_tokens": counts[row],
                "ids_crc32": list(map(zlib.crc32, held)),
                "task": np.full(len(row), task),
                "nth": nth,
                # Only pieces that may be cut again keep their ids, in two bytes each where they fit.
                "ids": [None if n == 4 * size else narrowed(x) for x, n in zip(held, (4 * length).tolist())],
            }
            yield pd.DataFrame(frame).astype({"doc_id": "Int64"})

    schema = (
        "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, task long, nth long, ids binary"
    )
    return documents(docs).mapInPandas(cut, schema)


def narrowed(ids: bytes) -> bytes:
    """Ids as two-byte numbers where all of them fit; otherwise as they are, behind an odd byte."""
    values = np.frombuffer(ids, dtype="<u4")
    return values.astype("<u2").tobytes() if not len(values) or values.max() < 1 << 16 else b"\0" + ids


def widened(held: bytes) -> bytes:
    return held[1:] if len(held) % 2 else np.frombuffer(held, dtype="<u2").astype("<u4").tobytes()


def costs(size: int) -> np.ndarray:
    """What a sequence of each fill takes: `size`, but a power of two only itself."""
    cost = np.full(size + 1, float(size))
    powers = 1 << np.arange(size.bit_length())
    cost[powers[powers <= size]] = powers[powers <= size]
    return cost + SEQUENCE_COST


def knapsack(prices: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fill the dearest choice of lengths that adds up to it, and the last one taken."""
    best, last = np.full(size + 1, -np.inf), np.full(size + 1, -1)
    best[0] = 0.0
    for fill in range(1, size + 1):
        upto = int(np.searchsorted(lengths, fill, "right"))
        if upto:
            worth = best[fill - lengths[:upto]] + prices[:upto]
            at = int(np.argmax(worth))
            best[fill], last[fill] = worth[at], at if worth[at] > -np.inf else -1
    return best, last


def patterns(prices: np.ndarray, lengths: np.ndarray, size: int, cost: np.ndarray):
    """Patterns that pay at these prices, best first: (gain, places in `lengths`, times, fill).

    One knapsack prices them all: the dearest of each fill, and for each length the dearest full
    one that holds it.
    """
    best, last = knapsack(prices, lengths, size)
    whole, holding = best - cost, best[size - lengths] + prices - cost[size]
    whole[0] = -np.inf
    wanted = [(gain, fill, -1) for fill, gain in enumerate(whole.tolist()) if gain > 1e-7]
    wanted += [(gain, size - int(lengths[i]), i) for i, gain in enumerate(holding.tolist()) if gain > 1e-7]
    for gain, fill, held in sorted(wanted, reverse=True):
        taken, rest = [held] if held >= 0 else [], fill
        while rest:
            taken.append(int(last[rest]))
            rest -= int(lengths[last[rest]])
        at, times = np.unique(taken, return_counts=True)
        yield gain, at, times, int((lengths[at] * times).sum())


def first_basis(lengths: np.ndarray, counts: np.ndarray, size: int, cost: np.ndarray):
    """A basis to begin with: patterns that suit the long lengths are used, each until one of its
    lengths is gone, so that every pattern has a length that no later one holds."""
    m, left, open_ = len(lengths), counts.astype(np.float64), np.arange(len(counts))
    columns, uses, own = [], [], []
    while len(open_):
        prices = lengths[open_].astype(np.float64) ** 1.5
        gone = np.zeros(m, dtype=bool)
        for _, at, times, fill in patterns(prices, lengths[open_], size, np.where(cost > size, 0, np.inf)):
            at = open_[at]
            if fill != size or gone[at].any():
                continue
            limits = left[at] / times
            out = int(np.argmin(limits))
            columns.append((at, times))
            uses.append(limits[out])
            own.append(int(at[out]))
            left[at] = np.maximum(left[at] - limits[out] * times, 0.0)
            left[at[out]], gone[at[out]] = 0.0, True
        if not gone.any():  # what is open now fills no sequence: patterns of one length each
            for i in open_:
                columns.append((np.array([i]), np.array([size // lengths[i]])))
                uses.append(left[i] / (size // lengths[i]))
                own.append(int(i))
            break
        open_ = open_[~gone[open_]]
    return columns, np.array(uses), own


def inverted(columns, own: list[int]) -> np.ndarray:
    """The inverse of the first basis, which is triangular in the order of its patterns."""
    m = len(columns)
    inverse, held = np.zeros((m, m)), [[] for _ in range(m)]
    for k, (at, times) in enumerate(columns):
        for i, t in zip(at.tolist(), times.tolist()):
            held[i].append((k, t))
    for k, i in enumerate(own):  # length i is held by pattern k and by earlier ones alone
        inverse[k, i] = 1.0
        for other, t in held[i]:
            if other != k:
                inverse[k] -= t * inverse[other]
        inverse[k] /= next(t for other, t in held[i] if other == k)
    return inverse


def generate(lengths: np.ndarray, counts: np.ndarray, size: int = SIZE) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Solve the linear program: patterns (places in `lengths`, how many of each) and their uses."""
    m, cost = len(lengths), costs(size)
    columns, uses, own = first_basis(lengths, counts, size, cost)
    inverse = inverted(columns, own)
    basis = np.array([cost[int((lengths[at] * times).sum())] for at, times in columns])
    least = float((lengths * counts).sum()) * (1 + SEQUENCE_COST / size)
    left, paying = PIVOTS, True
    while paying and left > 0 and float((basis * uses).sum()) > least * (1 + CLOSE):
        prices, paying = (basis[:, None] * inverse).sum(axis=0), False
        for _, at, times, fill in patterns(prices, lengths, size, cost):
            gain = float((prices[at] * times).sum()) - cost[fill]
            if left <= 0 or gain <= 1e-7:
                continue
            change = (inverse[:, at] * times).sum(axis=1)
            up = change > 1e-9
            limits = np.full(m, np.inf)
            limits[up] = uses[up] / change[up]
            out = int(np.argmin(limits))
            if not np.isfinite(limits[out]):
                continue
            step = limits[out]
            uses = np.maximum(uses - step * change, 0.0)
            uses[out] = step
            row, rows = inverse[out] / change[out], np.flatnonzero(change)
            inverse[rows] -= np.outer(change[rows], row)
            inverse[out] = row
            prices -= gain * row
            columns[out], basis[out] = (at, times), cost[fill]
            paying, left = True, left - 1
    return [(at, times, float(use)) for (at, times), use in zip(columns, uses)]


@dataclass
class Plan:
    """Where ranks of each length go.

    `placed`: ranks from `first_rank` of a length go `each` to a sequence, from `sequence` on, at
    `offset` and behind each other. Ranks from `laid` on are laid end to end from `position`, and
    this row of tokens is cut at `size`, its rest (`tail`) at powers of two.
    """

    size: int
    placed: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    laid: dict[int, tuple[int, int]] = field(default_factory=dict)
    sequences: int = 0  # the first one of the row
    full: int = 0  # tokens of the row in whole sequences
    tail: list[int] = field(default_factory=list)


def plan(counts: dict[int, int], size: int = SIZE) -> Plan:
    """Whole uses of patterns without padding, then the pieces left over end to end."""
    made, left = Plan(size), {length: n for length, n in counts.items() if n}
    rank = dict.fromkeys(left, 0)
    if full := left.pop(size, 0):
        made.placed.append((size, 0, 1, 0, 0))
        made.sequences = full
    lengths = np.array(sorted(left), dtype=np.int64)
    solved = generate(lengths, np.array([left[n] for n in lengths], dtype=np.float64), size) if left else []

    def use(at: np.ndarray, times: np.ndarray, most: int) -> None:
        many = min([most, *(left[int(lengths[i])] // int(t) for i, t in zip(at, times))])
        if many <= 0:
            return
        offset = 0
        for i, t in zip(at, times):
            length, t = int(lengths[i]), int(t)
            made.placed.append((length, rank[length], t, made.sequences, offset))
            rank[length] += many * t
            left[length] -= many * t
            offset += length * t
        made.sequences += many

    dense = [(at, times, value) for at, times, value in solved if _unpadded(int((lengths[at] * times).sum()), size)]
    for at, times, value in dense:
        use(at, times, int(value + 1e-6))
    for at, times, value in sorted(dense, key=lambda x: x[2] % 1, reverse=True):
        use(at, times, 1)  # rounded up while pieces are left
    position = 0
    for length in sorted(left):
        if left[length]:
            made.laid[length] = (rank[length], position)
            position += length * left[length]
    made.full = position // size * size
    rest = position - made.full
    made.tail = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return made


def _unpadded(fill: int, size: int) -> bool:
    return fill == size or fill & (fill - 1) == 0


class Places:
    """A plan as arrays, to look up many ranks at once."""

    def __init__(self, made: Plan):
        rows = np.array(sorted(made.placed), dtype=np.int64).reshape(-1, 5)
        self.keys = (rows[:, 0] << 44) + rows[:, 1]
        self.rows, self.made = rows, made
        self.laid = np.full(made.size + 1, np.iinfo(np.int64).max)
        self.position = np.zeros(made.size + 1, dtype=np.int64)
        for length, (first, position) in made.laid.items():
            self.laid[length], self.position[length] = first, position
        self.tail = made.full + np.concatenate(([0], np.cumsum(made.tail))).astype(np.int64)

    def fixed(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces that stay whole."""
        at = np.searchsorted(self.keys, (length << 44) + rank, "right") - 1
        _, first, each, sequence, offset = self.rows[at].T
        nth = rank - first
        return sequence + nth // each, offset + nth % each * length

    def cut(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """A piece of the row as parts: begin and end within it, sequence, offset."""
        size, full = self.made.size, self.made.full
        at = int(self.position[length]) + (rank - int(self.laid[length])) * length
        end, begin, parts = at + length, at, []
        while at < end:
            if at < full:
                sequence, offset = divmod(at, size)
                upto = min(end, (sequence + 1) * size)
            else:
                k = int(np.searchsorted(self.tail, at, "right")) - 1
                sequence, offset = full // size + k, at - int(self.tail[k])
                upto = min(end, int(self.tail[k + 1]))
            parts.append((at - begin, upto - begin, self.made.sequences + sequence, offset))
            at = upto
        return parts


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens without padding.

    Returns a row per piece: doc_id, start (in its document), length, ids_crc32, doc_tokens (with
    the end id), sequence_id, offset. Every sequence is full but for at most log2(size) whose
    lengths are powers of two. A null or empty text is the end id alone; repeated rows and null
    doc_ids are packed as rows of their own; an empty table gives no rows; other columns are
    ignored. Which of several pieces of a length goes where depends on how the input is split.
    """
    if size & (size - 1):
        raise ValueError("the size of sequences must be a power of two")
    held = staged(pieces(docs, tokenizer, size), "pieces")
    counts = staged(held.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    # At most `size` rows reach the driver; the plan is some entries for each.
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    made = plan({row.length: row.n for row in histogram}, size)
    shared = docs.sparkSession.sparkContext.broadcast(made)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("length", "task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    # The first piece of each length that is cut again, by task and number; at most `size` rows.
    spark, kinds = docs.sparkSession, "length long, edge_rank long"
    edges = spark.createDataFrame([(k, first) for k, (first, _) in made.laid.items()], kinds)
    edges = ranks.join(F.broadcast(edges), "length").filter("edge_rank >= before and edge_rank < before + n")
    edges = [tuple(r) for r in edges.selectExpr("length", "task", "edge_rank - before").collect()]
    edges = spark.createDataFrame(edges, "length long, edge_task long, edge_nth long")
    marked = held.join(F.broadcast(edges), "length", "left")
    again = F.expr("coalesce(task > edge_task or task = edge_task and nth >= edge_nth, false)")
    columns = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "nth"]
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = Places(shared.value)
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["nth"].to_numpy() + batch["before"].to_numpy()
            batch["sequence_id"], batch["offset"] = places.fixed(length, rank)
            batch["doc_id"] = batch["doc_id"].astype("Int64")  # nulls stay nulls
            yield batch.drop(columns=["nth", "before"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = Places(shared.value)
        for batch in batches:
            rows = []
            for r in batch.astype({"doc_id": "Int64"}).itertuples():
                ids = widened(r.ids)
                for begin, end, sequence, offset in places.cut(r.length, r.nth + r.before):
                    crc = zlib.crc32(ids[4 * begin : 4 * end])
                    rows.append((r.doc_id, r.start + begin, end - begin, crc, r.doc_tokens, sequence, offset))
            names = [c.split()[0] for c in out.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    ranks = ranks.drop("n")
    whole = marked.filter(~again).join(ranks, ["length", "task"]).select(*columns, "before")
    parts = marked.filter(again).join(ranks, ["length", "task"]).select(*columns, "before", "ids")
    parts = parts.mapInPandas(cut, out)
    return whole.mapInPandas(place, out_of(out)).select(*parts.columns).unionByName(parts)


def out_of(schema: str) -> str:
    """The order in which `place` holds its columns."""
    kinds = dict(c.split() for c in schema.split(", "))
    names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "sequence_id", "offset"]
    return ", ".join(f"{name} {kinds[name]}" for name in names)
