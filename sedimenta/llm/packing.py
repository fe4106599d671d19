"""Best-fit packing of tokenized documents by a plan over the histogram of lengths.

Documents are tokenized once, in tasks. What is planned is the histogram (at most `size` counts,
whatever the number of documents): best-fit decreasing works on counts, placing all pieces of a
length at a time into ranges of sequences with equal room. The plan is a table of a few entries
per length; every piece then takes its planned slot by its rank within its length.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import documents, gapless_rank, kept, lean, segment_ranges, staged

# Ids appended to a document so that its end can be seen.
END_ID = 1
CACHE_ENTRIES = 350_000
BATCH_CHARS = 4_000_000

# How the tokenizer cuts text into pieces before it merges bytes.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Characters that normalization leaves alone and that lower-case one by one.
_PLAIN = regex.compile(r"[\x21-\x7e\xa1-įı-ſ]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _pieces_of(word: str) -> list[str]:
    """The pieces of a word, in lower case; none where the tokenizer itself has to cut it."""
    if word.isascii() and word.isprintable() and word[:-1].isalpha():
        # Most words: letters, with at most one other character behind them.
        return [word.lower()] if word.isalpha() else [word[:-1].lower(), word[-1]]
    if _PLAIN.fullmatch(word) and "<|" not in word:
        return _PIECES.findall(word.lower())
    return []


class WordIds(dict):
    """Word to its place in one growing table of ids; a missing word is tokenized on demand.

    Pieces never reach across white space, so a text's ids are those of its words in a row.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.flat, self.starts = array("I"), array("q", [0])
        self.forget()

    def forget(self) -> None:
        """Drop the words not met since the last time; the others are taken over as they are met."""
        self.before = dict(self), self.flat, self.starts
        self.clear()
        self.flat, self.starts = array("I"), array("q", [0])

    def __missing__(self, word: str) -> int:
        known, flat, starts = self.before
        place = known.get(word)
        if place is not None:
            self.flat.extend(flat[starts[place] : starts[place + 1]])
            place = self[word] = len(self.starts) - 1
            self.starts.append(len(self.flat))
            return place
        pieces = _pieces_of(word)
        if len(pieces) == 1:
            piece = pieces[0]
            if piece != word:  # only its case differs, so it shares the place
                place = self[word] = self[piece]
                return place
            letters = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
            ids = [token.id for token in self.merge(letters)]
        elif pieces:  # a piece by itself is a word that is cut no further
            ids = array("I")
            for piece in pieces:
                place = self[piece]
                ids += self.flat[self.starts[place] : self.starts[place + 1]]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids if word else []
        self.flat.extend(ids)
        place = self[word] = len(self.starts) - 1
        self.starts.append(len(self.flat))
        return place

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and how many each text has."""
        if len(self) > CACHE_ENTRIES:
            self.forget()
        places, counts = array("q"), []
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            places.extend(map(self.__getitem__, words))
            counts.append(len(words))
        words = np.frombuffer(places, dtype=np.int64)
        starts = np.frombuffer(self.starts, dtype=np.int64)
        flat = np.frombuffer(self.flat, dtype=np.uint32) if self.flat else np.empty(0, np.uint32)
        lengths = starts[words + 1] - starts[words]
        ids = flat[segment_ranges(starts[words], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(counts)]
        return ids, np.diff(ends, prepend=0)


def encoder(path: str) -> WordIds:
    """One encoder per worker process, kept between tasks."""
    return kept(f"words of {path}", lambda: WordIds(path))


def text_batches(batches: Iterator[pd.DataFrame], chars: int) -> Iterator[pd.DataFrame]:
    """Cut batches so that each holds about `chars` of text at most, or one long text."""
    for batch in batches:
        part = (batch["text"].str.len().cumsum() // chars).to_numpy()
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
            if hi > lo:
                yield batch.iloc[lo:hi]


def pieces(docs: DataFrame, tokenizer: str, size: int) -> DataFrame:
    """Cut every document's ids, an end id last, into pieces of at most `size`."""

    @lean
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(tokenizer)
        for batch in text_batches(batches, BATCH_CHARS):
            ids, counts = words.encode(batch["text"].tolist())
            out, begin = [], 0
            for doc_id, count in zip(batch["doc_id"].array, counts):
                own = np.append(ids[begin : begin + count], np.uint32(END_ID)).astype("<u4")
                begin += count
                for number, start in enumerate(range(0, len(own), size)):
                    piece = own[start : start + size]
                    out.append((doc_id, number, start, len(piece), zlib.crc32(piece.tobytes())))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return documents(docs).mapInPandas(cut, schema)


def plan(counts: dict[int, int], size: int) -> pd.DataFrame:
    """Best-fit decreasing over counts.

    Returns rows (length, first_rank, many, first_sequence, offset): the pieces of that length
    with ranks from first_rank go, one each, to sequences from first_sequence at that offset.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges of sequences
    rows, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        fits = sorted(r for r in room if r >= length)
        while left and fits:  # the tightest first; what stays open may take one more
            best = fits[0]
            first, many = room[best].pop()
            if not room[best]:
                del room[best]
                fits.pop(0)
            take = min(left, many)
            rows.append((length, rank, take, first, size - best))
            if take < many:
                room.setdefault(best, []).append((first + take, many - take))
            if best - length:
                room.setdefault(best - length, []).append((first, take))
                if best - length >= length and best - length not in fits:
                    fits = sorted({*fits, best - length})
            rank, left = rank + take, left - take
        each = size // length
        full, rest = divmod(left, each)
        for many, height in ((full, each), (1 if rest else 0, rest)):
            for level in range(height if many else 0):
                rows.append((length, rank, many, sequences, level * length))
                rank += many
            if many and size - height * length:
                room.setdefault(size - height * length, []).append((sequences, many))
            sequences += many
    return pd.DataFrame(
        rows, columns=["length", "first_rank", "many", "first_sequence", "offset"], dtype="int64"
    )


def pack(docs: DataFrame, tokenizer: str, size: int = 4096) -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null
    or empty text is the end id alone; repeated rows and null doc_ids are packed as rows of their
    own; an empty table gives no rows; other columns are ignored. Ties in rank go by doc_id, piece
    and crc, so only indistinguishable pieces may change places.
    """
    cut = staged(pieces(docs, tokenizer, size), "pieces")
    histogram = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    # At most `size` rows reach the driver; the plan is some entries for each.
    planned = plan({row.length: row.n for row in histogram.collect()}, size)
    key = (planned["length"].to_numpy() << 44) + planned["first_rank"].to_numpy()
    order = np.argsort(key)
    table = planned.iloc[order].reset_index(drop=True)
    shared = docs.sparkSession.sparkContext.broadcast((key[order], table))

    @lean
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, slots = shared.value
        first = slots["first_sequence"].to_numpy() - slots["first_rank"].to_numpy()
        offset = slots["offset"].to_numpy()
        for batch in batches:
            rank = batch.pop("rank").to_numpy()
            at = np.searchsorted(keys, (batch["length"].to_numpy() << 44) + rank, "right") - 1
            batch["doc_id"] = batch["doc_id"].astype("Int64")  # nulls stay nulls
            yield batch.assign(sequence_id=first[at] + rank, offset=offset[at])

    ranked = gapless_rank(cut, "length", [F.col(c) for c in ("doc_id", "piece", "ids_crc32")], "rank")
    schema = cut.schema.simpleString()[7:-1].replace(":", " ") + ", sequence_id long, offset long"
    return ranked.mapInPandas(place, schema)
