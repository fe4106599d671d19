"""Encoding into vocabulary pieces and back, with giant texts cut anywhere and solved in parallel.

Among all ways to cut a text into pieces the one with the largest sum of scores is taken (a
piece's score falls with the logarithm of its rank in the vocabulary). A text longer than `chunk`
characters is cut into chunks. What a chunk does is a matrix: the best score from each number of
characters that a piece reaches into the chunk to each number that one reaches beyond it. The
matrices combine associatively under (max, +), first in blocks and then over blocks, which tells
where every chunk's path enters and leaves; then each chunk is traced back by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import digits
from sedimenta.llm.common import DOC_ID, TEXT, documents, kept, segment_ranges, staged

SPACE = "▁"  # stands for a blank in pieces
CACHE_ENTRIES = 900_000
BLOCK = 256
NEVER = -np.inf


class Vocabulary:
    """Pieces with their ids and scores; characters without a piece are spelled in bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [0] * 256
        size = model.get_piece_size()
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = -float(np.log1p(-model.get_score(i)))
        self.byte_score = -float(np.log1p(size)) - 10.0
        self.reach = max(map(len, self.ids))  # the longest piece
        spelled = [b""] * size  # what each id stands for
        for piece, i in self.ids.items():
            spelled[i] = piece.replace(SPACE, " ").encode()
        for byte, i in enumerate(self.byte_ids):
            spelled[i] = bytes([byte])
        self.lengths = np.array([len(b) for b in spelled])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        # Every beginning of a piece, with the piece's score where it is one itself.
        self.beginnings: dict[str, float | None] = {}
        for piece in self.ids:
            for end in range(1, len(piece)):
                self.beginnings.setdefault(piece[:end], None)
            self.beginnings[piece] = self.scores[piece]
        self.inside = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        self.units = Units(self)

    def spelled(self, character: str) -> float | None:
        """Score of a character in bytes, for one that has no piece of its own."""
        return None if character in self.scores else self.byte_score * len(spelling(character))

    def trace(self, text: str) -> tuple[float, list[int]]:
        """Score and ids of the best way to cut `text`; of equal ones, the first that was found."""
        beginnings, n = self.beginnings, len(text)
        best, back = [0.0] + [NEVER] * n, [0] * (n + 1)
        for start in range(n):
            here = best[start]
            for end in range(start + 1, n + 1):
                score = beginnings.get(text[start:end], NEVER)
                if score is None:
                    continue
                if score == NEVER:
                    break
                if here + score > best[end]:
                    best[end], back[end] = here + score, start
            spelled = self.spelled(text[start])
            if spelled is not None and here + spelled > best[start + 1]:
                best[start + 1], back[start + 1] = here + spelled, start
        ids, end = [], n
        while end:
            start = back[end]
            piece = self.ids.get(text[start:end])
            if piece is None:
                ids += [self.byte_ids[b] for b in spelling(text[start])[::-1]]
            else:
                ids.append(piece)
            end = start
        return best[n], ids[::-1]

    def encode(self, marked: str) -> np.ndarray:
        """Ids of a text whose blanks are marked. No piece has a mark behind another character or
        holds a line break, so the units between those are solved, and remembered, one by one."""
        if len(self.units) > CACHE_ENTRIES:
            self.units.clear()
        return np.frombuffer(b"".join(map(self.units.__getitem__, units(marked))), dtype="<u4")

    def transfer(self, marked: str, n: int, shared: bool = True) -> np.ndarray:
        """Best scores from entry i to exit j of a chunk: `n` characters and what may follow.

        No piece reaches across the start of a unit, so all paths meet there. What they have in
        common between the first such place behind the entries and the last one is one number,
        added to every score; without `shared` it is left out, as it decides between no paths.
        """
        reach = self.reach
        best = np.full((n + reach, reach), NEVER)
        best[np.arange(reach), np.arange(reach)] = 0.0
        meet = meeting_places(marked, reach, n)
        at = 0
        while at < n:
            if meet and at == meet[0] < meet[1]:
                common = sum(self.trace(u)[0] for u in units(marked[at : meet[1]])) if shared else 0.0
                best[meet[1]] = best[at] + common
                at = meet[1]
                continue
            row = best[at]
            if np.isfinite(row).any():
                for length in range(1, min(reach, len(marked) - at) + 1):
                    score = self.scores.get(marked[at : at + length])
                    if score is None and length == 1:
                        score = self.spelled(marked[at])
                    if score is not None:
                        np.maximum(best[at + length], row + score, out=best[at + length])
            at += 1
        return best[n:].T.copy()

    def decode(self, ids: np.ndarray) -> bytes:
        return self.letters[segment_ranges(self.starts[ids], self.lengths[ids])].tobytes()


def starts_unit(marked: str, at: int) -> bool:
    """Where no piece can reach across: a mark behind another character, and line breaks."""
    here, before = marked[at], marked[at - 1]
    return here == "\n" or before == "\n" or (here == SPACE and before != SPACE)


def meeting_places(marked: str, low: int, high: int) -> tuple[int, int] | None:
    """The first and the last start of a unit from `low` to `high`."""
    high = min(high, len(marked) - 1)
    first = next((at for at in range(max(low, 1), high + 1) if starts_unit(marked, at)), None)
    if first is None:
        return None
    return first, next(at for at in range(high, first - 1, -1) if starts_unit(marked, at))


def units(marked: str) -> list[str]:
    """The text cut where no piece can reach across."""
    out = []
    for number, line in enumerate(marked.split("\n")):
        if number:
            out.append("\n")
        first, *words = line.split(SPACE)
        if first:
            out.append(first)
        if "" not in words:
            out += [SPACE + word for word in words]
            continue
        blanks = 0  # marks in a row belong to the word behind them
        for word in words:
            blanks += 1
            if word:
                out.append(SPACE * blanks + word)
                blanks = 0
        if blanks:
            out.append(SPACE * blanks)
    return out


class Units(dict):
    """Ids of units as bytes, worked out once."""

    def __init__(self, words: Vocabulary):
        super().__init__()
        self.words = words

    def __missing__(self, unit: str) -> bytes:
        # Two characters that stand together in no piece part a unit; most often a full stop does.
        inside = self.words.inside
        cuts = [k for k in range(1, len(unit)) if unit[k - 1 : k + 1] not in inside]
        if cuts:
            ids = b"".join(self[unit[lo:hi]] for lo, hi in zip([0, *cuts], [*cuts, len(unit)]))
        else:
            ids = np.array(self.words.trace(unit)[1], dtype="<u4").tobytes()
        self[unit] = ids
        return ids


# Stands for a mark that the text itself holds. Half a surrogate pair occurs in no text.
OWN_MARK = "\ud801"


def spelling(character: str) -> bytes:
    return (SPACE if character == OWN_MARK else character).encode("utf-8", "replace")


def mark(text: str, first: bool) -> str:
    """Blanks as marks, one more in front of a document; marks of the text itself set apart."""
    marked = text.replace(SPACE, OWN_MARK).replace(" ", SPACE)
    return SPACE + marked if first else marked


def vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    return kept(f"pieces of {path}", lambda: Vocabulary(path))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two matrices under (max, +)."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def path_through(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """States before, between and after the matrices on the best path."""
    vectors = [np.full(len(matrices[0]), NEVER)]
    vectors[0][entry] = 0.0
    for matrix in matrices:
        vectors.append((vectors[-1][:, None] + matrix).max(0))
    states = [leave]
    for vector, matrix in zip(vectors[-2::-1], matrices[::-1]):
        states.append(int((vector + matrix[:, states[-1]]).argmax()))
    return states[::-1]


def _chunks(text: str, chunk: int, reach: int) -> Iterator[tuple[int, str, int]]:
    """Number, characters with those that may follow, and how many are the chunk's own."""
    for number, start in enumerate(range(0, max(len(text), 1), chunk)):
        yield number, text[start : start + chunk + reach], min(chunk, len(text) - start)


def encode(docs: DataFrame, model: str, chunk: int = 32_768) -> DataFrame:
    """Encode every document; longer ones than `chunk` characters in chunks.

    Returns a row per chunk: doc_id, chunk, start and length (characters of the text that its ids
    spell), n_ids and ids (little-endian 32-bit numbers in a row). The chunks of a document, in
    order, spell it exactly. A null or empty text has the one piece that stands in front of every
    text; null or repeated ids and repeated rows are rows of their own; an empty table gives no
    rows; other columns are ignored.
    """
    # Equal rows have equal chunks and may share one path; others with an id are told apart.
    text = documents(docs).withColumn("row", F.xxhash64(F.coalesce(DOC_ID, F.lit(0)), TEXT))
    giant = F.length(TEXT) > chunk
    reach = vocabulary(model).reach

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[DOC_ID, "chunk", "start", "length", "n_ids", "ids"])
        return out.assign(doc_id=out[DOC_ID].astype("Int64"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(model)
        for batch in digits.text_batches(batches, 2_000_000):
            rows = []
            for doc_id, own in zip(batch[DOC_ID].astype("Int64"), batch[TEXT]):
                ids = words.encode(mark(own, True))
                rows.append((doc_id, 0, 0, len(own), len(ids), ids.tobytes()))
            yield frame(rows)

    def parted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, row, own in zip(batch[DOC_ID].astype("Int64"), batch["row"], batch[TEXT]):
                # Some 200 chunks at a time, however long the text is.
                found = _chunks(own, chunk, reach)
                while some := list(islice(found, 200)):
                    part = pd.DataFrame(some, columns=["chunk", "own", "n"]).assign(row=row, doc_id=doc_id)
                    yield part.astype({DOC_ID: "Int64"})[[DOC_ID, "row", "chunk", "own", "n"]]

    def transfers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(model)
        for batch in batches:
            for r in batch.itertuples():
                first = r.chunk == 0
                matrix = words.transfer(mark(r.own, first), r.n + first, shared=False)
                yield pd.DataFrame(
                    {"row": [r.row], "block": [r.chunk // BLOCK], "chunk": [r.chunk], "matrix": [matrix.tobytes()]}
                )

    def matrices(group: pd.DataFrame) -> list[np.ndarray]:
        found = [np.frombuffer(m) for m in group["matrix"]]
        side = int(np.sqrt(len(found[0])))
        return [m.reshape(side, side) for m in found]

    def product(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk").drop_duplicates("chunk")
        each = matrices(group)
        total = each[0]
        for matrix in each[1:]:
            total = combine(total, matrix)
        return pd.DataFrame({"row": group["row"][:1], "block": group["block"][:1], "matrix": [total.tobytes()]})

    def through_blocks(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        states = path_through(matrices(group), 0, 0)
        return pd.DataFrame({"row": group["row"], "block": group["block"], "enters": states[:-1], "leaves": states[1:]})

    def through_chunks(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk").drop_duplicates("chunk")
        states = path_through(matrices(group), int(group["enters"].iloc[0]), int(group["leaves"].iloc[0]))
        return pd.DataFrame({"row": group["row"], "chunk": group["chunk"], "enters": states[:-1], "leaves": states[1:]})

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(model)
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                first = r.chunk == 0
                marked = mark(r.own, first)
                ids = words.encode(marked[r.enters : r.n + first + r.leaves])
                start = r.chunk * chunk + r.enters
                rows.append((r.doc_id, r.chunk, start, r.n + r.leaves - r.enters, len(ids), ids.tobytes()))
            out = frame(rows)
            yield out

    schema = "doc_id long, chunk int, start long, length long, n_ids long, ids binary"
    short = text.filter(~giant).select(DOC_ID, TEXT).mapInPandas(whole, schema)
    long = text.filter(giant)
    chunks = long.select(DOC_ID, "row", TEXT).mapInPandas(parted, "doc_id long, row long, chunk int, own string, n int")
    # Chunks of one text go to many tasks, for their matrices as well as for their paths.
    chunks = staged(chunks.repartition("row", "chunk"), "chunks")
    matrix = chunks.drop(DOC_ID).mapInPandas(transfers, "row long, block int, chunk int, matrix binary")
    matrix = staged(matrix, "transfers")
    key = "row long, block int, enters int, leaves int"
    blocks = matrix.groupBy("row", "block").applyInPandas(product, "row long, block int, matrix binary")
    ends = blocks.groupBy("row").applyInPandas(through_blocks, key)
    inside = matrix.join(ends, ["row", "block"]).groupBy("row", "block")
    states = inside.applyInPandas(through_chunks, "row long, chunk int, enters int, leaves int")
    return short.unionByName(chunks.join(states, ["row", "chunk"]).mapInPandas(traced, schema))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Texts of encoded chunks: adds `text` to doc_id, chunk, start, length, n_ids and ids."""

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(model)
        for batch in batches:
            texts = []
            for number, ids in zip(batch["chunk"], batch["ids"]):
                own = words.decode(np.frombuffer(ids, dtype="<u4"))
                texts.append((own[1:] if number == 0 else own).decode("utf-8", "replace"))
            yield batch.assign(doc_id=batch[DOC_ID].astype("Int64"), text=texts)

    schema = "doc_id long, chunk int, start long, length long, n_ids long, ids binary, text string"
    columns = encoded.select(DOC_ID, "chunk", "start", "length", "n_ids", "ids")
    return columns.mapInPandas(spell, schema)
