"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad, judged by its own shape and by that of the lines next to it, and
neighbouring labels depend on each other. Training maximizes the conditional likelihood with the
document's label given to its lines; a document's quality is the mean of its lines' marginal
chances (forward-backward) weighted by their lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import DOC_ID, TEXT, documents, forget, lean, staged
from sedimenta.llm.toxicity import labelled

# Shares of bytes by class, then shares of words, then length and being first or last.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b".,;:'-", b"!?", b"|<>{}[]()/\\=_", b"*$%&#@~^+")
N_SHAPE = len(_CLASSES) + 6


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), dtype=np.uint8)
    for number, members in enumerate(_CLASSES):
        table[list(members)] = number
    return table


_TABLE = _class_table()


@dataclass(frozen=True)
class Training:
    """`rows` bounds the labelled documents that are learned from; each is used whole."""

    rows: int = 4000
    epochs: int = 30
    batch: int = 200
    rate: float = 0.1
    decay: float = 1e-4
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """Weights of "good" against "bad" (three lines' shapes and a constant), changes of label
    (2 x 2), and how shapes are put on one scale."""

    weights: np.ndarray
    change: np.ndarray
    mean: np.ndarray
    spread: np.ndarray


def shapes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shape of every line of the texts in a row, the lines' bytes, and lines per text."""
    lines, counts = [], []
    for text in texts:
        own = text.split("\n")
        lines += own
        counts.append(len(own))
    encoded = [line.encode("utf-8", "replace") + b"\n" for line in lines]
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    data = _TABLE[np.frombuffer(b"".join(encoded), np.uint8)]
    starts = np.cumsum(sizes) - sizes
    width = np.maximum(sizes - 1, 1)
    shape = np.zeros((len(lines), N_SHAPE), dtype=np.float32)
    for number in range(len(_CLASSES)):
        shape[:, number] = np.add.reduceat((data == number).astype(np.int32), starts) / width
    at = len(_CLASSES)
    for row, line in enumerate(lines):
        words = line.split()
        n = len(words)
        if n:
            shape[row, at] = len(set(words)) / n
            shape[row, at + 1] = sum(map(eq, words, words[1:])) / n
            shape[row, at + 2] = (sizes[row] - 1) / n / 10
    shape[:, at + 3] = np.log1p(sizes - 1) / 5
    ends = np.cumsum(counts)
    shape[ends - np.array(counts), at + 4] = 1
    shape[ends - 1, at + 5] = 1
    return shape, sizes, np.array(counts, dtype=np.int64)


def features(shape: np.ndarray, counts: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """A line's shape, that of the line before and after it in the document, and a constant."""
    scaled = (shape - mean) / spread
    ends = np.cumsum(counts)
    before = np.vstack([np.zeros((1, scaled.shape[1]), scaled.dtype), scaled[:-1]])
    after = np.vstack([scaled[1:], np.zeros((1, scaled.shape[1]), scaled.dtype)])
    before[ends - counts] = 0
    after[ends - 1] = 0
    return np.hstack([scaled, before, after, np.ones((len(scaled), 1), scaled.dtype)])


def marginals(good: np.ndarray, counts: np.ndarray, change: np.ndarray):
    """Chance of "good" for every line, and of each pair of labels summed over neighbours.

    Documents advance together, longest first, so each step works on those that still have
    lines; memory is in proportion to the lines. Messages are normalized at every step.
    """
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # documents with line t
    own = np.exp(np.clip(np.stack([np.zeros_like(good), good], 1), -60, 60))
    move = np.exp(change)
    forward = np.empty_like(own)
    for t in range(steps):
        at = starts[: active[t]] + t
        message = own[at] if t == 0 else own[at] * (forward[at - 1] @ move)
        forward[at] = message / message.sum(1, keepdims=True)
    backward = np.ones_like(own)
    pairs = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        later = own[at + 1] * backward[at + 1]
        joint = forward[at][:, :, None] * move * later[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        message = later @ move.T
        backward[at] = message / message.sum(1, keepdims=True)
    chance = forward * backward
    return chance[:, 1] / chance.sum(1), pairs


def learn(shape: np.ndarray, counts: np.ndarray, labels: np.ndarray, training: Training) -> Model:
    """Maximum conditional likelihood by Adam; without both labels, a prior that keeps."""
    n = 3 * N_SHAPE + 1
    weights, change = np.zeros(n), np.zeros((2, 2))
    positive = float(labels.sum())
    if not len(labels) or positive in (0, len(labels)):
        weights[-1] = np.log((positive + 2) / (len(labels) - positive + 1))
        return Model(weights, change, np.zeros(N_SHAPE), np.ones(N_SHAPE))
    mean, spread = shape.mean(0), shape.std(0) + 1e-3
    every = features(shape, counts, mean, spread)
    ends = np.cumsum(counts)
    rng = np.random.default_rng(training.seed)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (weights, change)]
    step = 0
    for epoch in range(training.epochs):
        rate = training.rate * (1 - epoch / training.epochs)
        order = rng.permutation(len(labels))
        for at in range(0, len(order), training.batch):
            docs = order[at : at + training.batch]
            x = np.concatenate([every[ends[d] - counts[d] : ends[d]] for d in docs])
            y = np.repeat(labels[docs], counts[docs])
            chance, pairs = marginals(x @ weights, counts[docs], change)
            for label in (0, 1):
                pairs[label, label] -= (counts[docs] - 1)[labels[docs] == label].sum()
            step += 1
            gradients = ((chance - y) @ x / len(x), pairs / len(x))
            for p, g, (m, v) in zip((weights, change), gradients, state):
                g = g + training.decay * p
                m[...] = 0.9 * m + 0.1 * g
                v[...] = 0.99 * v + 0.01 * g * g
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(weights, change, mean, spread)


def fit(docs: DataFrame, labels: DataFrame, in_training: Column, training: Training = Training()) -> Model:
    """Learn from rows of `labels.quality` for which `in_training` (on doc_id) holds."""

    @lean
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            if len(batch):
                shape, _, counts = shapes(batch["text"].tolist())
                parts = np.split(shape, np.cumsum(counts)[:-1])
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"],
                        "label": batch["label"],
                        "shape": [part.tobytes() for part in parts],
                    }
                )

    rows = labelled(docs, labels, "quality", in_training, training.rows)
    # Written in parallel, then read part by part.
    shaped = staged(rows.mapInPandas(lines, "doc_id long, label int, shape binary"), "shapes")
    found = shaped.toLocalIterator()
    found = sorted(found, key=lambda r: (r.doc_id, bytes(r.shape)))
    parts = [np.frombuffer(r.shape, np.float32).reshape(-1, N_SHAPE) for r in found]
    return learn(
        np.concatenate(parts) if parts else np.empty((0, N_SHAPE), np.float32),
        np.array([len(p) for p in parts], dtype=np.int64),
        np.array([r.label for r in found], dtype=np.int64),
        training,
    )


def judge(texts: list[str], model: Model) -> np.ndarray:
    """Length-weighted mean of the lines' chances of being good, for each text."""
    shape, sizes, counts = shapes(texts)
    x = features(shape, counts, model.mean, model.spread)
    chance, _ = marginals(x @ model.weights, counts, model.change)
    starts = np.cumsum(counts) - counts
    weight = sizes.astype(float)
    return np.add.reduceat(chance * weight, starts) / np.add.reduceat(weight, starts)


def scorer(spark: SparkSession, model: Model, at_once: int = 500) -> Callable[[Column], Column]:
    """A function of a text column: its score, 0 to 1, higher where good is likelier. A null or
    empty text is one empty line."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    @lean
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        for batch in batches:
            texts = batch.tolist()
            parts = [judge(texts[i : i + at_once], shared.value) for i in range(0, len(texts), at_once)]
            yield pd.Series(np.clip(np.concatenate([*parts, np.empty(0)]), 0, 1))

    return lambda text: scored(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `score` and `predicted` (1 if the score is 0.5 or more) for every row.

    Null or repeated ids and repeated rows are scored as any other; an empty table stays empty;
    other columns take no part.
    """
    scored = scorer(docs.sparkSession, model)(F.col(TEXT)).alias("score")
    rows = documents(docs).select(DOC_ID, scored)
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
