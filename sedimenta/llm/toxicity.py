"""Toxicity by subword embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams and of itself, a document the mean of
its words, and both the vectors and the softmax over them are learned together. Unseen spellings
share n-grams with seen ones. N-grams that are about as frequent under either label keep a vector
of zero, as they could only learn single documents by heart. Since the model is linear after
training, a word has one score, so scoring a text looks up its words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import DOC_ID, TEXT, documents, kept, lean, staged

WORD = re.compile(r"[^\W_]+")
BUCKETS = 1 << 20
SHORTEST, LONGEST = 3, 6
CACHE_ENTRIES = 300_000
CACHED_SCORES = 200_000


@dataclass(frozen=True)
class Training:
    """`rows` bounds the labelled rows that are learned from; a text is used whole. An n-gram has
    a vector if at least `seen` documents hold it and its shares under the two labels differ by
    `apart` standard errors."""

    rows: int = 20_000
    seen: int = 5
    apart: float = 4.0
    dimensions: int = 8
    epochs: int = 10
    steps: int = 800  # at least, on a small sample
    batch: int = 64
    rate: float = 0.1
    decay: float = 1e-5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Learned: `subword` holds each n-gram's part of the log odds, `bias` the rest."""

    subword: np.ndarray
    bias: float


def subwords(word: str) -> list[int]:
    """Buckets of the word and of its character n-grams, with marks at both ends."""
    marked = f"<{word}>"
    plain = marked.isascii()
    if plain:
        marked = marked.encode()
    grams = [marked]
    for n in range(SHORTEST, LONGEST + 1):
        grams += [marked[i : i + n] for i in range(len(marked) - n + 1)]
    if not plain:
        grams = [g.encode("utf-8", "replace") for g in grams]
    return [zlib.crc32(g) % BUCKETS for g in grams]


class Subwords(dict):
    """Buckets of words, worked out once and kept within a bound."""

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        self[word] = found = np.array(subwords(word), np.int32)
        return found


def bag(text: str, known: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """A text as a mean over words of means over their subwords: buckets and their shares."""
    counts = Counter(WORD.findall(text.lower()))
    if not counts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    buckets = [known[word] for word in counts]
    sizes = np.fromiter(map(len, buckets), np.int64, len(buckets))
    weight = np.fromiter(counts.values(), np.float64, len(sizes)) / (counts.total() * sizes)
    found, place = np.unique(np.concatenate(buckets), return_inverse=True)
    return found, np.bincount(place, np.repeat(weight, sizes)).astype(np.float32)


def labelled(docs: DataFrame, labels: DataFrame, label: str, in_training: Column, rows: int) -> DataFrame:
    """At most `rows` documents with a label of 0 or 1, chosen by a hash of their id.

    The chosen ids are bounded by `rows`, so they are broadcast to the scan of the documents.
    Null or other labels and ids take no part; of conflicting labels the larger counts.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & in_training)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return documents(docs).join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, in_training: Column, training: Training = Training()) -> Model:
    """Learn from rows of `labels.toxic` for which `in_training` (on doc_id) holds."""

    sample = staged(labelled(docs, labels, "toxic", in_training, training.rows), "sample")

    @lean
    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, words = np.zeros((2, BUCKETS), dtype=np.int64), Subwords()
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                held[label, bag(text, words)[0]] += 1
        bucket = np.flatnonzero(held.any(0))
        yield pd.DataFrame({"bucket": bucket, "n0": held[0, bucket], "n1": held[1, bucket]})

    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("n1")).first()
    with_it, without = max(totals.n1, 1), max(totals.n - totals.n1, 1)
    share = (F.col("n0") + F.col("n1")) / max(totals.n, 1)
    error = F.sqrt(share * (1 - share) * (1 / with_it + 1 / without)) + 1e-9
    differs = F.abs(F.col("n1") / with_it - F.col("n0") / without) >= training.apart * error
    counts = sample.mapInPandas(seen, "bucket int, n0 long, n1 long").groupBy("bucket")
    counts = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    kept = counts.filter((F.col("n0") + F.col("n1") >= training.seen) & differs).select("bucket")
    known = np.zeros(BUCKETS, dtype=bool)
    known[kept.toPandas()["bucket"].to_numpy().astype(np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @lean
    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Subwords()
        for batch in batches:
            both = [bag(text, words) for text in batch["text"]]
            keep = [shared.value[buckets] for buckets, _ in both]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "buckets": [b[k].tobytes() for (b, _), k in zip(both, keep)],
                    "shares": [s[k].tobytes() for (_, s), k in zip(both, keep)],
                }
            )

    schema = "doc_id long, label int, buckets binary, shares binary"
    # Written in parallel, then read part by part.
    found = staged(sample.mapInPandas(bags, schema), "bags").toLocalIterator()
    found = sorted(found, key=lambda r: (r.doc_id, bytes(r.buckets)))
    model = learn(
        [np.frombuffer(r.buckets, np.int32) for r in found],
        [np.frombuffer(r.shares, np.float32) for r in found],
        np.array([r.label for r in found], np.float32),
        training,
    )
    return Model(np.where(known, model.subword, 0).astype(np.float32), model.bias)


def learn(buckets: list, shares: list, labels: np.ndarray, training: Training) -> Model:
    """Joint gradient descent (Adam) on vectors and softmax; without rows, a low prior."""
    positive = float(labels.sum())
    bias = np.log((positive + 1) / (len(labels) - positive + 2))
    if not len(labels) or positive in (0, len(labels)):
        return Model(np.zeros(BUCKETS, np.float32), float(bias))
    rng = np.random.default_rng(training.seed)
    d = training.dimensions
    vectors = rng.uniform(-1 / d, 1 / d, (BUCKETS, d)).astype(np.float32)
    softmax = rng.normal(0, 1, (d, 2)).astype(np.float32)
    offsets = np.array([0, bias], np.float32)
    parameters = [vectors, softmax, offsets]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    step = 0
    epochs = max(training.epochs, training.steps * training.batch // len(labels))
    for epoch in range(epochs):
        rate = training.rate * (1 - epoch / epochs)
        order = rng.permutation(len(labels))
        for at in range(0, len(order), training.batch):
            rows = order[at : at + training.batch]
            sizes = [len(buckets[r]) for r in rows]
            idx = np.concatenate([buckets[r] for r in rows])
            share = np.concatenate([shares[r] for r in rows])[:, None]
            of = np.repeat(np.arange(len(rows)), sizes)
            hidden = np.stack(
                [np.bincount(of, vectors[idx, k] * share[:, 0], len(rows)) for k in range(d)], 1
            ).astype(np.float32)
            logits = hidden @ softmax + offsets
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            error = chance.copy()
            error[np.arange(len(rows)), labels[rows].astype(int)] -= 1
            error /= len(rows)
            back = (error @ softmax.T)[of] * share
            touched, place = np.unique(idx, return_inverse=True)
            grown = np.stack([np.bincount(place, back[:, k], len(touched)) for k in range(d)], 1)
            step += 1
            gradients = [grown.astype(np.float32), hidden.T @ error, error.sum(0)]
            for which, (p, g, (m, v)) in enumerate(zip(parameters, gradients, moments)):
                rows_of = touched if which == 0 else slice(None)
                g = g + training.decay * p[rows_of]
                m[rows_of] = 0.9 * m[rows_of] + 0.1 * g
                v[rows_of] = 0.99 * v[rows_of] + 0.01 * g * g
                mean, var = m[rows_of] / (1 - 0.9**step), v[rows_of] / (1 - 0.99**step)
                p[rows_of] -= rate * mean / (np.sqrt(var) + 1e-8)
    direction = softmax[:, 1] - softmax[:, 0]
    return Model(vectors @ direction, float(offsets[1] - offsets[0]))


class WordScores(dict):
    """A word's part of the log odds, worked out once and kept within a bound.

    Once there are too many, those not met again until the next time are dropped, so that a worker
    process holds few rare words and still knows the frequent ones.
    """

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.before = model, {}

    def __missing__(self, word: str) -> float:
        score = self.before.get(word)
        if score is None:
            score = float(self.model.subword[subwords(word)].mean())
        self[word] = score
        return score

    def score(self, text: str) -> float:
        if len(self) > CACHED_SCORES:
            self.before = dict(self)
            self.clear()
        words = WORD.findall(text.lower())
        odds = self.model.bias + (sum(map(self.__getitem__, words)) / len(words) if words else 0.0)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def word_scores(name: str, model: Model) -> WordScores:
    """The scores of the words met so far, kept between the tasks of a worker process for the
    model in use."""
    return kept(name, lambda: WordScores(model))


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function of a text column: its score, 0 to 1, higher where toxic is likelier. A null or
    empty text gets the score of the bias alone."""
    shared, name = spark.sparkContext.broadcast(model), uuid4().hex

    @F.pandas_udf("double")
    @lean
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = word_scores(name, shared.value)
        for texts in batches:
            yield pd.Series([words.score(text) for text in texts], dtype="float64")

    return lambda text: scored(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `score` and `predicted` (1 if the score is 0.5 or more) for every row.

    Null or repeated ids and repeated rows are scored as any other; an empty table stays empty;
    other columns take no part.
    """
    scored = scorer(docs.sparkSession, model)(F.col(TEXT)).alias("score")
    rows = documents(docs).select(DOC_ID, scored)
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
