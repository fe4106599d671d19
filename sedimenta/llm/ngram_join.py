"""Exact Jaccard self-join of documents' n-gram sets by prefix trees.

A radix pass over all n-grams counts how many of each set another set also holds; sets that share
too few for any link leave. The others are written in one global order, rare n-grams first, so two
sets that are alike enough share an n-gram among the first quarter of each. The order comes from
counts over all documents, kept in a table of `SLOTS` counters by hash; any fixed order gives the
same links, a good one fewer candidates. Candidates are verified by tries: a probe walks the trie of its partners' ordered
sets, branches share the overlap counted so far, and a branch is left as soon as what remains
cannot reach the threshold.

Only classes are asked for, so a group of n copies needs about n pairs: first every document is
compared with one leader for each shared n-gram, then only documents that still stand in
different classes are compared with each other. No pair of one class is lost by that, since it
could not change a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import digits
from sedimenta.llm.common import (
    DOC_ID,
    TEXT,
    components,
    documents,
    lean,
    membership,
    mix,
    segment_ranges,
    staged,
)
from sedimenta.llm.hashing import parts, powers

WORDS = 5
# Alike: 100 * |intersection| >= 75 * |union|, as parts of 4.
SIMILAR, OUT_OF = 3, 4
SLOTS = 1 << 18
BATCH_CHARS = 6_000_000
LONG_WORD = 32
PARTNERS = 400
RECORD, SETTLED, SHARED = 0, 1, 2

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of lower-cased texts in a row, ascending, and how many each has."""
    joined = b"\n".join([*texts, b""]).lower()
    data = np.frombuffer(joined, dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    word = np.concatenate(([False], ~_SPACE[data], [False]))
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    at = powers()
    hashes = mix(at.stretch(at.prefix(data), start, end), 11)
    # Sums of powers tell long words of a regular build apart badly; those are hashed by themselves.
    for k in np.flatnonzero(end - start > LONG_WORD):
        hashes[k] = xxhash.xxh3_64_intdigest(joined[start[k] : end[k]])
    doc = np.searchsorted(ends, start, side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    size = np.minimum(n_words, WORDS)  # shorter texts are one shingle
    first = np.cumsum(n_words) - n_words
    n = len(hashes)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        within = np.arange(n) - first[doc] + k < n_words[doc]
        part = mix(hashes[np.minimum(np.arange(n) + k, n - 1)] if n else hashes, 20 + k)
        rolled += np.where(within, part, np.uint64(k + 1))
    valid = np.arange(n) - first[doc] <= n_words[doc] - size[doc]
    token, doc = mix(rolled[valid], 12), doc[valid]
    order = np.lexsort((token, doc))
    token, doc = token[order], doc[order]
    new = digits.runs(doc, token)
    return token[new], np.bincount(doc[new], minlength=len(texts))


def _sets(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    texts = [t.encode("utf-8", "replace") for t in batch[TEXT]]
    found = [shingles(texts[lo:hi]) for lo, hi in parts([len(t) for t in texts])]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _nodes(token: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """One number for each set, the same for equal sets; an empty set is known by its document."""
    sums = np.zeros(len(token) + 1, dtype=np.uint64)
    np.cumsum(mix(token, 13), out=sums[1:])
    ends = np.cumsum(counts)
    total = sums[ends] - sums[ends - counts]
    return np.where(counts > 0, mix(total ^ mix(counts.astype(np.uint64), 14), 15), mix(codes, 16))


def _slot(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(64 - 18)).astype(np.int64)


def _survey(docs: DataFrame) -> DataFrame:
    """A row per document (doc_id, n, node), and the counters of each task (slot, count)."""

    @lean
    def survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(SLOTS, dtype=np.int64)
        for batch in digits.text_batches(batches, BATCH_CHARS):
            token, counts = _sets(batch)
            counters += np.bincount(_slot(token), minlength=SLOTS)
            node = _nodes(token, counts, digits.to_code(batch[DOC_ID].to_numpy()))
            yield pd.DataFrame(
                {DOC_ID: batch[DOC_ID], "n": counts, "node": node.view(np.int64), "slot": -1, "count": 0}
            )
        used = np.flatnonzero(counters)
        yield pd.DataFrame({DOC_ID: 0, "n": 0, "node": 0, "slot": used, "count": counters[used]})

    return docs.mapInPandas(survey, "doc_id long, n long, node long, slot int, count long")


def _ordered(token: np.ndarray, counts: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Each document's tokens in the global order, rare ones first."""
    doc = np.repeat(np.arange(len(counts)), counts)
    return token[np.lexsort((token, frequency[_slot(token)], doc))]


def _shared_counts(docs: DataFrame, n_tokens: int) -> DataFrame:
    """(node, n, shared): how many of a set's n-grams another set also holds, at least one row for
    every set that has some. A count may be above the truth where shortened hashes meet, never
    below it."""
    n_buckets, bits = digits.buckets_for(n_tokens), digits.bits_for(n_tokens)

    @lean
    def ship(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in digits.text_batches(batches, BATCH_CHARS):
            token, counts = _sets(batch)
            node = _nodes(token, counts, digits.to_code(batch[DOC_ID].to_numpy()))
            _, rows = np.unique(node, return_index=True)
            rows = np.sort(rows[counts[rows] > 0])
            if not len(rows):
                continue
            owner = np.repeat(np.arange(len(rows)), counts[rows])
            first = np.cumsum(counts) - counts
            key = digits.narrowed(mix(token[segment_ranges(first[rows], counts[rows])], 17), bits)
            order = np.argsort(key)
            key, owner = key[order], owner[order]
            group = np.cumsum(digits.runs(key)) - 1
            settled = (np.bincount(group) > 1)[group]
            shared = np.unique(key[settled])
            # What is settled here is one count per document, handed on by any bucket.
            here = np.bincount(owner[settled], minlength=len(rows))
            counted = np.flatnonzero(here)
            scattered = digits.narrowed(mix(np.arange(len(counted), dtype=np.uint64)), bits)
            kinds = [(RECORD, key[~settled], owner[~settled]), (SHARED, shared, 0 * shared), (SETTLED, scattered, counted)]
            yield digits.blobs(
                n_buckets,
                np.concatenate([k for _, k, _ in kinds]),
                np.concatenate([o.astype(np.int64) for _, _, o in kinds]),
                node[rows],
                counts[rows].astype(np.uint64),
                [np.concatenate([np.zeros(len(key) - settled.sum() + len(shared), np.int64), here[counted]])],
                np.concatenate([np.full(len(k), kind, np.uint64) for kind, k, _ in kinds]),
            )

    def settle(keys, nodes, sizes, more, kind, batch) -> pd.DataFrame:
        at = np.flatnonzero(kind == RECORD)
        at = at[np.lexsort((nodes[at], keys[at]))]
        at = at[digits.runs(keys[at], nodes[at])]
        group = np.cumsum(digits.runs(keys[at])) - 1
        several = (np.bincount(group) > 1)[group] if len(at) else np.empty(0, bool)
        at = at[several | np.isin(keys[at], keys[kind == SHARED])]
        handed = np.flatnonzero(kind == SETTLED)
        chosen = np.concatenate((handed, at))
        weight = np.concatenate((more[0][handed].astype(np.int64), np.ones(len(at), np.int64)))
        node, place = np.unique(nodes[chosen], return_inverse=True)
        size = np.zeros(len(node), dtype=np.int64)
        size[place] = sizes[chosen]
        shared = np.bincount(place, weight, len(node)).astype(np.int64)
        return pd.DataFrame({"node": node.view(np.int64), "n": size, "shared": shared})

    shipped = docs.mapInPandas(ship, digits.BLOB_SCHEMA)
    return digits.grouped(shipped, 1, settle, "node long, n long, shared long")


def _set_rows(docs: DataFrame, frequency) -> DataFrame:
    """(node, n, tokens) with the tokens in the global order."""

    @lean
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in digits.text_batches(batches, BATCH_CHARS):
            token, counts = _sets(batch)
            node = _nodes(token, counts, digits.to_code(batch[DOC_ID].to_numpy()))
            token = _ordered(token, counts, frequency.value)
            each = np.split(token, np.cumsum(counts)[:-1])
            yield pd.DataFrame(
                {"node": node.view(np.int64), "n": counts, "tokens": [t.tobytes() for t in each]}
            )

    return docs.mapInPandas(rows, "node long, n long, tokens binary")


def _prefixes(sets: DataFrame) -> DataFrame:
    """(token, node, n, at) for a quarter of each set's n-grams and one more, the rare ones, with
    their places: two sets that are similar meet there, as each holds three quarters of the
    larger one."""
    n = F.col("n")
    length = (n - F.ceil(n * SIMILAR / OUT_OF) + 1).cast("int")

    @lean
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lists = [np.frombuffer(t, np.int64)[:k] for t, k in zip(batch["tokens"], batch["length"])]
            if lists:
                each = [len(x) for x in lists]
                token = np.concatenate(lists)
                at = segment_ranges(np.zeros(len(each), np.int64), np.array(each))
                of = {c: np.repeat(batch[c].to_numpy(), each) for c in ("node", "n")}
                yield pd.DataFrame({"token": token, **of, "at": at})

    schema = "token long, node long, n long, at long"
    return sets.withColumn("length", length).mapInPandas(rows, schema)


def walk(probe: np.ndarray, partners: list[np.ndarray], step: int = 64) -> list[bool]:
    """Which partners are similar to the probe, by a walk over the trie of their ordered sets.

    Partners in lexicographic order are the trie depth first; the longest common prefix with the
    one before is the branch where a partner leaves it, and the overlap up to there is kept.
    """
    members = np.sort(probe)
    order = sorted(range(len(partners)), key=lambda i: partners[i].astype(">u8").tobytes())
    found = [False] * len(partners)
    path = np.empty(0, dtype=np.uint64)
    overlap = np.zeros(1, dtype=np.int64)  # tokens of the path's first i that the probe has
    known = 0  # how deep the overlap has been counted
    for i in order:
        own = partners[i]
        n = min(len(path), len(own))
        differ = np.flatnonzero(path[:n] != own[:n])
        depth = min(int(differ[0]) if len(differ) else n, known)
        counted = np.empty(len(own) + 1, dtype=np.int64)
        counted[: depth + 1] = overlap[: depth + 1]
        # |a and b| needed for |a and b| / |a or b| >= 3/4
        need = -(-SIMILAR * (len(probe) + len(own)) // (SIMILAR + OUT_OF))
        while depth < len(own):
            have = counted[depth]
            if have + min(len(own) - depth, len(probe) - have) < need:
                break
            block = own[depth : depth + step]
            at = np.searchsorted(members, block)
            hit = members[np.minimum(at, len(members) - 1)] == block
            counted[depth + 1 : depth + 1 + len(block)] = have + np.cumsum(hit)
            depth += len(block)
        found[i] = bool(depth == len(own) and counted[depth] >= need)
        path, overlap, known = own, counted, depth
    return found


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (probe, partner) that are similar.

    A probe's partners are cut into chunks of about PARTNERS, and chunks are dealt to cells of
    about as many pairs, so a probe that meets a third of all rows is walked in many tasks.
    """
    pairs = staged(pairs, "pairs")
    n_cells = max(digits.LEAST_BUCKETS, -(-pairs.count() // PARTNERS))
    degree = pairs.groupBy("probe").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("chunks"))
    chunk = F.pmod(F.xxhash64("partner"), F.col("chunks"))
    cell = F.pmod(F.xxhash64("probe", chunk), F.lit(n_cells)).cast("int").alias("cell")
    dealt = pairs.join(degree, "probe").select("probe", "partner", cell)
    partners = dealt.join(sets.select(F.col("node").alias("partner"), "tokens"), "partner")
    probes = dealt.select("probe", "cell").distinct()
    probes = probes.join(sets.select(F.col("node").alias("probe"), "tokens"), "probe")

    itself = F.col("probe").alias("partner")  # a probe's own set comes as its own partner
    walked = partners.select("cell", "probe", "partner", "tokens").unionByName(
        probes.select("cell", "probe", itself, "tokens")
    )

    def join(group: pd.DataFrame) -> pd.DataFrame:
        links = []
        for probe, rows in group.groupby("probe"):
            itself = rows["partner"] == probe
            if itself.any():
                sets_of = [np.frombuffer(t, np.uint64) for t in rows["tokens"][~itself]]
                similar = walk(np.frombuffer(rows["tokens"][itself].iloc[0], np.uint64), sets_of)
                links.append(rows.loc[~itself, ["probe", "partner"]][similar])
        return pd.concat(links) if links else group[["probe", "partner"]].iloc[:0]

    links = walked.groupBy("cell").applyInPandas(join, "probe long, partner long")
    return staged(links, "links")


def _may_link(n: Column, at: Column, o_n: Column, o_at: Column) -> Column:
    """Whether two sets that share the n-gram at these places, and none before, can be similar:
    what follows must hold the overlap needed. A pair that fails at its first common n-gram fails
    at all later ones, so every pair that can be similar passes somewhere."""
    return F.least(n - at, o_n - o_at) * (SIMILAR + OUT_OF) >= (n + o_n) * SIMILAR


# In a pair that may link, the n-gram stands within the first seventh of the smaller set: what
# follows it must hold 3/7 of both sets together.
_EARLY = "at * 7 <= n"


def join_classes(docs: DataFrame) -> DataFrame:
    """The class of every document under links between similar documents.

    Returns a row per row of `docs`: doc_id, n_shingles, component_id (smallest doc_id of the
    class). Words are cut at ASCII white space after lower-casing A-Z. Null and empty texts, and
    those of white space alone, have no shingles and are alone. Rows with equal sets are one
    class; a null doc_id stands behind all others. An empty table gives no rows; other columns
    are ignored. Sets are known by 64-bit hashes.
    """
    spark = docs.sparkSession
    text = documents(docs).withColumn(DOC_ID, F.coalesce(DOC_ID, F.lit(digits.NO_ID)))
    survey = staged(_survey(text), "survey")
    rows = survey.filter("slot < 0").select(DOC_ID, "n", "node")
    counted = survey.filter("slot >= 0").groupBy("slot").agg(F.sum("count").alias("count")).toPandas()
    counters = np.zeros(SLOTS, dtype=np.int64)  # SLOTS numbers, whatever the input
    counters[counted["slot"].to_numpy()] = counted["count"].to_numpy()
    frequency = spark.sparkContext.broadcast(counters)

    # A set with a similar partner shares three quarters of its n-grams; most sets end here.
    n_tokens = int(rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    held = _shared_counts(text, n_tokens).groupBy("node", "n").agg(F.sum("shared").alias("shared"))
    held = held.filter(F.col("shared") * OUT_OF >= F.col("n") * SIMILAR).select("node")
    needed = rows.join(held, "node", "left_semi").groupBy("node").agg(F.min(DOC_ID).alias(DOC_ID))
    needed = staged(needed, "needed")
    ids = needed.select(DOC_ID).distinct()
    # Most texts stop here instead of being shuffled to the exact test that follows.
    likely = text.filter(membership(ids, DOC_ID)(F.col(DOC_ID)))
    sets = _set_rows(likely.join(ids, DOC_ID, "left_semi"), frequency)
    sets = staged(sets.filter("n > 0"), "sets")
    shared = staged(_prefixes(sets), "prefixes")

    # Sizes in one band are compatible, so each member may be compared with the band's leader.
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(OUT_OF / SIMILAR)))
    banded = shared.withColumn("band", band)
    # A shared n-gram stands earliest in the set with the fewest rare ones of its own, such as the
    # text that others were copied from; that one is similar to more of them than they are to
    # each other.
    leader = F.min(F.struct(F.col("at") / F.col("n"), "node", "n", "at")).alias("leader")
    leaders = banded.filter(_EARLY).groupBy("token", "band").agg(leader)
    led = banded.join(leaders, ["token", "band"]).filter(
        (F.col("node") != F.col("leader.node"))
        & _may_link(F.col("n"), F.col("at"), F.col("leader.n"), F.col("leader.at"))
    )
    led = led.select(F.col("leader.node").alias("probe"), F.col("node").alias("partner"))
    pairs = staged(led.distinct(), "led")
    links = _verified(pairs, sets)
    classes = components(links, "probe", "partner")

    # N-grams whose documents stand in several classes: all but the largest class there are
    # compared with everything in other classes.
    members = shared.join(classes, "node", "left").select(
        "token", "node", "n", "at", F.coalesce("component", "node").alias("class")
    )
    members = staged(members, "members")
    per_class = members.groupBy("token", "class").agg(F.count(F.lit(1)).alias("size"))
    split = per_class.groupBy("token").agg(
        F.max(F.struct("size", "class"))["class"].alias("largest"), F.count(F.lit(1)).alias("classes")
    )
    split = members.join(split.filter("classes > 1"), "token")
    rest = F.col("class") != F.col("largest")
    names = ("node", "n", "at", "class")
    other = split.select("token", "largest", *[F.col(c).alias(f"o_{c}") for c in names])

    def across(small: DataFrame, large: DataFrame) -> DataFrame:
        small, large = small.select("token", *names), large.select("token", *[f"o_{c}" for c in names])
        met = small.join(large, "token").filter(
            (F.col("n") <= F.col("o_n"))
            & (F.col("class") != F.col("o_class"))
            & _may_link(*[F.col(c) for c in ("n", "at", "o_n", "o_at")])
        )
        least, most = F.least("node", "o_node"), F.greatest("node", "o_node")
        return met.select(least.alias("probe"), most.alias("partner"))

    early, others = split.filter(_EARLY), other.filter(F.col("o_class") != F.col("largest"))
    more = across(early.filter(rest), other).unionByName(across(early.filter(~rest), others))
    tested = pairs.select(
        F.least("probe", "partner").alias("probe"), F.greatest("probe", "partner").alias("partner")
    )
    more = _verified(more.distinct().join(tested, ["probe", "partner"], "left_anti"), sets)
    if not more.isEmpty():
        classes = components(links.unionByName(more), "probe", "partner")

    joined = rows.join(classes, "node", "left").select(
        DOC_ID, "n", F.coalesce("component", "node").alias("class")
    )
    least = joined.groupBy("class").agg(F.min(DOC_ID).alias("component_id"))
    real = lambda c: F.when(F.col(c) != digits.NO_ID, F.col(c)).alias(c)
    return joined.join(least, "class").select(
        real(DOC_ID), F.col("n").alias("n_shingles"), real("component_id")
    )


# The classes by brute force in the checking engine's SQL.
ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 5
    THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
      FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 75 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
                     UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""
