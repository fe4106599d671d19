"""License scans: phrases, and an exact set-similarity join of text blocks with notice templates.

DataFrame functions only. A block is a line, or a run of consecutive words that may cross lines and
is as long as a template allows. It meets a template where it holds at least `CONTAINMENT` of the
template's distinct words, or all of them if they are few. Template words are ordered by their
frequency over all documents, rare ones first; a block that meets a template holds one of the
template's first few words, so only lines with such a word are joined (prefix filter), only if they
have enough template words at all (length filter) and enough after the word that matched
(positional filter). Runs are looked at where such a word stands, if what surrounds it has enough
template words.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import staged

# Words, phrases and labels of the scan.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices, one template each.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
CONTAINMENT = (4, 5)
# Templates of so few distinct words say nothing with one of them missing.
SHORT = 5


def needed(n_words: int) -> int:
    """Words of a template that make `CONTAINMENT` of it."""
    part, of = CONTAINMENT
    return -(-n_words * part // of)


def asked(n_words: int) -> int:
    """Words of a template that a block must hold."""
    return n_words if n_words <= SHORT else needed(n_words)


def span(n_words: int) -> int:
    """Words of the longest run of which a template of `n_words` (repeats count) makes `CONTAINMENT`."""
    part, of = CONTAINMENT
    return n_words * of // part


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _places(phrase: str, spaced: Column, n_words: Column) -> tuple[Column, Column, Column]:
    """How often a phrase stands in the words, and its first and last start. `spaced` has every
    word between two blanks of its own."""
    words = phrase.split(" ")
    pattern = "".join(f" {w} " for w in words)
    has = F.contains(spaced, F.lit(pattern))
    # A look-ahead counts places that overlap as well.
    count = F.regexp_count(spaced, F.lit(f"(?={re.escape(pattern)})"))

    def before(text: Column, wanted: str) -> Column:
        prefix = F.substring_index(text, wanted, 1)
        return F.floor((F.length(prefix) - F.length(F.replace(prefix, F.lit(" "), F.lit("")))) / 2)

    first = before(spaced, pattern)
    last = n_words - before(F.reverse(spaced), pattern[::-1]) - len(words)
    return F.when(has, count).otherwise(0), F.when(has, first), F.when(has, last)


def _held(template: Column, words: Column) -> Column:
    """Most of a template's words that one run of the words holds; null where none meets it.

    Every run that holds one of the template's first few words is covered.
    """
    length, need = template["span"], template["need"]

    def share(start: Column, size: Column) -> Column:
        return F.size(F.array_intersect(template["words"], F.slice(words, start, size)))

    def first(place: Column) -> Column:
        return F.greatest(place - length + 1, F.lit(1))

    def best(place: Column) -> Column:
        return F.array_max(F.transform(F.sequence(first(place), place), lambda start: share(start, length)))

    places = F.transform(words, lambda w, i: F.when(F.array_contains(template["prefix"], w), i + 1))
    places = F.filter(F.array_compact(places), lambda p: share(first(p), p - first(p) + length) >= need)
    return F.array_max(F.filter(F.transform(places, best), lambda n: n >= need))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Places of phrases and notices may cross lines. `score` is 1 where a phrase stands, else the
    largest share of a template held by one line or run that meets it, else 0. A null text is empty and has no words;
    null or repeated ids and repeated rows are rows of their own; an empty table gives no rows;
    other columns are ignored.
    """
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered.alias("text"))

    notices = [(label, re.findall(WORD, template)) for label, template in templates]
    sets = [(label, sorted(set(words)), span(len(words))) for label, words in notices]
    vocabulary = sorted({w for _, words, _ in sets for w in words})
    # A count for each template word, whatever the size of the corpus.
    counted = text.select(F.explode(F.array_intersect(_strings(vocabulary), _words(F.col("text")))).alias("word"))
    frequency = {r.word: r.n for r in counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows, prefix_words, specs = [], set(), []
    for number, (label, words, length) in enumerate(sets):
        words, need = sorted(words, key=rank.get), asked(len(words))
        first = words[: len(words) - need + 1]
        for place, word in enumerate(first):
            rows.append((word, number, label, place, len(words), need, words))
            prefix_words.add(word)
        spec = {"label": label, "size": len(words), "need": need, "span": length}
        lists = [_strings(words).alias("words"), _strings(first).alias("prefix")]
        specs.append(F.struct(*[F.lit(v).alias(k) for k, v in spec.items()], *lists))
    schema = "word string, template int, label string, place int, size int, need int, words array<string>"
    prefixes = docs.sparkSession.createDataFrame(rows, schema)  # a few rows per template

    words = text.select("doc_id", "text", _words(F.col("text")).alias("words"))
    words = words.withColumn("held", F.array_intersect(_strings(order), F.col("words")))
    # The templates that the whole text has enough words of; most texts have none.
    may = F.lit(False)
    for _, names, _ in sets:
        may = may | (F.size(F.array_intersect(_strings(names), F.col("held"))) >= asked(len(names)))
    words = words.withColumn("may", may)
    spaced = F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))
    some = "|".join(sorted(prefix_words)) or "$^"
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(some))
    blocks = F.transform(lines, lambda line: F.array_intersect(_strings(order), _words(line)))
    blocks = F.when(F.col("may"), blocks).otherwise(F.array().cast("array<array<string>>"))
    least = min((need for *_, need, _ in rows), default=1)
    # A text of one line holds no run that its line does not hold.
    kind = "struct<label:string,size:int,need:int,span:int,words:array<string>,prefix:array<string>>"
    likely = F.filter(F.array(*specs).cast(f"array<{kind}>"), lambda t: F.size(F.array_intersect(t["words"], F.col("held"))) >= t["need"])
    runs = F.transform(
        likely,
        lambda t: F.struct(
            t["label"].alias("label"), (_held(t, F.col("words")) / t["size"]).alias("share")
        ),
    )
    runs = F.when(F.col("may") & F.contains("text", F.lit("\n")), F.filter(runs, lambda r: r["share"].isNotNull()))
    words = words.select(
        "doc_id", F.size("words").alias("n_words"), spaced.alias("spaced"), blocks.alias("blocks"), runs.alias("runs")
    )
    found = [(label, *_places(phrase, F.col("spaced"), F.col("n_words"))) for phrase, label in phrases.items()]
    scanned = words.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        sum((n for _, n, _, _ in found), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.array(*[f for _, _, f, _ in found])).cast("long").alias("first_word"),
        F.array_max(F.array(*[f for _, _, _, f in found])).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for label, n, _, _ in found]))).alias("base"),
        F.filter("blocks", lambda b: F.size(b) >= least).alias("blocks"),
        "runs",
    )
    scanned = staged(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")

    block = scanned.select("row", F.posexplode("blocks").alias("line", "block"))
    tokens = block.select("row", "line", "block", F.posexplode("block").alias("at", "word"))
    size, remaining = F.size("block"), F.least(F.col("size") - F.col("place"), F.size("block") - F.col("at"))
    candidates = tokens.join(F.broadcast(prefixes), "word").filter(
        (size >= F.col("need")) & (F.least("place", "at") + remaining >= F.col("need"))
    )
    shared = F.size(F.array_intersect("block", "words"))
    met = candidates.filter(shared >= F.col("need")).select("row", "label", (shared / F.col("size")).alias("share"))
    met = met.unionByName(scanned.select("row", F.inline("runs")))
    met = met.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    joined = scanned.join(met, "row", "left")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", _strings([])))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def oracle_sql(phrases: dict[str, str] = PHRASES, templates=TEMPLATES) -> str:
    """The scan of `documents` by brute force in the checking engine's SQL."""
    starts = []
    for phrase, label in phrases.items():
        same = " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split(" ")))
        starts.append(f"list_transform(list_filter(range(len(ws)), lambda i: {same}), lambda i: {{'i': i, 'l': '{label}'}})")
    places = starts[0]
    for more in starts[1:]:
        places = f"list_concat({places}, {more})"
    sets = []
    for label, template in templates:
        words = sorted(set(re.findall(WORD, template)))
        listed = ", ".join(f"'{w}'" for w in words)
        sets.append(f"('{label}', [{listed}], {needed(len(words))})")
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{WORD}') AS ws FROM d),
p AS (SELECT doc_id, len(ws) AS n, {places} AS p FROM w),
b AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
bw AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '{WORD}')) AS ws FROM b),
tpl(label, words, need) AS (VALUES {', '.join(sets)}),
m AS (SELECT doc_id, label, len(list_intersect(ws, words)) / len(words) AS share
      FROM bw, tpl WHERE len(list_intersect(ws, words)) >= need),
g AS (SELECT doc_id, list(DISTINCT label) AS more, max(share) AS share FROM m GROUP BY doc_id)
SELECT p.doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
  CAST(list_min(list_transform(p, lambda x: x.i)) AS BIGINT) AS first_word,
  CAST(list_max(list_transform(p, lambda x: x.i)) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.l))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.l), coalesce(more, [])))), ',') AS labels,
  CASE WHEN len(p) > 0 THEN 1.0e0 ELSE coalesce(share, 0.0e0) END AS score
FROM p LEFT JOIN g ON p.doc_id = g.doc_id"""
