"""Periodic runs, cutting stock and collocations against brute force, odd rows included."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.llm import common, cutting, digits, hashing, periods, phrases, queries, suffixes
from tests.llm.conftest import make_docs, texts

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def runs_by_force(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > at and end - at + q >= max(6, 4 * q):
                found.setdefault((at, end - at + q), q)
            at = end + 1
    return sorted((a, n, q) for (a, n), q in found.items())


def with_repeats(rng, n, kinds):
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 8 else 0):
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // rng.randint(1, 9)))
        for i in range(a, rng.randint(a, n)):
            words[i] = words[a + (i - a) % p]
    return words


def test_catchers_find_every_run():
    rng = random.Random(11)
    for _ in range(300):
        many = [with_repeats(rng, rng.choice([0, 1, 5, 24, 70, 300]), rng.choice([1, 2, 3, 40])) for _ in range(4)]
        many.sort(key=len, reverse=True)
        stream = np.concatenate([np.array([*words, 1000 + k]) for k, words in enumerate(many)])
        caught = periods.catch(stream, np.array([len(words) for words in many]))
        for k, words in enumerate(many):
            assert sorted(tuple(r[1:]) for r in caught.tolist() if r[0] == k) == runs_by_force(words)


def test_equal_hashes_are_not_taken_for_runs(monkeypatch):
    monkeypatch.setattr(periods, "mix", lambda values, seed=0: np.zeros(len(values), dtype=np.uint64))
    words = [*range(40), *([7, 8] * 6), *range(50, 90)]
    caught = periods.catch(np.array([*words, 1000]), np.array([len(words)]))
    assert set(map(tuple, caught[:, 1:].tolist())) <= set(runs_by_force(words))


def run_row(doc_id, text):
    words = (text or "").encode().split()
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    order = list(numbers)
    ids = queries._planted(doc_id, np.array([numbers[w] for w in words], dtype=np.int64)).tolist()
    found = runs_by_force(ids)
    told = "".join(f"{a},{n},{q}\n" for a, n, q in found)
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    kept = b" ".join(order[w] for i, w in enumerate(ids) if i not in gone)
    best = min(((-n, a, q) for a, n, q in found), default=None)
    best = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (doc_id, len(found), *best, sha(told.encode()), sha(kept))


def test_runs_of_documents(llm, tmp_path, docs):
    rng = random.Random(3)
    rows = [(i, t if t is None or len(t) < 6000 else t[:3000]) for i, t in texts()]
    rows += [(200 + i, " ".join(f"w{w}" for w in with_repeats(rng, 150, 3))) for i in range(40)]
    make_docs(llm, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periods(llm, str(tmp_path))
    found = found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted((run_row(i, t) for i, t in rows), key=str)


def test_a_text_of_one_word_and_of_long_words(llm, monkeypatch):
    monkeypatch.setattr(periods, "SPLIT_BYTES", 8)  # words are longer than what is split at once
    rows = [(1, "same " * 5000), (2, "averyveryverylongword\tb  " * 4), (3, "x")]
    found = {r.doc_id: r for r in periods.runs(make_docs(llm, rows)).collect()}
    assert (found[1].starts, found[1].lengths, found[1].periods, found[1].collapsed) == ([0], [5000], [1], "same")
    assert (found[2].lengths, found[2].periods, found[2].collapsed) == ([8], [2], "averyveryverylongword b")
    assert (found[3].n_words, found[3].starts) == (1, [])


@pytest.mark.parametrize("size", [64, 1024])
def test_cutting_stock_fills_every_sequence(llm, docs, size):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(TOKENIZER).encode
    rows = cutting.pack(docs, TOKENIZER, size).toPandas()
    expected = Counter()
    for i, t in texts():
        ids = [*encode(t or "", add_special_tokens=False).ids, 0]
        expected[i, len(ids)] += len(ids)
        own = rows[rows["doc_id"].isna() if i is None else rows["doc_id"] == i]
        for r in own[own["doc_tokens"] == len(ids)].itertuples():
            piece = np.array(ids[r.start : r.start + r.length], dtype="<u4")
            repeated = sum(1 for j, u in texts() if j == i) > 1
            assert repeated or zlib.crc32(piece.tobytes()) == r.ids_crc32
    held = rows.groupby(["doc_id", "doc_tokens"], dropna=False)["length"].sum()
    assert {(None if pd.isna(i) else int(i), n): v for (i, n), v in held.items()} == dict(expected)
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]]
        fill = own["length"].sum()
        assert fill <= size and fill & (fill - 1) == 0
    assert (rows.groupby("sequence_id")["length"].sum() < size).sum() <= size.bit_length()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab'stZ 1.,!\n\t\xa0　\x1cé日😀<|>", max_size=40))
def test_ids_are_those_of_the_tokenizer(text):
    known = cutting.tokens(TOKENIZER)
    assert known.ids(text) == known.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=25))
def test_plan_gives_every_rank_one_place(counts):
    made = cutting.plan(dict(counts), 64)
    places, fills = cutting.Places(made), Counter()
    for length, n in counts.items():
        first = made.laid.get(length, (n, 0))[0]
        ranks = np.arange(first)
        for sequence, offset in zip(*places.fixed(np.full(first, length), ranks)):
            fills[int(sequence)] += length
            assert offset + length <= 64
        for rank in range(first, n):
            parts = places.cut(length, rank)
            assert parts[0][0] == 0 and parts[-1][1] == length
            for begin, end, sequence, _ in parts:
                fills[sequence] += end - begin
    assert all(fill == 64 or fill & (fill - 1) == 0 for fill in fills.values())
    assert sorted(fills) == list(range(len(fills)))
    assert sum(fills.values()) == sum(k * n for k, n in counts.items())


def test_linear_program_is_near_its_bound():
    rng = np.random.default_rng(4)
    lengths = np.arange(1, 200)
    counts = rng.integers(20, 400, len(lengths)).astype(float)
    solved = cutting.generate(lengths, counts, 256)
    cost = cutting.costs(256)
    held = np.zeros(len(lengths))
    for at, times, use in solved:
        held[at] += times * use
    assert np.allclose(held, counts)
    spent = sum(cost[int((lengths[at] * times).sum())] * use for at, times, use in solved)
    assert spent <= (lengths * counts).sum() * (1 + 1 / 256) * 1.002


def collocations_by_force(rows, threshold, longest, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        plain = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", plain):
            words = re.findall(rb"[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= threshold}
    inside = {}
    for (lang, p), a in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(a, inside.get((lang, p[i : i + k]), 0))
    out = []
    for lang in n:
        scored = []
        for (of, p), a in often.items():
            if of == lang and inside.get((of, p), 0) < a:
                cuts = [(f[of, p[:k]], f[of, p[k:]], k) for k in range(1, len(p))]
                score, _, left, right = min((1000 * a * n[lang] // (x * y), k, x, y) for x, y, k in cuts)
                scored.append((-score, -a, b" ".join(p), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def spoken(rng, n):
    return "".join(rng.choice(["alpha", "Beta", "γ", "d'e"]) + rng.choice([" "] * 8 + [". ", ",", "\t", "\n", "  "]) for _ in range(n))


def lang_docs(llm):
    rng = random.Random(8)
    rows = [(k, rng.choice(["en", "de", None]), spoken(rng, rng.randint(0, 80))) for k in range(60)]
    rows += [(1, "en", None), (None, "en", ""), (3, "und", "alpha beta " * 300), (3, "und", "alpha beta " * 300)]
    frame = llm.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, lang string, text string, n string, a string")
    return rows, frame.repartition(4)


@pytest.mark.parametrize("slack", [4, 1])
def test_collocations(llm, monkeypatch, slack):
    rows, docs = lang_docs(llm)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 200)  # phrases lie over the seams of blocks
    found = phrases.collocations(docs, threshold=6, longest=4, top=25, slack=slack).collect()
    expected = collocations_by_force([r[1:] for r in rows], 6, 4, 25)
    assert sorted(map(tuple, found)) == expected


def test_collocations_of_languages_whose_names_hold_a_nul(llm):
    langs = ["en", "en\0", "en\0a", "\0", "\0a", None]
    rows = [(lang, f"{first} {second} " * (4 + at)) for at, lang in enumerate(langs) for first, second in ("ab", "ba", "cd")]
    docs = llm.createDataFrame(rows, "lang string, text string").coalesce(1)
    found = phrases.collocations(docs, threshold=4, longest=3, top=9).collect()
    assert sorted(map(tuple, found)) == collocations_by_force(rows, 4, 3, 9)


def test_collocations_dealt_out_twice(llm, monkeypatch):
    rows, docs = lang_docs(llm)
    for name, value in (("PART_MASS", 500), ("FAN_BITS", 2), ("FLUSH", 300)):
        monkeypatch.setattr(phrases, name, value)
    found = phrases.collocations(docs, threshold=6, longest=4).collect()
    assert sorted(map(tuple, found)) == collocations_by_force([r[1:] for r in rows], 6, 4, None)


def test_summaries_keep_what_is_frequent_however_they_are_merged(monkeypatch):
    monkeypatch.setattr(phrases, "FLUSH", 0)
    rng = np.random.default_rng(6)
    values = np.minimum(rng.zipf(1.3, 40_000), 5_000).astype(np.uint64)
    threshold, parts = 200, []
    capacity = len(values) // threshold + 1
    for chunk in np.array_split(values, 4):
        summary = phrases.Summary(capacity)
        for lot in np.array_split(chunk, 7):
            summary.add(*phrases.combine([lot]))
        parts.append(summary)
    whole = parts[0]
    for other in parts[1:]:
        whole.merge(other)
    often = {v for v, n in Counter(values.tolist()).items() if n >= threshold}
    assert often <= set(whole.possible(threshold).tolist())
    assert len(whole.values[0]) <= capacity and 0 < whole.lost < threshold


def test_dealt_rows_give_back_their_values():
    values = np.array([0, 3, 3 + 2**20, 2**39, 2**40 - 1], dtype=np.uint64)
    counts = np.array([1, 255, 256, 1000, 2])
    back = [phrases.dealt(row) for row in phrases.deal(values, counts, 40, 3).itertuples()]
    assert [x.tolist() for x in phrases.combine(*map(list, zip(*back)))] == [values.tolist(), counts.tolist()]


def test_no_documents(llm, empty):
    assert periods.runs(empty).count() == 0
    assert cutting.pack(empty, TOKENIZER).count() == 0
    none = llm.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(none).count() == 0


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_long_regular_words_are_told_apart(llm, n):
    from sedimenta.llm import ngram_join

    words = [thue_morse(n), thue_morse(n, "b", "a")]
    hashes = [ngram_join.shingles([w.encode()])[0].tolist() for w in words]
    assert hashes[0] != hashes[1]
    found = ngram_join.join_classes(make_docs(llm, list(enumerate(words, 1))))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 2)]


def test_copies_of_a_row_are_cut_once(llm):
    from sedimenta.llm import suffixes

    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=400))
    many = llm.range(3000).selectExpr("cast(NULL as long) as doc_id", f"'{text}' as text")
    first = llm.createDataFrame([(1, "x" + text[100:200])], "doc_id long, text string")
    found = suffixes.remove_repeats(many.unionByName(first))
    rows = found.groupBy("doc_id", "n_removed").count().collect()
    assert sorted(map(tuple, rows), key=str) == [(1, 0, 1), (None, 100, 3000)]
    marks = suffixes.first_digit(
        many.selectExpr(f"{2**63 - 1} as doc_id", "xxhash64(text) as variant", "text").unionByName(
            first.selectExpr("doc_id", "0 as variant", "text")
        ),
        1_200_000,
    )
    assert marks.count() <= 100 * many.rdd.getNumPartitions()


def test_texts_that_share_a_gram_but_no_window_keep_every_byte(llm):
    from sedimenta.llm import suffixes

    rng = random.Random(9)
    around = lambda k: "".join(rng.choices("klmnopqrst", k=k))
    rows = [(k, around(30) + "the same twenty byte" + around(30)) for k in range(20_000)]
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    assert suffixes.remove_repeats(frame).filter("n_removed > 0").count() == 0


def test_cut_repeats_match_all_windows_in_sql(llm):
    shared = "".join(chr(97 + k * k % 23) for k in range(90)) + "é" * 9
    rows = [
        (3, "x" + shared + "y"), (1, shared + "unlike " * 9), (None, shared[5:70]), (None, shared[5:70]), (7, None),
        (3, "other " + shared[:60]), (8, ""), (9, "a" * 200), (10, "b" + "a" * 120 + shared), (10, "b" + "a" * 120 + shared),
    ]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})
    connection = duckdb.connect()
    connection.register("documents", documents)
    expected = connection.execute(suffixes.ORACLE_SQL).fetchall()
    found = suffixes.remove_repeats(llm.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", "n_bytes", "n_removed", F.size("span_starts").cast("long"), F.sha2("kept", 256)
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert sum(r[2] for r in expected) > 400


def test_what_is_hashed_at_once_stays_below_what_workers_map_anew():
    # A worker gives larger arrays back at once, so each new one costs its pages again.
    assert hashing.HASHED_BYTES * 8 < int(common._WORKER_MEMORY["MALLOC_MMAP_THRESHOLD_"])


@pytest.mark.parametrize("buckets", [7, 300, 70_000])
def test_blobs_come_by_bucket_key_and_owner(buckets):
    rng = np.random.default_rng(buckets)
    key, owner = rng.integers(0, 900, 4000).astype(np.uint64), rng.integers(0, 5, 4000)
    assert digits.ordered(key, owner).tolist() == np.lexsort((owner, key)).tolist()
    assert digits.ordered(key[:0], owner[:0]).tolist() == []
    codes = np.arange(5, dtype=np.uint64)
    place = np.arange(4000, dtype=np.uint64)
    sent = digits.blobs(buckets, key, owner, codes, codes, [place], place)
    order = np.lexsort((owner, key // np.uint64(buckets), key % np.uint64(buckets)))
    assert np.concatenate([common.unpack(b) for b in sent["kind"]]).tolist() == order.tolist()
    assert sent["bucket"].is_monotonic_increasing and sent["n"].sum() == 4000


def test_context_spans_the_windows_that_a_gram_leads():
    rng = random.Random(8)
    periodic = [b"ab" * 70, b"z" * 51, b"z" * 50, bytes(range(100, 117)) * 9]
    made = [bytes(rng.choices(b"abc", k=rng.randint(0, 200))) for _ in range(60)]
    texts = [b"", *periodic, b"short", *made, *periodic, *made[:5]]
    w = suffixes.Windows(texts)
    at = w.leading()
    text = np.searchsorted(w.ends, at, side="right")
    got = w.context(at, text)
    wanted, n = [], 0
    for p in at.tolist():
        led = [v for v in range(max(0, p - suffixes.LED + 1), min(p + 1, w.count)) if w.least[v] == w.gram[p]]
        n += len(led)
        begin, end = np.array(led[:1]), np.array(led[-1:])
        value = hashing.powers().stretch(w.sums, begin, end + suffixes.WINDOW)
        offset = ((p - begin) * 64 + p - end).astype(np.uint64)
        wanted += common.mix(value ^ common.mix(offset, 3), 4).tolist()
    assert got.tolist() == wanted and n >= w.whole.sum() > 0
    least = [w.gram[v : v + suffixes.LED].min() for v in np.flatnonzero(w.whole)]
    assert w.least[w.whole].tolist() == [int(x) for x in least] and not w.least[~w.whole].any()
