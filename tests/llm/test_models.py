"""Learned scores, vector searches, registration and the pipeline, on small tables."""

import ast
import inspect
import os
import random
import re
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from sedimenta.llm import common, embedding_dedup, neighbours, packing, quality, toxicity
from sedimenta.llm.common import components, membership
from sedimenta.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import make_docs, texts, words

SF = "/root/testdata/sf0.001"
benchmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def judged(llm):
    """Documents with rude words and their spellings, and documents of junk lines."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(240):
        toxic, good = i % 3 == 0, i % 4 != 0
        own = words(rng, 60).split(" ")
        if toxic:
            for at in rng.sample(range(60), 6):
                own[at] = rng.choice(["grobbly", "vexnard", "zilkish"])
        text = "\n".join(" ".join(own[k : k + 12]) + "." for k in range(0, 60, 12))
        if not good:
            text = "\n".join([text.split("\n")[0], *(line.upper() + "!!" for line in text.split("\n")[1:])])
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    labels += [(None, 1, 1), (1000, None, None), (1001, 7, 7), (1, 0, None)]
    labelled = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return make_docs(llm, rows), labelled, rows


def test_toxicity_learns_words_and_their_spellings(llm, judged):
    docs, labels, rows = judged
    model = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held_out = [i for i, _ in rows if i % 5 == 0]
    right = [found[i].predicted == int(i % 3 == 0) for i in held_out]
    assert np.mean(right) > 0.95
    plain, unseen = "an be co du er fi go hu " * 5, "an be co du er fi grobblyy vexnards " * 5
    words_of = toxicity.WordScores(model)
    assert words_of.score(unseen) > 0.5 > words_of.score(plain)


def test_quality_uses_lines_and_their_neighbours(llm, judged):
    docs, labels, rows = judged
    model = quality.fit(docs, labels, F.col("doc_id") % 3 != 1)
    found = {r.doc_id: r for r in quality.score(docs, model).collect()}
    held_out = [i for i, _ in rows if i % 3 == 1]
    assert np.mean([found[i].predicted == int(i % 4 != 0) for i in held_out]) > 0.95


def test_known_words_are_bounded_and_frequent_ones_worked_out_once(monkeypatch):
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), 0.1)
    rows = [words(random.Random(i), 40) + " comé" for i in range(60)]
    path = public_tokenizers.path("word_bpe_49k.json")
    wanted = [toxicity.WordScores(model).score(text) for text in rows]
    ids = [packing.WordIds(path).encode([text])[0].tolist() for text in rows[:20]]
    met = []
    for module, name in ((toxicity, "subwords"), (packing, "_pieces_of")):
        count = lambda word, inner=getattr(module, name): met.append(word) or inner(word)
        monkeypatch.setattr(module, name, count)
    monkeypatch.setattr(toxicity, "CACHED_SCORES", 100)
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 100)
    known = toxicity.WordScores(model)
    assert [known.score(text) for text in rows] == wanted
    assert len(known) + len(known.before) <= 2 * (100 + 41) and met.count("comé") == 1
    met.clear()
    encoder = packing.WordIds(path)
    assert [encoder.encode([text])[0].tolist() for text in rows[:20]] == ids
    assert len(encoder) + len(encoder.before[0]) <= 2 * (100 + 82) and met.count("comé") == 1


def test_subwords_of_any_text_are_those_of_its_characters():
    for word in ("", "a", "plain", "naïve", "日本語", "x\ud800y", "\U0001f600"):
        marked = f"<{word}>"
        grams = [marked] + [marked[i : i + n] for n in range(3, 7) for i in range(len(marked) - n + 1)]
        assert toxicity.subwords(word) == [toxicity.zlib.crc32(g.encode("utf-8", "replace")) % toxicity.BUCKETS for g in grams]


def test_a_worker_drops_what_the_last_operator_kept(llm):
    common.kept("scores of toxicity", dict)
    score = quality.scorer(llm, quality.learn(np.empty((0, quality.N_SHAPE)), np.empty(0, int), np.empty(0, int), quality.Training()))
    scored = inspect.getclosurevars(score).nonlocals["scored"].func
    assert len(next(iter(scored(iter([pd.Series(["one\ntwo", ""])])))))
    assert not common._KEPT


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="needs Linux")
def test_lean_work_returns_memory_between_what_stays():
    def taken():
        return int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGESIZE") / 1e6

    stays = []

    def work(batches):
        for batch in batches:
            many = [bytes(1000) for _ in range(200_000)]
            stays.append(many[::1000])
            yield batch

    before = taken()
    assert list(common.lean(work)(iter([1]))) == [1]
    assert taken() - before < 100


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_scores_of_odd_tables(llm, operator, docs, empty, judged):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    model = operator.fit(docs, none, F.lit(True))
    rows = operator.score(docs, model).collect()
    assert len(rows) == len(texts()) and all(0 <= r.score <= 1 for r in rows)
    # Without labels nothing is rejected.
    assert {r.predicted for r in rows} == {0 if operator is toxicity else 1}
    assert operator.score(empty, model).count() == 0
    assert operator.score(empty, operator.fit(empty, judged[1], F.lit(True))).count() == 0


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(4)
    counts = np.array([3, 1, 5])
    good, change = rng.normal(size=9), rng.normal(size=(2, 2))
    chance, pairs = quality.marginals(good, counts, change)
    expected, expected_pairs, start = [], np.zeros((2, 2)), 0
    for n in counts:
        own, total = np.zeros(n), 0.0
        pair = np.zeros((2, 2))
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            weight = np.exp(sum(good[start + k] * y[k] for k in range(n)) + sum(change[a, b] for a, b in zip(y, y[1:])))
            total += weight
            own += weight * np.array(y)
            for a, b in zip(y, y[1:]):
                pair[a, b] += weight
        expected += list(own / total)
        expected_pairs += pair / total
        start += n
    assert np.allclose(chance, expected) and np.allclose(pairs, expected_pairs)


def vector_rows():
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):
        v = rng.normal(size=20)
        rows.append((i, v.tolist(), i % 3))
    for i in range(300, 420):  # near copies, in chains
        v = np.array(rows[(i - 300) // 8][1]) + rng.normal(size=20) * 0.08
        rows.append((i, v.tolist(), (i - 300) // 8 % 3))
    rows += [(420 + k, rows[0][1], 0) for k in range(40)]  # a hot vector
    rows += [
        (500, None, 0), (501, [0.0] * 20, 0), (502, [float("nan")] * 20, 0),
        (503, [float("inf")] + [1.0] * 19, 0), (504, [None] + [1.0] * 19, 0), (505, rows[0][1], None),
        (None, rows[0][1], 0), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0), (1, rows[1][1], 1),
    ]
    return rows


@pytest.fixture(scope="module")
def vectors(llm):
    extra = "n int, node int, rank int, score double, copies int"
    rows = [(*r, 0, 0, 0, 0.0, 0) for r in vector_rows()]
    return llm.createDataFrame(rows, f"vec_id long, embedding array<double>, label int, {extra}")


def good(v):
    return v is not None and None not in v and np.isfinite(v).all() and any(v)


def test_nearest_vectors(vectors):
    rows = [(i, np.array(v)) for i, v, _ in vector_rows() if i is not None and good(v)]
    found = {}
    for r in neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, k=5, lists=neighbours.Lists(per_list=16, ratio=1.6)).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hit = total = 0
    for i, v in rows:
        if i % 20 == 0:
            others = [(float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in rows if j != i and len(w) == len(v)]
            best = sorted(others)[:5]
            got = [found[i][k + 1] for k in range(len(found[i]))]
            assert len(got) == len(best) and [s for _, s in got] == sorted(s for _, s in got)
            assert all(np.isclose(s, next(d for d, j in others if j == c)) for c, s in got)
            hit += len({c for c, _ in got} & {j for _, j in best})
            total += len(best)
    assert hit >= 0.9 * total
    # The hot vector's copies are nearest to each other, the smaller numbers first.
    assert [found[440][k][0] for k in range(1, 6)] == [0, 420, 421, 422, 423]


def nearest_by_force(rows, query, k):
    distances = sorted((float(np.sqrt(((w - rows[query]) ** 2).sum())), j) for j, w in rows.items() if j != query)
    return distances[:k]


def found_nearest(llm, rows, asks, **lists):
    table = llm.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(table, asks, lists=neighbours.Lists(**lists)).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return found


def test_ties_of_many_vectors_go_to_the_smaller_numbers(llm, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 37)  # lists and queries in several blocks
    rows = {i: row for i, row in enumerate(np.eye(400))}
    found = found_nearest(llm, rows, F.col("vec_id") % 50 == 0)
    assert found.keys() == set(range(0, 400, 50))
    for query, got in found.items():
        assert [j for _, j in got] == [j for j in range(11) if j != query][:10]


def test_vectors_far_from_zero_and_close_together(llm):
    rng = np.random.default_rng(3)
    rows = {i: 1e6 + rng.normal(size=16) * 1e-3 for i in range(1500)}
    found = found_nearest(llm, rows, F.col("vec_id") % 50 == 0)
    hit = [len(set(found[q]) & set(nearest_by_force(rows, q, 10))) for q in range(0, 1500, 50)]
    assert sum(hit) >= 0.95 * 10 * len(hit)


def test_groups_larger_than_a_list_are_read_across_lists(llm):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(3, 32))
    rows = {i: middles[i % 3] + rng.normal(size=32) * 0.01 for i in range(1800)}
    found = found_nearest(llm, rows, F.col("vec_id") % 60 == 0, per_list=40)
    hit = [len({j for _, j in found[q]} & {j for _, j in nearest_by_force(rows, q, 10)}) for q in range(0, 1800, 60)]
    assert sum(hit) >= 0.9 * 10 * len(hit)


@pytest.mark.parametrize("scale", [1e-200, 1.0, 1e160, 1e200])
def test_closest_is_exact_at_every_magnitude(scale):
    rng = np.random.default_rng(5)
    held = rng.integers(-2, 3, (300, 3)) * scale  # many ties
    least = rng.permutation(300)
    with np.errstate(over="ignore"):
        for q, (at, distance) in zip(held[:20], neighbours.closest(held[:20], held, least, 12)):
            exact = np.sqrt(((held - q) ** 2).sum(1))
            order = np.lexsort((least, exact))[:12]
            assert at.tolist() == order.tolist() and distance.tolist() == exact[order].tolist()


def test_near_duplicate_vectors(vectors, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 7)  # several blocks even here
    rows = vector_rows()
    unit = [np.array(v) / np.linalg.norm(v) if good(v) else None for _, v, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    takes = [unit[k] is not None and rows[k][0] is not None and rows[k][2] is not None for k in range(len(rows))]
    for a in range(len(rows)):
        for b in range(a):
            if takes[a] and takes[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                if unit[a] @ unit[b] >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    parent[root(a)] = root(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), 10**9), 10**9 if i is None else i)
    expected = [
        (i, links[k], None if i is None else least[root(k)], i is not None and i == least[root(k)])
        for k, (i, _, _) in enumerate(rows)
    ]
    found = [tuple(r) for r in embedding_dedup.near_duplicates(vectors).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_lots_are_bounded_with_a_hot_cell(llm, monkeypatch):
    """All rows that are placed, over the lots, though a hot cell copies each to many blocks."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 5)
    monkeypatch.setattr(embedding_dedup, "LOT", 40)
    found, deal = [], F.pmod

    def pmod(value, n):
        found.append(n)
        return deal(value, n)

    monkeypatch.setattr(embedding_dedup.F, "pmod", pmod)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=20)
    rows = [(i, (centre + rng.normal(size=20) * 0.002).tolist(), 0) for i in range(150)]
    rows += [(1000 + i, rng.normal(size=20).tolist(), 0) for i in range(20)]
    table = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    kept = {r.vec_id for r in embedding_dedup.near_duplicates(table).collect() if r.kept}
    assert kept == {0, *range(1000, 1020)}
    n_lots = int(re.search(r"\d+", str(found[-1])).group())
    # 150 vectors share a cell of each table: 30 blocks, so 30 rows each.
    assert n_lots * 40 >= 150 * 30 * 6


def test_hadamard_is_its_own_inverse():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(embedding_dedup.hadamard(embedding_dedup.hadamard(x)) / 16, x)


def test_no_vectors(vectors):
    none = vectors.limit(0)
    assert neighbours.nearest(none, F.lit(True)).count() == 0
    assert embedding_dedup.near_duplicates(none).count() == 0


def test_components(llm):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 90), (100, 101), (102, 101), (7, 7)]
    edges += [(200 + rng.randrange(30), 200 + rng.randrange(30)) for _ in range(40)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    table = llm.createDataFrame(edges, "a long, b long")
    linked = {x for a, b in edges if a != b for x in (a, b)}
    found = {r.node: r.component for r in components(table, "a", "b").collect()}
    assert found == {x: root(x) for x in linked}
    assert components(table.limit(0), "a", "b").count() == 0


def test_membership_passes_every_key(llm):
    keys = llm.range(0, 3000, 3)
    passed = {r.id for r in llm.range(3000).filter(membership(keys, "id", 1 << 14)(F.col("id"))).collect()}
    assert passed >= set(range(0, 3000, 3)) and len(passed) < 1300
    assert llm.range(100).filter(membership(keys.limit(0), "id")(F.col("id"))).count() == 0


def test_every_operator_is_registered_once():
    names = sorted(QUERIES, key=lambda name: int(name[2:].split("_")[0]))
    assert [int(name[2:].split("_")[0]) for name in names] == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= driver.queries().keys()
    assert ORACLE.keys() <= driver.oracle_sql().keys()


def test_nothing_else_imports_the_package():
    root = Path(__file__).resolve().parents[2]
    for path in [*root.glob("sedimenta/**/*.py"), *root.glob("bindings/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in name or "corpus_pipeline" in name for name in names), path


def test_near_copies_are_dropped_by_row(llm):
    rng = random.Random(8)
    base, unique, again, other, third, hot = (words(rng, 60) for _ in range(6))
    rows = [
        (1, base), (5, f"{base} more"), (5, unique), (None, f"{base} same"),
        (7, again), (7, again), (7, other), (7, f"{again} same"),
        (None, third), (3, f"{third} same"), (None, third),
        (9, ""), (9, ""), (None, None), *[(None, hot)] * 40,
    ]
    docs = make_docs(llm, rows)
    found = corpus_pipeline.drop_near_copies(llm, docs, "")
    assert found.columns == docs.columns
    texts_of = {}
    for r in found.collect():
        texts_of.setdefault(r.doc_id, []).append(r.text)
    # Of row 7's similar texts any one may stay.
    assert sorted(t.removesuffix(" same") for t in texts_of.pop(7)) == sorted([again, other])
    assert sorted(texts_of.pop(None), key=str) == sorted([None, hot], key=str)
    assert texts_of == {1: [base], 5: [unique], 3: [f"{third} same"], 9: ["", ""]}


def test_near_copies_keep_columns_called_as_the_key(llm):
    text = words(random.Random(9), 30)
    docs = llm.createDataFrame([(1, text, 7), (2, text, 8), (3, None, 9)], "doc_id long, text string, _row int")
    kept = corpus_pipeline.drop_near_copies(llm, docs, "")
    assert kept.columns == docs.columns and sorted((r.doc_id, r._row) for r in kept.collect()) == [(1, 7), (3, 9)]


def test_stages_on_no_documents(llm, judged, tmp_path):
    _, labels, _ = judged
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    none = llm.createDataFrame([], columns)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(llm, none, str(tmp_path))
        assert found.count() == 0
        if name != "packing":
            assert found.columns == none.columns


@benchmark
def test_pipeline_keeps_what_each_stage_decides(llm, tmp_path):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    ids, columns = None, docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(llm, docs, SF).write.parquet(f"{tmp_path}/{number}")
        out = llm.read.parquet(f"{tmp_path}/{number}")
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids is None or kept <= ids
        if name != "packing":
            assert out.columns == columns and out.count() == len(kept) > 0
        elif kept != ids:
            raise AssertionError("packing loses documents")
        ids, docs = kept, out
    assert corpus_pipeline.run(llm, SF).count() == docs.count()


@pytest.mark.parametrize("width", [16, 64, 384])
@pytest.mark.parametrize("n_joined", [1, 2, 3, 4])
def test_pairs_at_the_least_cosine_meet(width, n_joined):
    rng = np.random.default_rng(width)
    x, y = rng.normal(size=(2, 1000, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = 0.98 * x + np.sqrt(1 - 0.98**2) * y
    hashes = [embedding_dedup.axes(v, embedding_dedup.Hashing(), n_joined).astype(np.int64) for v in (x, near)]
    met = embedding_dedup._meet(*hashes) < np.iinfo(np.int64).max
    assert met.mean() >= 0.97


def test_buckets_do_not_grow_with_the_table(llm):
    """Comparisons for each vector stay within a bound while vectors become 16 times as many."""
    hashing = embedding_dedup.Hashing(tables=2, crowd=10)
    rng = np.random.default_rng(0)
    sizes = llm.createDataFrame([(1000,), (16_000,)], "n long")
    chosen = sizes.select("n", embedding_dedup.joined_rotations(F.col("n"), F.lit(16), hashing).alias("k"))
    chosen = {r.n: r.k for r in chosen.collect()}
    assert chosen[1000] < chosen[16_000]
    for n, n_joined in chosen.items():
        found = embedding_dedup.axes(rng.normal(size=(n, 16)), hashing, n_joined)
        counts = [np.unique(found[:, t], return_counts=True)[1] for t in range(2)]
        per_vector = sum((c.astype(float) ** 2).sum() for c in counts) / n
        assert per_vector < 16 * 10 * 2 * found.shape[2] ** 2


def test_joined_hashes_find_planted_groups(llm):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 24))
    rows = [(i, (centres[i % 40] + rng.normal(size=24) * 0.01).tolist(), i % 40 % 2) for i in range(200)]
    table = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    hashing = embedding_dedup.Hashing(crowd=1)
    found = embedding_dedup.near_duplicates(table, hashing=hashing).collect()
    assert {tuple(r) for r in found} == {(i, 4, i % 40, i < 40) for i in range(200)}
