import random

import pytest

from sedimenta.llm.common import reach_workers

# Names that operators use themselves, as extra columns of the input.
CLASHING = "n node token rank shard slot bucket text_crc32 variant carried row score label kept"


@pytest.fixture(scope="session")
def llm(spark):
    reach_workers(spark)
    return spark


def make_docs(spark, rows):
    clash = CLASHING.split()
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash)
    return spark.createDataFrame([(i, t, *clash) for i, t in rows], schema).repartition(3)


def words(rng, n):
    syllables = ["an", "be", "co", "du", "er", "fi", "go", "hu", "is", "ka", "lo", "mé", "nü", "ß"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def texts():
    """Null, empty and blank texts, exact and near copies, shared passages, a long text."""
    rng = random.Random(5)
    base, passage = words(rng, 120), words(rng, 60)
    near = base.split(" ")
    near[60] = "changed"
    far = base.split(" ")
    for at in range(0, 120, 12):
        far[at] = f"other{at}"
    rows = [
        (0, base), (1, None), (2, ""), (3, " \n\t "), (4, base), (5, " ".join(near)),
        (6, " ".join(far)), (7, f"{words(rng, 30)} {passage} {words(rng, 20)}"),
        (8, f"{words(rng, 15)}\n{passage}\n{words(rng, 40)}"), (9, "one two"), (10, "ONE two"),
        (11, words(rng, 9000)), (12, words(rng, 300)), (13, passage), (None, base), (None, words(rng, 50)),
        (14, "ab " * 400), (15, "x" * 49), (16, "x" * 49), (17, "y" * 50), (18, "y" * 50), (19, "y" * 120),
        (4, base), (20, "Licensed under the Apache License, Version 2.0.\nAll rights reserved. CC BY, cc by"),
        (21, "Released under the MIT License."), (22, "▁ marks ▁▁ and  blanks \n\n 日本語 \U0001f600"),
    ]
    return rows + [(100 + i, " ".join([*base.split(" ")[: 100 + i], words(rng, 3)])) for i in range(20)]


@pytest.fixture(scope="session")
def docs(llm):
    return make_docs(llm, texts()).cache()


@pytest.fixture(scope="session")
def empty(llm):
    return make_docs(llm, texts()).limit(0)
