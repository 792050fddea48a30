import random
import re

import numpy as np
import pytest

from beadloom.llm import jaccard
from beadloom.llm.common import pieces
from beadloom.llm.graph import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, n):
    found = WORD.findall((text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
    if len(found) < n:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + n]) for k in range(len(found) - n + 1)}


def brute(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(i), find(rows[b][0])))
                root[y] = x
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets))


def texts(seed, count=220):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdéXYZ") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    out = []
    for _ in range(count):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split()
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 9, 30, 80, 200]))]
            if rng.random() < 0.5:
                words += passage
        out.append(" \n\t"[rng.randrange(3)].join(words))
    return out


@pytest.mark.parametrize("seed,n,percent,bucket", [(1, 4, 85, 3_000_000), (2, 5, 80, 3_000_000), (3, 4, 85, 600), (4, 5, 80, 900), (5, 3, 60, 3_000_000), (6, 4, 100, 3_000_000), (7, 4, 100, 600), (8, 4, 85, 4000)])
def test_against_brute_force(spark, seed, n, percent, bucket):
    rows = list(enumerate(texts(seed)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = jaccard.link(df, n, percent, bucket_tokens=bucket)
    assert sorted(map(tuple, found.collect())) == brute(rows, n, percent)


def test_edges(spark):
    same = " ".join(f"w{k}" for k in range(30))
    rows = [(5, None, 1), (6, "", 1), (7, " \n ", 1), (8, "One two", 1), (9, "one TWO", 1), (3, same, 1), (3, same, 1), (None, same, 1), (2, same.upper(), 1), (4, "é" * 200_000, 1), (1, same + " w30", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_shingles int")
    got = sorted(map(tuple, jaccard.link(df, 4, 85).collect()), key=str)
    assert got == sorted([(5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (3, 27, 1), (3, 27, 1), (None, 27, None), (2, 27, 1), (4, 1, 4), (1, 28, 1)], key=str)
    kept = sorted(r["doc_id"] or 0 for r in jaccard.one_of_each(df, 4, 85).collect())
    assert kept == [0, 1, 4, 5, 6, 7, 8]
    assert jaccard.link(df.limit(0), 4, 85).count() == 0


def test_many_candidates_of_one_bucket():
    rng = np.random.default_rng(4)
    base = np.arange(1, 201, dtype=np.uint64)
    sets = []
    for _ in range(150):  # copies that link with the original but hardly with each other
        own = base.copy()
        own[rng.choice(200, 14, replace=False)] = rng.integers(1000, 1 << 60, 14)
        sets.append(np.unique(own))
    sets.append(base)
    ids = np.arange(len(sets))[::-1].copy()
    roots = jaccard.bucket_roots(ids, sets, np.full(len(sets), 2), 85)
    expected = np.arange(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if jaccard.linked(both, len(sets[a]), len(sets[b]), 85):
                x, y = sorted((expected[a], expected[b]))
                expected[expected == y] = x
    smallest = [ids[expected == e].min() for e in expected]
    assert roots.tolist() == smallest


def test_components_with_a_hot_node(spark, monkeypatch):
    from beadloom.llm import graph

    monkeypatch.setattr(graph, "pieces", lambda counts, key, total=None: pieces(counts, key, 20, total))
    edges = spark.createDataFrame([(5000, k) for k in range(100, 400)] + [(k, k + 1000) for k in range(100, 130)] + [(1, 2), (None, 3)], "u bigint, v bigint")
    got = {r["id"]: r["root"] for r in components(edges).collect()}
    assert got == {5000: 100, **{k: 100 for k in range(100, 400)}, **{k + 1000: 100 for k in range(100, 130)}, 1: 1, 2: 1}
    assert components(edges.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7)], "u bigint, v bigint")
    got = {r["id"]: r["root"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}
