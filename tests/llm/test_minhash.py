import random
import time

import numpy as np
import pytest

from siltstone.llm import minhash
from siltstone.llm.components import connected_components


def shingle_set(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def brute(rows, width, percent=80):
    sets = [shingle_set(t, width) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if a and b and rows[x][0] is not None and rows[y][0] is not None:
                if 100 * len(a & b) >= percent * len(a | b):
                    p, q = sorted((root(rows[x][0]), root(rows[y][0])))
                    parent[q] = p
    return sorted((-1 if i is None else i, len(s), -1 if i is None else root(i), i is None or root(i) == i) for (i, _), s in zip(rows, sets))


def corpus(seed):
    """Copies, near copies around an original, chains of small changes, common passages and odd rows."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    texts = [None, "", "  \n", "One", "one", "ONE two", "one\ttwo", "é É"]
    for _ in range(8):
        base = [word() for _ in range(rng.randrange(3, 150))]
        for _ in range(12):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + len(t) // 8)):
                t[rng.randrange(len(t))] = word()
            texts.append(rng.choice([" ", "\n", " \t"]).join(t))
    chain = [word() for _ in range(100)]
    for k in range(20):
        chain = chain[3:] + [word() for _ in range(3)]
        texts.append(" ".join(chain))
    passage = [word() for _ in range(60)]
    texts += [" ".join(passage + [word() for _ in range(n)]) for n in range(5, 60, 3) for _ in range(2)]
    texts += [texts[20]] * 10
    ids = rng.sample(range(10000), len(texts))
    return list(zip(ids, texts)) + [(None, texts[20]), (None, None)]


@pytest.mark.parametrize(("seed", "width"), [(1, 2), (2, 5), (3, 2)])
def test_against_brute_force(spark, seed, width):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, node string, kept int")
    got = [tuple(-1 if v is None else v for v in r) for r in minhash.near_duplicates(df, width=width).collect()]
    assert sorted(got) == brute(rows, width)


def test_differences_lose_no_pair(spark):
    """Variants around a leader: every similar pair that isn't connected through the leader is proposed."""
    rng = np.random.default_rng(7)
    for percent in (80, 60):
        base = set(range(120))
        sets = {0: base}
        for i in range(1, 90):
            parent = sets[int(rng.integers(0, i))] if i % 3 else base
            gone = set(rng.choice(sorted(parent), int(rng.integers(1, 22)), replace=False).tolist())
            sets[i] = (parent - gone) | {1000 * i + k for k in range(int(rng.integers(0, 22)))}
        similar = lambda x, y: 100 * len(x & y) >= percent * len(x | y)
        linked = {i for i in sets if similar(sets[i], base)}
        rows = [(0, i, len(s), len(base), 0 if i in linked else i, sorted(s ^ base)) for i, s in sets.items() if i]
        family = spark.createDataFrame(rows, "leader long, node long, n long, n2 long, component long, delta array<long>")
        got = {(r.a, r.b) for r in minhash.pairs_by_difference(family, percent).collect()}
        want = {(i, j) for i in sets for j in sets if 0 < i < j and similar(sets[i], sets[j]) and not {i, j} <= linked}
        assert want and want <= got and len(got) < 90 * 89 / 4


def test_repeated_ids_and_empty(spark):
    same = " ".join(f"a{i}" for i in range(40))
    rows = [(7, same), (7, same), (7, same + " z"), (3, same + " z z"), (9, "other text here"), (9, "quite another one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df, width=2).select("doc_id", "component_id").collect()))
    assert got == [(3, 3), (7, 3), (7, 3), (7, 3), (9, 9), (9, 9)]
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    x, y = np.unique(pool[:1000]), np.unique(pool[100:1100])
    hasher = minhash.Hasher(rows=100, bands=20)
    with np.errstate(over="ignore"):
        (a, b), (c, d) = hasher.signature(x), hasher.signature(y)
    estimate = (np.mean(a == c) + np.mean(b == d)) / 2
    assert abs(estimate - 900 / 1100) < 0.05


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, i) for i in range(5001, 5200)] + [(4, 4), (None, 3)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    got = sorted(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == sorted((i, root(i)) for i in parent)


def test_a_large_family_of_one_component_makes_no_rows(spark):
    """8,000 members that share a difference from their leader, all connected already."""
    from pyspark.sql import functions as F

    n = 8000
    family = spark.range(1, n + 1).select(
        F.lit(0).cast("long").alias("leader"), F.col("id").alias("node"), F.lit(100).cast("long").alias("n"), F.lit(100).cast("long").alias("n2"),
        F.lit(1).cast("long").alias("component"), F.array(F.lit(5), F.lit(6), *[F.col("id") * 1000 + k for k in range(40)]).cast("array<long>").alias("delta"),
    )
    pairs = minhash.pairs_by_difference(family, 80)
    start = time.monotonic()
    assert pairs.count() == 0 and time.monotonic() - start < 60


def test_components_of_hot_nodes(spark):
    edges = [(0, i) for i in range(1, 400)] + [(i, i + 1000) for i in range(1, 400)] + [(5000, 5001)] + [(i, 399) for i in range(380, 399)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {n for n, c in got.items() if c == 0} == set(range(400)) | {i + 1000 for i in range(1, 400)} and got[5001] == 5000
