import numpy as np
import pytest

from siltstone.llm import topk


def brute(rows, k, n=50):
    good = {(i, tuple(v)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)}
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in good]
    out = []
    for q, qv in good:
        if q % n == 0:
            found = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if i != q and len(v) == len(qv))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, **opts):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string")
    v = topk.quantised(df, "vec_id", "embedding")
    return sorted(map(tuple, topk.exact_topk(v, topk.every_nth_query(v), **opts).collect()))


@pytest.mark.parametrize("block", [64, 4096])
def test_matches_brute_force_with_ties_and_odd_rows(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8) * 0.1)], "x") for i in range(300)]
    rows += [(i, rows[3][1], "tie") for i in range(300, 420)] + [rows[7]]
    rows += [(500, None, ""), (550, [], ""), (600, [None] * 8, ""), (650, [float("nan")] * 8, ""), (700, [float("inf")] * 8, "")]
    assert run(spark, rows, corpus_block=block, query_block=4) == brute([r[:2] for r in rows], 5)


def test_few_candidates_and_empty(spark):
    assert run(spark, [(50, [1.0, 0.0], ""), (51, [0.5, 2.0], ""), (100, [0.0, 0.0], "")]) == [
        (50, 1, 51, 32768), (50, 2, 100, 0), (100, 1, 50, 0), (100, 2, 51, 0),
    ]
    assert run(spark, []) == []


def test_stops_early():
    """With one dominant dimension the lists are left long before their end."""
    n = 4096
    corpus = np.zeros((n, 4))
    corpus[:, 0] = np.arange(n) * 1000
    corpus[:, 1:] = np.random.default_rng(0).integers(-3, 4, (n, 3))
    query = np.array([[5.0, 1, -1, 1]])

    class Counted(np.ndarray):
        scored = 0

        def __matmul__(self, other):
            Counted.scored += len(self)
            return np.asarray(self) @ np.asarray(other)

    found = topk.threshold_topk(corpus.view(Counted), np.arange(n), query, np.array([-1]), 5)
    assert [i for _, i, _ in found] == [4095, 4094, 4093, 4092, 4091]
    assert Counted.scored < n


def test_very_large_numbers_stay_exact():
    big = np.array([[2**40, 1], [2**40, 2], [0, 2**30]], dtype=object)
    found = topk.threshold_topk(big, np.arange(3), big[:1], np.array([0]), 2)
    assert found == [(0, 1, 2**80 + 2), (0, 2, 2**30)]


def test_a_floor_stops_before_anything_is_read():
    corpus = np.arange(40, dtype=np.float64).reshape(20, 2)
    query = np.array([[1.0, 1.0]])
    assert topk.threshold_topk(corpus, np.arange(20), query, np.array([-1]), 2, [78]) == []
    assert (0, 19, 77) in topk.threshold_topk(corpus, np.arange(20), query, np.array([-1]), 2, [77])


def long_score(x):
    return min(max(x, -(2**63)), 2**63 - 1)


@pytest.mark.parametrize("block", [3, 4096])
def test_large_ids_and_repeated_rows(spark, block):
    big = 2**53
    rows = [(50, [1.0, 0.0]), (51, [0.5, 0.5]), (51, [0.5, 0.5]), (big + 1, [0.25, 1.0]), (big + 2, [0.25, 1.0]), (big, [0.25, 1.0]), (-7, [0.1, 0.0])]
    got = run(spark, [(i, v, "") for i, v in rows], corpus_block=block)
    assert got == brute(rows, 5)
    assert [r[2] for r in got if r[0] == 50] == [51, big, big + 1, big + 2, -7]


def test_scores_beyond_a_long(spark):
    rows = [(50, [1e9] * 64, ""), (51, [1e9] * 64, ""), (52, [-1e9] * 64, ""), (53, [1.0] * 64, ""), (100, [3e38] * 64, "")]
    want = {(q, i): s for q, _, i, s in brute([r[:2] for r in rows], 9)}
    got = run(spark, rows, k=4)
    assert [(r[0], r[1], r[2]) for r in got] == [(50, 1, 51), (50, 2, 100), (50, 3, 53), (50, 4, 52), (100, 1, 50), (100, 2, 51), (100, 3, 53), (100, 4, 52)]
    assert want[50, 51] > 2**63 and all(r[3] == long_score(want[r[0], r[2]]) for r in got if r[0] == 50)
