"""Exact top-k inner-product search with the threshold algorithm over sorted per-dimension lists.

The corpus is cut into blocks of some thousand vectors. In a block every dimension has a list of the vectors sorted by
that component. For a query the lists are read in step, from the top where the query's component is positive and from
the bottom where it is negative; each vector met is scored in full (random access). The value that the lists show at
the depth reached bounds the score of every vector not met yet. Reading stops once that bound is below the kth score:
at an equal bound a vector not met could still tie with a smaller id.

Queries and corpus meet in a grid of (query block, corpus block) cells, so no task ever holds more than one block of
each and neither side is broadcast. Blocks are dealt by hash, so each is a fair sample of the corpus: the first is
searched before the others, and every query takes the kth score found there along as its floor. A cell stops, perhaps
before it reads anything, once its bound is below that floor. Each cell keeps k rows a query, merged by a rank-limited
window at the end.

Cases: a null vector, an empty one and one that holds null, NaN or an infinity take no part, neither as query nor as
candidate; so do rows with a null id. Repeated rows (same id, same vector) count once, whatever the size of the id. A
candidate with the query's id is the query's own and is left out; queries of one id share its k places. Vectors of
different lengths are never compared. Ties go to the smaller id. Sums are exact; a score that a long can't hold becomes
the nearest long, and such scores tie. A query without candidates has no rows; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import durable

CORPUS_BLOCK = 4096
#: Every corpus block is copied once for each block of queries, so these are the larger ones that memory allows.
QUERY_BLOCK = 8192
#: Rows read from each list before the bound is first looked at; doubled each time.
FIRST_DEPTH = 32
#: Integers up to this are exact in a double, so inner products below it are too.
EXACT = 2**53
LONGS = -(2**63), 2**63 - 1


def threshold_topk(corpus: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, floors=None):
    """For each query the k best rows of one block: lists of (row of query, id, score), best first.

    corpus and queries hold integers, as float64 where all products are exact there and as Python integers if not.
    floors: for each query a score that k rows elsewhere have; rows below it needn't be found."""
    n = len(ids)
    if not n or not len(queries):
        return []
    by_id = np.argsort(ids, kind="stable")  # equal scores then come in the order of ids
    corpus, ids = corpus[by_id], ids[by_id]
    lists = np.argsort(corpus, axis=0, kind="stable")
    shown = np.take_along_axis(corpus, lists, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    best_rows = [np.empty(0, dtype=np.int64)] * len(queries)
    best_scores = [np.empty(0, dtype=queries.dtype)] * len(queries)
    floors = [None] * len(queries) if floors is None else floors
    first = up @ shown[n - 1] + down @ shown[0]
    active = [q for q in range(len(queries)) if floors[q] is None or first[q] >= floors[q]]
    met = {q: np.zeros(n, dtype=bool) for q in active}
    depth, step = 0, FIRST_DEPTH
    while active and depth < n:
        upto = min(n, depth + step)
        high, low = lists[n - upto : n - depth], lists[depth:upto]
        bounds = up @ shown[n - upto] + down @ shown[upto - 1]
        still = []
        for q in active:
            seen = met[q]
            fresh = np.zeros(n, dtype=bool)
            fresh[high[:, queries[q] > 0]] = True
            fresh[low[:, queries[q] < 0]] = True
            if upto == n:
                fresh[:] = True  # lists of zero components were never read
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh)
            rows = rows[ids[rows] != query_ids[q]]
            scores = np.concatenate((best_scores[q], corpus[rows] @ queries[q]))
            rows = np.concatenate((best_rows[q], rows))
            if len(rows) > k:
                kth = np.sort(scores)[-k]
                keep = scores >= kth
                rows, scores = rows[keep], scores[keep]
            order = np.lexsort((rows, -scores))[:k]
            best_rows[q], best_scores[q] = rows[order], scores[order]
            reached = floors[q]
            if len(order) == k and (reached is None or best_scores[q][-1] > reached):
                reached = best_scores[q][-1]
            if reached is None or bounds[q] >= reached:
                still.append(q)
        active, depth, step = still, upto, step * 2
    return [(q, int(ids[r]), int(s)) for q in range(len(queries)) for r, s in zip(best_rows[q], best_scores[q], strict=True)]


def _distinct(side: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and floors (as objects; None for none) of one length, each row once."""
    side = side[side.v.map(len) == width]
    m = np.asarray([np.asarray(x, dtype=np.float64) for x in side.v]).reshape(len(side), width) + 0.0
    i = side.id.to_numpy(dtype=np.int64)
    floors = np.array([None if pd.isna(x) else int(x) for x in side.floor], dtype=object)
    _, first = np.unique(np.column_stack((i, m.view(np.int64))), axis=0, return_index=True)
    return i[first], m[first], floors[first]


def _search_cell(k: int):
    def search(queries: pd.DataFrame, corpus: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        for width in sorted(set(map(len, queries.v))):
            (qi, qm, floors), (ci, cm, _) = _distinct(queries, width), _distinct(corpus, width)
            if len(qi) and len(ci) and width * np.abs(qm).max() * np.abs(cm).max() >= EXACT:
                qm, cm = (np.vectorize(int, otypes=[object])(m) for m in (qm, cm))
            found += [(int(qi[q]), i, min(max(s, LONGS[0]), LONGS[1])) for q, i, s in threshold_topk(cm, ci, qm, qi, k, floors)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def exact_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    corpus_block: int = CORPUS_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score). corpus and queries: (id long, v array<double> of whole numbers)."""

    def whole(df: DataFrame) -> DataFrame:
        able = df.where(F.col("id").isNotNull() & (F.size("v") > 0) & _finite(F.col("v")))
        return able.select(F.col("id").alias("id"), F.col("v").alias("v"))  # columns of its own, also where both sides are one table

    n_corpus, n_queries = corpus.count(), queries.count()
    corpus_blocks = max(1, -(-n_corpus // corpus_block))
    query_blocks = max(1, -(-n_queries // query_block))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    # a text, since pandas would read longs with nulls as doubles
    no_floor = F.lit(None).cast("string")
    left = whole(queries).withColumn("q", block(query_blocks))
    right = whole(corpus).withColumn("c", block(corpus_blocks))

    def cells(left: DataFrame, right: DataFrame, first: int, last: int) -> DataFrame:
        every = lambda a, b: F.explode(F.sequence(F.lit(a), F.lit(b)).cast("array<long>"))
        left = left.withColumn("c", every(first, last))
        right = right.where(F.col("c").between(first, last)).withColumn("floor", no_floor).withColumn("q", every(0, query_blocks - 1))
        grid = left.groupBy("q", "c").cogroup(right.groupBy("q", "c"))
        return grid.applyInPandas(_search_cell(k), "query_id long, vec_id long, score long")

    found = cells(left.withColumn("floor", no_floor), right, 0, 0)
    if corpus_blocks > 1:
        found = durable(found)
        kth = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") == k)
        exact = (F.col("s") > LONGS[0]) & (F.col("s") < LONGS[1])
        floors = kth.where(exact).select(F.col("query_id").alias("id"), F.col("s").cast("string").alias("floor"))
        found = found.union(cells(left.join(floors, "id", "left"), right, 1, corpus_blocks - 1))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def quantised(df: DataFrame, id_column: str, vector_column: str, scale: int = 256) -> DataFrame:
    """(id, v): every component x as floor(scale * x), x taken as a double."""
    whole = F.transform(F.col(vector_column), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return df.select(F.col(id_column).cast("long").alias("id"), F.when(_finite(F.col(vector_column)), whole).alias("v"))


def _finite(v):
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def every_nth_query(df: DataFrame, n: int = 50) -> DataFrame:
    """The stated query set: rows whose id is divisible by n."""
    return df.where(F.col("id") % n == 0)
