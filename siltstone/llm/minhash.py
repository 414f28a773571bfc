"""Near-duplicate documents by min-max hashing.

A document's set holds its distinct word shingles, as 64-bit hashes. Every permutation of the hash space is evaluated
once and gives two signature values, the least and the greatest image of the set; both agree between two sets with the
probability of their similarity. Bands of `rows` values from different permutations, all least or all greatest, are
hashed to keys, and documents that share a key are candidates. With 5 rows and 40 bands from 100 permutations a pair at
a similarity of 0.8 has no common key once in 8 million.

Equal sets are first reduced to one representative each. Within a bucket no pairs are listed: one leader is compared
with each other member on full sets, and the links found are joined to components. The leader is the member that shares
the most keys with others, so the original among its variants. Buckets whose other members are by then in one component
are done. In the others each member is written as its difference from the leader: two members differ from each other in
at most |d1| + |d2| elements, less two for each element that d1 and d2 share. Two that aren't connected yet, of which
one isn't linked to the leader, can therefore only be similar if they share more than half of the other's difference;
so only pairs that share one of its rarer half are compared, and only elements that two components have are looked at. That is exact: every pair with a common key is compared,
connected, or ruled out by these counts, and no bucket is cut short. Hot buckets are spread: leaders and frequencies
come from partial aggregates, members join them.

Cases: a null or blank text has no set, is its own component and is kept. A row with a null id takes no part: its
component is null and it is kept. Repeated rows of one id are one node; each row is returned. Texts with fewer words
than a shingle have their whole word sequence as the one shingle. Long texts need memory in proportion to their words.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import durable
from siltstone.llm.components import connected_components

ROWS, BANDS = 5, 40
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_U = np.uint64
#: Elements times permutations evaluated at once.
_CELLS = 1 << 20


class _Words(dict):
    """64-bit hashes of words; emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text, as 64-bit hashes; letters A-Z count as a-z."""
    if not text:
        return np.empty(0, dtype=_U)
    words = text.encode().translate(_LOWER).split()
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=_U, count=len(words))
    width = min(width, len(h)) or 1
    n = len(h) - width + 1
    acc = np.full(max(n, 0), width, dtype=_U)
    for k in range(width if len(h) else 0):
        acc = _mix(acc * _U(0x9E3779B97F4A7C15) ^ h[k : k + n])
    return np.unique(acc)


class Hasher:
    """Band keys and fingerprints of shingle sets."""

    def __init__(self, rows: int = ROWS, bands: int = BANDS, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.rows, self.bands = rows, bands
        n = rows * -(-bands // 2)
        self.a = rng.integers(0, 2**63, n, dtype=np.uint64) * _U(2) + _U(1)
        self.b = rng.integers(0, 2**63, n, dtype=np.uint64)

    def signature(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) image of the set under each permutation."""
        low, high = np.full(len(self.a), ~_U(0)), np.zeros(len(self.a), dtype=_U)
        step = max(1, _CELLS // len(self.a))
        for at in range(0, len(s), step):
            images = np.multiply.outer(self.a, s[at : at + step])
            images += self.b[:, None]
            np.minimum(low, images.min(axis=1), out=low)
            np.maximum(high, images.max(axis=1), out=high)
        return low, high

    def keys(self, s: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band; even bands hold minima, odd ones maxima of the same permutations."""
        low, high = self.signature(s)
        values = np.stack((low.reshape(-1, self.rows), high.reshape(-1, self.rows)), axis=1).reshape(-1, self.rows)[: self.bands]
        key = np.arange(1, self.bands + 1, dtype=_U)
        for k in range(self.rows):
            key = _mix(key * _U(0x9E3779B97F4A7C15) ^ values[:, k])
        return key


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    one = _mix(s ^ _U(0xA0761D6478BD642F)).sum(dtype=_U) + _U(len(s))
    two = _mix(s * _U(0xE7037ED1A0B428DB)).sum(dtype=_U)
    return int(np.int64(one)), int(np.int64(two))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def signatures(df: DataFrame, width: int, rows: int, bands: int) -> DataFrame:
    """Rows (doc_id, n_shingles, f1, f2, keys) from (doc_id, text); keys is null for an empty set."""
    schema = "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(rows, bands)
        with np.errstate(over="ignore"):
            for batch in batches:
                n, one, two, keys = [], [], [], []
                for text in batch.column(1):
                    s = shingles(text.as_py(), width)
                    f = fingerprint(s)
                    n.append(len(s))
                    one.append(f[0])
                    two.append(f[1])
                    keys.append(_signed(hasher.keys(s)) if len(s) else None)
                columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "f1", "f2", "keys"])

    return df.mapInArrow(run, schema)


def shingle_sets(df: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, f1, f2, shingles binary) from (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = [shingles(text.as_py(), width) for text in batch.column(1)]
                prints = [fingerprint(s) for s in sets]
                columns = [pa.array([p[k] for p in prints], pa.int64()) for k in (0, 1)]
                columns = [batch.column(0), *columns, pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "f1", "f2", "shingles"])

    return df.mapInArrow(run, "doc_id long, f1 long, f2 long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets (node, shingles) are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=_U) for v in (x, y))
                both = np.sort(np.concatenate((x, y)), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _components(links: DataFrame, members: DataFrame) -> DataFrame:
    """members with `component`: that of its node, or the node where nothing is linked to it."""
    found = connected_components(links)
    joined = members.join(found, members["node"] == found["node"], "left").select(members["*"], "component")
    return joined.withColumn("component", F.coalesce("component", "node"))


def differences(family: DataFrame, sets: DataFrame) -> DataFrame:
    """family with `delta`: the elements that only one of node and leader has."""
    columns = family.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=_U) for v in (x, y))
                out.append(_signed(np.setxor1d(x, y, assume_unique=True)))
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.list_(pa.int64()))], [*columns, "delta"])

    left = sets.select("node", F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("leader"), F.col("shingles").alias("y"))
    schema = ", ".join(f"{c} {kind}" for c, kind in family.dtypes)
    return family.join(left, "node").join(right, "leader").mapInArrow(run, f"{schema}, delta array<long>")


def pairs_by_difference(family: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one leader, in different components, that may be similar.

    family: (leader, node, n, n2, component, delta), n and n2 the sizes of node's and leader's sets. Similar means that
    the difference is at most c times the sum of sizes. With node a not linked to the leader, |a ^ leader| is more than
    that, and similar a and b share more than (|delta b| + c (n2 - n of b)) / 2 elements of their differences, and at least
    (|delta a| + |delta b| - c (n of a + n of b)) / 2."""
    c = (100 - percent) / (100 + percent)
    elements = family.withColumn("d", F.size("delta")).withColumn("e", F.explode("delta")).drop("delta")
    # an element that only one component has links nothing new
    mixed = (F.min("component") != F.max("component")).alias("mixed")
    often = elements.groupBy("leader", "e").agg(F.count("*").alias("f"), mixed)
    counted = elements.join(often, ["leader", "e"])
    order = Window.partitionBy("leader", "node").orderBy("f", "e")
    shared = F.floor((F.col("d") + c * (F.col("n2") - F.col("n"))) / 2 - 1e-9)
    ranked = counted.withColumn("k", F.row_number().over(order)).where("mixed")
    rare = ranked.where(F.col("k") <= F.col("d") - shared)
    rare = rare.select("leader", "e", *[F.col(x).alias(x[0] + "b") for x in ("node", "component", "k", "d")], F.col("n").alias("sb"))
    apart = ranked.where(F.col("d") > c * (F.col("n") + F.col("n2")) - 1e-9)
    apart = apart.select("leader", "e", *[F.col(x).alias(x[0] + "a") for x in ("node", "component", "k", "d")], F.col("n").alias("sa"))
    close = F.least("sa", "sb") * 100 >= F.greatest("sa", "sb") * percent
    # of the elements that these two must share, the rarest is among the first of either that leave room for the others
    least_shared = F.ceil((F.col("da") + F.col("db") - c * (F.col("sa") + F.col("sb"))) / 2 - 1e-9)
    early = (F.col("ka") <= F.col("da") - least_shared + 1) & (F.col("kb") <= F.col("db") - least_shared + 1)
    found = apart.join(rare, ["leader", "e"]).where("ca <> cb").where(close & early)
    found = found.select(F.col("na").alias("a"), F.col("nb").alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links_of(nodes: DataFrame, sets_of, percent: int) -> DataFrame | None:
    """Links (a, b) between nodes (node, n, keys) that connect exactly what all links connect; None without candidates.

    sets_of: gives full sets (node, shingles) for a DataFrame of nodes."""
    rows = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    active = durable(rows.join(shared, "key"))
    if active.isEmpty():
        return None
    sets = durable(sets_of(active.select("node").distinct()))
    standing = active.groupBy("node").agg(F.sum("size").alias("standing"))
    best = F.max(F.struct("standing", (-F.col("node")).alias("m"), "n")).alias("best")
    leaders = active.join(standing, "node").groupBy("key").agg(best)
    leaders = leaders.select("key", (-F.col("best.m")).alias("leader"), F.col("best.n").alias("n2"))
    led = durable(active.join(leaders, "key").where("node <> leader").select("key", "node", "n", "leader", "n2"))
    close = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
    pairs = led.where(close).select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    links = durable(confirmed(pairs, sets, percent))
    rest = _components(links, led)
    mixed = rest.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("key")
    family = rest.join(mixed, "key", "left_semi").select("leader", "node", "n", "n2", "component").distinct()
    family = durable(family)
    if family.isEmpty():
        return links
    more = pairs_by_difference(durable(differences(family, sets)), percent)
    return links.union(durable(confirmed(more, sets, percent)))


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of df."""
    texts = df.select(df[id_column].cast("long").alias("doc_id"), df[text_column].cast("string").alias("text"))
    signed = durable(signatures(texts, width, rows, bands))
    able = signed.where("doc_id is not null and n_shingles > 0")
    equal = durable(able.groupBy("f1", "f2").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")))
    repeated = not able.groupBy("doc_id").count().where("count > 1").isEmpty()
    nodes = able.join(equal.withColumnRenamed("node", "doc_id"), ["doc_id", "f1", "f2"])
    nodes = nodes.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "keys")

    def sets_of(wanted: DataFrame) -> DataFrame:
        chosen = wanted.join(equal, "node").select(F.col("node").alias("doc_id"), "f1", "f2")
        sets = shingle_sets(texts.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi"), width)
        if repeated:  # one row for each set
            sets = sets.join(chosen, ["doc_id", "f1", "f2"]).dropDuplicates(["doc_id", "f1", "f2"])
        return sets.select(F.col("doc_id").alias("node"), "shingles")

    links = links_of(nodes, sets_of, percent)
    # copies hang on the node of their set; a node may itself be the row of another set where ids repeat
    own = able.select("doc_id", "f1", "f2").join(equal.where("copies > 1"), ["f1", "f2"])
    edges = own.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    if links is not None:
        edges = edges.union(links)
    found = durable(connected_components(edges))
    joined = signed.join(found, signed["doc_id"] == found["node"], "left")
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))
