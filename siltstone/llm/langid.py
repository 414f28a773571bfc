"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree of orders 0 to 3 with frozen counts. The probability of a byte is its share in
the longest known context; a byte that a context hasn't seen costs that context's escape probability (as many escapes
as it has distinct bytes, method C) and is then looked for in the next shorter context, and at last among all 256 bytes
alike. A text's code length under a language is the sum over all its bytes, and the language of the shortest code wins.

Training is bounded: at most `train_documents` labelled documents of each language, those of the smallest hash of id and
text, whole texts; and at most `most_languages` labels, the most frequent ones. Four-byte counts of that sample (all
lower orders are sums of them) are all that reaches the driver and, by broadcast, the workers, so what is broadcast
doesn't grow with the corpus. Prediction is one narrow pass.

Cases: a null text and one without letters give `und` with score 0. Rows with a null text or label teach nothing. Ties
go to the smaller name. With nothing to learn from every text is `und`. Rows repeated in id, text and label teach once
and are predicted each; rows of one id with different texts teach each. An empty table gives an empty result. A null id
counts as not held out. Other columns are ignored, also if they are named like results.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = 3
#: Labelled documents a language that the model is fitted on, at most.
TRAIN_DOCUMENTS = 1000
#: Labels that are learned, at most: the most frequent ones.
MOST_LANGUAGES = 400
#: Hashes are below this.
SPREAD = 1 << 52
#: Bytes scored at once.
WINDOW = 1 << 19
START = b"\n" * ORDER


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte strings, as big-endian numbers, that end at a byte of a text, and how often each occurs."""
    found = []
    for text in texts:
        b = np.frombuffer(START + text.encode(), dtype=np.uint8).astype(np.uint32)
        found.append(b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:])
    return np.unique(np.concatenate(found or [np.empty(0, np.uint32)]), return_counts=True)


class Trees:
    """The context trees of all languages side by side, as lookup tables of natural log probabilities.

    Orders 0 and 1 are dense; of orders 2 and 3 there is one row for each string seen, so memory is 4 bytes for each
    string and language, besides 256 KB a language."""

    def __init__(self, languages: list[str], codes: np.ndarray, counts: np.ndarray) -> None:
        """codes: sorted four-byte numbers; counts: a row for each, a column for each language."""
        self.languages = languages
        if not languages:
            return
        codes, counts = codes.astype(np.int64), counts.astype(np.float64)
        self.log1 = self._dense(codes, counts, len(languages))
        base = lambda seen: self.log1[seen & 65_535]
        seen, n = self._summed(codes & 0xFFFFFF, counts)
        self.row2, self.leaf2, self.escape2, self.log2 = self._sparse(seen, n, base)
        contexts = np.unique(codes >> 8)
        base = lambda seen: self._order2(self.row2[(seen >> 8) & 65_535], seen & 255, seen & 65_535)
        rows, self.leaf3, self.escape3, self.log3 = self._sparse(codes, counts, base)
        # rows of three-byte contexts by their first two bytes and then their last
        heads, head_of = np.unique(contexts >> 8, return_inverse=True)
        self.head = np.zeros(65_536, dtype=np.int32)
        self.head[heads] = np.arange(1, len(heads) + 1)
        self.row3 = np.zeros((len(heads) + 1) * 256, dtype=np.int32)
        self.row3[(head_of + 1) * 256 + (contexts & 255)] = rows

    @staticmethod
    def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen, at = np.unique(codes, return_inverse=True)
        n = np.zeros((len(seen), counts.shape[1]))
        np.add.at(n, at, counts)
        return seen, n

    def _dense(self, codes: np.ndarray, counts: np.ndarray, n_lang: int) -> np.ndarray:
        """Order 1 by context and byte, over order 0, over all bytes alike."""
        shorter, table = np.full((256, n_lang), -np.log(256)), None
        for mask in (255, 65_535):
            seen, n = self._summed(codes & mask, counts)
            contexts, of = np.unique(seen >> 8, return_inverse=True)
            escape, full = self._escapes(n, of, len(contexts))
            table = np.repeat(shorter[None], 1 if mask == 255 else 256, axis=0)
            table[contexts] += escape[:, None, :]
            known = np.log(np.maximum(n, 1)) - full[of]
            table[contexts[of], seen & 255] = np.where(n > 0, known, table[contexts[of], seen & 255])
            shorter = table[0]
        return table.reshape(65_536, n_lang).astype(np.float32)

    def _sparse(self, seen: np.ndarray, n: np.ndarray, base) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of one order: row by context (0 where unknown), leaf by row and byte, escapes by row, logs by leaf."""
        contexts, of = np.unique(seen >> 8, return_inverse=True)
        escape, full = self._escapes(n, of, len(contexts))
        none = np.zeros((1, n.shape[1]))
        logs = np.where(n > 0, np.log(np.maximum(n, 1)) - full[of], escape[of] + base(seen))
        rows = np.arange(1, len(contexts) + 1)
        leaf = np.zeros((len(contexts) + 1) * 256, dtype=np.int32)
        leaf[(of + 1) * 256 + (seen & 255)] = np.arange(1, len(seen) + 1)
        if len(seen) and seen[-1] < 1 << 24:
            by_context = np.zeros(65_536, dtype=np.int32)
            by_context[contexts] = rows
            rows = by_context
        return rows, leaf, np.concatenate((none, escape)).astype(np.float32), np.concatenate((none, logs)).astype(np.float32)

    def _order2(self, rows: np.ndarray, symbols: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Log probabilities with two bytes of context: of the leaf, or of order 1 after an escape."""
        leaf = self.leaf2[rows * 256 + symbols]
        total = self.escape2[rows] + self.log1[pairs]
        hit = np.flatnonzero(leaf)
        total[hit] = self.log2[leaf[hit]]
        return total

    @staticmethod
    def _escapes(n: np.ndarray, of: np.ndarray, n_contexts: int) -> tuple[np.ndarray, np.ndarray]:
        """By context and language: the log of the escape probability (0 where the context is unknown), and that of
        all counts with escapes."""
        total, distinct = np.zeros((n_contexts, n.shape[1])), np.zeros((n_contexts, n.shape[1]))
        np.add.at(total, of, n)
        np.add.at(distinct, of, n > 0)
        full = np.log(np.maximum(total + distinct, 1))
        return np.where(total > 0, np.log(np.maximum(distinct, 1)) - full, 0.0), full

    def log_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Natural log probability of each whole text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        buffer = np.frombuffer(b"".join(START + t for t in texts), dtype=np.uint8)
        ends = np.cumsum([len(t) + ORDER for t in texts])
        starts = ends - [len(t) for t in texts]  # of the real bytes
        for at in range(0, len(buffer), WINDOW):
            upto = min(at + WINDOW, len(buffer))
            lo = max(at, ORDER)
            if lo >= upto:
                continue
            b = buffer[lo - ORDER : upto].astype(np.int32)
            pairs = b[:-1] << 8 | b[1:]
            s = b[3:]
            row3 = self.row3[self.head[pairs[:-2]] * 256 + b[2:-1]]
            total = self.escape3[row3] + self._order2(self.row2[pairs[1:-1]], s, pairs[2:])
            leaf = self.leaf3[row3 * 256 + s]
            hit = np.flatnonzero(leaf)
            total[hit] = self.log3[leaf[hit]]
            first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, upto, "left")
            for d in range(first, last):
                x, y = max(starts[d], lo), min(ends[d], upto)
                if x < y:
                    out[d] += total[x - lo : y - lo].sum(axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        usable = [t is not None and any(map(str.isalpha, t)) for t in texts]
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        logs = iter(self.log_probabilities([t.encode() for t, ok in zip(texts, usable, strict=True) if ok]))
        out = []
        for ok in usable:
            if not ok:
                out.append(("und", 0.0))
                continue
            x = next(logs)
            best = int(np.argmax(x))  # the first of equals: languages are sorted
            out.append((self.languages[best], float(1 / np.exp(x - x[best]).sum())))
        return out


def _sample(df: DataFrame, train_documents: int, most_languages: int, spread: int = SPREAD) -> tuple[list[str], DataFrame | None]:
    """The languages and (lang, text) of the distinct rows of the smallest hashes of (lang, id, text) of each.

    Hashes below a limit are looked at first, so that little is shuffled; a language for which that gave too few rows
    (its rows repeat) is looked at again with a wider limit, up to all of its rows."""
    labelled = df.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    by_size = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    sizes = {r["lang"]: r["n"] for r in by_size.collect()}
    if not sizes:
        return [], None
    hashed = labelled.withColumn("h", F.pmod(F.xxhash64("lang", "doc_id", "text"), F.lit(spread)))
    limits = {lang: min(spread, spread * 4 * train_documents // n + 1) for lang, n in sizes.items()}
    cuts: dict[str, int] = {}  # the greatest hash that a language's sample has
    while len(cuts) < len(sizes):
        open_limits = {lang: limit for lang, limit in limits.items() if lang not in cuts}
        near = hashed.where(F.col("h") < _by_language(open_limits)).select("lang", "h").distinct()
        order = Window.partitionBy("lang").orderBy("h")
        first = near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= train_documents)
        for r in first.groupBy("lang").agg(F.count("*").alias("n"), F.max("h").alias("h")).collect():
            if r["n"] == train_documents or limits[r["lang"]] == spread:
                cuts[r["lang"]] = r["h"]
        limits = {lang: min(spread, limit * 64) for lang, limit in limits.items()}
    chosen = hashed.where(F.col("h") <= _by_language(cuts)).dropDuplicates(["lang", "h"])
    return sorted(sizes), chosen.select("lang", "text")


def _by_language(values: dict[str, int]) -> Column:
    """A number by language; null for languages that have none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("lang"))


def train(
    df: DataFrame, train_documents: int = TRAIN_DOCUMENTS, most_languages: int = MOST_LANGUAGES
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, codes and counts from (doc_id, text, lang); only rows that may teach should be given."""
    languages, sample = _sample(df, train_documents, most_languages)
    if sample is None:
        return [], np.empty(0, np.int64), np.empty((0, 0))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for lang, rows in part.groupby("lang"):
                codes, n = grams(list(rows.text))
                yield pd.DataFrame({"lang": lang, "code": codes.astype(np.int64), "n": n.astype(np.int64)})

    counted = sample.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    got = counted.toArrow()
    codes, at = np.unique(got["code"].to_numpy(), return_inverse=True)
    counts = np.zeros((len(codes), len(languages)))
    column = {lang: i for i, lang in enumerate(languages)}
    counts[at, [column[x] for x in got["lang"].to_pylist()]] = got["n"].to_numpy()
    return languages, codes, counts


_TREES: dict[str, Trees] = {}


def predict_languages(df: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score) from (doc_id, text)."""
    shared, key = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _TREES:  # built once in each Python worker
            _TREES.clear()
            _TREES[key] = Trees(*shared.value)
        trees = _TREES[key]
        for batch in batches:
            found = []
            for at in range(0, len(batch), 256):
                found += trees.predict(batch.column(2).slice(at, 256).to_pylist())
            columns = [batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify_languages(df: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """Train on what isn't held out, then predict every row of (doc_id, text, lang)."""
    rows = df.select("doc_id", "text", "lang")
    return predict_languages(rows, train(rows.where(~held_out(F.col("doc_id"))), train_documents))
