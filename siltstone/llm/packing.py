"""Bounded-space online best-fit packing of documents into sequences of fixed length.

A document's ids plus one end token form its stream. A stream no longer than a sequence stays whole. A longer one is
cut into full pieces; what is left over comes first, so the first piece may be shorter. Full pieces are sequences of
their own. Every other piece goes, as it arrives, into the open bin that it fills best. Open bins hang in lists by their
free space and one bitset says which lists hold any: best fit is the lowest set bit at or above the length. At most
`open_bins` bins are open; one more, and the fullest (lowest set bit of all) closes. A packer's memory is that bound.

Tokenising is one narrow pass over the texts. Only rows of piece sizes are shuffled, dealt evenly (so repeated or null
ids don't gather) to packers of about `per_packer` documents each. They arrive in the order of their
checksums, which has nothing to do with their sizes, so a packer that runs again packs the same way. Packers never share a sequence.

Cases: a null or empty text is one piece of the end token alone. Repeated rows are packed each. Ties in fit go to the
bin opened or filled last. Null ids are kept. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from siltstone.llm.tokens import reader

#: Of about 6,000 bins that a packer of the default size fills; 8,192 would leave as much waste (README).
OPEN_BINS = 64
PER_PACKER = 16_384
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


class OpenBins:
    """A fixed number of open bins in a bitset keyed by free space."""

    def __init__(self, capacity: int, most: int) -> None:
        self.capacity, self.most = capacity, most
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.n_open = self.n_bins = self.n_closed = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of 1 to capacity tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            free, chosen = self.capacity, self.n_bins
            self.n_bins += 1
        left = free - length
        if left:
            self.by_free[left].append(chosen)
            self.bits |= 1 << left
            self.n_open += 1
            if self.n_open > self.most:
                self.n_closed += 1
                self._take((self.bits & -self.bits).bit_length() - 1)
        return chosen, self.capacity - free


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a stream: full pieces, after what is left over."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def stream(ids: np.ndarray, end_id: int) -> np.ndarray:
    """A document's ids and the end token, as little-endian unsigned 32-bit integers."""
    out = np.empty(len(ids) + 1, dtype="<u4")
    out[:-1] = ids
    out[-1] = end_id
    return out


def document_pieces(df: DataFrame, vocabulary: str, pattern: str | None, end_id: int, capacity: int) -> DataFrame:
    """Rows of PIECES from (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = reader(vocabulary, pattern).ids
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole = stream(ids_of(text.as_py()), end_id)
                for piece, (start, length) in enumerate(cuts(len(whole), capacity)):
                    rows.append((doc_id, piece, start, length, zlib.crc32(whole[start : start + length])))
            yield _batch(rows, PIECES)

    return df.mapInArrow(run, PIECES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    types = {"long": pa.int64(), "int": pa.int32()}
    arrays = [pa.array(c, types[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def pack_pieces(pieces: DataFrame, capacity: int, packers: int, open_bins: int = OPEN_BINS) -> DataFrame:
    """Rows of PACKED from rows of PIECES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            placed = [bins.place(length) for length in batch.column(3).to_pylist()]
            sequence = pa.array([base + b for b, _ in placed], pa.int64())
            offset = pa.array([o for _, o in placed], pa.int64())
            names = [*batch.schema.names, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns, sequence, offset], names)

    dealt = pieces.repartition(packers)
    return dealt.sortWithinPartitions("ids_crc32", "doc_id", "start", "length").mapInArrow(run, PACKED)


def pack_documents(
    df: DataFrame,
    vocabulary: str,
    pattern: str | None,
    end_id: int,
    capacity: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
    open_bins: int = OPEN_BINS,
    per_packer: int = PER_PACKER,
) -> DataFrame:
    """One row of PACKED for each piece of each document."""
    packers = max(1, -(-df.count() // per_packer))
    documents = df.select(df[id_column].cast("long").alias("doc_id"), df[text_column].cast("string").alias("text"))
    return pack_pieces(document_pieces(documents, vocabulary, pattern, end_id, capacity), capacity, packers, open_bins)
