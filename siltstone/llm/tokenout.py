"""Packed token-id output: best-fit-decreasing with capacity search in a segment tree.

Documents become streams of ids with an end token. A stream longer than a sequence is split losslessly: its pieces,
joined by start, are the stream again. Pieces of one buffer (a bounded number of tokens of one input split) are sorted
by length, longest first, and each goes to the bin with the least free space that still holds it. A segment tree over
free space, whose nodes say whether any bin below them is open, finds that bin in log(capacity) steps.

Each row of the result is one sequence: a line of the id matrix (`input_ids`, unsigned little-endian integers, padded
with the end token), the cumulative lengths of its segments (`cu_seqlens`, from 0 to the number of real tokens), the
positions (`position_ids`, restarting at 0 at each segment), and where each segment comes from. write_matrices() writes
them as blocks of `rows_per_block` lines, so a trainer reads fixed-size matrices from any store that Spark writes to.

One narrow pass: no shuffle; a lost task packs its own split again, in the same way. Each buffer packs alone, so it may
leave its last sequences short: with the default buffer well under one in a thousand (README).

Cases: a null or empty text is one segment of the end token. Repeated rows are packed each. Ties in length keep the
order of arrival; ties in fit go to the bin opened or filled last. An empty table gives no sequences. Null ids are kept.
An id that `id_bytes` can't hold is an error and never wraps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.packing import cuts, stream
from siltstone.llm.tokens import reader

#: Tokens that a task holds before it packs them.
BUFFER_TOKENS = 8_000_000
SEQUENCES = (
    "sequence_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>,"
    " doc_ids array<long>, starts array<long>"
)


class CapacityTree:
    """Open bins by free space; finds the least free space that is at least a length."""

    def __init__(self, capacity: int) -> None:
        self.width = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, bin_: int) -> None:
        self.bins[free].append(bin_)
        node = self.width + free
        while node and not self.open[node]:
            self.open[node] = True
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(free space, bin) of the tightest bin, which leaves the tree; None if none is large enough."""
        node = self.width + least
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):  # up, until something open lies to the right
                node >>= 1
            if node <= 1:
                return None
            node += 1
        while node < self.width:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        free = node - self.width
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.open[node] = False
            node >>= 1
            while node and not (self.open[2 * node] or self.open[2 * node + 1]):
                self.open[node] = False
                node >>= 1
        return free, found


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes into lengths."""
    tree, bins = CapacityTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        free, chosen = found if found else (capacity, len(bins))
        if found is None:
            bins.append([])
        bins[chosen].append(i)
        if free > lengths[i]:
            tree.add(free - lengths[i], chosen)
    return bins


def narrowed(ids: np.ndarray, kind: str) -> np.ndarray:
    """The same ids in another width; an error if one doesn't fit."""
    if len(ids) and int(ids.max()) > np.iinfo(kind).max:
        raise ValueError(f"token id {int(ids.max())} does not fit {np.dtype(kind).itemsize} bytes: use id_bytes=4")
    return ids.astype(kind)


def packed_sequences(
    df: DataFrame,
    vocabulary: str,
    pattern: str | None,
    end_id: int,
    capacity: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
    id_bytes: int = 2,
) -> DataFrame:
    """Rows of SEQUENCES. id_bytes: 2 for vocabularies below 65,536 ids, else 4."""
    kind = f"<u{id_bytes}"
    if not 0 <= end_id <= np.iinfo(kind).max:
        raise ValueError(f"end_id {end_id} does not fit {id_bytes} bytes")

    def emit(pieces: list[tuple], base: int) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(7)]
        for n, members in enumerate(best_fit_decreasing([len(p[2]) for p in pieces], capacity)):
            line = np.full(capacity, end_id, dtype=kind)
            places = np.zeros(capacity, dtype="<u4" if capacity > 65_535 else "<u2")
            ends = [0]
            for i in members:
                ids = pieces[i][2]
                at, end = ends[-1], ends[-1] + len(ids)
                line[at:end] = ids
                places[at:end] = np.arange(len(ids))
                ends.append(end)
            row = (base + n, ends[-1], line.tobytes(), places.tobytes(), ends, [pieces[i][0] for i in members], [pieces[i][1] for i in members])
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
        names = [f.split()[0] for f in SEQUENCES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = reader(vocabulary, pattern).ids
        base, pieces, held = TaskContext.get().partitionId() << 36, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole = narrowed(stream(ids_of(text.as_py()), end_id), kind)
                for start, length in cuts(len(whole), capacity):
                    pieces.append((doc_id, start, whole[start : start + length]))
                held += len(whole)
                if held >= BUFFER_TOKENS:
                    done = emit(pieces, base)
                    base, pieces, held = base + len(done), [], 0
                    yield done
        if pieces:
            yield emit(pieces, base)

    documents = df.select(df[id_column].cast("long").alias("doc_id"), df[text_column].cast("string").alias("text"))
    return documents.mapInArrow(run, SEQUENCES)


def write_matrices(sequences: DataFrame, path: str, rows_per_block: int = 256) -> None:
    """Blocks of lines: `input_ids` and `position_ids` as one matrix each, `cu_seqlens` and the sources a line each.
    Only the last block of a task may be short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 36, []
        for batch in batches:
            for at in range(0, len(batch), rows_per_block):  # so that no more than a block is held as Python objects
                held += batch.slice(at, rows_per_block).to_pylist()
                if len(held) >= rows_per_block:
                    yield _block(block, held[:rows_per_block])
                    block, held = block + 1, held[rows_per_block:]
        if held:
            yield _block(block, held)

    schema = (
        "block_id long, n_rows int, input_ids binary, position_ids binary, cu_seqlens array<array<int>>,"
        " doc_ids array<array<long>>, starts array<array<long>>"
    )
    sequences.mapInArrow(run, schema).write.mode("errorifexists").parquet(path)


def _block(block_id: int, rows: list[dict]) -> pa.RecordBatch:
    joined = lambda name: pa.array([b"".join(r[name] for r in rows)], pa.binary())
    listed = lambda name, kind: pa.array([[r[name] for r in rows]], pa.list_(pa.list_(kind)))
    columns = {
        "block_id": pa.array([block_id], pa.int64()),
        "n_rows": pa.array([len(rows)], pa.int32()),
        "input_ids": joined("input_ids"),
        "position_ids": joined("position_ids"),
        "cu_seqlens": listed("cu_seqlens", pa.int32()),
        "doc_ids": listed("doc_ids", pa.int64()),
        "starts": listed("starts", pa.int64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def restored_streams(sequences: DataFrame, id_bytes: int = 2) -> DataFrame:
    """Rows (doc_id, start, ids binary): the segments of packed sequences, for round trips."""
    parts = F.transform(
        F.sequence(F.lit(1), F.size("doc_ids")),
        lambda i: F.struct(
            F.element_at("doc_ids", i).alias("doc_id"),
            F.element_at("starts", i).alias("start"),
            F.substring(
                F.col("input_ids"),
                F.element_at("cu_seqlens", i) * id_bytes + 1,
                (F.element_at("cu_seqlens", i + 1) - F.element_at("cu_seqlens", i)) * id_bytes,
            ).alias("ids"),
        ),
    )
    return sequences.select(F.inline(parts))
