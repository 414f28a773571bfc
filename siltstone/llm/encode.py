"""The byte-level BPE operator on DataFrames; the algorithm itself is in bpe.py."""

from __future__ import annotations

import hashlib
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.bpe import codec


def little_endian_ids(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit integers, least significant byte first."""
    packed = array("I", ids)
    if packed.itemsize != 4:
        packed = array("L", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def encode_documents(df: DataFrame, vocabulary: str, pattern: str, id_column: str, text_column: str) -> DataFrame:
    """Rows (doc_id, ids array<int>) of the whole texts. The vocabulary file must be at the same path on every
    executor. One narrow pass: no shuffle, and a lost task reads only its own split again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            ids = [own.encode(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _named(df, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(df: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Rows (doc_id, bytes binary) from (doc_id, ids array<int>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            data = [own.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "bytes"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip_digests(df: DataFrame, vocabulary: str, pattern: str, id_column: str, text_column: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded again, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py())
                counts.append(len(ids))
                encoded.append(hashlib.sha256(little_endian_ids(ids)).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _named(df, id_column, text_column).mapInArrow(run, schema)


def _named(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return df.select(df[id_column].cast("long").alias("doc_id"), df[text_column].cast("string").alias("text"))
