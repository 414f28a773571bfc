"""The corpus pipeline: quality rules, line dedup, near-dedup, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of documents, with
n_chars brought up to date wherever a stage changes texts:

* quality_rules removes failed lines and rejects documents,
* line_dedup takes lines out that are boilerplate of their source,
* near_duplicates keeps one document of each group of near copies (five-word shingles, similarity 0.8),
* personal_data replaces every span by its kind in brackets,
* best_fit_packing returns one row for each piece of each document, with its sequence and place.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import compat
from siltstone.llm import lines, minhash, packing, pii, quality
from siltstone.llm.common import durable
from siltstone.session import shared_folder
from siltstone.sources.files import Store

#: Ids of removed documents that are still broadcast (8 bytes each).
BROADCAST_IDS = 500_000


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """docs with n_chars as long as the text is, if it has the column."""
    n_chars = F.length("text").cast("long").alias("n_chars")
    return docs.select(*[n_chars if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(quality.clean_documents(docs), docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(lines.drop_boilerplate(docs, host="source", text="text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest id. Where ids repeat or are null, rows are judged each by its own
    text, and those without id come last; exact copies of id and text are one row."""
    if not docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return _near_duplicates_of_rows(docs)
    judged = minhash.near_duplicates(docs, width=5, percent=80).where("not kept")
    removed = durable(judged.select("doc_id").distinct())
    removed = F.broadcast(removed) if removed.count() <= BROADCAST_IDS else removed
    return docs.join(removed, "doc_id", "left_anti").select(*docs.columns)


def _near_duplicates_of_rows(docs: DataFrame) -> DataFrame:
    """near_duplicates() where ids repeat or are null: a row is known by id and text."""
    digest = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), digest.alias("digest"))
    rows = rows.dropDuplicates(["id", "digest"])
    # numbered in the order of id and text, over fixed partitions, so that a group keeps its smallest id
    numbered = compat.with_position(rows.select("id", "digest").orderBy(F.col("id").asc_nulls_last(), "digest"), "at")
    numbered = durable(numbered.select("at", F.col("id").alias("of_id"), F.col("digest").alias("of_digest")))
    keyed = rows.join(numbered, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_digest")))
    texts = keyed.select(F.col("at").alias("doc_id"), F.col("row.text").alias("text"))
    kept = minhash.near_duplicates(texts, width=5, percent=80).where("kept").select(F.col("doc_id").alias("at"))
    return keyed.join(durable(kept), "at", "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.redact(docs, "text"), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path, public_tokenizers.PATTERN, end_id=2, capacity=1024)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Near-duplicate groups and token ids can't be had in SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir. What a stage passes on is written to the shared folder and
    removed once the next one has been written; the result reads the last of these."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            now = f"{folder}/{k}-{name}"
            docs.write.parquet(now)
            if before:
                Store(spark).delete(before, True)
            docs, before = spark.read.parquet(now), now
    return docs
