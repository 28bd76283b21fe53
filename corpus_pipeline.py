"""From raw documents to packed training sequences, in five stages.

Each stage takes (session, documents, folder of the tables) and returns a frame; ``run`` writes it as Parquet into the shared
folder and reads it again as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import block_naming, order_minhash, packing, pii, quality_knn
from skytally.llm.queries import TOKENIZER
from skytally.llm.shared import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It learns from the labels of the documents at hand."""
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = quality_knn.score_quality(docs, labels, keep=COLUMNS)
    return scored.filter("predicted = 1").select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id; of rows that repeat id and text, one."""
    docs = docs.select(*COLUMNS)
    found = block_naming.find_exact_duplicates(docs.select("doc_id", "text"), one_row=True)
    kept = found.filter("kept").select(F.col("id").alias("kept_id"), "text_sha256").distinct()
    return _one_row_each(docs, kept, "kept_id", "text_sha256")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with nearly equal texts, the one with the least id."""
    docs = docs.select(*COLUMNS)
    found = order_minhash.find_near_duplicates(docs.select("doc_id", "text"))
    kept = found.filter(F.col("leads") & F.col("id").eqNullSafe(F.col("class_id")))
    kept = kept.select(F.col("id").alias("kept_id"), F.col("text_key").alias("text_sha256")).distinct()
    return _one_row_each(docs, kept, "kept_id", "text_sha256")


def _one_row_each(docs: DataFrame, kept: DataFrame, id_col: str, digest: str) -> DataFrame:
    """One row of ``docs`` for every id and text in ``kept``, by the digest of the text. Rows that repeat both but differ in
    other columns are settled by the least of these."""
    marked = docs.withColumn("__digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    same = marked["__digest"].eqNullSafe(kept[digest]) & marked["doc_id"].eqNullSafe(kept[id_col])
    chosen = marked.join(kept, same).drop(id_col, digest)
    repeated = chosen.groupBy("doc_id", "__digest").agg(
        F.count("*").alias("__rows"), F.min(F.struct("lang", "source", "n_chars", "text")).alias("__row")
    )
    return repeated.select(
        "doc_id", F.col("__row.text").alias("text"), *[F.col(f"__row.{c}").alias(c) for c in ("lang", "source", "n_chars")]
    )


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every span of personal data replaced by its kind in brackets, and ``n_chars`` counted anew."""
    docs = docs.select(*COLUMNS)
    return pii.redact_documents(docs, carry=COLUMNS).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with their ids."""
    return packing.pack_documents(docs.select("doc_id", "text"), TOKENIZER, with_ids=True, special_tokens=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("PII", redact_personal_data),
    ("packing", pack),
]

# Neighbour votes, edit similarity and tokens are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
