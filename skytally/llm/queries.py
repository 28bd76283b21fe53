"""The registered queries of this subpackage: every operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import (
    block_naming,
    byte_bpe,
    conversation_repair,
    decontaminate,
    fingerprint,
    merkle,
    order_minhash,
    packing,
    pii,
    quality_knn,
    token_counts,
    toxicity,
    warc_zip,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.archive_and_read(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return byte_bpe.digest_documents(documents, RANKS, public_tokenizers.PATTERN)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER, special_tokens=True)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return fingerprint.fingerprint_edited(documents).withColumnRenamed("id", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.count_section_tokens(documents, TOKENIZER, special_tokens=True)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score_toxicity(documents, _table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_spans(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_knn.score_quality(documents, _table(spark, sf_dir, "labels", "doc_id", "quality"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.find_near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        found.id.alias("doc_id"), "class_id", "class_size", "class_texts",
        (found.leads & found.id.eqNullSafe(found.class_id)).alias("kept"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = block_naming.find_exact_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    seventh = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.build_manifest(documents, replaced={"n_chars": F.col("n_chars") + 1}, where=seventh)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.find_contamination(documents, _table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.drop("items", "hit_share")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_packing": op3_packing,
    "op4_fingerprints": op4_fingerprints,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_pii": op7_pii,
    "op8_quality": op8_quality,
    "op9_near_dedup": op9_near_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle": op12_merkle,
    "op13_decontamination": op13_decontamination,
}

ORACLE: dict[str, str] = {
    "op1_warc": """
        with payloads as (
            select page_id, sha256(coalesce(html, '')) as payload_digest, strlen(coalesce(html, ''))::bigint as payload_bytes
            from pages
        ),
        marked as (
            select *, min(page_id) over (partition by payload_digest) as first,
                payload_bytes >= 100 and page_id <> min(page_id) over (partition by payload_digest) as again
            from payloads
        )
        select page_id, payload_bytes, payload_digest, if(again, 'revisit', 'response') as record_type,
            if(again, first, null) as refers_to
        from marked
    """,
    "op10_exact_dedup": """
        with texts as (select doc_id, coalesce(text, '') as text from documents),
        groups as (select text, max(doc_id) as keep_id, count(*) as group_size from texts group by text)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256
        from texts join groups using (text)
    """,
    "op13_decontamination": r"""
        with worded as (
            select row_number() over () as r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
            from documents
        ),
        items as (
            select coalesce(item_id::varchar, '') as item, words, least(len(words), 10) as size from (
                select item_id, regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
                from benchmark)
            where len(words) > 0
        ),
        owned as (
            select distinct item, size, array_to_string(words[s:s + size - 1], ' ') as span
            from (select *, unnest(range(1, len(words) - size + 2)) as s from items)
        ),
        sizes as (select distinct size from owned),
        places as (
            select r, size, s, array_to_string(words[s:s + size - 1], ' ') as span
            from (select r, words, size, unnest(range(1, len(words) - size + 2)) as s from worded, sizes)
        ),
        met as (select r, s, places.size, span from places where span in (select span from owned)),
        hits as (
            select r, count(distinct p) as n_hit
            from (select r, unnest(range(s, s + size)) as p from met) group by r
        ),
        listed as (
            select r, count(*) as n_items, string_agg(item, ',' order by item) as items
            from (select distinct r, item from met join owned using (span)) group by r
        )
        select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
            sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from worded left join hits using (r) left join listed using (r)
    """,
}
