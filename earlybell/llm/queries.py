"""The dealt operators' registered queries: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earlybell.llm import (
    decontaminate,
    gnat,
    jaccard,
    language,
    licenses,
    merkle,
    nn_descent,
    packing,
    pii,
    quality,
    secrets,
    sql,
    tokens,
    toxicity,
)
from earlybell.llm.common import held_out, store, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The id that ends each packed document, and the sequence length.
END_ID, SEQUENCE = 1, 2048
TOKEN_LIMIT = 512
TOXIC_AT = 0.7


@dataclass(frozen=True)
class LlmQuery:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.mark(docs, items, keep=["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out()))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"),
    )


def secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[_count(spans, k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
    )


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), TOKENIZER, keep=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under their address, documents under source and language, as files with paths."""
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    address = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    of_pages = pages.select(
        F.lit("pages").alias("origin"),
        F.col("page_id").alias("row_id"),
        F.concat(F.lit("web/"), address).alias("path"),
        F.regexp_replace(F.regexp_replace("html", licenses.BLOCK_TAGS, "\n"), "<[^>]*>", " ").alias("text"),
    )
    of_docs = docs.select(
        F.lit("documents").alias("origin"),
        F.col("doc_id").alias("row_id"),
        F.concat_ws("/", F.lit("corpus"), "source", "lang", F.col("doc_id").cast("string")).alias("path"),
        "text",
    )
    return licenses.scan(of_pages.union(of_docs))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    proposed = store(pii.propose(table(spark, sf_dir, "documents"), keep=["doc_id"]), "pii_proposals")
    found = pii.select(proposed, pii.fit(proposed))
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[_count(spans, k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
    )


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    pieces = packing.pack(docs, TOKENIZER, END_ID, SEQUENCE)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out()))
    named = language.identify(docs, model, keep=["doc_id"])
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.hard_negatives(table(spark, sf_dir, "embeddings"))


def neighbour_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, LlmQuery] = {
    "op1_benchmark_decontamination": LlmQuery(decontamination, sql.DECONTAMINATION),
    "op2_ngram_jaccard": LlmQuery(ngram_jaccard, sql.JACCARD),
    "op3_toxicity": LlmQuery(toxic_spans),
    "op4_secret_links": LlmQuery(secret_links, sql.SECRETS),
    "op5_token_counts": LlmQuery(token_counts),
    "op6_quality_rules": LlmQuery(quality_rules, sql.QUALITY),
    "op7_license_scan": LlmQuery(license_scan, sql.LICENSES),
    "op8_packing": LlmQuery(packed_sequences),
    "op9_personal_data": LlmQuery(personal_data),
    "op10_language_id": LlmQuery(language_id),
    "op11_hard_negatives": LlmQuery(hard_negatives, sql.HARD_NEGATIVES),
    "op12_neighbour_search": LlmQuery(neighbour_search),
    "op13_merkle_manifest": LlmQuery(merkle_manifest, sql.MERKLE),
}
