"""Thin queries of the numbered operators over the driver tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm import (byte_bpe, circulant_minhash, langid, lattice_lm, line_dedup, lz_fingerprint, merkle_manifest,
                           near_documents, oracle_sql, packing, paragraphs, suffix_dedup, voronoi_knn,
                           word_variants)
from driftwood.llm.common import crc_of_id
from driftwood.llm.catalog import ORACLE, QUERIES, documents, register  # noqa: F401


@register("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(documents(spark, sf_dir),
                            public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(documents(spark, sf_dir),
                                  public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces)


@register("op8_lz_fingerprint")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.edited_fingerprints(documents(spark, sf_dir))


@register("op9_ngram_jaccard_join", oracle_sql.NEAR_DOCUMENTS)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents.near_documents(documents(spark, sf_dir))


@register("op7_paragraph_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, also for those that lose nothing."""
    docs = documents(spark, sf_dir)
    removed = paragraphs.removals(paragraphs.near_paragraphs(docs))
    return docs.select("doc_id").join(removed, "doc_id", "left").select(
        "doc_id", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("chars_removed", F.lit(0)).alias("chars_removed"), "spans", "kept_in")


@register("op2_fuzzy_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


@register("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from two thirds of the documents by id; answers for all."""
    third = F.coalesce(crc_of_id("doc_id") % 3 == 1, F.lit(False))
    docs = documents(spark, sf_dir).withColumn("held_out", third)
    model = langid.train(docs.where(crc_of_id("doc_id") % 3 != 1))
    return langid.predict(docs, model, keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score")


@register("op4_voronoi_top_k", oracle_sql.TOP_K)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = voronoi_knn.quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return voronoi_knn.top_k(vectors)


@register("op10_lattice_lm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose crc32 is no multiple of ten; scores all."""
    docs = documents(spark, sf_dir).withColumns({"held_out": crc_of_id("doc_id") % 10 == 0,
                                                 "training": crc_of_id("doc_id") % 10 != 0})
    return lattice_lm.score(docs, public_tokenizers.path("piece_bpe_32k.model"))


@register("op3_suffix_dedup", oracle_sql.SUBSTRINGS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op13_merkle_manifest", oracle_sql.MANIFEST)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows, by the crc32 of their id, are checked without their line breaks."""
    even = F.coalesce(crc_of_id("doc_id") % 2 == 0, F.lit(False))
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle_manifest.manifest(documents(spark, sf_dir), tampered, proofs=False).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@register("op12_circulant_minhash", oracle_sql.NEAR_COPIES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_copies(documents(spark, sf_dir))


@register("op11_spelling_variants", oracle_sql.VARIANTS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_variants.spelling_variants(documents(spark, sf_dir), spoil=199)
