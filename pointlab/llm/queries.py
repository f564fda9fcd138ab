"""The operators over whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlab.llm import alignment, bpe, cws, langid, licenses, linededup, mixing, repetition, sharding, simhash, spelling, tokencount, vptree
from pointlab.llm.shared import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
OTHER_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count().alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed")


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vptree.nearest(rows, rows.where("vec_id % 100 = 0"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    models = langid.train(docs.where(remainder != 2))
    rows = docs.select("doc_id", "text", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"))
    return langid.identify(rows, models).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repetition.repetition(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "base_failed", "kept")
    return rows.select(*names)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), VOCABULARY, OTHER_VOCABULARY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_token_counts, op2_license_scan, op3_mix_sources, op4_line_dedup, op5_bpe_round_trip,
        op6_simhash, op7_nearest, op8_shards, op9_language, op10_fingerprints,
        op11_repetition, op12_spelling_variants, op13_token_alignment,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op3_mix_sources": mixing.ORACLE, "op4_line_dedup": linededup.ORACLE, "op11_repetition": repetition.ORACLE}
