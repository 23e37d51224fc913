"""Registered queries of the operators, and their DuckDB SQL where SQL can
express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyseries.llm import (conversations, decontam, hamming, langid, line_dedup, minhash, mixing, oracles, pii,
                             simhash, suffix_dedup, token_counts, warc, whitening)
from dailyseries.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest_columns(warc.round_trip(table(spark, sf_dir, "pages")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_columns(pii.report(table(spark, sf_dir, "documents")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_table(table(spark, sf_dir, "documents"))


def op5_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hamming.top_k(vectors, vectors.where(F.col("vec_id") % hamming.QUERY_STEP == 0))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.schedule(docs, mixing.TARGET, mixing.TARGET_REST)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.digest_columns(minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest_columns(line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest_columns(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest_columns(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest_columns(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(*conversations.damage(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_warc, op3_pii, op4_token_counts, op5_hamming_top_k, op6_mixing, op7_minhash,
    op8_line_dedup, op9_suffix_dedup, op10_decontamination, op11_simhash, op12_whitening, op13_conversations)}

ORACLE = {
    "op2_warc": warc.ORACLE,
    "op3_pii": oracles.PII,
    "op5_hamming_top_k": hamming.ORACLE,
    "op6_mixing": mixing.oracle("documents", "doc_id, source"),
    "op7_minhash": oracles.MINHASH,
    "op8_line_dedup": line_dedup.ORACLE,
    "op9_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op10_decontamination": decontam.ORACLE,
    "op13_conversations": oracles.CONVERSATIONS,
}
