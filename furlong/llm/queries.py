"""The ``opN_`` queries: each applies one operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.llm import decontamination, embeddings, language_id, line_dedup, mixing, simhash, token_counts, token_output, toxicity, warc
from furlong.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = language_id.held_out(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), 3, 1)
    model = language_id.learn(docs.where(~F.col("held_out")))
    return language_id.identify(docs, model, keep=("held_out",))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity_model(docs, labels))
    return language_id.held_out(scored, 4, 2).select("doc_id", "held_out", "score", "predicted")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    known = language_id.held_out(labels.select("doc_id", "toxic"), 4, 2).where(~F.col("held_out"))
    return toxicity.learn(docs, known)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.report(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.edited_counts(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_language_id,
        op3_toxicity,
        op4_simhash,
        op5_line_dedup,
        op6_embedding_dedup,
        op7_warc,
        op8_token_output,
        op9_token_counts,
        op10_mixing,
    )
}

ORACLES = {
    "op1_decontamination": decontamination.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op6_embedding_dedup": embeddings.ORACLE,
    "op7_warc": warc.ORACLE,
    "op10_mixing": mixing.ORACLE,
}
