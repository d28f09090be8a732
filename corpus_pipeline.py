"""A corpus pipeline: the stages' functions take (spark, docs, sf_dir); each stage's rows are written and read again as the next one's documents.

Defined cases: a null or empty text, and a document without an id, goes through all
stages like any other; it is scored, compared and tokenized as an empty text. Rows
that repeat an id with equal or nearly equal texts leave one row at the SimHash
stage, rows with different texts stay. The mix may take a document up to three
times, so ids may repeat in the result. An empty ``documents``, ``labels`` or
``benchmark`` is no error: nothing is rejected for want of it. Columns beyond those
that a stage reads pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from furlong.llm import decontamination, mixing, simhash, token_output, toxicity
from furlong.llm.common import table
from furlong.llm.queries import toxicity_model
from furlong.llm.storage import remove_folder
from furlong.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.remove_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that of the smallest id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages by the contamination rule."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    return mixing.repeat_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_output.report(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: Toxicity, SimHash and tokenization have no SQL form; the tests hold each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``; a stage's rows are removed once the next one's are written."""
    folder = shared_folder(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(before)
        before = path
    return docs
