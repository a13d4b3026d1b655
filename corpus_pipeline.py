"""The corpus pipeline: five stages from ``documents`` to the words that a training mix takes.

Every stage gets the documents that its predecessor kept. All but the last
return the columns of ``documents``; other columns of the input are carried on.
Null and empty texts are no reason to drop a document, neither are repeated
rows; empty tables give empty results. See each operator for the details.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm.decontaminate import clean_documents
from scoreloom.llm.jaccard_join import one_of_each
from scoreloom.llm.mixing import mix_sources
from scoreloom.llm.queries import held_out
from scoreloom.llm.scratch import scratch_table
from scoreloom.llm.secret_scan import markov_samples, redacted, secret_spans, train_markov
from scoreloom.llm.toxicity import train_toxicity, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic (score below 0.7), learned as in op6."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out()).select("doc_id", "toxic")
    return without_toxic(docs, train_toxicity(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at similarity 0.8: the smallest id."""
    return one_of_each(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any run of ten words of a benchmark item (or a whole shorter item)."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark; ``n_chars`` follows the text."""
    model = train_markov(markov_samples(docs))
    found = secret_spans(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text"), model)
    clean = redacted("text", "spans")
    fresh = {"text": clean, "n_chars": F.when(F.size("spans") > 0, F.length(clean)).otherwise(F.col("doc")["n_chars"])}
    return found.select(*[fresh.get(c, F.col("doc")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the words that a mix of 150% takes, sources weighing 3, 1, 2 in turn."""
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

# Models and components are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
