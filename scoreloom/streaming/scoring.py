"""Scoring of applicant streams: validate, score, write. Stateless, no watermark needed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from scoreloom.config import CreditConfig, with_optional
from scoreloom.functions.columns import nan_to_null
from scoreloom.operators.score import score
from scoreloom.operators.validate import split_valid, validate
from scoreloom.sources.applicants import APPLICANT_SCHEMA
from scoreloom.sources.params import Scorecard

BATCH = "batch_id"


def read_applicant_stream(
    spark: SparkSession,
    folder: str,
    fmt: str = "json",
    schema: T.StructType = APPLICANT_SCHEMA,
    **options: str,
) -> DataFrame:
    """Stream of applicant files arriving in a folder."""
    return nan_to_null(spark.readStream.schema(schema).format(fmt).options(**options).load(folder))


def input_contract(config: CreditConfig, card: Scorecard) -> CreditConfig:
    """The configuration with only those columns required that the scorecard reads.

    A rule of another column still refuses rows whose value breaks it, but a table
    does not have to carry a column that has no part in the score.
    """
    read = set(card.coefficients)
    if any(f.startswith(f"{card.category_column}_") for f in read):
        read.add(card.category_column)
    unused = [r.column for r in config.rules if r.column not in read]
    return replace(config, rules=with_optional(config.rules, *unused))


def score_stream(
    applicants: DataFrame,
    card: Scorecard,
    config: CreditConfig,
    keep: Sequence[str],
    allow_null: bool = False,
    timestamp: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(scored, quarantine)`` streams; refused rows keep their reasons.

    Each is a query of its own that reads the input; ``start_scoring`` writes both
    in one pass.
    """
    valid, refused = split_valid(validate(applicants, input_contract(config, card), allow_null))
    scored = score(valid, card, keep)
    if timestamp:
        scored = scored.withColumn("timestamp", F.current_timestamp())
    return scored, refused


def start_scoring(
    applicants: DataFrame,
    card: Scorecard,
    config: CreditConfig,
    keep: Sequence[str],
    scored_path: str,
    refused_path: str,
    checkpoint: str,
    allow_null: bool = False,
    timestamp: bool = True,
    once: bool = False,
) -> StreamingQuery:
    """One query that writes scored and refused rows of a stream, each exactly once.

    A micro-batch is read, parsed and validated once and held while both tables
    are written. Each batch has a folder of its own in either table, named by its
    number, and a batch that is run again replaces its folders: a query that ends
    between the two writes loses and repeats no row when it is started again from
    its checkpoint. ``timestamp`` is the time the batch was planned, the same in
    a second run. Read the tables by ``read_batches``.
    """
    contract = input_contract(config, card)
    stamped = applicants.withColumn("timestamp", F.current_timestamp()) if timestamp else applicants
    stamps = ["timestamp"] if timestamp else []

    def write(batch: DataFrame, number: int) -> None:
        validated = validate(batch, contract, allow_null).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, refused = split_valid(validated)
            write_batch(_score_with(valid, card, keep, stamps), scored_path, number)
            write_batch(refused.drop(*stamps), refused_path, number)
        finally:
            validated.unpersist()

    writer = stamped.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _score_with(valid: DataFrame, card: Scorecard, keep: Sequence[str], stamps: Sequence[str]) -> DataFrame:
    """The score with columns of the input after it."""
    scored = score(valid, card, [*keep, *(c for c in stamps if c not in keep)])
    return scored.select(*[c for c in scored.columns if c not in stamps], *stamps)


def write_batch(rows: DataFrame, path: str, number: int) -> None:
    """Write a micro-batch into its own folder of a table, instead of an earlier try."""
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches written so far, with ``batch_id``."""
    return spark.read.option("basePath", path).parquet(path)


def start_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    once: bool = False,
) -> StreamingQuery:
    """Append a stream to a file table, exactly once.

    ``once`` processes what is there and stops. ``checkpoint`` must outlive the
    executors: a folder in shared storage.
    """
    writer = (
        stream.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
