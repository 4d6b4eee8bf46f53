"""The control log: one JSON record per pipeline step, partitioned by the day it was written."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake import contract as names
from chainlake.contract import CONTROL, LEAF, Contract
from chainlake.functions.dates import instant, iso_text, partition_day, utc_day
from chainlake.functions.status import (
    identified,
    status_from_outcome,
    status_from_problems,
    status_from_state,
)


def read_control(
    spark: SparkSession, path: str, as_of: datetime | str | None = None, days: int | None = None
) -> DataFrame:
    """The log, or its last `days` days up to `as_of`, today included; older partitions are not listed."""
    log = spark.read.schema(CONTROL).json(path).select(*CONTROL.names)
    return log if days is None else recent(log, as_of, days)


def read_batch(spark: SparkSession, path: str, leaf: str) -> DataFrame:
    """What one batch left in the log, no more of it listed than the days."""
    return spark.read.schema(CONTROL).json(f"{path}/*/{LEAF}={leaf}").select(*CONTROL.names)


def batch_time(batch: DataFrame, column: str) -> datetime | None:
    """The instant of a micro-batch, which its replay has too: any row's `column`, filled by `current_timestamp`."""
    moment = batch.agg(F.unix_micros(F.min(column)).alias("at")).first()["at"]
    return None if moment is None else datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=moment)


def batch_leaf(batch: DataFrame, batch_id: int, writer: str) -> str:
    """A name for what `writer` records of a micro-batch: the same on a replay, another for another checkpoint."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{writer}-{stream or 'direct'}-{batch_id}"


def append_control(
    records: DataFrame, path: str, written_at: datetime | str | Column | None = None, leaf: str | None = None
) -> None:
    """Append a batch of records of any kind; fields a kind lacks stay null.

    What is written lies in a leaf of its day. Writing a leaf again replaces it, so a batch replayed under
    its own leaf and instant leaves its records once; without a `leaf` the batch gets a new one.
    `dt` is the UTC day of writing. The rebalance lets AQE size the files, so that the log grows neither by
    one object per record nor by one file per task, and a large batch still has many writers.
    """
    moment = F.current_timestamp() if written_at is None else instant(written_at)
    empty = records.sparkSession.createDataFrame([], CONTROL)
    whole = empty.unionByName(records, allowMissingColumns=True).select(*records.columns, *(
        c for c in CONTROL.names if c not in records.columns
    ))
    stamped = whole.withColumn("dt", partition_day(moment)).withColumn(
        "timestamp", F.coalesce("timestamp", iso_text(moment))
    )
    leaves = stamped.withColumn(LEAF, F.lit(leaf or uuid.uuid4().hex))
    writer = leaves.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("dt", LEAF).json(path)


def append_alerts(alerts: DataFrame, path: str, leaf: str) -> None:
    """Append a batch's alerts (subject, message); the batch replayed under its `leaf` replaces its own."""
    alerts.select("subject", "message").write.mode("overwrite").json(f"{path}/{LEAF}={leaf}")


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("subject string, message string").json(path).select("subject", "message")


def of_origin(control: DataFrame, *origins: str) -> DataFrame:
    return control.where(F.col("origem").isin(*origins))


def with_execution(control: DataFrame, blank_ok: bool) -> DataFrame:
    return control.where(identified(F.col("execution_id"), blank_ok))


def recent(control: DataFrame, as_of: datetime | str, days: int) -> DataFrame:
    """Days `as_of - days` to `as_of` and later, by the partition column."""
    return control.where(F.col("dt") >= (utc_day(as_of) - timedelta(days=days)).isoformat())


def past_days(control: DataFrame, as_of: datetime | str, days: int, same_weekday: bool = False) -> DataFrame:
    """The `days` days before `as_of`, today excluded; with `same_weekday` only those on its weekday.

    The wanted days are listed as literals, so partitions of other weekdays are pruned too.
    """
    today = utc_day(as_of)
    wanted = [today - timedelta(days=n) for n in range(1, days + 1)]
    if same_weekday:
        wanted = [day for day in wanted if day.weekday() == today.weekday()]
    return control.where(F.col("dt").isin([day.isoformat() for day in wanted]))


# ---- records of the steps ----


def copy_records(copied: DataFrame) -> DataFrame:
    """From manifest entries that were copied: (origem, destino)."""
    return copied.select(
        F.lit(names.COPY_STAGE).alias("origem"),
        F.col("destino").alias("zip"),
        F.col("origem").alias("origem_arquivo"),
        F.lit("copiado").alias("status"),
    )


def unpack_records(archives: DataFrame, contract: Contract) -> DataFrame:
    """From archives unpacked: (path, destino, execution_id)."""
    return archives.select(
        F.lit(contract.start_stage).alias("origem"),
        F.col("path").alias("zip"),
        F.col("destino").alias("csv"),
        "execution_id",
        F.lit("descompactado").alias("status"),
    )


def rule_records(outcomes: DataFrame, execution_id: Column | None = None) -> DataFrame:
    """From rule outcomes, one record per rule."""
    return outcomes.select(
        F.lit(names.RULES_STAGE).alias("origem"),
        (F.lit(None).cast("string") if execution_id is None else execution_id).alias("execution_id"),
        "regra", "outcome", "motivo_falha", "metrica_nome", "metrica_valor",
        status_from_outcome(F.col("outcome")).alias("status"),
    )


def volume_records(verdicts: DataFrame) -> DataFrame:
    """From volume verdicts: (csv, linhas, problemas, execution_id)."""
    return verdicts.select(
        F.lit(names.VOLUME_STAGE).alias("origem"),
        "csv", "linhas", "problemas",
        status_from_problems(F.col("problemas")).alias("status"),
        "execution_id",
    )


def outcome_records(outcomes: DataFrame) -> DataFrame:
    """From enriched job outcomes: (job_run_id, state, execution_id, duracao_segundos)."""
    return outcomes.select(
        F.lit(names.JOB_STAGE).alias("origem"),
        "job_run_id", "execution_id",
        status_from_state(F.col("state")).alias("status"),
        "duracao_segundos",
    )
