"""Streams of arrivals and job events: duplicates, outcomes, stuck runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainlake.contract import JOB_STAGE, Contract
from chainlake.functions.status import is_terminal
from chainlake.operators.checks import failure_alerts
from chainlake.operators.correlate import enrich_outcome, keyed_arrivals
from chainlake.operators.keyed import attach
from chainlake.sources import generations
from chainlake.sources.control import append_alerts, append_control, batch_leaf, batch_time, outcome_records


def first_arrivals(arrivals: DataFrame, horizon: str = "7 days", by_content: bool = False) -> DataFrame:
    """Arrivals (path, arrived_at, ...) without redeliveries; each whole name is remembered for `horizon`."""
    keyed = keyed_arrivals(arrivals, by_content).withWatermark("arrived_at", horizon)
    return keyed.dropDuplicatesWithinWatermark(["identidade"]).drop("identidade")


def registered_arrivals(
    arrivals: DataFrame, registry_path: str, flagged_path: str, checkpoint: str, by_content: bool = False, buckets: int = 64, most: int = 4,
) -> StreamingQuery:
    """Write every arrival (path, arrived_at, ...) of the stream below `flagged_path`, with `duplicado`, whether its identity was met before, and
    `atrasado`, whether it came after a later arrival of that identity. None is dropped and no identity forgotten.

    Identities are kept with their first arrival in a table of buckets (`sources.generations`), of which a micro-batch reads and
    writes those it touches. Within a micro-batch the first by time and path starts a run; rows equal in both are one delivery's copies, of which one
    is the first. A replayed batch is judged by what was known before it, and replaces what it wrote.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keyed = keyed_arrivals(batch, by_content)
        bucket = F.pmod(F.xxhash64("identidade"), F.lit(buckets)).cast("int")
        mine = keyed.groupBy("identidade").agg(F.min("arrived_at").alias("primeira"))
        known = generations.read(spark, registry_path, batch_id, generations.bucket_numbers(mine, bucket))
        if known is None:
            known = mine.where("false")
        first = fold_first(known).withColumnRenamed("primeira", "antes")
        place = W.partitionBy("identidade").orderBy("arrived_at", "path")
        # `row_number() = 1` of many deliveries of one identity is limited before the shuffle; the others keep their rows.
        judged = attach(keyed.withColumn("linha", F.monotonically_increasing_id()), first, "identidade")
        starts = judged.where("antes IS NULL").withColumn("vez", F.row_number().over(place)).where("vez = 1").select(F.col("linha").alias("inicio"))
        flagged = judged.join(starts, F.col("linha") == F.col("inicio"), "left").select(
            *batch.columns, "chave", F.col("inicio").isNull().alias("duplicado"), F.coalesce(F.col("arrived_at") < F.col("antes"), F.lit(False)).alias("atrasado")
        )
        flagged.write.mode("overwrite").parquet(f"{flagged_path}/batch={batch_id}")
        generations.merge(mine, registry_path, batch_id, fold_first, bucket, most)

    return (
        arrivals.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def fold_first(identities: DataFrame) -> DataFrame:
    return identities.groupBy("identidade").agg(F.min("primeira").alias("primeira"))


def outcome_stream(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Terminal job events with their run's execution id and duration, each once per delivery."""
    return enrich_outcome(events.where(is_terminal(F.col("state"))), runs)


def record_outcomes(
    events: DataFrame, runs: DataFrame, control_path: str, checkpoint: str, alerts_path: str | None = None,
    contract: Contract | None = None,
) -> StreamingQuery:
    """Append every terminal outcome to the control log; `runs` is read anew for each batch. With `alerts_path`, every failure leaves an alert
    of the `contract` there as well, once however often its batch is replayed.

    Not the streaming file sink: its own list of files would hide what batches append to the same log.
    """
    if alerts_path is not None and contract is None:
        raise ValueError("alerts need the contract that words them")

    def step(batch: DataFrame, batch_id: int) -> None:
        leaf = batch_leaf(batch, batch_id, JOB_STAGE)
        records = outcome_records(batch.drop("gravado_em"))
        append_control(records, control_path, batch_time(batch, "gravado_em"), leaf)
        if alerts_path is not None:
            append_alerts(failure_alerts(batch, contract), alerts_path, leaf)

    return (
        outcome_stream(events, runs).withColumn("gravado_em", F.current_timestamp())
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stuck_stream(events: DataFrame, contract: Contract, lateness: str = "10 minutes") -> DataFrame:
    """(name, start_date, alert_at) of runs that reach the margin without a terminal event.

    `events` is (name, event_time, state) with a RUNNING event per start. An interval outer join keeps the
    waiting runs as join state; a terminal event within the margin cancels the alert, the watermark passing
    the margin raises it, and both let go of the state.
    """
    margin = F.expr(f"INTERVAL {contract.lineage_margin_hours} HOURS")
    starts = events.where(F.col("state") == "RUNNING").select(
        F.col("name"), F.col("event_time").alias("start_date")
    )
    ends = events.where(is_terminal(F.col("state"))).select(
        F.col("name").alias("ended"), F.col("event_time").alias("end_date")
    )
    alert_at = F.col("start_date") + margin
    cancels = (
        (F.col("name") == F.col("ended"))
        & (F.col("end_date") >= F.col("start_date"))
        & (F.col("end_date") < alert_at)
    )
    waited = starts.withWatermark("start_date", lateness).join(
        ends.withWatermark("end_date", lateness), cancels, "leftOuter"
    )
    return waited.where(F.col("ended").isNull()).select("name", "start_date", alert_at.alias("alert_at"))


def run_stream(events: DataFrame, runs_path: str, checkpoint: str) -> StreamingQuery:
    """Keep every run's start and end below `runs_path`, each micro-batch as a part of its own that its replay rewrites."""

    def step(batch: DataFrame, batch_id: int) -> None:
        _ends(batch.select(
            "name", F.when(F.col("state") == "RUNNING", F.col("event_time")).alias("start_date"),
            F.when(is_terminal(F.col("state")), F.col("event_time")).alias("end_date"),
        )).write.mode("overwrite").parquet(f"{runs_path}/slice={batch_id}")

    return (
        events.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    """(name, start_date, status) of every started run so far, for `stuck_runs` at any time: no later event is needed."""
    folded = _ends(spark.read.parquet(runs_path)).where("start_date IS NOT NULL")
    ended = F.coalesce(F.col("end_date") >= F.col("start_date"), F.lit(False))
    return folded.select("name", "start_date", F.when(ended, "ENDED").otherwise("RUNNING").alias("status"))


def _ends(rows: DataFrame) -> DataFrame:
    # A run that was started again runs since then.
    return rows.groupBy("name").agg(F.max("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
