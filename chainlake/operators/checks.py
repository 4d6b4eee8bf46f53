"""Checks of the pipeline itself: freshness, lineage, stuck runs; and alerts as rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.contract import CHECK_STAGE, Contract
from chainlake.functions.dates import age_hours, instant, iso_text, previous_business_day, utc_day
from chainlake.functions.messages import (
    CHECK_BODY,
    CHECK_COUNT,
    CHECK_SUBJECT,
    COPY_BODY,
    COPY_SUBJECT,
    INCOMPLETE,
    JOB_BODY,
    JOB_SUBJECT,
    STALE,
    STUCK,
    filled,
    joined,
)
from chainlake.functions.status import is_failure, status_from_problems
from chainlake.functions.text import fixed_point
from chainlake.sources.control import of_origin, recent, with_execution


def freshness(control: DataFrame, as_of: datetime | str, contract: Contract) -> DataFrame:
    """One problem row if no file was unpacked on the business day before `as_of`, else none.

    Only that one day is looked at, so a single gap is reported once.
    """
    day = previous_business_day(F.lit(utc_day(as_of))).cast("string")
    log = recent(of_origin(control, contract.start_stage), as_of, contract.lineage_window_days)
    seen = log.agg(F.coalesce(F.bool_or(F.col("timestamp").startswith(day)), F.lit(False)).alias("seen"))
    return seen.where("not seen").select(
        F.lit("atualidade").alias("checagem"), day.alias("chave"), filled(STALE, dia=day).alias("problema")
    )


def freshness_calendar(control: DataFrame, contract: Contract) -> DataFrame:
    """(dia): every business day, from the log's first to its last day, on which nothing was unpacked."""
    bounds = control.agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    days = bounds.select(
        F.explode(F.sequence(F.to_date("first"), F.to_date("last"))).alias("day")
    ).where(F.weekday("day") < 5)
    seen = of_origin(control, contract.start_stage).select(F.to_date(F.substring("timestamp", 1, 10)).alias("day"))
    return days.join(seen.distinct(), "day", "left_anti").select(F.col("day").cast("string").alias("dia"))


def missing_stages(control: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """(execution_id, faltando): the expected stages an execution has no record of, in expected order.

    One boolean per stage instead of a set of names: fixed-width buffers, combined before the shuffle.
    """
    return _stages(with_execution(control, blank_ok=False), expected).select("execution_id", "faltando")


def _stages(control: DataFrame, expected: tuple[str, ...], *more) -> DataFrame:
    seen = [F.bool_or(F.col("origem") == stage).alias(f"seen_{i}") for i, stage in enumerate(expected)]
    per_execution = control.groupBy("execution_id").agg(*seen, *more)
    lacking = [
        F.when(~F.coalesce(f"seen_{i}", F.lit(False)), F.lit(stage)) for i, stage in enumerate(expected)
    ]
    missing = F.array_compact(F.array(*lacking)) if lacking else F.array().cast("array<string>")
    return per_execution.withColumn("faltando", missing).drop(*(f"seen_{i}" for i in range(len(expected))))


def lineage_gaps(
    control: DataFrame, as_of: datetime | str, contract: Contract, whole_log: bool = False
) -> DataFrame:
    """(execution_id, idade_horas, faltando, problema) of executions that lack a stage.

    Out of scope: records without an execution id, executions without a start record, and those younger
    than the margin (an age equal to it is checked). `whole_log` looks beyond the contract's window.
    """
    log = with_execution(control, blank_ok=False)
    if not whole_log:
        log = recent(log, as_of, contract.lineage_window_days)
    started = F.min(
        F.when(F.col("origem") == contract.start_stage, F.to_timestamp("timestamp"))
    ).alias("inicio")
    age = age_hours(as_of, F.col("inicio"))
    text = filled(
        INCOMPLETE,
        execucao=F.col("execution_id"), idade=fixed_point(age, 1), etapas=F.array_join("faltando", ", "),
    )
    return (
        _stages(log, contract.expected_stages, started)
        .where(F.col("inicio").isNotNull() & (F.size("faltando") > 0))
        .where(age >= contract.lineage_margin_hours)
        .select("execution_id", age.alias("idade_horas"), "faltando", text.alias("problema"))
    )


def stuck_runs(runs: DataFrame, as_of: datetime | str, contract: Contract) -> DataFrame:
    """(name, idade_horas, problema) of runs still RUNNING after the margin."""
    age = age_hours(as_of, F.col("start_date"))
    margin = contract.lineage_margin_hours
    text = filled(STUCK, execucao=F.col("name"), idade=fixed_point(age, 1), margem=margin)
    return runs.where((F.col("status") == "RUNNING") & (age >= margin)).select(
        "name", age.alias("idade_horas"), text.alias("problema")
    )


def check_problems(
    control: DataFrame, runs: DataFrame | None, as_of: datetime | str, contract: Contract
) -> DataFrame:
    """(checagem, chave, problema): the problems of all checks, one per row. No `runs`, no stuck-run check.

    The table beside the check's one record: write it, then give what was written to `check_verdict`.
    """
    lineage = lineage_gaps(control, as_of, contract).select(
        F.lit("linhagem").alias("checagem"), F.col("execution_id").alias("chave"), "problema"
    )
    problems = freshness(control, as_of, contract).unionByName(lineage)
    if runs is not None:
        stuck = stuck_runs(runs, as_of, contract)
        problems = problems.unionByName(
            stuck.select(F.lit("travadas").alias("checagem"), F.col("name").alias("chave"), "problema")
        )
    return problems


def check_verdict(problems: DataFrame, as_of: datetime | str) -> DataFrame:
    """The check's own control record, always one: `ok`, or `problema` with how many problems each check found.

    `problems` is what `check_problems` gives. A bad day may bring any number of them, so they stay rows of that
    table; the record holds a line for each check, of which there are three.
    """
    counts = problems.groupBy("checagem").agg(F.count("*").alias("total"))
    line = filled(CHECK_COUNT, checagem=F.col("checagem"), total=F.col("total"))
    gathered = counts.agg(F.sort_array(F.collect_list(line)).alias("problemas"))
    return gathered.select(
        iso_text(instant(as_of)).alias("timestamp"),
        F.lit(CHECK_STAGE).alias("origem"),
        status_from_problems(F.col("problemas")).alias("status"),
        "problemas",
    )


# ---- alerts: rows of (subject, message); silence when all is well ----


def check_alerts(verdict: DataFrame, contract: Contract) -> DataFrame:
    """One alert per check run that found something."""
    return verdict.where(F.size("problemas") > 0).select(
        filled(CHECK_SUBJECT, fonte=contract.name).alias("subject"),
        filled(CHECK_BODY, problemas=joined(F.col("problemas"))).alias("message"),
    )


def failure_alerts(outcomes: DataFrame, contract: Contract) -> DataFrame:
    """Per job run that ended badly: (job_name, job_run_id, state)."""
    body = filled(JOB_BODY, job=F.col("job_name"), run=F.col("job_run_id"), estado=F.col("state"))
    return outcomes.where(is_failure(F.col("state"))).select(
        filled(JOB_SUBJECT, fonte=contract.name).alias("subject"), body.alias("message")
    )


def missing_source_alerts(missing: DataFrame, contract: Contract) -> DataFrame:
    """Per manifest entry without a file."""
    return missing.select(
        filled(COPY_SUBJECT, fonte=contract.name).alias("subject"),
        filled(COPY_BODY, arquivo=F.col("origem")).alias("message"),
    )
