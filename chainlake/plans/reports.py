"""The eleven standing reports: two over Bronze, nine over the control log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake import contract as names
from chainlake.functions.status import PROBLEM
from chainlake.functions.text import named
from chainlake.sources.control import of_origin, with_execution


def rows_per_file(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("arquivo_origem").agg(F.count("*").alias("linhas"))


def action_distribution(bronze: DataFrame, column: str = "Action type") -> DataFrame:
    return (
        bronze.groupBy(named(column).alias(column))
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), named(column))
    )


def volume_by_day(control: DataFrame) -> DataFrame:
    return (
        of_origin(control, names.VOLUME_STAGE)
        .groupBy("dt")
        .agg(F.sum("linhas").alias("linhas_total"), F.count("*").alias("arquivos"))
        .orderBy("dt")
    )


def problem_rate(control: DataFrame) -> DataFrame:
    return (
        of_origin(control, names.VOLUME_STAGE)
        .groupBy("dt")
        .agg(
            F.count("*").alias("total_arquivos"),
            F.count_if(F.col("status") == PROBLEM).alias("com_problema"),
        )
        .orderBy("dt")
    )


def dispatch_list(control: DataFrame) -> DataFrame:
    """Dispatches recorded by a step that no longer exists; old records only."""
    return (
        of_origin(control, names.DISPATCH_STAGE)
        .select("dt", "csv", "job_run_id", "timestamp")
        .orderBy(F.desc("timestamp"), "job_run_id")
    )


def execution_flow(control: DataFrame, start_stage: str) -> DataFrame:
    """The steps of each execution side by side."""

    def least(stage: str, column: str, name: str):
        return F.min(F.when(F.col("origem") == stage, F.col(column))).alias(name)

    return (
        with_execution(control, blank_ok=True)
        .groupBy("execution_id")
        .agg(
            least(start_stage, "timestamp", "descompactado_em"),
            least(names.DISPATCH_STAGE, "timestamp", "disparado_em"),
            least(names.VOLUME_STAGE, "status", "qualidade"),
            least(names.JOB_STAGE, "status", "desfecho_glue"),
            least(names.JOB_STAGE, "duracao_segundos", "duracao_glue_segundos"),
        )
        .orderBy(F.desc("descompactado_em"), "execution_id")
    )


def verdict_summary(control: DataFrame) -> DataFrame:
    """Volume verdict beside the rules' verdict, which is null, not `ok`, where no rule failed."""
    both = of_origin(with_execution(control, blank_ok=True), names.VOLUME_STAGE, names.RULES_STAGE)
    failed = (F.col("origem") == names.RULES_STAGE) & (F.col("outcome") == "Failed")
    return (
        both.groupBy("execution_id")
        .agg(
            F.min(F.when(F.col("origem") == names.VOLUME_STAGE, F.col("status"))).alias("veredito_python"),
            F.max(F.when(failed, F.lit(PROBLEM))).alias("veredito_glue_dq"),
        )
        .orderBy(F.desc("execution_id"))
    )


def rule_detail(control: DataFrame) -> DataFrame:
    return (
        of_origin(control, names.RULES_STAGE)
        .select("dt", "execution_id", "regra", "outcome", "motivo_falha", "metrica_nome", "metrica_valor")
        .orderBy(F.desc("dt"), "execution_id", "regra", "metrica_valor")
    )


def rule_ranking(control: DataFrame) -> DataFrame:
    return (
        of_origin(control, names.RULES_STAGE)
        .groupBy("regra")
        .agg(
            F.count("*").alias("total_avaliacoes"),
            F.count_if(F.col("outcome") == "Failed").alias("falhas"),
        )
        .orderBy(F.desc("falhas"), "regra")
    )


def check_history(control: DataFrame) -> DataFrame:
    return (
        of_origin(control, names.CHECK_STAGE)
        .select("dt", "timestamp", "status", "problemas")
        .orderBy(F.desc("timestamp"))
    )


def problem_explode(control: DataFrame) -> DataFrame:
    """One row per problem the pipeline check found."""
    return (
        of_origin(control, names.CHECK_STAGE)
        .where(F.col("status") == PROBLEM)
        .select("dt", "timestamp", F.explode("problemas").alias("problema"))
        .orderBy(F.desc("timestamp"), "problema")
    )
