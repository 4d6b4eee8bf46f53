"""Volume of a file against the history of the volume check's own records."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chainlake.contract import VOLUME_STAGE, Contract
from chainlake.functions.dates import utc_day
from chainlake.functions.messages import (
    FILE_BODY,
    FILE_SUBJECT,
    FLAT_LABEL,
    SEASONAL_LABEL,
    VOLUME_DROP,
    filled,
    joined,
)
from chainlake.functions.status import OK, is_volume_drop
from chainlake.functions.text import fixed_point
from chainlake.sources.control import of_origin, past_days


def counted(control: DataFrame) -> DataFrame:
    """Volume records that carry a row count. Days with problems stay in."""
    return of_origin(control, VOLUME_STAGE).where(F.col("linhas").isNotNull())


def baseline_flat(control: DataFrame, as_of: datetime | str, days: int) -> DataFrame:
    """(media): mean over the records of the last `days` days, today excluded; null without records."""
    return counted(past_days(control, as_of, days)).agg(F.avg("linhas").alias("media"))


def baseline_seasonal(control: DataFrame, as_of: datetime | str, weeks: int) -> DataFrame:
    """(media): the same over the last `weeks` days that share today's weekday."""
    return counted(past_days(control, as_of, 7 * weeks, same_weekday=True)).agg(F.avg("linhas").alias("media"))


def _chosen(seasonal: Column, flat: Column, contract: Contract) -> tuple[Column, Column]:
    """(media, rotulo): the seasonal mean if it is on and has at least one record, else the flat one."""
    seasonal_label = filled(SEASONAL_LABEL, semanas=contract.seasonal_weeks)
    flat_label = filled(FLAT_LABEL, dias=contract.history_days)
    use = seasonal if contract.seasonal else F.lit(None).cast("double")
    label = F.when(use.isNotNull(), seasonal_label).when(flat.isNotNull(), flat_label)
    return F.coalesce(use, flat).alias("media"), label.alias("rotulo")


def choose_baseline(control: DataFrame, as_of: datetime | str, contract: Contract) -> DataFrame:
    """(media, rotulo): one row, nulls without any history. One scan of the days either baseline needs."""
    reach = max(contract.history_days, 7 * contract.seasonal_weeks if contract.seasonal else 0)
    log = counted(past_days(control, as_of, reach))
    flat_days = _days_before(as_of, range(1, contract.history_days + 1))
    season_days = _days_before(as_of, range(7, 7 * contract.seasonal_weeks + 1, 7))
    means = log.agg(
        F.avg(F.when(F.col("dt").isin(season_days), F.col("linhas"))).alias("sazonal"),
        F.avg(F.when(F.col("dt").isin(flat_days), F.col("linhas"))).alias("simples"),
    )
    return means.select(*_chosen(F.col("sazonal"), F.col("simples"), contract))


def _days_before(as_of: datetime | str, steps: range) -> list[str]:
    return [(utc_day(as_of) - timedelta(days=n)).isoformat() for n in steps]


# ---- every day at once ----


def daily_volume(control: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """(dt, linhas, registros): sum and number of the records of each day.

    `days` adds days that have no record of their own but need a baseline.
    """
    log = counted(control).select("dt", "linhas", F.lit(1).alias("registros"))
    if days is not None:
        log = log.unionByName(days.select("dt", F.lit(0).cast("long").alias("linhas"), F.lit(0).alias("registros")))
    return log.groupBy("dt").agg(F.sum("linhas").alias("linhas"), F.sum("registros").alias("registros"))


def _trailing_mean(before: int, *season: Column) -> Column:
    """Mean over the records of the `before` preceding days, from daily sums and counts."""
    frame = W.partitionBy(*season).orderBy(F.unix_date(F.to_date("dt"))).rangeBetween(-before, -1)
    return F.try_divide(F.sum("linhas").over(frame).cast("double"), F.sum("registros").over(frame).cast("double"))


def baseline_calendar(control: DataFrame, contract: Contract, days: DataFrame | None = None) -> DataFrame:
    """(dt, simples, sazonal, media, rotulo) for every day of the log.

    The log is first summed per day, so the windows run over one row per calendar day however many files
    arrived; a mean over records is the quotient of the frame's sums.
    """
    daily = daily_volume(control, days)
    means = daily.select(
        "dt",
        _trailing_mean(contract.history_days, F.lit(0)).alias("simples"),
        _trailing_mean(7 * contract.seasonal_weeks, F.weekday(F.to_date("dt"))).alias("sazonal"),
    )
    return means.select("*", *_chosen(F.col("sazonal"), F.col("simples"), contract))


def baseline_month(control: DataFrame, contract: Contract) -> DataFrame:
    """(dt, media): mean over the earlier days of the same calendar month, this year's and past ones."""
    frame = W.partitionBy(F.month(F.to_date("dt"))).orderBy(F.unix_date(F.to_date("dt"))).rangeBetween(
        W.unboundedPreceding, -1
    )
    mean = F.try_divide(F.sum("linhas").over(frame).cast("double"), F.sum("registros").over(frame).cast("double"))
    return daily_volume(control).select("dt", mean.alias("media"))


def baseline_robust(control: DataFrame, days: int, how: str = "median") -> DataFrame:
    """(dt, media): a baseline a bad day cannot pull down; `median` of the records, or mean of `ok` ones.

    A median is not a quotient of sums: each record is handed to the `days` days it counts for (a fixed
    fan-out) and grouped there, which spreads the days over tasks where a window would use one.
    """
    if how == "ok":
        good = control.where(F.col("status") == OK)
        frame = W.orderBy(F.unix_date(F.to_date("dt"))).partitionBy(F.lit(0)).rangeBetween(-days, -1)
        mean = F.try_divide(
            F.sum("linhas").over(frame).cast("double"), F.sum("registros").over(frame).cast("double")
        )
        return daily_volume(good, counted(control).select("dt")).select("dt", mean.alias("media"))
    if how != "median":
        raise ValueError(f"how must be 'median' or 'ok', not {how!r}")
    log = counted(control).select(F.to_date("dt").alias("day"), "linhas")
    ahead = F.sequence(F.date_add("day", 1), F.date_add("day", days))
    handed = log.select(F.explode(ahead).alias("day"), "linhas")
    needed = log.select("day", F.lit(None).cast("long").alias("linhas"), F.lit(True).alias("own"))
    return (
        handed.withColumn("own", F.lit(False))
        .unionByName(needed)
        .groupBy("day")
        .agg(F.median("linhas").alias("media"), F.bool_or("own").alias("own"))
        .where("own")
        .select(F.date_format("day", "yyyy-MM-dd").alias("dt"), "media")
    )


# ---- verdicts ----


def _problems(rows: Column, mean: Column, label: Column, tolerance: float) -> Column:
    text = filled(VOLUME_DROP, rotulo=label, linhas=rows, media=fixed_point(mean, 0))
    return F.when(is_volume_drop(rows, mean, tolerance), F.array(text)).otherwise(
        F.array().cast("array<string>")
    )


def volume_verdict(counts: DataFrame, control: DataFrame, as_of: datetime | str, contract: Contract) -> DataFrame:
    """`counts` (csv, linhas, ...) plus `problemas`, judged against the history before `as_of`."""
    chosen = choose_baseline(control, as_of, contract).select(F.struct("media", "rotulo")).scalar()
    problems = _problems(F.col("linhas"), chosen["media"], chosen["rotulo"], contract.max_drop)
    return counts.withColumn("problemas", problems)


def volume_verdict_by_day(counts: DataFrame, control: DataFrame, contract: Contract) -> DataFrame:
    """`counts` (csv, dt, linhas, ...) plus `problemas`, each file judged against its own day's history."""
    base = baseline_calendar(control, contract, counts.select("dt")).select("dt", "media", "rotulo")
    problems = _problems(F.col("linhas"), F.col("media"), F.col("rotulo"), contract.max_drop)
    return counts.join(base, "dt", "left").withColumn("problemas", problems).drop("media", "rotulo")


def volume_alerts(verdicts: DataFrame, contract: Contract) -> DataFrame:
    """(subject, message) per file with problems; nothing when all is well."""
    subject = filled(FILE_SUBJECT, fonte=contract.name, arquivo=F.col("csv"))
    body = filled(FILE_BODY, arquivo=F.col("csv"), problemas=joined(F.col("problemas")))
    return verdicts.where(F.size("problemas") > 0).select(
        "csv", subject.alias("subject"), body.alias("message")
    )
