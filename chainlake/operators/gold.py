"""Business metrics over the current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def volume_by_product(state: DataFrame) -> DataFrame:
    """(product, currency, operacoes, abertas, volume). `notional` must be a decimal."""
    return state.groupBy("product", "currency").agg(
        F.count("*").alias("operacoes"),
        F.count_if(~F.col("encerrada")).alias("abertas"),
        F.sum("notional").alias("volume"),
    )


def tenor_buckets(state: DataFrame, start: str, end: str, edges: tuple[int, ...]) -> DataFrame:
    """(faixa, operacoes, menor, maior, mediana): distribution of the days from `start` to `end`.

    Bucket i holds tenors from edges[i-1] (included) to edges[i]; the first and last are open. The dates
    are parameters because the feed's own column names differ between layouts. Tenors are counted per
    length before the median, which then weighs at most one row per distinct number of days.
    """
    days = F.datediff(F.col(end), F.col(start))
    lengths = state.select(days.alias("dias")).where("dias is not null").groupBy("dias").agg(F.count("*").alias("n"))
    bucket = F.lit(len(edges))
    for i, edge in reversed(list(enumerate(edges))):
        bucket = F.when(F.col("dias") < edge, i).otherwise(bucket)
    return lengths.groupBy(bucket.alias("faixa")).agg(
        F.sum("n").alias("operacoes"),
        F.min("dias").alias("menor"),
        F.max("dias").alias("maior"),
        F.percentile("dias", F.lit(0.5), F.col("n")).alias("mediana"),
    )


def concentration(state: DataFrame, party: str, amount: str) -> DataFrame:
    """(party, total, participacao, hhi): each party's share, and the Herfindahl index of all shares.

    The grand totals are one scalar subquery over the per-party sums; a window over all parties would bring
    every one of them into one task.
    """
    totals = state.groupBy(party).agg(F.sum(amount).alias("total"))
    value = F.col("total").cast("double")
    grand = totals.agg(
        F.struct(F.sum("total").cast("double").alias("whole"), F.sum(value * value).alias("squares"))
    ).scalar()
    whole, squares = grand["whole"], grand["squares"]
    return totals.select(
        party, "total",
        F.try_divide(value, whole).alias("participacao"),
        F.try_divide(squares, whole * whole).alias("hhi"),
    )
