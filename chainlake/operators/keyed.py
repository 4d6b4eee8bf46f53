"""Working per key when single keys may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot. There are at most rows / HOT_ROWS hot keys, which bounds every
# table of hot keys and makes it fit to broadcast: 100,000 keys for 10^11 rows.
HOT_ROWS = 1_000_000


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hot keys of `rows`, marked for broadcast. Counting combines before it shuffles."""
    counts = rows.groupBy(key).agg(F.count("*").alias("rows"))
    return F.broadcast(counts.where(F.col("rows") > hot_rows).select(key))


def attach(rows: DataFrame, facts: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left-join `rows` with `facts`, which has one row per key.

    AQE splits a skewed join partition only where both sides come straight from a shuffle, not from an
    aggregate, as facts mostly do. So rows of hot keys stay where they are and get their facts by broadcast;
    only the others are shuffled.
    """
    hot = hot_keys(rows, key, hot_rows)
    few = F.broadcast(facts.join(hot, key, "left_semi"))
    stay = rows.join(hot, key, "left_semi").join(few, key, "left")
    move = rows.join(hot, key, "left_anti").join(facts, key, "left")
    return stay.unionByName(move)
