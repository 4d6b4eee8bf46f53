"""Numbering rows in an order that no single task sees whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.llm.common import saved

# monotonically_increasing_id: the partition above this many bits, the row within it below.
_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column | str], name: str, purpose: str = "numbered") -> DataFrame:
    """`df` with column `name`: each row's place in `order`, from 0 and without gaps.

    Rows are dealt out by ranges of the order, sorted and written; a row's place is its place in its range and the rows of the
    ranges before. Rows that the order does not tell apart follow each other in the order they are read in, which also
    parts them between ranges, however many there are. What is added up in one task has a row for each range.
    """
    read = df.withColumn("_read", F.monotonically_increasing_id())
    spread = read.repartitionByRange(*order, "_read").sortWithinPartitions(*order, "_read").drop("_read")
    placed = saved(spread.withColumn("_slot", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_slot", _ROW_BITS)
    before = F.coalesce(F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).select("_part", before.cast("long").alias("_start"))
    place = F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1) + F.col("_start")
    # A row for each partition of the sort: its number is a setting, not the table's size.
    return placed.join(F.broadcast(starts), part == F.col("_part")).select(*df.columns, place.alias(name))
