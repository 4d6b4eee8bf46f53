"""Prefix sums along linked lists whose items lie in no order: list ranking.

Items are dealt into blocks of neighbouring ids. A block joins what it holds into chains by pointer jumping, and a chain that leaves the
block becomes one item of a shorter list, which is ranked in the same way. Where ids follow the list at all, nearly everything falls
together at once. Where they do not, so that a list hardly shrinks, its items double their reach in rounds of joins instead.
No task holds more than a block, and rounds grow with the logarithm of the items.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import saved
from chainlake.llm.order import numbered

BLOCK = 1 << 17


def chains(ids: np.ndarray, nexts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each item of a block, whose `ids` are sorted and whose `nexts` are -1 at a list's end: the first item of its chain, whether it
    is the chain's last, and the weights (a row each) of the chain's items before it."""
    at = np.minimum(np.searchsorted(ids, nexts), len(ids) - 1)
    inside = (nexts >= 0) & (ids[at] == nexts)
    before = np.full(len(ids), -1, dtype=np.int64)
    before[at[inside]] = np.flatnonzero(inside)
    jump = before.copy()
    first = np.where(before < 0, np.arange(len(ids)), before)
    sums = np.where(before < 0, 0, weights[:, before])
    while (jump >= 0).any():
        on = np.flatnonzero(jump >= 0)
        sums[:, on] += sums[:, jump[on]]
        first[on] = first[jump[on]]
        jump[on] = jump[jump[on]]
    return ids[first], ~inside, sums


def _chained(items: DataFrame, names: list[str], block: int) -> DataFrame:
    """Each item with `head` and `tail`, the first of its chain and whether it is the last, and `b_<name>`, the weights before it in its chain."""

    def step(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        nexts = table.column("next").fill_null(-1).to_numpy()
        weights = np.stack([table.column(n).to_numpy() for n in names])
        head, tail, sums = chains(table.column("id").to_numpy(), nexts, weights)
        out = {"id": table.column("id"), "next": table.column("next"), "head": head, "tail": tail}
        return pa.table(out | {n: table.column(n) for n in names} | {f"b_{n}": s for n, s in zip(names, sums)})

    fields = ["id long", "next long", "head long", "tail boolean", *(f"{n} long" for n in names), *(f"b_{n} long" for n in names)]
    grouped = items.select("id", "next", *names).groupBy(F.expr(f"id div {block}"))
    return saved(grouped.applyInArrow(step, ", ".join(fields)), "chains")


def _jumped(items: DataFrame, names: list[str]) -> DataFrame:
    """(id, b_<name>): the weights before each item, each round reaching twice as far back."""
    back = items.where("next IS NOT NULL").select(F.col("next").alias("id"), F.col("id").alias("jump"), *(F.col(n).alias(f"b_{n}") for n in names))
    nothing = [F.coalesce(f"b_{n}", F.lit(0).cast("long")).alias(f"b_{n}") for n in names]
    now = saved(items.select("id").join(back, "id", "left").select("id", "jump", *nothing), "jumps")
    while not now.where("jump IS NOT NULL").isEmpty():
        there = now.select(F.col("id").alias("jump"), F.col("jump").alias("far"), *(F.col(f"b_{n}").alias(f"f_{n}") for n in names))
        further = [(F.col(f"b_{n}") + F.coalesce(f"f_{n}", F.lit(0))).alias(f"b_{n}") for n in names]
        now = saved(now.join(there, "jump", "left").select("id", F.col("far").alias("jump"), *further), "jumps")
    return now.drop("jump")


def prefix_sums(items: DataFrame, names: list[str], block: int = BLOCK) -> DataFrame:
    """(id, b_<name> for each weight) of every item (id, next, weights): the weights of all items before it in its list.

    Ids are distinct and close to gapless from 0 (gaps only make blocks smaller); `next` is null at a list's end and no two items have the
    same. Weights are longs, not null. No items: no rows.
    """
    local = _chained(items, names, block)
    total = [(F.col(n) + F.col(f"b_{n}")).alias(n) for n in names]
    parts = local.where("tail").select(F.col("head").alias("id"), "next", *total)
    n_parts, n_items = parts.count(), local.count()
    # Lists that lie in one block each need nothing from others.
    if not n_parts or parts.where("next IS NOT NULL").isEmpty():
        return local.select("id", *(f"b_{n}" for n in names))
    if n_parts > n_items // 2:
        above = _jumped(parts, names)
    else:
        placed = saved(numbered(parts, ["id"], "place", "parts"), "parts")
        of_next = placed.select(F.col("id").alias("next"), F.col("place").alias("next_place"))
        shorter = saved(placed.join(of_next, "next", "left").select("id", "place", "next_place", *names), "parts")
        found = prefix_sums(shorter.select(F.col("place").alias("id"), F.col("next_place").alias("next"), *names), names, block)
        above = shorter.select(F.col("id").alias("part"), "place").join(found.withColumnRenamed("id", "place"), "place").drop("place").withColumnRenamed("part", "id")
    above = saved(above.select(F.col("id").alias("head"), *(F.col(f"b_{n}").alias(f"a_{n}") for n in names)), "heads")
    return local.join(above, "head").select("id", *((F.col(f"b_{n}") + F.col(f"a_{n}")).alias(f"b_{n}") for n in names))
