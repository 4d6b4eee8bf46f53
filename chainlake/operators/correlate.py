"""Tying arrivals, files and job outcomes to executions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chainlake.functions.status import execution_or_new
from chainlake.functions.text import arrival_key, base_name, blank_filled
from chainlake.operators.keyed import HOT_ROWS, attach, hot_keys
from chainlake.sources.control import of_origin


def keyed_arrivals(arrivals: DataFrame, by_content: bool = False) -> DataFrame:
    """Add `chave`, the name a run for this arrival would get, and `identidade`, what a redelivery has in common with it.

    The identity is the whole base name; a run name is cut and made safe, so different files may share one. By base name
    alone, a corrected upload under an old name counts as a duplicate. `by_content` adds length and modification
    time, so that only a true redelivery does. A null path has the identity of an empty name.
    """
    identity = base_name(blank_filled(F.col("path")))
    if by_content:
        identity = F.to_json(F.struct(identity.alias("n"), "length", F.unix_micros("modified").alias("m")))
    return arrivals.withColumns({"chave": arrival_key(F.col("path")), "identidade": identity})


def suppress_duplicates(
    arrivals: DataFrame,
    started: DataFrame | None = None,
    by_content: bool = False,
    tie: tuple[str, ...] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`arrivals` (path, arrived_at, ...) plus `chave` and `duplicado`; a duplicate is reported, not an error.

    The first arrival of an identity starts a run, unless it is among `started`, earlier arrivals with the columns the
    identity is made of. First is by time, then path, then the `tie` columns, such as a delivery id: rows equal in
    all of these cannot be told apart and carry the same flag.
    """
    keyed = keyed_arrivals(arrivals, by_content)
    place = F.struct("arrived_at", "path", *tie)
    known = _started(started, keyed, by_content)

    # Rows of hot identities stay where they are; the few first arrivals of those are broadcast.
    hot = hot_keys(keyed, "identidade", hot_rows)
    rows = keyed.join(hot, "identidade", "left_semi")
    firsts = rows.groupBy("identidade").agg(F.min(place).alias("first")).join(known, "identidade", "left")
    stay = rows.join(F.broadcast(firsts), "identidade").withColumn("later", place != F.col("first")).drop("first")

    # All others are numbered in a window, whose partitions hold at most `hot_rows` rows each.
    inside = W.partitionBy("identidade").orderBy("arrived_at", "path", *tie)
    move = keyed.join(hot, "identidade", "left_anti").join(known, "identidade", "left")
    move = move.withColumn("later", F.rank().over(inside) > 1)

    marked = stay.unionByName(move)
    duplicate = F.col("later") | F.coalesce("known", F.lit(False))
    return marked.withColumn("duplicado", duplicate).drop("later", "known", "identidade")


def _started(started: DataFrame | None, keyed: DataFrame, by_content: bool) -> DataFrame:
    """(identidade, known): identities of arrivals whose runs have started."""
    before = keyed.limit(0) if started is None else keyed_arrivals(started, by_content)
    return before.select("identidade").distinct().withColumn("known", F.lit(True))


def enrich_outcome(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Job events plus `execution_id` and `duracao_segundos` of their run; null where the run is unknown.

    A plain equi-join on purpose: both sides come straight from a shuffle, so AQE can broadcast a small
    `runs` or split a skewed key by itself.
    """
    details = runs.select(
        "job_name", "job_run_id",
        F.try_element_at("arguments", F.lit("--execution_id")).alias("execution_id"),
        F.col("execution_time").alias("duracao_segundos"),
    )
    return events.join(details, ["job_name", "job_run_id"], "left")


def correlate(files: DataFrame, control: DataFrame, start_stage: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """`files` (csv, ...) plus the `execution_id` its last unpack record gave it, null without one."""
    last = (
        of_origin(control, start_stage)
        .groupBy("csv")
        .agg(F.max_by("execution_id", F.struct("timestamp", "execution_id")).alias("execution_id"))
    )
    return attach(files, last, "csv", hot_rows)


def with_execution_id(files: DataFrame) -> DataFrame:
    """Keep a correlated id, draw one for files without. Write the result before using it twice."""
    return files.withColumn("execution_id", execution_or_new(F.col("execution_id")))
