"""Current state kept near real time from intraday slices.

Each micro-batch folds its own events and stores that fold under its own id; a reader folds the stored
parts. The fold is idempotent and order-free, so late and out-of-order events need no watermark, a replayed
batch rewrites its own part and nothing else, and a slice costs what the slice holds, never the whole state.

`state_stream` keeps every slice. `merged_stream` deals chains out to buckets, folds a bucket's parts together whenever there are
too many of them, and takes the options of `current_state`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainlake.operators.silver import as_states, finished_states, fold_partials, fold_states, partial_states
from chainlake.sources import generations

PART = "slice"


def state_stream(events: DataFrame, state_path: str, checkpoint: str) -> StreamingQuery:
    """Fold the slices of `events`, a streaming typed log, into the state below `state_path`."""

    def step(batch: DataFrame, batch_id: int) -> None:
        fold_states(as_states(batch)).write.mode("overwrite").parquet(f"{state_path}/{PART}={batch_id}")

    return (
        events.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """One row per chain over all slices so far."""
    return fold_states(spark.read.parquet(state_path).drop(PART))


def compact_state(spark: SparkSession, state_path: str, target: str) -> None:
    """Store the folded state as a single part at `target`, a new path. Point the readers there, and later
    slices too; a slice present in both does no harm."""
    read_state(spark, state_path).write.mode("errorifexists").parquet(f"{target}/{PART}=-1")


def merged_stream(
    events: DataFrame, state_path: str, checkpoint: str, blank_values: str = "row", reopen_on: tuple[str, ...] = (),
    buckets: int = 64, most: int = 4,
) -> StreamingQuery:
    """Fold the slices of `events`, a streaming typed log, into buckets of chains below `state_path`.

    A slice writes its fold into the buckets it touches and no other. A bucket that holds `most` parts has them folded into one with the
    slice that comes next, so a chain's row is written again once in `most` slices that touch its bucket and a read folds at most `most` parts.
    The options are those of `current_state`, given to `merged_state` as well.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        folded = partial_states(batch, blank_values, reopen_on)
        bucket = F.pmod(F.xxhash64("chain"), F.lit(buckets)).cast("int")
        generations.merge(folded, state_path, batch_id, fold_partials, bucket, most)

    return (
        events.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merged_state(spark: SparkSession, state_path: str, columns: list[str], drop_annulled: bool = False) -> DataFrame:
    """The current state, with `columns` of the typed log, as of the last slice committed."""
    state = finished_states(fold_partials(generations.read(spark, state_path)), columns)
    return state.where(F.col("action") != "EROR") if drop_annulled else state
