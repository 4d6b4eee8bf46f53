"""Files processed once each as they arrive: land in Bronze, then check, never letting a check stop a load."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainlake.contract import CHECK_STAGE, CONTROL, PROVENANCE, VOLUME_STAGE, Contract
from chainlake.functions.messages import CHECKS_BROKEN
from chainlake.functions.status import PROBLEM
from chainlake.functions.text import named
from chainlake.operators.correlate import correlate
from chainlake.operators.quality import evaluate, ruleset
from chainlake.operators.volume import volume_alerts, volume_verdict
from chainlake.sources.archives import archive_files, unpack
from chainlake.sources.bronze import write_bronze
from chainlake.sources.control import (
    append_alerts,
    append_control,
    batch_leaf,
    batch_time,
    of_origin,
    read_batch,
    read_control,
    rule_records,
    unpack_records,
    volume_records,
)
from chainlake.sources.csv_events import MARK, Layout, aligned, csv_options, records, with_ingest_time

log = logging.getLogger(__name__)

# Files of a micro-batch, at most; and the micro-batches that a backlog comes in while that leaves them smaller.
MOST_FILES = 1000
BATCHES = 8


def stream_events(
    spark: SparkSession, path: str, layout: Layout, files_per_trigger: int | None = None
) -> DataFrame:
    """Bronze rows of the files that arrive below `path`, and one MARK row per file.

    Line numbers are counted inside the scan's task, so no window is needed, which a stream would refuse.
    """
    reader = csv_options(spark.readStream, layout.width)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_ingest_time(aligned(records(reader.csv(path)), layout.columns, layout.width, marks=True))


def backlog_limit(spark: SparkSession, path: str, least: int) -> int:
    """Files per trigger for the files now below `path`: `least` for few, a share of a larger backlog, MOST_FILES at most.

    A micro-batch has a cost of its own, beside its rows', so their number must not grow with the files while these fit into larger ones.
    """
    # The listing's content column is not selected, so no file is read for it.
    files = spark.read.format("binaryFile").load(path).select("path").count()
    return min(MOST_FILES, max(least, -(-files // BATCHES)))


def process_batch(
    contract: Contract,
    bronze_path: str,
    control_path: str | None = None,
    clock: Callable[[], datetime] | None = None,
    alerts_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The `foreachBatch` step: write Bronze, then record rule outcomes and the volume verdict.

    The batch is kept for the checks so that the CSV is parsed once; the trigger's limit bounds its size. Records
    bear the micro-batch's own instant, or the `clock`'s, and a replay replaces them. Checks that fail leave a
    record of that, and the load stands. With `alerts_path`, files with a volume problem leave an alert there.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_bronze(batch.where(F.col("line_number") != MARK), bronze_path)
            if control_path is not None:
                leaf = batch_leaf(batch, batch_id, VOLUME_STAGE)
                at = clock() if clock else batch_time(batch, "ingerido_em")
                if at is None:  # nothing came
                    return
                try:
                    append_control(check_records(batch, batch_id, contract, control_path, at), control_path, at, leaf)
                    if alerts_path is not None:
                        # From the records as they were written: judged once, worded alike.
                        volumes = of_origin(read_batch(batch.sparkSession, control_path, leaf), VOLUME_STAGE)
                        append_alerts(volume_alerts(volumes, contract), alerts_path, leaf)
                except Exception as error:  # a check that breaks must not undo or block the load
                    log.exception("checks of batch %s failed; its rows are in Bronze", batch_id)
                    append_control(broken_records(batch, batch_id, error), control_path, at, leaf)
        finally:
            batch.unpersist()

    return step


def broken_records(batch: DataFrame, batch_id: int, error: Exception) -> DataFrame:
    """(origem, csv, status, problemas): for each file of a batch, that its checks did not come to an end."""
    text = CHECKS_BROKEN.format(lote=batch_id, erro=type(error).__name__)
    return batch.select(F.col("arquivo_origem").alias("csv")).distinct().select(
        F.lit(CHECK_STAGE).alias("origem"), "csv", F.lit(PROBLEM).alias("status"), F.array(F.lit(text)).alias("problemas")
    )


def check_records(
    batch: DataFrame, batch_id: int, contract: Contract, control_path: str, as_of: datetime
) -> DataFrame:
    """Control records of a batch: per file one per rule, and one for its volume.

    A file's execution id is the one its unpacking left in the log; else one derived from file and batch,
    so that a replayed batch records the same id.
    """
    spark = batch.sparkSession
    try:
        control = read_control(spark, control_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # The first batch: no log yet.
        control = spark.createDataFrame([], CONTROL)
    rows = batch.where(F.col("line_number") != MARK)
    columns = [c for c in batch.columns if c not in PROVENANCE]
    there = F.array_compact(F.array(*(F.nullif(named(c), F.lit("")) for c in columns)))
    layouts = batch.where(F.col("line_number") == MARK).select("arquivo_origem", there.alias("colunas"))
    counts = batch.groupBy("arquivo_origem").agg((F.count("*") - 1).alias("linhas"))
    listed = counts.withColumn("csv", F.concat(F.lit(contract.raw_prefix), "arquivo_origem"))
    own = F.md5(F.concat_ws("|", "csv", F.lit(batch_id)))
    files = correlate(listed, control, contract.start_stage).withColumn(
        "execution_id", F.coalesce("execution_id", own)
    )
    outcomes = evaluate(rows, ruleset(contract), by="arquivo_origem", layouts=layouts).join(
        files.select("arquivo_origem", "execution_id"), "arquivo_origem"
    )
    verdicts = volume_verdict(files, control, as_of, contract)
    return rule_records(outcomes, F.col("execution_id")).unionByName(
        volume_records(verdicts), allowMissingColumns=True
    )


def ingest_stream(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    contract: Contract,
    layout: Layout,
    bronze_path: str,
    control_path: str | None = None,
    files_per_trigger: int | None = MOST_FILES,
    clock: Callable[[], datetime] | None = None,
    alerts_path: str | None = None,
) -> StreamingQuery:
    """Process all files not yet processed under this checkpoint, then stop. A new checkpoint starts over.

    A backlog comes in batches of `files_per_trigger` files; None takes it all at once.
    """
    rows = stream_events(spark, path, layout, files_per_trigger)
    return (
        rows.writeStream.foreachBatch(process_batch(contract, bronze_path, control_path, clock, alerts_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def unpack_stream(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    contract: Contract,
    raw_dir: str,
    control_path: str,
    seen_path: str,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Unpack the archives not yet unpacked under this checkpoint into `raw_dir`, then stop.

    Every archive unpacked leaves a control record with its execution id, derived from path and batch, so
    that a replay keeps it. One without exactly one CSV leaves none and does not hold up the others: it
    stays in `seen_path`, where each batch stores what it found, with its `problema`.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        seen = f"{seen_path}/batch={batch_id}"
        # Written once and read back, since evaluating it again would unpack again.
        unpack(batch, raw_dir).write.mode("overwrite").parquet(seen)
        done = spark.read.parquet(seen).where("problema is null").withColumns(
            {
                "destino": F.concat(F.lit(contract.raw_prefix), "member"),
                "execution_id": F.md5(F.concat_ws("|", "path", F.lit(batch_id))),
            }
        )
        leaf = batch_leaf(batch, batch_id, contract.start_stage)
        append_control(unpack_records(done, contract), control_path, batch_time(batch, "lido_em"), leaf)

    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    return (
        archive_files(reader, path).withColumn("lido_em", F.current_timestamp())
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
