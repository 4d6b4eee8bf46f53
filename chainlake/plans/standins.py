"""Event log, control log, runs and files derived from the driver's tables.

Each is a projection of a table, row by row, so that it grows with the table and costs no shuffle; the SQL
next to it says the same for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake import contract as names
from chainlake.contract import Contract
from chainlake.functions.dates import iso_text
from chainlake.sources.store import open_store

SOURCE = Contract(name="swaps")

# Events per generated file. A day's file of the real feed holds about ten times as many.
FILE_ROWS = 2500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# ---- event log ----


def bronze_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of a feed: `events` as swap events, strings under the feed's column names.

    A chain is a user and a last digit; sign-ups create it. Chains without a sign-up are orphans, a second
    sign-up repeats the first one's id, and a quarter of the amounts are blank.
    """
    c = SOURCE.columns
    e = _events(spark, sf_dir)
    chain = F.concat(F.lit("S"), "user_id", F.lit("-"), F.col("event_id") % 10)
    new = F.col("event_type") == "signup"
    action = (
        F.when(new, "NEWT").when(F.col("event_type") == "click", "MODI")
        .when(F.col("event_type") == "view", "REVI").when(F.col("event_type") == "purchase", "CORR")
        .when(F.col("value") < 40, "TERM").otherwise("EROR")
    )
    amount = F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    return e.select(
        F.when(new, chain).otherwise(F.concat(chain, F.lit("/"), "event_id")).alias(c.diss_id),
        F.when(new, "").otherwise(chain).alias(c.orig_id),
        action.alias(c.action),
        F.col("event_type").alias(c.event),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c.event_ts),
        F.lit("IR").alias(c.asset_class),
        F.concat(F.lit("PROD-"), F.col("user_id") % 7).alias(c.product),
        amount.alias(c.notional),
        F.when(F.col("user_id") % 3 == 0, "EUR").otherwise("USD").alias(c.currency),
        F.concat(F.lit("EVENTS_"), F.date_format("ts", "yyyy_MM_dd"), F.lit(".csv")).alias("arquivo_origem"),
        F.col("event_id").alias("line_number"),
    )


EVENT_LOG_SQL = """
SELECT CASE WHEN event_type = 'signup' THEN chain ELSE chain || '/' || event_id END AS diss_id,
  CASE WHEN event_type = 'signup' THEN '' ELSE chain END AS orig_id,
  CASE event_type WHEN 'signup' THEN 'NEWT' WHEN 'click' THEN 'MODI' WHEN 'view' THEN 'REVI'
    WHEN 'purchase' THEN 'CORR' ELSE CASE WHEN value < 40 THEN 'TERM' ELSE 'EROR' END END AS action,
  ts AS event_ts, 'PROD-' || (user_id % 7) AS product,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS notional,
  CASE WHEN user_id % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
  'EVENTS_' || strftime(ts, '%Y_%m_%d') || '.csv' AS arquivo_origem,
  event_id AS line_number, chain, event_type AS event
FROM (SELECT *, 'S' || user_id || '-' || (event_id % 10) AS chain FROM events)
"""

# First copy of each event, as the fold counts it.
DISTINCT_LOG_SQL = f"""
SELECT * FROM ({EVENT_LOG_SQL})
QUALIFY row_number() OVER (PARTITION BY diss_id ORDER BY arquivo_origem, line_number) = 1
"""


# ---- control log ----


def control_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as pipeline step records; an execution is a user and a last digit."""
    e = _events(spark, sf_dir)
    kind = F.col("event_type")
    origin = (
        F.when(kind == "signup", SOURCE.start_stage).when(kind == "view", names.RULES_STAGE)
        .when(kind == "click", names.JOB_STAGE).when(kind == "purchase", names.VOLUME_STAGE)
        .when(F.col("event_id") % 2 == 0, names.DISPATCH_STAGE).otherwise(names.CHECK_STAGE)
    )
    status = (
        F.when(kind == "signup", "descompactado").when(kind == "click", "succeeded")
        .when(F.col("value") > 60, "problema").otherwise("ok")
    )
    rule = kind == "view"
    problems = F.when(
        status == "problema",
        F.array(F.concat(F.lit("p-"), "event_id"), F.concat(F.lit("u-"), "user_id")),
    ).otherwise(F.array().cast("array<string>"))
    return e.select(
        iso_text(F.col("ts")).alias("timestamp"),
        origin.alias("origem"),
        F.concat(F.lit("raw/swaps/F"), F.floor(F.col("event_id") / 3), F.lit(".csv")).alias("csv"),
        F.when(kind == "error", F.concat(F.lit("jr_"), "event_id")).alias("job_run_id"),
        F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("ex-"), "user_id", F.lit("-"), F.col("event_id") % 10))
        .alias("execution_id"),
        F.when(kind == "purchase", F.floor("value") + 1).alias("linhas"),
        problems.alias("problemas"),
        status.alias("status"),
        F.when(kind == "click", F.floor("value")).alias("duracao_segundos"),
        F.when(rule, F.concat(F.lit("R"), F.col("user_id") % 8)).alias("regra"),
        F.when(rule, F.when(F.col("value") > 60, "Failed").otherwise("Passed")).alias("outcome"),
        F.when(rule & (F.col("value") > 60), F.concat(F.lit("Value: "), "event_id")).alias("motivo_falha"),
        F.when(rule, "Completeness").alias("metrica_nome"),
        F.when(rule, F.col("value")).alias("metrica_valor"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )


CONTROL_LOG_SQL = f"""
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN epoch_us(ts) % 1000000 <> 0 THEN strftime(ts, '.%f') ELSE '' END || '+00:00' AS "timestamp",
  ts, CASE WHEN event_type = 'signup' THEN '{SOURCE.start_stage}' WHEN event_type = 'view' THEN 'glue_data_quality'
    WHEN event_type = 'click' THEN 'glue_job' WHEN event_type = 'purchase' THEN 'quality_check'
    WHEN event_id % 2 = 0 THEN 'trigger_bronze' ELSE 'checar_pipeline' END AS origem,
  'raw/swaps/F' || (event_id // 3) || '.csv' AS csv,
  CASE WHEN event_type = 'error' THEN 'jr_' || event_id END AS job_run_id,
  CASE WHEN event_id % 11 <> 0 THEN 'ex-' || user_id || '-' || (event_id % 10) END AS execution_id,
  CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) + 1 END AS linhas,
  CASE WHEN event_type IN ('signup', 'click') OR value <= 60 THEN []
    ELSE ['p-' || event_id, 'u-' || user_id] END AS problemas,
  CASE WHEN event_type = 'signup' THEN 'descompactado' WHEN event_type = 'click' THEN 'succeeded'
    WHEN value > 60 THEN 'problema' ELSE 'ok' END AS status,
  CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) END AS duracao_segundos,
  CASE WHEN event_type = 'view' THEN 'R' || (user_id % 8) END AS regra,
  CASE WHEN event_type = 'view' THEN CASE WHEN value > 60 THEN 'Failed' ELSE 'Passed' END END AS outcome,
  CASE WHEN event_type = 'view' AND value > 60 THEN 'Value: ' || event_id END AS motivo_falha,
  CASE WHEN event_type = 'view' THEN 'Completeness' END AS metrica_nome,
  CASE WHEN event_type = 'view' THEN value END AS metrica_valor,
  strftime(ts, '%Y-%m-%d') AS dt
FROM events
"""


def order_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as volume records: each order a file of its day, its price the row count."""
    o = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("timestamp"))
    return o.select(
        F.lit(names.VOLUME_STAGE).alias("origem"),
        F.concat(F.lit("order-"), "o_orderkey").alias("csv"),
        F.floor("o_totalprice").alias("linhas"),
        F.when(F.col("o_orderstatus") == "P", "problema").otherwise("ok").alias("status"),
        F.date_format("day", "yyyy-MM-dd").alias("dt"),
    )


ORDER_VOLUMES_SQL = """
SELECT 'order-' || o_orderkey AS csv, CAST(floor(o_totalprice) AS BIGINT) AS linhas,
  CASE WHEN o_orderstatus = 'P' THEN 'problema' ELSE 'ok' END AS status,
  CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y-%m-%d') AS dt
FROM orders
"""


# ---- job events and runs: each event is a run ----


def job_events(spark: SparkSession, sf_dir: str, run: str = "event_id") -> DataFrame:
    """A RUNNING event per run when it starts and, but for clicks, a terminal one `value` minutes later. By user, runs start again and again."""
    e = _events(spark, sf_dir)
    kind = F.col("event_type")
    ended = (
        F.when(kind.isin("view", "purchase"), "SUCCEEDED").when(kind == "error", "FAILED")
        .when(kind == "signup", "STOPPED")
    )
    end = F.timestamp_micros(F.unix_micros("ts") + F.floor(F.col("value") * 60) * 1_000_000)
    both = F.array(
        F.struct(F.lit("RUNNING").alias("state"), F.col("ts").alias("event_time")),
        F.struct(ended.alias("state"), end.alias("event_time")),
    )
    return e.select(
        F.lit("bronze").alias("job_name"),
        F.concat(F.lit("jr_"), "event_id").alias("job_run_id"),
        F.concat(F.lit("run-"), run).alias("name"),
        F.inline(both),
    ).where("state is not null")


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run details; runs of views were started by hand and have no execution id."""
    given = F.create_map(F.lit("--execution_id"), F.concat(F.lit("ex-"), "user_id"))
    none = F.create_map().cast("map<string,string>")
    return _events(spark, sf_dir).select(
        F.lit("bronze").alias("job_name"),
        F.concat(F.lit("jr_"), "event_id").alias("job_run_id"),
        F.when(F.col("event_type") == "view", none).otherwise(given).alias("arguments"),
        F.floor("value").alias("execution_time"),
    )


JOB_EVENTS_SQL = """
SELECT 'bronze' AS job_name, 'jr_' || event_id AS job_run_id, 'run-' || event_id AS name, 'RUNNING' AS state,
  ts AS event_time FROM events
UNION ALL SELECT 'bronze', 'jr_' || event_id, 'run-' || event_id,
  CASE WHEN event_type IN ('view', 'purchase') THEN 'SUCCEEDED' WHEN event_type = 'error' THEN 'FAILED' ELSE 'STOPPED' END,
  make_timestamp(epoch_us(ts) + CAST(floor(value * 60) AS BIGINT) * 1000000)
FROM events WHERE event_type <> 'click'
"""

JOB_RUNS_SQL = """
SELECT 'bronze' AS job_name, 'jr_' || event_id AS job_run_id,
  CASE WHEN event_type <> 'view' THEN 'ex-' || user_id END AS execution_id,
  CAST(floor(value) AS BIGINT) AS duracao_segundos
FROM events
"""


def running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, start_date, status): a run is RUNNING unless it has a terminal event."""
    runs = job_events(spark, sf_dir).groupBy("name").agg(
        F.min("event_time").alias("start_date"), F.bool_or(F.col("state") != "RUNNING").alias("ended")
    )
    return runs.select(
        "name", "start_date", F.when(F.col("ended"), "SUCCEEDED").otherwise("RUNNING").alias("status")
    )


RUNNING_SQL = f"""
SELECT name, min(event_time) AS start_date FROM ({JOB_EVENTS_SQL}) GROUP BY name HAVING bool_and(state = 'RUNNING')
"""


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object arrivals, several per name: two events of the same user and type are two deliveries."""
    return _events(spark, sf_dir).select(
        F.concat(F.lit("raw/swaps_zip/"), "event_type", F.lit(" "), "user_id", F.lit(".zip")).alias("path"),
        F.col("ts").alias("arrived_at"),
        F.floor("value").alias("length"),
        F.date_trunc("day", "ts").alias("modified"),
    )


# ---- raw files ----


def write_csv_files(spark: SparkSession, sf_dir: str, folder: str, as_zip: bool = False) -> str:
    """Write the event log as CSV files of FILE_ROWS events, or as archives of one such file each.

    A group is one file and bounded by FILE_ROWS ids. Odd-numbered files swap the first two columns, so
    readers must go by the header. An archive whose last event is an error holds a second CSV, which makes
    it a bad one.
    """
    rows = bronze_log(spark, sf_dir).drop("arquivo_origem").withColumnRenamed("line_number", "event_id")
    files = rows.groupBy(F.floor(F.col("event_id") / FILE_ROWS).alias("file"))
    write = _archive_writer(folder) if as_zip else _csv_writer(folder)
    files.applyInPandas(write, "name string, rows long").write.format("noop").mode("overwrite").save()
    return folder


def file_name(number: int) -> str:
    return f"EVENTS {number:08d}.csv"


def _csv_bytes(key, frame) -> tuple[str, bytes]:
    frame = frame.sort_values("event_id").drop(columns="event_id")
    names_ = list(frame.columns)
    if key[0] % 2:
        names_[0], names_[1] = names_[1], names_[0]
    return file_name(key[0]), frame[names_].to_csv(index=False).encode("utf-8-sig")


def _save(folder: str, name: str, content: bytes) -> None:
    store, root = open_store(folder)
    store.create_dir(root)
    with store.open_output_stream(f"{root}/{name}") as out:
        out.write(content)


def _csv_writer(folder: str):
    import pandas as pd

    def write(key, frame):
        name, content = _csv_bytes(key, frame)
        _save(folder, name, content)
        return pd.DataFrame({"name": [name], "rows": [len(frame)]})

    return write


def _archive_writer(folder: str):
    import io
    import zipfile

    import pandas as pd

    def write(key, frame):
        name, content = _csv_bytes(key, frame)
        blob = io.BytesIO()
        with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"out/{name}", content)
            if frame.sort_values("event_id")[SOURCE.columns.event].iloc[-1] == "error":
                archive.writestr("second.CSV", b"a\n1\n")
        _save(folder, name.removesuffix(".csv") + ".zip", blob.getvalue())
        return pd.DataFrame({"name": [name], "rows": [len(frame)]})

    return write
