"""Streams: files once, checks beside the load, state by slices, outcomes, stuck runs, redeliveries."""

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chainlake.contract import JOB_RUNS
from chainlake.operators import checks, silver
from chainlake.plans import standins as s
from chainlake.sources import bronze, control, csv_events, generations
from chainlake.streaming import ingest, outcomes, state, timers
from tests.helpers import SOURCE, archive_of, folder_of, fresh, tuples
from tests.test_silver import MORE, REAL, log_of

CLOCK = lambda: datetime(2026, 10, 5, 12, tzinfo=timezone.utc)
HEADER = b"Dissemination Identifier,Original Dissemination Identifier,Action type,Event timestamp\n"
ROW = b"%d,,NEWT,2026-10-02T19:00:00\n"


def run(query):
    query.awaitTermination()
    assert query.exception() is None


@pytest.fixture
def feed(spark, tmp_path):
    """A folder with two files, and a function that ingests what is new in it."""
    folder = folder_of(tmp_path, {"a.csv": HEADER + ROW % 1 + ROW % 2, "empty.csv": HEADER})
    target, log, checkpoint = (fresh(tmp_path, n) for n in ("bronze", "log", "offsets"))
    layout = csv_events.discover_layout(spark, folder)

    def go(contract=SOURCE, at=checkpoint):
        run(ingest.ingest_stream(spark, folder, at, contract, layout, target, log, 5, CLOCK))

    return Path(folder), target, log, go


def test_each_file_once_and_only_new_ones(spark, feed):
    folder, target, log, go = feed
    go()
    first = bronze.read_bronze(spark, target).select("ingerido_em").distinct().collect()
    go()
    (folder / "b.csv").write_bytes(HEADER + ROW % 3)
    go()
    stored = bronze.read_bronze(spark, target)
    assert sorted(tuples(stored.select("arquivo_origem", "line_number"))) == [("a.csv", 0), ("a.csv", 1), ("b.csv", 0)]
    assert stored.where("arquivo_origem = 'a.csv'").select("ingerido_em").distinct().collect() == first


def test_checks_judge_every_file_even_an_empty_one(spark, feed):
    _, _, log, go = feed
    go()
    records = control.read_control(spark, log)
    volumes = records.where("origem = 'quality_check'").select("csv", "linhas", "status")
    assert sorted(tuples(volumes)) == [("raw/swaps/a.csv", 2, "ok"), ("raw/swaps/empty.csv", 0, "ok")]
    rules = records.where("origem = 'glue_data_quality'")
    assert rules.count() == 16
    assert {r["regra"] for r in rules.where("outcome = 'Failed'").collect()} == {
        'IsComplete "Dissemination Identifier"', "RowCount > 0",
        'ColumnValues "Action type" in ["NEWT", "MODI", "CORR", "TERM", "EROR", "REVI"]',
        'Uniqueness "Dissemination Identifier" > 0.99',
    }
    assert records.groupBy("csv").agg(F.count_distinct("execution_id")).where("csv is not null").count() == 2
    assert records.where("execution_id is null").count() == 0


def test_execution_id_comes_from_the_unpack_record(spark, feed):
    _, _, log, go = feed
    done = spark.createDataFrame([("in/a.zip", "raw/swaps/a.csv", "e-1")], "path string, destino string, execution_id string")
    control.append_control(control.unpack_records(done, SOURCE), log)
    go()
    ids = control.read_control(spark, log).where("csv = 'raw/swaps/a.csv'").select("execution_id").distinct()
    assert tuples(ids) == [("e-1",)]


def test_a_failing_check_does_not_stop_the_load(spark, feed, monkeypatch):
    _, target, log, go = feed

    def broken(*_):
        raise RuntimeError("no check today")

    monkeypatch.setattr(ingest, "check_records", broken)
    go()
    assert bronze.read_bronze(spark, target).count() == 2


def test_state_by_slices_equals_batch_in_any_order(spark, tmp_path):
    rows = REAL + MORE
    expected = sorted(tuples(silver.current_state(log_of(spark, rows), dedupe=False)), key=str)
    for order in (rows, rows[::-1]):
        slices, path = fresh(tmp_path, "slices"), fresh(tmp_path, "state")
        for i in range(0, len(order), 5):
            log_of(spark, order[i:i + 5]).coalesce(1).write.mode("append").parquet(slices)
        reader = spark.readStream.schema(spark.read.parquet(slices).schema).option("maxFilesPerTrigger", 1)
        run(state.state_stream(reader.parquet(slices), path, fresh(tmp_path, "offsets")))
        found = state.read_state(spark, path)
        assert sorted(tuples(found.select(*silver.current_state(log_of(spark, rows)).columns)), key=str) == expected
    compact = fresh(tmp_path, "compact")
    state.compact_state(spark, path, compact)
    assert sorted(tuples(state.read_state(spark, compact)), key=str) == sorted(tuples(found), key=str)


def test_a_replayed_slice_changes_nothing(spark, tmp_path):
    slices, path = fresh(tmp_path, "slices"), fresh(tmp_path, "state")
    log_of(spark, REAL).write.parquet(slices)
    stream = lambda: spark.readStream.schema(spark.read.parquet(slices).schema).parquet(slices)
    run(state.state_stream(stream(), path, fresh(tmp_path, "offsets")))
    before = sorted(tuples(state.read_state(spark, path)))
    run(state.state_stream(stream(), path, fresh(tmp_path, "offsets")))
    assert sorted(tuples(state.read_state(spark, path))) == before


def events_stream(spark, tmp_path, schema, *batches):
    folder = fresh(tmp_path, "events")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
    made = spark.read.parquet(folder)
    return spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_outcomes_share_the_log_with_batch_records(spark, tmp_path):
    log = fresh(tmp_path, "log")
    copied = spark.createDataFrame([("a", "b")], "origem string, destino string")
    control.append_control(control.copy_records(copied), log)
    events = events_stream(
        spark, tmp_path, "job_name string, job_run_id string, state string",
        [("j", "1", "SUCCEEDED"), ("j", "2", "RUNNING")], [("j", "3", "FAILED")],
    )
    details = spark.createDataFrame([("j", "1", {"--execution_id": "e1"}, 42)], JOB_RUNS)
    run(outcomes.record_outcomes(events, details, log, fresh(tmp_path, "offsets")))
    found = control.read_control(spark, log).select("origem", "job_run_id", "status", "execution_id", "duracao_segundos")
    assert sorted(tuples(found), key=str) == [
        ("glue_job", "1", "succeeded", "e1", 42), ("glue_job", "3", "failed", None, None),
        ("ingerir_cumulative", None, "copiado", None, None),
    ]


def to_sink(df, tmp_path):
    target = fresh(tmp_path, "out")
    run(
        df.writeStream.option("path", target).option("checkpointLocation", fresh(tmp_path, "offsets"))
        .trigger(availableNow=True).start()
    )
    return df.sparkSession.read.parquet(target)


def test_stuck_runs_by_watermark(spark, tmp_path):
    at = lambda h, m=0: datetime(2026, 10, 5, h, m, tzinfo=timezone.utc)
    events = events_stream(
        spark, tmp_path, "name string, event_time timestamp, state string",
        [("fine", at(1), "RUNNING"), ("stuck", at(1), "RUNNING"), ("late", at(1), "RUNNING")],
        [("fine", at(2), "SUCCEEDED"), ("late", at(4), "SUCCEEDED"), ("young", at(9), "RUNNING"), ("x", at(9), "FAILED")],
    )
    alerts = to_sink(outcomes.stuck_stream(events, SOURCE), tmp_path)
    assert sorted(r["name"] for r in alerts.collect()) == ["late", "stuck"]


def test_a_stuck_run_needs_no_later_event(spark, tmp_path):
    at = lambda h: datetime(2026, 10, 5, h, tzinfo=timezone.utc)
    events = events_stream(
        spark, tmp_path, "name string, event_time timestamp, state string",
        [("fine", at(1), "RUNNING"), ("dead", at(1), "RUNNING")], [("fine", at(2), "SUCCEEDED"), ("last", at(3), "RUNNING")],
    )
    kept = fresh(tmp_path, "runs")
    run(outcomes.run_stream(events, kept, fresh(tmp_path, "offsets")))
    stuck = lambda as_of: sorted(r["name"] for r in checks.stuck_runs(outcomes.read_runs(spark, kept), as_of, SOURCE).collect())
    assert stuck("2026-10-05T04:00:00+00:00") == ["dead"] and stuck("2026-10-05T06:00:00+00:00") == ["dead", "last"]


def test_redeliveries_are_dropped(spark, tmp_path):
    at = lambda m: datetime(2026, 10, 5, 1, m, tzinfo=timezone.utc)
    arrivals = events_stream(
        spark, tmp_path, "path string, arrived_at timestamp",
        [("in/a.zip", at(0)), ("in/b.zip", at(0))], [("in/a.zip", at(5)), ("in/c.zip", at(5))],
    )
    first = to_sink(outcomes.first_arrivals(arrivals), tmp_path)
    assert sorted(r["chave"] for r in first.collect()) == ["a-zip", "b-zip", "c-zip"]


def test_generated_files_follow_the_log(spark, sf_small, tmp_path):
    folder = s.write_csv_files(spark, sf_small, fresh(tmp_path, "raw"))
    read = csv_events.read_events(spark, folder)
    assert read.count() == spark.read.parquet(f"{sf_small}/events.parquet").count()


def test_bad_archives_do_not_hold_up_good_ones(spark, tmp_path):
    folder = archive_of(tmp_path, {"good.zip": {"in/a.csv": HEADER + ROW % 1}, "bad.zip": {"a.txt": b""}})
    raw, log, seen, offsets = (fresh(tmp_path, n) for n in ("raw", "log", "seen", "offsets"))
    for _ in range(2):
        run(ingest.unpack_stream(spark, folder, offsets, SOURCE, raw, log, seen))
    (record,) = control.read_control(spark, log).collect()
    assert (record["origem"], record["csv"], record["status"]) == ("unzip_swaps", "raw/swaps/a.csv", "descompactado")
    assert (Path(raw) / "a.csv").read_bytes() == HEADER + ROW % 1
    rejected = spark.read.parquet(seen).where("problema is not null").collect()
    assert [r["path"].endswith("bad.zip") for r in rejected] == [True]


@pytest.mark.parametrize("blank_values, reopen_on, annulled", [("row", (), False), ("keep", ("MODI",), True)])
def test_merged_state_equals_batch_with_its_options(spark, tmp_path, blank_values, reopen_on, annulled):
    rows = REAL + MORE + [("", "", "NEWT", "2026-10-02T10:00:00", "N", "1", "d3.csv", i) for i in (1, 2)]
    log = log_of(spark, rows)
    columns = [*log.columns, "encerrada", "tem_origem"]
    expected = sorted(tuples(silver.current_state(log, blank_values, reopen_on, annulled).select(columns)), key=str)
    slices, path = fresh(tmp_path, "slices"), fresh(tmp_path, "state")
    for i in range(0, len(rows), 3):
        log_of(spark, rows[::-1][i:i + 3]).coalesce(1).write.mode("append").parquet(slices)
    reader = spark.readStream.schema(spark.read.parquet(slices).schema).option("maxFilesPerTrigger", 1)
    run(state.merged_stream(reader.parquet(slices), path, fresh(tmp_path, "offsets"), blank_values, reopen_on, buckets=2, most=2))
    found = lambda: sorted(tuples(state.merged_state(spark, path, log.columns, annulled).select(columns)), key=str)
    assert found() == expected
    assert generations.vacuum(spark, path) > 0 and found() == expected


def totals(spark, path):
    return {r["k"]: r["n"] for r in generations.read(spark, path).groupBy("k").agg(F.max("n").alias("n")).collect()}


def test_generations_fold_full_buckets_and_replay(spark, tmp_path):
    path = fresh(tmp_path, "table")
    fold = lambda df: df.groupBy("k").agg(F.max("n").alias("n"))
    bucket = F.pmod(F.col("k"), F.lit(2)).cast("int")
    with pytest.raises(FileNotFoundError):
        generations.read(spark, path)
    add = lambda batch, rows: generations.merge(spark.createDataFrame(rows, "k long, n long"), path, batch, fold, bucket, 2)
    add(0, [(1, 1), (2, 1)])
    add(1, [(1, 2)])
    add(2, [(1, 3), (3, 1)])
    assert totals(spark, path) == {1: 3, 2: 1, 3: 1}
    # Bucket 1 had two parts and became one; bucket 0 was not touched.
    assert generations.read(spark, path).count() == 3
    assert not list(Path(path).glob("generation=2/bucket=0"))
    add(2, [(1, 3), (3, 1)])
    assert totals(spark, path) == {1: 3, 2: 1, 3: 1} and generations.read(spark, path).count() == 3
    add(3, [])
    # What a batch wrote without committing is not read.
    spark.createDataFrame([(9, 9)], "k long, n long").write.parquet(f"{path}/generation=4/bucket=1")
    assert totals(spark, path) == {1: 3, 2: 1, 3: 1}
    assert generations.vacuum(spark, path, keep=1) == 2 and totals(spark, path) == {1: 3, 2: 1, 3: 1}


def test_stuck_runs_by_timer(spark, tmp_path):
    at = lambda h, m=0: datetime(2026, 10, 5, h, m, tzinfo=timezone.utc)
    schema, folder, target, offsets = "name string, event_time timestamp, state string", *(fresh(tmp_path, n) for n in ("events", "out", "offsets"))

    def go(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        events = spark.readStream.schema(schema).parquet(folder)
        alerts = timers.stuck_alert_stream(events, SOURCE)
        run(alerts.writeStream.option("path", target).option("checkpointLocation", offsets).trigger(once=True).start())
        return sorted((r["name"] or "", r["start_date"].hour) for r in spark.read.parquet(target).collect())

    first = go(
        ("fine", at(1), "RUNNING"), ("fine", at(2), "SUCCEEDED"), ("dead", at(1), "RUNNING"), ("late", at(1), "RUNNING"), ("late", at(9), "FAILED"),
        ("again", at(1), "RUNNING"), ("again", at(1, 30), "SUCCEEDED"), ("again", at(2), "RUNNING"), (None, at(3), "RUNNING"),
        ("restarted", at(1), "RUNNING"), ("restarted", at(2), "RUNNING"), ("restarted", at(2, 5), "STOPPED"), ("early", at(5), "SUCCEEDED"), ("no time", None, "RUNNING"),
    )
    # Nothing came after these events: the clock alone told them.
    assert first == [("", 3), ("again", 2), ("dead", 1), ("late", 1)]
    # An end that came before its start; a run told once though its end comes late; a new start of a told run.
    assert go(("early", at(4), "RUNNING"), ("again", at(8), "SUCCEEDED"), ("dead", at(6), "RUNNING")) == sorted([*first, ("dead", 6)])
    with pytest.raises(ValueError):
        timers.stuck_alert_stream(spark.readStream.schema(schema).parquet(folder), SOURCE, forget=timedelta(hours=1))


def test_a_run_started_again_is_open(spark, tmp_path):
    at = lambda h: datetime(2026, 10, 5, h, tzinfo=timezone.utc)
    events = events_stream(
        spark, tmp_path, "name string, event_time timestamp, state string",
        [("r", at(1), "RUNNING"), ("r", at(2), "FAILED"), ("r", at(3), "RUNNING")],
    )
    kept = fresh(tmp_path, "runs")
    run(outcomes.run_stream(events, kept, fresh(tmp_path, "offsets")))
    assert [(r["status"], r["start_date"].hour) for r in outcomes.read_runs(spark, kept).collect()] == [("RUNNING", 3)]


def test_alerts_beside_the_streams(spark, tmp_path):
    log, alerts = fresh(tmp_path, "log"), fresh(tmp_path, "alerts")
    events = events_stream(spark, tmp_path, "job_name string, job_run_id string, state string", [("j", "1", "SUCCEEDED"), ("j", "2", "FAILED")])
    details = spark.createDataFrame([], JOB_RUNS)
    for _ in range(2):  # the second checkpoint is another stream's and leaves its own
        run(outcomes.record_outcomes(events, details, log, fresh(tmp_path, "offsets"), alerts, SOURCE))
    assert [r["message"].count("run 2") for r in control.read_alerts(spark, alerts).collect()] == [1, 1]
    with pytest.raises(ValueError):
        outcomes.record_outcomes(events, details, log, fresh(tmp_path, "offsets"), alerts)


def test_volume_alerts_beside_the_ingest(spark, tmp_path):
    folder = folder_of(tmp_path, {"a.csv": HEADER + ROW % 1})
    log, alerts = fresh(tmp_path, "log"), fresh(tmp_path, "alerts")
    days = [(f"2026-10-0{d}", f"e{d}", f"raw/swaps/{d}.csv", 100) for d in (1, 2, 3, 4)]
    past = spark.createDataFrame(days, "dt string, execution_id string, csv string, linhas long").withColumn("problemas", F.array().cast("array<string>"))
    for day in ("2026-10-01", "2026-10-02", "2026-10-03", "2026-10-04"):
        control.append_control(control.volume_records(past.where(F.col("dt") == day).drop("dt")), log, f"{day}T12:00:00+00:00")
    layout = csv_events.discover_layout(spark, folder)
    run(ingest.ingest_stream(spark, folder, fresh(tmp_path, "offsets"), SOURCE, layout, fresh(tmp_path, "bronze"), log, 5, CLOCK, alerts))
    (alert,) = control.read_alerts(spark, alerts).collect()
    assert "a.csv" in alert["message"] and "1 linhas" in alert["message"]


def test_redeliveries_after_any_time_and_late_arrivals_are_told(spark, tmp_path):
    at = lambda y, m=1: datetime(y, m, 1, tzinfo=timezone.utc)
    arrivals = events_stream(
        spark, tmp_path, "path string, arrived_at timestamp",
        [("in/a.zip", at(2024)), ("in/b.zip", at(2024)), ("in/b.zip", at(2024)), (None, at(2024))], [("in/a.zip", at(2031)), ("in/c.zip", at(2024, 6))],
        [("in/c.zip", at(2024, 2)), ("in/d.zip", at(2032))], [("in/a.zip", at(2033)), ("in/b.zip", at(2023))],
    )
    registry, flagged = fresh(tmp_path, "registry"), fresh(tmp_path, "flagged")
    run(outcomes.registered_arrivals(arrivals, registry, flagged, fresh(tmp_path, "offsets"), buckets=2, most=2))
    found = sorted((r["path"] or "", r["arrived_at"].year, r["duplicado"], r["atrasado"]) for r in spark.read.parquet(flagged).collect())
    assert found == [
        ("", 2024, False, False), ("in/a.zip", 2024, False, False), ("in/a.zip", 2031, True, False), ("in/a.zip", 2033, True, False),
        ("in/b.zip", 2023, True, True), ("in/b.zip", 2024, False, False), ("in/b.zip", 2024, True, False),
        ("in/c.zip", 2024, False, False), ("in/c.zip", 2024, True, True), ("in/d.zip", 2032, False, False),
    ]


def test_a_backlog_comes_in_a_bounded_number_of_batches(spark, tmp_path, monkeypatch):
    for i in range(20):
        (tmp_path / f"F{i}.csv").write_text("a\n1\n")
    assert ingest.backlog_limit(spark, str(tmp_path), least=8) == 8
    assert ingest.backlog_limit(spark, str(tmp_path), least=2) == 3
    monkeypatch.setattr(ingest, "MOST_FILES", 2)
    assert ingest.backlog_limit(spark, str(tmp_path), least=1) == 2
