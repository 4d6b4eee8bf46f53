"""Quality rules, volume, pipeline checks, correlation: worked cases."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chainlake.contract import JOB_RUNS, RUNS
from chainlake.functions import dates, status, text
from chainlake.operators import checks, correlate, quality, volume
from tests.helpers import SOURCE, control, tuples, volumes

TODAY = "2026-10-05T12:00:00+00:00"  # a Monday
STAGES = SOURCE.expected_stages


def counts(spark, rows):
    return spark.createDataFrame([("raw/f.csv", rows)], "csv string, linhas long")


def verdict(spark, log, rows, contract=SOURCE):
    return volume.volume_verdict(counts(spark, rows), log, TODAY, contract).collect()[0]["problemas"]


# ---- volume ----


def test_drop_alerts(spark):
    log = volumes(spark, *((f"2026-10-0{d}", 100) for d in range(1, 5)), ("2026-09-30", 100))
    (text_,) = verdict(spark, log, 1)
    assert text_ == "volume muito abaixo do histórico (média dos últimos 7 dias corridos): 1 linhas (média: 100)"


def test_normal_volume_and_no_history_are_silent(spark):
    log = volumes(spark, *((f"2026-10-0{d}", 10) for d in range(1, 5)))
    assert verdict(spark, log, 9) == []
    assert verdict(spark, volumes(spark), 0) == []
    assert verdict(spark, log, 5) == []  # exactly at the limit


def test_only_volume_records_count(spark):
    day = {"dt": "2026-10-04"}
    log = control(
        spark,
        {**day, "origem": "trigger_bronze"}, {**day, "origem": "glue_job", "linhas": 900},
        {**day, "origem": "glue_data_quality"}, {**day, "origem": "quality_check", "linhas": 5},
        {**day, "origem": "quality_check"},
    )
    assert volume.baseline_flat(log, TODAY, 7).collect()[0][0] == 5
    assert verdict(spark, log, 0)[0].endswith("(média: 5)")


SAME = [("2026-09-28", 50), ("2026-09-21", 50), ("2026-09-14", 50), ("2026-09-07", 50)]
OTHER = [(f"2026-10-0{d}", 5) for d in range(1, 5)] + [("2026-09-29", 5), ("2026-09-30", 5)]


def test_same_weekday_is_preferred(spark):
    (text_,) = verdict(spark, volumes(spark, *SAME, *OTHER), 20)
    assert "últimas 4 ocorrências do mesmo dia da semana" in text_ and "(média: 50)" in text_


def test_seasonal_off_uses_the_flat_mean(spark):
    log = volumes(spark, *SAME, *OTHER)
    assert verdict(spark, log, 20, replace(SOURCE, seasonal=False)) == []
    assert volume.baseline_flat(log, TODAY, 7).collect()[0][0] == pytest.approx((50 + 6 * 5) / 7)


def test_seasonal_falls_back_without_a_single_record(spark):
    log = volumes(spark, *((d, 30) for d, _ in OTHER))
    assert "média dos últimos 7 dias corridos" in verdict(spark, log, 1)[0]


def test_seasonal_window(spark):
    log = volumes(spark, *SAME[:2], ("2026-09-14", 5000), ("2026-09-07", 5000))
    two = replace(SOURCE, seasonal_weeks=2)
    assert verdict(spark, log, 20, two)[0].endswith("(média: 50)")
    assert volume.baseline_seasonal(log, TODAY, 4).collect()[0][0] == 2525


def test_calendar_baseline_equals_the_one_day_baseline(spark):
    log = volumes(spark, *SAME, *OTHER, ("2026-10-04", 70), ("2026-10-05", 1))
    (day,) = volume.baseline_calendar(log, SOURCE).where("dt = '2026-10-05'").collect()
    (one,) = volume.choose_baseline(log, TODAY, SOURCE).collect()
    assert (day["media"], day["rotulo"]) == (one["media"], one["rotulo"])
    assert day["simples"] == volume.baseline_flat(log, TODAY, 7).collect()[0][0]


def test_robust_baselines(spark):
    log = control(
        spark,
        *({"origem": "quality_check", "dt": f"2026-10-0{d}", "linhas": n, "status": s}
          for d, n, s in ((1, 10, "ok"), (2, 10, "ok"), (3, 1, "problema"), (4, 40, "ok"))),
    )
    median = dict(tuples(volume.baseline_robust(log, 7)))
    assert median["2026-10-04"] == 10 and median["2026-10-01"] is None
    assert dict(tuples(volume.baseline_robust(log, 7, "ok")))["2026-10-04"] == 10
    with pytest.raises(ValueError):
        volume.baseline_robust(log, 7, "mode")


def test_volume_alert_rows(spark):
    judged = volume.volume_verdict(counts(spark, 1), volumes(spark, ("2026-10-04", 100)), TODAY, SOURCE)
    (alert,) = volume.volume_alerts(judged, SOURCE).collect()
    assert alert["subject"] == "[swaps-pipeline] qualidade de dados: raw/f.csv"
    assert alert["message"].startswith("Problemas encontrados em raw/f.csv:\n- volume muito abaixo")


# ---- quality ----


def test_contract_ruleset_texts():
    assert [r.text for r in quality.ruleset(SOURCE)] == [
        'ColumnExists "Dissemination Identifier"',
        'ColumnExists "Original Dissemination Identifier"',
        'ColumnExists "Action type"',
        'ColumnExists "Event timestamp"',
        'IsComplete "Dissemination Identifier"',
        "RowCount > 0",
        'ColumnValues "Action type" in ["NEWT", "MODI", "CORR", "TERM", "EROR", "REVI"]',
        'Uniqueness "Dissemination Identifier" > 0.99',
    ]


def test_rules_on_nulls_blanks_and_copies(spark):
    df = spark.createDataFrame([("1", "NEWT"), ("2", None), ("2", "XXXX"), ("", "NEWT"), (None, "NEWT")], "id string, act string")
    rules = [
        quality.IsComplete("id"), quality.IsComplete("id", blank_is_null=True),
        quality.InDomain("act", ("NEWT",)), quality.Uniqueness("id", 0.4), quality.Uniqueness("act", 0.5),
        quality.ColumnExists("gone"), quality.RowCount(5),
    ]
    got = {(r["regra"], round(r["metrica_valor"] or 0, 6)): r["outcome"] for r in quality.evaluate(df, rules).collect()}
    assert got == {
        ('IsComplete "id"', 0.8): "Failed", ('IsComplete "id"', 0.6): "Failed",
        ('ColumnValues "act" in ["NEWT"]', 0.6): "Failed",
        ('Uniqueness "id" > 0.4', 0.4): "Failed",  # strictly above the floor
        ('Uniqueness "act" > 0.5', 0.2): "Failed",
        ('ColumnExists "gone"', 0): "Failed", ("RowCount > 5", 5): "Failed",
    }


def test_rules_on_no_rows(spark):
    df = spark.createDataFrame([], "id string, act string")
    rules = [quality.ColumnExists("id"), quality.RowCount(0), quality.IsComplete("id"), quality.Uniqueness("id", 0.9)]
    assert [r["outcome"] for r in quality.evaluate(df, rules).collect()] == ["Passed", "Failed", "Failed", "Failed"]


def test_columns_are_judged_by_each_files_header(spark):
    df = spark.createDataFrame([("a", "1", ""), ("b", "", "2")], "arquivo_origem string, x string, y string")
    headers = spark.createDataFrame([("a", ["x"]), ("b", ["y"]), ("c", ["x"])], "arquivo_origem string, colunas array<string>")
    rules = [quality.ColumnExists("x"), quality.RowCount(0)]
    got = quality.evaluate(df, rules, by="arquivo_origem", layouts=headers)
    assert {(r[0], r[1]): r[2] for r in tuples(got)} == {
        ("a", 'ColumnExists "x"'): "Passed", ("b", 'ColumnExists "x"'): "Failed", ("c", 'ColumnExists "x"'): "Passed",
        ("a", "RowCount > 0"): "Passed", ("b", "RowCount > 0"): "Passed", ("c", "RowCount > 0"): "Failed",
    }
    assert dict(tuples(quality.any_failed(got, "arquivo_origem"))) == {"a": False, "b": True, "c": True}


# ---- freshness, lineage, stuck runs ----


@pytest.mark.parametrize(
    "day, before",
    [("2024-01-29", "2024-01-26"), ("2024-01-28", "2024-01-26"), ("2024-01-27", "2024-01-26"), ("2024-01-31", "2024-01-30")],
)
def test_previous_business_day(spark, day, before):
    found = spark.range(1).select(dates.previous_business_day(F.lit(day).cast("date")).cast("string"))
    assert found.collect()[0][0] == before


def started(at, execution="e1", stages=(SOURCE.start_stage,)):
    return [{"timestamp": at, "origem": s, "execution_id": execution, "dt": at[:10]} for s in stages]


def test_freshness(spark):
    (row,) = checks.freshness(control(spark), TODAY, SOURCE).collect()
    assert row["problema"] == "nenhuma execução em 2026-10-02 (dia útil) -- ingestão não rodou"
    log = control(spark, *started("2026-10-02T23:00:00+00:00"))
    assert checks.freshness(log, TODAY, SOURCE).count() == 0
    sunday = control(spark, *started("2026-10-04T23:00:00+00:00"))
    assert checks.freshness(sunday, TODAY, SOURCE).count() == 1


def test_lineage(spark):
    five = "2026-10-05T07:00:00+00:00"
    log = control(
        spark,
        *started(five, "whole", STAGES),
        *started(five, "half", STAGES[:2]),
        *started("2026-10-05T11:50:00+00:00", "young"),
        *started("2026-10-05T10:00:00+00:00", "edge"),
        *started(five, "unstarted", STAGES[1:2]),
        *started(five, None), *started(five, ""),
    )
    got = {r["execution_id"]: r["problema"] for r in checks.lineage_gaps(log, TODAY, SOURCE).collect()}
    assert got == {
        "half": "execução half (iniciada há 5.0h) sem etapa(s): glue_job, quality_check",
        "edge": "execução edge (iniciada há 2.0h) sem etapa(s): glue_data_quality, glue_job, quality_check",
    }
    missing = dict(tuples(checks.missing_stages(log, STAGES)))
    assert missing["whole"] == [] and missing["unstarted"] == [STAGES[0], *STAGES[2:]]


def test_lineage_window(spark):
    log = control(spark, *started("2026-09-20T07:00:00+00:00"))
    assert checks.lineage_gaps(log, TODAY, SOURCE).count() == 0
    assert checks.lineage_gaps(log, TODAY, SOURCE, whole_log=True).count() == 1


def runs(spark, *rows):
    made = spark.createDataFrame([(n, t, s) for n, t, s in rows], "name string, t string, status string")
    return made.select("name", F.to_timestamp("t").alias("start_date"), "status")


def test_stuck_runs(spark):
    found = checks.stuck_runs(
        runs(spark, ("old", "2026-10-05T07:00:00Z", "RUNNING"), ("new", "2026-10-05T11:50:00Z", "RUNNING"),
             ("done", "2026-10-05T01:00:00Z", "SUCCEEDED")),
        TODAY, SOURCE,
    )
    (row,) = found.collect()
    assert row["problema"] == (
        "execução old do Step Functions está RUNNING há 5.0h (> 2h) -- possível travamento"
    )
    assert checks.stuck_runs(spark.createDataFrame([], RUNS), TODAY, SOURCE).count() == 0


def test_check_verdict_with_and_without_problems(spark):
    log = control(spark, *started("2026-10-05T07:00:00+00:00", "e1", STAGES[:1]))
    found = checks.check_problems(log, None, TODAY, SOURCE)
    (record,) = checks.check_verdict(found, TODAY).collect()
    assert record["status"] == "problema" and record["timestamp"] == "2026-10-05T12:00:00+00:00"
    assert [r["problema"] for r in found.orderBy("checagem").collect()] == [
        "nenhuma execução em 2026-10-02 (dia útil) -- ingestão não rodou",
        "execução e1 (iniciada há 5.0h) sem etapa(s): glue_data_quality, glue_job, quality_check",
    ]
    (alert,) = checks.check_alerts(checks.check_verdict(found, TODAY), SOURCE).collect()
    assert alert["subject"] == "[swaps-pipeline] atualidade/linhagem: problema encontrado"
    assert alert["message"].startswith("Problemas encontrados:\n- atualidade: 1 problema(s)")

    good = control(spark, *started("2026-10-02T07:00:00+00:00", "e1", STAGES))
    verdict_ = checks.check_verdict(checks.check_problems(good, None, TODAY, SOURCE), TODAY)
    (record,) = verdict_.collect()
    assert (record["status"], record["problemas"]) == ("ok", [])
    assert checks.check_alerts(verdict_, SOURCE).count() == 0


def test_one_record_however_many_problems(spark):
    log = control(spark, *(r for i in range(1500) for r in started("2026-10-05T07:00:00+00:00", f"e{i}")))
    found = checks.check_problems(log, None, TODAY, SOURCE)
    assert found.count() == 1501
    (record,) = checks.check_verdict(found, TODAY).collect()
    assert record["status"] == "problema" and [p.split(" ")[:2] for p in record["problemas"]] == [
        ["atualidade:", "1"], ["linhagem:", "1500"],
    ]
    assert checks.check_alerts(checks.check_verdict(found, TODAY), SOURCE).count() == 1


# ---- correlation ----


def test_arrival_keys(spark):
    def key(path):
        return spark.range(1).select(text.arrival_key(F.lit(path))).collect()[0][0]

    assert key("raw/zip/CFTC_CUMULATIVE_RATES_2026_10_02.zip") == "CFTC_CUMULATIVE_RATES_2026_10_02-zip"
    assert key("a/" + "x" * 100 + ".zip") == "x" * 80


def test_duplicate_arrivals(spark):
    rows = [("in/a.zip", "2026-10-02T06:00:00Z", 1, 1), ("in/a.zip", "2026-10-02T06:00:01Z", 2, 2),
            ("in/b.zip", "2026-10-02T06:00:00Z", 1, 3), ("in/b.zip", "2026-10-02T06:00:00Z", 1, 4)]
    came = spark.createDataFrame(rows, "path string, t string, length long, id long").select(
        "path", F.to_timestamp("t").alias("arrived_at"), "length", F.to_timestamp("t").alias("modified"), "id"
    )

    def flags(**options):
        found = correlate.suppress_duplicates(came, tie=("id",), **options)
        return [r["duplicado"] for r in found.orderBy("id").collect()]

    assert flags() == flags(hot_rows=1) == [False, True, False, True]
    assert flags(by_content=True) == [False, False, False, True]
    began = spark.createDataFrame([("old/a.zip",), ("older/a.zip",)], "path string")
    assert flags(started=began) == [True, True, False, True]


def test_outcomes(spark):
    events = spark.createDataFrame(
        [("j", "1", "SUCCEEDED"), ("j", "2", "FAILED"), ("j", "3", "STOPPED"), ("j", "4", "RUNNING")],
        "job_name string, job_run_id string, state string",
    )
    details = spark.createDataFrame([("j", "1", {"--execution_id": "e1"}, 42), ("j", "2", {}, 3)], JOB_RUNS)
    got = {r["job_run_id"]: r for r in correlate.enrich_outcome(events, details).collect()}
    assert (got["1"]["execution_id"], got["1"]["duracao_segundos"]) == ("e1", 42)
    assert got["2"]["execution_id"] is None and got["3"]["duracao_segundos"] is None
    assert [r["message"] for r in checks.failure_alerts(events, SOURCE).collect()] == ["Job j run 2 terminou em FAILED"]
    terminal = events.where(status.is_terminal(F.col("state"))).select(status.status_from_state(F.col("state")))
    assert sorted(r[0] for r in terminal.collect()) == ["failed", "stopped", "succeeded"]


def test_correlation_inherits_the_last_id_or_draws_one(spark):
    log = control(
        spark,
        {"origem": SOURCE.start_stage, "csv": "a", "execution_id": "old", "timestamp": "2026-10-01"},
        {"origem": SOURCE.start_stage, "csv": "a", "execution_id": "new", "timestamp": "2026-10-02"},
        {"origem": "quality_check", "csv": "b", "execution_id": "not-this"},
    )
    files = spark.createDataFrame([("a",), ("b",)], "csv string")
    found = correlate.correlate(files, log, SOURCE.start_stage)
    assert sorted(tuples(found)) == [("a", "new"), ("b", None)]
    drawn = dict(tuples(correlate.with_execution_id(found)))
    assert drawn["a"] == "new" and len(drawn["b"]) == 36


def test_half_even_numbers_in_messages(spark):
    row = spark.range(1).select(*(text.fixed_point(F.lit(v), d) for v, d in ((2.5, 0), (3.5, 0), (0.25, 1), (18.06, 1)))).collect()[0]
    assert tuple(row) == ("2", "4", "0.2", "18.1")
    row = spark.range(1).select(*(text.fixed_point(F.lit(v), 1) for v in (2.45, 0.35, 1.05, 24.95))).collect()[0]
    assert tuple(row) == ("2.5", "0.3", "1.1", "24.9")


def test_files_that_share_a_run_name_are_not_duplicates(spark):
    paths = ["in/A B.zip", "in/A-B.zip", f"in/{'x' * 90}1.zip", f"in/{'x' * 90}2.zip"]
    came = spark.createDataFrame([(p, "2026-10-02T06:00:00Z") for p in paths], "path string, t string")
    found = correlate.suppress_duplicates(came.withColumn("arrived_at", F.to_timestamp("t")))
    assert [r["duplicado"] for r in found.collect()] == [False] * 4
    assert found.select("chave").distinct().count() == 2


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        moments = (dates.instant("2026-10-05T12:00:00"), dates.instant("2026-10-05T01:00:00.5Z"))
        row = spark.range(1).select(*map(dates.iso_text, moments), dates.partition_day(moments[1])).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("2026-10-05T12:00:00+00:00", "2026-10-05T01:00:00.500000+00:00", "2026-10-05")


@pytest.mark.parametrize("hot_rows", [1, 3, 1000])
def test_hot_files_are_correlated_like_others(spark, hot_rows):
    log = control(
        spark,
        *({"origem": SOURCE.start_stage, "csv": c, "execution_id": f"e-{c}", "timestamp": "1"} for c in "abc"),
    )
    files = spark.createDataFrame([(c, i) for i in range(5) for c in "aad"] + [("b", 9)], "csv string, i long")
    found = correlate.correlate(files, log, SOURCE.start_stage, hot_rows)
    assert found.count() == 16
    assert {(r["csv"], r["execution_id"]) for r in found.collect()} == {("a", "e-a"), ("b", "e-b"), ("d", None)}


def test_a_real_verdict(spark):
    """The messages of a check on a Monday after a missed Friday, with four executions behind."""
    as_of = "2026-10-05T12:00:00+00:00"
    lacking = {"e1": ("04T17:54", STAGES[2:]), "e2": ("04T17:00", STAGES[2:3]), "e3": ("04T17:12", STAGES[2:]),
               "e4": ("04T17:24", STAGES[2:])}
    rows = [r for e, (t, there) in lacking.items()
            for r in started(f"2026-10-{t}:00+00:00", e, (STAGES[0], *there))]
    found = checks.check_problems(control(spark, *rows), None, as_of, SOURCE)
    assert [r["problema"] for r in found.orderBy("checagem", "chave").collect()] == [
        "nenhuma execução em 2026-10-02 (dia útil) -- ingestão não rodou",
        "execução e1 (iniciada há 18.1h) sem etapa(s): glue_data_quality",
        "execução e2 (iniciada há 19.0h) sem etapa(s): glue_data_quality, quality_check",
        "execução e3 (iniciada há 18.8h) sem etapa(s): glue_data_quality",
        "execução e4 (iniciada há 18.6h) sem etapa(s): glue_data_quality",
    ]
