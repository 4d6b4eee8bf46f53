"""What the plans must look like, and what operator code must not do."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from chainlake.operators import checks, quality, silver, volume
from chainlake.plans import reports
from chainlake.plans import standins as s
from chainlake.plans.registry import ORACLES, QUERIES
from chainlake.plans.standins import SOURCE
from chainlake.sources.control import append_control, past_days, read_control
from tests.helpers import fresh

PACKAGE = Path(__file__).resolve().parents[1] / "chainlake"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?!SinglePartition)(hash|range)partitioning", plan(df)))


def test_operators_do_not_collect():
    allowed = {"csv_events.py": 1}  # the distinct header names
    # The optional subpackage states its bounds itself.
    for path in (p for p in PACKAGE.rglob("*.py") if "llm" not in p.parts):
        code = path.read_text()
        calls = len(re.findall(r"\.(collect|toPandas|toLocalIterator|take|head)\(", code))
        assert calls <= allowed.get(path.name, 0), path
        assert not re.search(r"crossJoin|localCheckpoint|\.rdd\b|\.foreach\(", code), path


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) > 60


def test_control_days_are_pruned(spark, sf_small, tmp_path):
    path = fresh(tmp_path, "log")
    append_control(s.control_log(spark, sf_small).drop("dt"), path, F.to_timestamp("timestamp"))
    log = read_control(spark, path)
    assert "PartitionFilters: [dt" in plan(past_days(log, "2024-01-20T00:00:00+00:00", 14, same_weekday=True))
    gaps = checks.lineage_gaps(log, "2024-01-20T00:00:00+00:00", SOURCE)
    assert "PartitionFilters: [isnotnull(dt" in plan(gaps)
    assert "ReadSchema: struct<timestamp:string,origem:string,execution_id:string>" in plan(gaps)


def test_rules_need_one_scan_and_one_wide_shuffle(spark, sf_small):
    rules = [quality.IsComplete("o_orderkey"), quality.RowCount(0), quality.InDomain("o_orderstatus", ("F",)),
             quality.Uniqueness("o_orderkey", 0.99)]
    text = plan(quality.evaluate(s.table(spark, sf_small, "orders"), rules))
    assert text.count("FileScan") == 1 and text.count("hashpartitioning") == 1
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_fold_combines_before_its_one_shuffle(spark, sf_small):
    log = silver.typed_log(s.bronze_log(spark, sf_small), SOURCE)
    df = silver.current_state(log, dedupe=False)
    assert exchanges(df) == 1 and "partial_max_by" in plan(df)
    assert plan(silver.current_state(log, dedupe=True)).count("WindowGroupLimit") == 2


def test_lineage_aggregates_by_hash(spark, sf_small):
    text = plan(checks.missing_stages(s.control_log(spark, sf_small), SOURCE.expected_stages))
    assert "HashAggregate" in text and "SortAggregate" not in text and "collect_set" not in text


def test_windows_run_on_daily_rows(spark, sf_small):
    text = plan(volume.baseline_calendar(s.order_volumes(spark, sf_small), SOURCE))
    below = text[text.rindex("Window"):]
    assert "HashAggregate(keys=[dt" in below


def test_reports_shuffle_once_to_group_and_once_to_sort(spark, sf_small):
    assert exchanges(reports.rule_ranking(s.control_log(spark, sf_small))) == 2
    assert exchanges(reports.rows_per_file(s.bronze_log(spark, sf_small))) == 1
