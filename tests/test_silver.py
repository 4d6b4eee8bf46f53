"""Chains, current state, history, gold metrics."""

import random

import pytest
from pyspark.sql import functions as F

from chainlake.functions.chain import amount, chain_key
from chainlake.operators import gold, numbering, silver
from tests.helpers import SOURCE, tuples

FIELDS = (
    "diss_id string, orig_id string, action string, t string, product string, notional string, "
    "arquivo_origem string, line_number long"
)

# A chain of the real feed: the last event by time has the smallest id of the three changes.
REAL = [
    ("5598983937000000601", "", "NEWT", "2026-10-02T19:00:00", "IRS", "100", "d1.csv", 0),
    ("5598983979000000301", "5598983937000000601", "MODI", "2026-10-02T19:00:04", "IRS", "200", "d1.csv", 1),
    ("5598984059000000201", "5598983937000000601", "MODI", "2026-10-02T19:00:07", "IRS", "300", "d1.csv", 2),
    ("5598983938000000701", "5598983937000000601", "MODI", "2026-10-02T19:00:24", "IRS", "", "d1.csv", 3),
]
MORE = [
    ("10", "", "NEWT", "2026-10-02T10:00:00", "A", "1", "d1.csv", 10),
    ("11", "10", "TERM", "2026-10-02T11:00:00", "A", "2", "d1.csv", 11),
    ("12", "10", "MODI", "2026-10-02T12:00:00", "A", "3", "d1.csv", 12),
    ("20", "", "NEWT", "2026-10-02T10:00:00", "B", "1", "d1.csv", 20),
    ("21", "20", "EROR", "2026-10-02T11:00:00", "B", "1", "d1.csv", 21),
    ("31", "30", "MODI", "2026-10-02T11:00:00", "C", "1", "d1.csv", 30),
    ("40", "", "NEWT", "2026-10-02T10:00:00", "D", "1", "d1.csv", 40),
    ("41", "40", "MODI", "2026-10-02T11:00:00", "D", "2", "d1.csv", 41),
    ("42", "40", "MODI", "2026-10-02T11:00:00", "D", "3", "d1.csv", 42),
    ("50", "", "NEWT", "2026-10-02T10:00:00", "E", "1", "d1.csv", 50),
    ("50", "", "NEWT", "2026-10-02T10:00:00", "E", "1", "d2.csv", 0),
    ("60", "", "NEWT", "2026-10-02T10:00:00", "F", "1", "d1.csv", 60),
    ("61", "60", "MODI", "not a time", "F", "2", "d1.csv", 61),
]


def log_of(spark, rows):
    df = spark.createDataFrame(rows, FIELDS)
    return df.select(
        "diss_id", "orig_id", "action", F.try_to_timestamp("t").alias("event_ts"), "product", "notional",
        "arquivo_origem", "line_number", chain_key(F.col("diss_id"), F.col("orig_id")).alias("chain"),
    )


def state_of(spark, rows, **options):
    found = silver.current_state(log_of(spark, rows), **options)
    return {r["chain"]: r for r in found.collect()}


def test_latest_by_time_not_by_id(spark):
    state = state_of(spark, REAL)["5598983937000000601"]
    assert (state["diss_id"], state["notional"]) == ("5598983938000000701", "")
    kept = state_of(spark, REAL, blank_values="keep")["5598983937000000601"]
    assert (kept["diss_id"], kept["notional"], kept["action"]) == ("5598983938000000701", "300", "MODI")


def test_state_options(spark):
    state = state_of(spark, MORE)
    assert (state["10"]["encerrada"], state["10"]["notional"]) == (True, "3")
    assert state["20"]["action"] == "EROR"
    assert (state["30"]["tem_origem"], state["10"]["tem_origem"]) == (False, True)
    assert state["40"]["diss_id"] == "42"
    assert state["50"]["arquivo_origem"] == "d2.csv"
    assert state["60"]["diss_id"] == "60"
    assert state_of(spark, MORE, dedupe=True)["50"]["arquivo_origem"] == "d1.csv"
    assert not state_of(spark, MORE, reopen_on=("MODI",))["10"]["encerrada"]
    assert state_of(spark, MORE, reopen_on=("CORR",))["10"]["encerrada"]
    assert "20" not in state_of(spark, MORE, drop_annulled=True)
    with pytest.raises(ValueError):
        state_of(spark, MORE, blank_values="drop")


def test_state_does_not_depend_on_input_order(spark):
    rows = REAL + MORE
    expected = state_of(spark, rows)
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        assert state_of(spark, shuffled) == expected


def test_fold_of_parts_is_fold_of_whole_and_repeatable(spark):
    states = silver.as_states(log_of(spark, REAL + MORE))
    whole = sorted(tuples(silver.fold_states(states)), key=str)
    even, odd = states.where("line_number % 2 = 0"), states.where("line_number % 2 = 1")
    parts = silver.fold_states(even).unionByName(silver.fold_states(odd)).unionByName(silver.fold_states(odd))
    assert sorted(tuples(silver.fold_states(parts)), key=str) == whole


def test_history(spark):
    found = silver.history(log_of(spark, REAL)).orderBy("event_seq").collect()
    assert [r["event_seq"] for r in found] == [1, 2, 3, 4]
    assert [r["valid_to"] for r in found[:3]] == [r["valid_from"] for r in found[1:]]
    assert [r["is_current"] for r in found] == [False, False, False, True]
    assert found[3]["valid_to"] is None


@pytest.mark.parametrize("hot_rows, slice_rows", [(1, 1), (3, 2), (50, 7)])
def test_history_of_hot_chains_equals_the_plain_one(spark, hot_rows, slice_rows):
    rng = random.Random(7)
    rows = REAL + MORE
    for i in range(300):  # one chain with most rows, crowded times and unreadable ones
        t = f"2026-10-02T19:{rng.choice([0, 0, 0, 5, 59]):02d}:{rng.randrange(60):02d}" if i % 9 else "n/a"
        rows.append((f"h{i}", "hot", "MODI", t, "X", str(i), f"d{rng.randrange(3)}.csv", 1000 + i))
    log = log_of(spark, rows)
    plain = sorted(tuples(silver.history(log)), key=str)
    assert sorted(tuples(silver.history(log, hot_rows, slice_rows)), key=str) == plain
    assert len(plain) == len(rows)


def test_members_and_orphans(spark):
    log = log_of(spark, REAL + MORE)
    assert sorted(r["diss_id"] for r in silver.orphans(log).collect()) == ["31"]
    members = {r["diss_id"] for r in silver.chain_members(log).collect()}
    assert "31" not in members and {"11", "12", "5598983938000000701"} <= members


def test_typed_log_and_unreadable_times(spark):
    c = SOURCE.columns
    bronze = spark.createDataFrame(
        [("1", "", "NEWT", "2026-10-02T19:00:00", "f.csv", 0), ("2", "1", "MODI", "soon", "f.csv", 1)],
        "a string, b string, c string, d string, arquivo_origem string, line_number long",
    ).toDF(c.diss_id, c.orig_id, c.action, c.event_ts, "arquivo_origem", "line_number")
    log = silver.typed_log(bronze, SOURCE)
    assert [r["chain"] for r in log.orderBy("line_number").collect()] == ["1", "1"]
    assert tuples(silver.unreadable_times(bronze, SOURCE)) == [("f.csv", 2, 1)]


def test_amounts(spark):
    texts = ["1,000,000", "250,000,000+", "", "12.5", "n/a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(amount(F.col("t")).cast("double"))
    assert [r[0] for r in df.collect()] == [1e6, 2.5e8, None, 12.5, None]


def test_gold(spark):
    state = spark.createDataFrame(
        [("A", "USD", False, "2024-01-01", "2024-01-11", 10), ("A", "USD", True, "2024-01-01", "2024-02-10", 30),
         ("B", "EUR", False, "2024-01-01", "2023-12-31", 60)],
        "product string, currency string, encerrada boolean, start string, end string, n long",
    ).withColumn("notional", F.col("n").cast("decimal(38,6)"))
    volumes = {r["product"]: r for r in gold.volume_by_product(state).collect()}
    assert (volumes["A"]["operacoes"], volumes["A"]["abertas"], float(volumes["A"]["volume"])) == (2, 1, 40.0)
    dated = state.select(F.to_date("start").alias("s"), F.to_date("end").alias("e"))
    tenors = sorted(tuples(gold.tenor_buckets(dated, "s", "e", (0, 30))))
    assert tenors == [(0, 1, -1, -1, -1.0), (1, 1, 10, 10, 10.0), (2, 1, 40, 40, 40.0)]
    shares = {r["product"]: r for r in gold.concentration(state, "product", "notional").collect()}
    assert shares["B"]["participacao"] == pytest.approx(0.6)
    assert shares["A"]["hhi"] == pytest.approx(0.52)


def test_columns_beyond_the_declared_ones_are_carried_along(spark):
    c = SOURCE.columns
    bronze = spark.createDataFrame(
        [("1", "", "NEWT", "2026-10-02T19:00:00", "old", "f.csv", 0), ("2", "1", "MODI", "2026-10-02T19:00:01", "", "f.csv", 1)],
        "a string, b string, c string, d string, e string, arquivo_origem string, line_number long",
    ).toDF(c.diss_id, c.orig_id, c.action, c.event_ts, "Fixed rate-Leg 1.x", "arquivo_origem", "line_number")
    log = silver.typed_log(bronze, SOURCE, more=("Fixed rate-Leg 1.x",))
    assert silver.current_state(log).collect()[0]["Fixed rate-Leg 1.x"] == ""
    assert silver.current_state(log, blank_values="keep").collect()[0]["Fixed rate-Leg 1.x"] == "old"
    assert silver.history(log).count() == 2


def test_events_without_an_id_of_their_own_are_not_copies(spark):
    log = spark.createDataFrame(
        [("", "a", 1), ("", "b", 2), (None, "c", 3), ("x", "a", 4), ("x", "b", 5)], "diss_id string, arquivo_origem string, line_number long"
    )
    kept = sorted(r["line_number"] for r in silver.distinct_events(log).collect())
    assert kept == [1, 2, 3, 4]


def test_slices_of_a_burst_hold_no_more_than_they_should(spark):
    """All events of a chain in one instant or without a readable time: neither makes a slice larger."""
    rows = [(str(i), "0", "MODI", "no time" if i < 40 else "2026-10-02T10:00:00", "P", "1", f"d{i % 3}.csv", i) for i in range(100)]
    rows += [("900", "", "NEWT", "2026-10-02T09:00:00", "Q", "1", "d1.csv", 900)]
    log = log_of(spark, rows)
    plain = sorted(tuples(silver.history(log)), key=str)
    found = silver.history(log, hot_rows=20, slice_rows=7)
    assert sorted(tuples(found), key=str) == plain
    numbered = numbering.numbered(log, ["chain", *silver.PLACE], "place")
    assert [r["place"] for r in numbered.orderBy("place").collect()] == list(range(101))


def test_numbering_follows_the_order_whatever_the_partitions(spark):
    rows = [(i * 7919 % 1000, i % 2) for i in range(1000)] + [(5, 0)] * 50
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "a long, b long").repartition(parts)
        found = numbering.numbered(df, [F.desc("b"), "a"], "place").orderBy("place").collect()
        assert [r["place"] for r in found] == list(range(1050))
        assert [(-r["b"], r["a"]) for r in found] == sorted((-b, a) for a, b in rows)
    assert numbering.numbered(df.where("false"), ["a"], "place").count() == 0
