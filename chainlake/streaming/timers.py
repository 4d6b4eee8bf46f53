"""Stuck runs told by a timer: no later event is needed, of the run or of any other."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from chainlake.contract import Contract
from chainlake.functions.status import is_terminal

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class StuckRuns(StatefulProcessor):
    """Per name: when its open run started, whether that was told, and the latest end. Times are microseconds.

    Events of a name are taken in time order, a start before an end of the same instant. A start or an end within the margin
    keeps the run before it from being told; one after it tells it. What is open after that waits for its timer.
    """

    def __init__(self, margin: timedelta, grace: timedelta, forget: timedelta):
        self.margin = margin // timedelta(microseconds=1)
        self.grace = grace // timedelta(milliseconds=1)
        self.forget = forget // timedelta(milliseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "started long, told boolean, ended long", self.forget)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        started, told, ended = self.run.get() if self.run.exists() else (None, False, None)
        # One name's events of one micro-batch.
        events = sorted((int(t), bool(end)) for frame in rows for t, end in zip(frame["micros"], frame["is_end"]) if pd.notna(t))
        stuck = []
        for at, is_end in events:
            if started is not None and at >= started:
                if at - started >= self.margin and not told:
                    stuck.append(started)
                started, told = None, False
            if is_end:
                ended = at if ended is None else max(ended, at)
            elif started is None:
                started, told = at, False
                # An end that came in an earlier batch than its start.
                if ended is not None and ended >= at:
                    if ended - at >= self.margin:
                        stuck.append(at)
                    started = None
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        if started is not None and not told:
            due = -(-(started + self.margin) // 1000)
            self.handle.registerTimer(max(due, timerValues.getCurrentProcessingTimeInMs() + self.grace))
        self.run.update((started, told, ended))
        yield self._told(key, stuck)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.run.exists():
            started, told, ended = self.run.get()
            if started is not None and not told:
                self.run.update((started, True, ended))
                yield self._told(key, [started])

    def _told(self, key, starts: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"name": pd.Series([key[0]] * len(starts), dtype=object), "started": pd.Series(starts, dtype="int64")})

    def close(self) -> None:
        pass


def stuck_alert_stream(events: DataFrame, contract: Contract, grace: timedelta = timedelta(0), forget: timedelta = timedelta(days=30)) -> DataFrame:
    """(name, start_date, alert_at) of every run, by its start, without another start or an end of its name within the margin.

    `events` is a stream of (name, event_time, state), a RUNNING event per start. A run is told once: as soon as the clock passes its margin,
    or with the event that comes too late. Names may run again and again. Ends may come in an earlier micro-batch than their starts; a start
    older than its name's open one is passed over. A null time is no event, a null name is one name.

    A backlog's margins are past when it is read: read it in one micro-batch, or give a `grace` in which its later batches come. State of a name
    without events is forgotten after `forget`, which must exceed margin and grace. Needs the RocksDB state store (`STATE_STORE`), set here.
    """
    margin = timedelta(hours=contract.lineage_margin_hours)
    if forget <= margin + grace:
        raise ValueError("runs must be remembered for longer than the margin and the grace")
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    marked = events.where(is_terminal(F.col("state")) | (F.col("state") == "RUNNING")).select(
        "name", F.unix_micros("event_time").alias("micros"), (F.col("state") != "RUNNING").alias("is_end")
    )
    told = marked.groupBy("name").transformWithStateInPandas(
        StuckRuns(margin, grace, forget), "name string, started long", "Append", "ProcessingTime"
    )
    start = F.timestamp_micros("started")
    return told.select("name", start.alias("start_date"), (start + F.expr(f"INTERVAL {contract.lineage_margin_hours} HOURS")).alias("alert_at"))
