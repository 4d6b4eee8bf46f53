"""Status derivations and predicates over pipeline records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainlake.contract import FAILURE_STATES, TERMINAL_STATES
from chainlake.functions.text import blank

# The two verdicts a check can leave.
OK = "ok"
PROBLEM = "problema"


def status_from_outcome(outcome: Column) -> Column:
    return F.when(outcome == "Passed", OK).otherwise(PROBLEM)


def status_from_problems(problems: Column) -> Column:
    return F.when(F.size(problems) > 0, PROBLEM).otherwise(OK)


def status_from_state(state: Column) -> Column:
    return F.lower(state)


def is_failure(state: Column) -> Column:
    """A run that ended badly. A stopped run is not a failure."""
    return state.isin(*FAILURE_STATES)


def is_terminal(state: Column) -> Column:
    return state.isin(*TERMINAL_STATES)


def is_volume_drop(rows: Column, baseline: Column, tolerance: float) -> Column:
    """Strictly below the tolerated share of the baseline; never true without a baseline."""
    return F.coalesce(rows < baseline * (1 - tolerance), F.lit(False))


def identified(execution_id: Column, blank_ok: bool) -> Column:
    """Records tied to an execution. Reports accept an empty id, the lineage check does not."""
    return execution_id.isNotNull() if blank_ok else ~blank(execution_id)


def execution_or_new(execution_id: Column) -> Column:
    """Keep the id, else draw one. Not repeatable: write the result before using it twice."""
    return F.coalesce(F.when(~blank(execution_id), execution_id), F.uuid())
