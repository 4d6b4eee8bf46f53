"""Folding event chains into a current state, and keeping their full history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chainlake.contract import Contract
from chainlake.functions.chain import chain_key, event_order, event_time
from chainlake.functions.text import blank, blank_filled, named
from chainlake.operators.keyed import HOT_ROWS
from chainlake.operators.numbering import numbered
from chainlake.sources.bronze import project

PLACE = ("event_ts", "arquivo_origem", "line_number")


def typed_log(bronze: DataFrame, contract: Contract, more: tuple[str, ...] = ()) -> DataFrame:
    """Declared Bronze columns under short names, plus the chain key and a parsed `event_ts`.

    `more` names further Bronze columns to carry along under their own names.
    """
    present = {new: old for new, old in contract.columns.raw_names().items() if old in bronze.columns}
    kept = {**present, **{c: c for c in (*more, "arquivo_origem", "line_number")}}
    return project(bronze, kept).withColumns(
        {"event_ts": event_time(F.col("event_ts")), "chain": chain_key(F.col("diss_id"), F.col("orig_id"))}
    )


def unreadable_times(bronze: DataFrame, contract: Contract) -> DataFrame:
    """(arquivo_origem, eventos, sem_hora): events per file, and how many have no readable event time."""
    return typed_log(bronze, contract).groupBy("arquivo_origem").agg(
        F.count("*").alias("eventos"), F.count_if(F.col("event_ts").isNull()).alias("sem_hora")
    )


def distinct_events(log: DataFrame) -> DataFrame:
    """One copy of each event, the first by file and line. Cumulative files may repeat events.

    `row_number() = 1` becomes a group limit below the shuffle, so of a much-copied event each task sends
    one row.
    """
    copies = W.partitionBy("diss_id").orderBy("arquivo_origem", "line_number")
    named_rows = log.where(~blank(F.col("diss_id")))
    first = named_rows.withColumn("copy", F.row_number().over(copies)).where("copy = 1").drop("copy")
    return first.unionByName(log.where(blank(F.col("diss_id"))))


def as_states(log: DataFrame) -> DataFrame:
    """Each event as the state of a chain of one event."""
    return log.withColumns(
        {"encerrada": F.col("action") == "TERM", "tem_origem": F.col("action") == "NEWT"}
    )


def fold_states(states: DataFrame) -> DataFrame:
    """One state per chain: the latest row's fields, closed if any part was, rooted if any part was.

    The fold is idempotent and takes its input in any order and grouping, so states of parts of a chain
    fold to the state of the whole, and a replayed part changes nothing.
    """
    fields = [c for c in states.columns if c not in ("chain", "encerrada", "tem_origem")]
    latest = F.max_by(F.struct(*map(named, fields)), event_order()).alias("latest")
    folded = states.groupBy("chain").agg(
        latest, F.bool_or("encerrada").alias("encerrada"), F.bool_or("tem_origem").alias("tem_origem")
    )
    return folded.select("chain", "latest.*", "encerrada", "tem_origem")


def current_state(
    log: DataFrame,
    blank_values: str = "row",
    reopen_on: tuple[str, ...] = (),
    drop_annulled: bool = False,
    dedupe: bool = False,
) -> DataFrame:
    """One row per chain.

    blank_values='row': the latest event's row wins whole. 'keep': a blank in a later event leaves the last
    non-blank value standing, column by column.
    reopen_on: actions that, after the last TERM, open a closed chain again; by default it stays closed.
    drop_annulled: leave out chains whose last event is an annulment.
    dedupe: count a repeated event once, by its first copy. By default every copy counts and the last one stands, as
    the fold of a stream does: no shuffle beyond the fold's own, and no difference between the two.
    """
    if blank_values not in ("row", "keep"):
        raise ValueError(f"blank_values must be 'row' or 'keep', not {blank_values!r}")
    events = distinct_events(log) if dedupe else log
    plain = blank_values == "row" and not reopen_on
    state = fold_states(as_states(events)) if plain else _folded(events, blank_values, reopen_on)
    return state.where(F.col("action") != "EROR") if drop_annulled else state


def _folded(events: DataFrame, blank_values: str, reopen_on: tuple[str, ...]) -> DataFrame:
    return finished_states(partial_states(events, blank_values, reopen_on), events.columns)


def partial_states(events: DataFrame, blank_values: str = "row", reopen_on: tuple[str, ...] = ()) -> DataFrame:
    """What of each chain's events the options of `current_state` need, in a form that folds like `fold_states`: (chain, latest, last_<column> of
    columns that keep their last non-blank value, closed, opened, tem_origem), each with the place it was found at."""
    order = event_order()
    strings = {f.name for f in events.schema.fields if f.dataType.simpleString() == "string"}
    fixed = {"chain", "diss_id", "orig_id", "action", "arquivo_origem"}
    sticky = [c for c in events.columns if c in strings - fixed] if blank_values == "keep" else []
    whole = [c for c in events.columns if c != "chain" and c not in sticky]

    kept = [F.max(F.when(~blank(named(c)), F.struct(order.alias("at"), named(c).alias("value")))).alias(f"last_{c}") for c in sticky]
    return events.groupBy("chain").agg(
        F.max(F.struct(order.alias("at"), F.struct(*map(named, whole)).alias("row"))).alias("latest"), *kept,
        F.max(F.when(F.col("action") == "TERM", order)).alias("closed"),
        F.max(F.when(F.col("action").isin(*reopen_on), order)).alias("opened"),
        F.bool_or(F.col("action") == "NEWT").alias("tem_origem"),
    )


def fold_partials(partials: DataFrame) -> DataFrame:
    """One partial state per chain. Takes parts in any order and grouping, repeated ones included."""
    latest = [F.max(named(c)).alias(c) for c in partials.columns if c not in ("chain", "tem_origem")]
    return partials.groupBy("chain").agg(*latest, F.bool_or("tem_origem").alias("tem_origem"))


def finished_states(partials: DataFrame, columns: list[str]) -> DataFrame:
    """The current state, with `columns` of the events, of folded partial states."""
    ended = F.col("closed").isNotNull() & F.coalesce(F.col("opened") < F.col("closed"), F.lit(True))

    def column(c: str) -> Column:
        if f"last_{c}" in partials.columns:
            return blank_filled(named(f"last_{c}")["value"])
        return F.col("chain") if c == "chain" else F.col("latest")["row"][c]

    return partials.select(*(column(c).alias(c) for c in columns), ended.alias("encerrada"), "tem_origem")


def history(log: DataFrame, hot_rows: int = HOT_ROWS, slice_rows: int = HOT_ROWS // 2) -> DataFrame:
    """Every event with `event_seq`, `valid_from`, `valid_to` and `is_current` within its chain.

    A chain is one window partition, unless it is hot: a chain with more than `hot_rows` events is put in order by
    a distributed sort and cut into slices of `slice_rows` events, the last one less, each its own window partition, and a
    slice's numbers are shifted by the events of the slices before it. So neither a burst in one instant nor events
    without a readable time make a slice larger. Hot chains and their slices are few (rows divided by hot_rows and by
    slice_rows), so both are broadcast.
    """
    chains = log.groupBy("chain").agg(F.count("*").alias("events"))
    busy = chains.where(F.col("events") > hot_rows)
    following = F.lead(F.struct(F.lit(1).alias("some"), F.col("event_ts")))
    if busy.isEmpty():
        whole = W.partitionBy("chain").orderBy(*PLACE)
        counted = log.withColumns({"seq": F.row_number().over(whole), "next": following.over(whole)})
        return _dated(counted, log.columns, F.col("seq"), F.col("next"))
    hot = F.broadcast(busy.select(F.col("chain").alias("hot_chain")))
    # The key of events without an id is null: they are one chain, as in the windows.
    same = F.col("chain").eqNullSafe(F.col("hot_chain"))
    calm = log.join(hot, same, "left_anti").withColumns({"part": F.lit(0).cast("long"), "hot": F.lit(False)})
    placed = numbered(log.join(hot, same, "left_semi"), ["chain", *PLACE], "place", "history")
    starts = F.broadcast(placed.groupBy(F.col("chain").alias("hot_chain")).agg(F.min("place").alias("start")))
    part = F.expr(f"(place - start) div {slice_rows}")
    cut = placed.join(starts, same).select(*map(named, log.columns), part.alias("part"), F.lit(True).alias("hot"))
    sliced = calm.unionByName(cut)

    heads = (
        sliced.where("hot")
        .groupBy("chain", "part")
        .agg(F.count("*").alias("events"), F.min(F.struct(F.lit(1).alias("some"), F.col("event_ts"))).alias("head"))
    )
    along = W.partitionBy("chain").orderBy("part")
    shifts = heads.select(
        F.col("chain").alias("cut_chain"), F.col("part").alias("cut_part"),
        F.coalesce(F.sum("events").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.lead("head").over(along).alias("next_head"),
    )

    inside = W.partitionBy("chain", "hot", "part").orderBy(*PLACE)
    counted = sliced.withColumns({"seq": F.row_number().over(inside), "next": following.over(inside)})
    at_part = F.col("hot") & F.col("chain").eqNullSafe(F.col("cut_chain")) & (F.col("part") == F.col("cut_part"))
    joined = counted.join(F.broadcast(shifts), at_part, "left")
    return _dated(joined, log.columns, F.col("seq") + F.coalesce("before", F.lit(0)), F.coalesce("next", "next_head"))


def _dated(rows: DataFrame, columns: list[str], seq: Column, successor: Column) -> DataFrame:
    return rows.select(
        *map(named, columns),
        seq.cast("int").alias("event_seq"),
        F.col("event_ts").alias("valid_from"),
        successor["event_ts"].alias("valid_to"),
        successor.isNull().alias("is_current"),
    )


def chain_members(log: DataFrame) -> DataFrame:
    """Events that point at a root present in the log."""
    return _pointing(log).join(_roots(log), F.col("orig_id") == F.col("root"), "left_semi")


def orphans(log: DataFrame) -> DataFrame:
    """Events that point at a root the log does not hold."""
    return _pointing(log).join(_roots(log), F.col("orig_id") == F.col("root"), "left_anti")


def _pointing(log: DataFrame) -> DataFrame:
    return log.where((F.col("action") != "NEWT") & ~blank(F.col("orig_id")))


def _roots(log: DataFrame) -> DataFrame:
    # Not made distinct: a plain scan keeps AQE free to split a root that very many events point at.
    return log.where(F.col("action") == "NEWT").select(F.col("diss_id").alias("root"))
