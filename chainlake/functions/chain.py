"""Keys, order and amounts of event chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainlake.functions.text import blank


def chain_key(diss_id: Column, orig_id: Column) -> Column:
    """The id of the record an event is about: the one it points at, else its own."""
    return F.when(blank(orig_id), diss_id).otherwise(orig_id)


def event_order() -> Column:
    """Total order of the events of a chain: by event time, then by place in the source.

    A null event time sorts first, so an event without a readable time never overrides one that has it.
    """
    return F.struct("event_ts", "arquivo_origem", "line_number")


def event_time(text: Column) -> Column:
    """Event time, null where the text is not a timestamp."""
    return F.try_to_timestamp(text)


def amount(text: Column) -> Column:
    """Notional as a decimal: thousands separators and the capped-notional `+` removed; blank -> null."""
    return F.regexp_replace(text, "[,+ ]", "").try_cast("decimal(38,6)")
