"""Names, keys and message formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a run name may hold, and its greatest length.
NAME_SAFE = "[^0-9A-Za-z_-]"
NAME_LIMIT = 80


def base_name(path: Column) -> Column:
    """Last element of a `/`-separated path."""
    return F.substring_index(path, "/", -1)


def decoded_name(file_name: Column) -> Column:
    """File name from `_metadata`, which Spark hands out URL-encoded; a literal `+` stays a `+`."""
    return F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))


def address(path: Column) -> Column:
    """One spelling for a file's address: Hadoop writes a local one with one slash or with three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def arrival_key(path: Column) -> Column:
    """Deterministic run name of an arrived file: its base name, made safe and cut to length.

    A name to show, not an identity: different files may share it.
    """
    return F.substring(F.regexp_replace(base_name(blank_filled(path)), NAME_SAFE, "-"), 1, NAME_LIMIT)


def fixed_point(value: Column, digits: int) -> Column:
    """`value`, a double, as text with 0 or 1 decimals: the exact binary value rounded, true ties to even.

    2.45 as a double lies above the tie and gives 2.5, 0.35 lies below and gives 0.3. Ten times the value is the sum of
    8 and 2 times it, both exact; what that sum lost in rounding decides where it looks like a tie.
    """
    if digits not in (0, 1):
        raise ValueError("digits must be 0 or 1")
    value = value.cast("double")
    if digits == 0:
        return F.bround(value, 0).cast("decimal(38,0)").cast("string")
    eight, two = value * 8, value * 2
    ten = eight + two
    lost = (eight - (ten - (ten - eight))) + (two - (ten - eight))
    tie = ten - F.floor(ten) == 0.5
    whole = F.when(tie & (lost > 0), F.ceil(ten)).when(tie & (lost < 0), F.floor(ten)).otherwise(F.rint(ten))
    return (whole.cast("decimal(20,0)") / 10).cast("decimal(38,1)").cast("string")


def blank(column: Column) -> Column:
    """True for null and for the empty string."""
    return column.isNull() | (column == "")


def blank_filled(column: Column) -> Column:
    """Absent value -> empty string, the only kind of 'no value' Bronze holds."""
    return F.coalesce(column, F.lit(""))


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col(quoted(column))
