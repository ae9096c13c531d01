"""Casts, numbers and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(column: Column | str) -> Column:
    """Parse to double; text that is no number becomes NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.trim(c.cast("string")).try_cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL for a zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def shift_seconds(column: Column | str, seconds: Column) -> Column:
    """Move a timestamp by a number of seconds, keeping its type."""
    c = F.col(column) if isinstance(column, str) else column
    return c + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def one_day_later(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c + F.expr("INTERVAL 1 DAY")


def half_up(column: Column | str, digits: int = 6) -> Column:
    """Rounded double for reports and comparisons; folds -0.0 into 0.0."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits) + F.lit(0.0)


def utc_instant(column: Column | str) -> Column:
    """A zone-free timestamp read as UTC, whatever the session time zone. Watermarks need an instant."""
    c = F.col(column) if isinstance(column, str) else column
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")


def utc_wall_clock(column: Column | str) -> Column:
    """The UTC wall clock of an instant, without a zone."""
    c = F.col(column) if isinstance(column, str) else column
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
