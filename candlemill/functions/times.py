"""Event times and trailing windows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# End of a trailing window: a time, a column expression, a one-row table, or the clock.
AsOf = datetime | Column | DataFrame | None

# Largest epoch-ms magnitude that still fits a timestamp's microseconds.
_MAX_MILLIS = (2**63 - 1) // 1000


def epoch_millis(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp; NULL where they lie outside the timestamp range,
    so that one corrupt record cannot fail the job under ANSI mode."""
    return F.when(ms.between(-_MAX_MILLIS, _MAX_MILLIS), F.timestamp_millis(ms))


def latest(df: DataFrame, column: str = "trade_time") -> DataFrame:
    """The newest value of a column, as a one-row table to be used as ``as_of``."""
    return df.agg(F.max(column).alias("as_of"))


def trailing_floor(interval: str, as_of: AsOf = None) -> Column:
    """Start of the window that ends at ``as_of`` (default: the query's clock).

    A one-row table becomes a scalar subquery: no join, nothing collected. The interval is
    taken off inside of it, because Spark hands a bare subquery result to the Parquet scan,
    but not an expression over it.
    """
    length = F.expr(f"INTERVAL {interval}")
    if isinstance(as_of, DataFrame):
        (column,) = as_of.columns
        return as_of.select(F.col(column).cast("timestamp") - length).scalar()
    if as_of is None:
        as_of = F.now()
    elif isinstance(as_of, datetime):
        # Without a zone it is UTC, whatever the zone of the driver's machine.
        as_of = F.lit(as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc))
    return as_of.cast("timestamp") - length


def trailing(
    df: DataFrame,
    interval: str,
    as_of: AsOf = None,
    column: str = "trade_time",
    date_column: str = "trade_date",
) -> DataFrame:
    """Rows no older than ``interval`` before ``as_of``: an inclusive lower bound only.

    The bound reaches the Parquet scan, where it skips row groups by their statistics. Where
    the table is partitioned by date, it also prunes partitions.
    """
    floor = trailing_floor(interval, as_of)
    kept = df.filter(F.col(column) >= floor)
    if date_column in df.columns:
        kept = kept.filter(F.col(date_column) >= floor.cast("date"))
    return kept
