"""Bronze rows to Silver trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import epoch_millis, side_of
from ..schemas import SILVER, TRADE_PAYLOAD
from .contract import conform

# Change operations that put a new row into the source table.
INSERTS = ("c", "r")  # create, snapshot read

# Arrival order of change records; the columns that are present are used.
ARRIVAL = ("lsn", "offset", "partition")


def parse_trades(bronze: DataFrame) -> DataFrame:
    """Typed trades of the inserts and snapshot rows; updates, deletes and unparseable
    records are left behind in Bronze. The filter reaches the Bronze scan."""
    position = [c for c in ARRIVAL if c in bronze.columns and c != "lsn"]
    payload = bronze.filter(F.col("op").isin(*INSERTS)).select(
        "lsn",
        "ingested_at",
        *position,
        F.inline(F.array(F.from_json("after", TRADE_PAYLOAD))),
    )
    return (
        payload.withColumn("trade_time", epoch_millis(F.col("trade_time")))
        .withColumn("side", side_of(F.col("is_buyer_maker")))
        .withColumn("processed_at", F.current_timestamp())
    )


def keep_first(
    df: DataFrame,
    keys: Sequence[str] = ("trade_id",),
    *,
    forget_after: str | None = None,
    hot_key_splits: int = 0,
) -> DataFrame:
    """One row per key: the first that arrived.

    *Batch*: lowest ``lsn``, then offset, then partition, whatever the partitioning. Spark
    keeps the first row per key in each task before the shuffle (window group limit), so
    the copies of a hot key never meet in one task.

    *Stream*: the first copy the query sees, over the query's lifetime. State is one entry
    per key for ever, or, with ``forget_after``, only for keys that arrived within that time
    of the newest arrival; a copy that comes later than that is admitted again. The
    watermark is on ``ingested_at``, which grows from batch to batch, not on the trade time:
    a late or back-filled trade is never dropped. ``hot_key_splits`` first removes copies
    within (key, split), so that a key holding a large part of the feed is spread over
    several tasks; this costs a second state entry per key.
    """
    keys = list(keys)
    if not df.isStreaming:
        order = [F.col(c).asc_nulls_last() for c in ARRIVAL if c in df.columns]
        first = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        return df.withColumn("_nth", first).filter("_nth = 1").drop("_nth")
    if forget_after:
        df = df.withWatermark("ingested_at", forget_after)
    drop = DataFrame.dropDuplicatesWithinWatermark if forget_after else DataFrame.dropDuplicates
    if hot_key_splits > 1:
        split = F.pmod(F.xxhash64("offset"), F.lit(hot_key_splits))
        df = drop(df.withColumn("_split", split), [*keys, "_split"]).drop("_split")
    return drop(df, keys)


def refine(
    bronze: DataFrame,
    keys: Sequence[str] = ("trade_id",),
    *,
    forget_after: str | None = None,
    hot_key_splits: int = 0,
    metrics: str | Observation | None = None,
) -> DataFrame:
    """Silver: insert-only, typed, one row per key, no row without a ``trade_id``.

    ``metrics`` counts the rows rejected for a missing ``trade_id`` (unparseable or absent
    payload). Use ``keys=("symbol", "trade_id")`` where ids are unique per symbol only.
    """
    trades = parse_trades(bronze)
    position = [c for c in ARRIVAL if c in trades.columns and c not in SILVER.fieldNames()]
    valid = conform(trades, SILVER, carry=position, metrics=metrics)
    unique = keep_first(valid, keys, forget_after=forget_after, hot_key_splits=hot_key_splits)
    return unique.drop(*position)
