"""OHLCV candles, and the pre-aggregate that all Gold tables can share.

Open, close and last price are those of the first and last trade by ``(trade_time,
trade_id)``, so they do not depend on arrival order or partitioning.

``min_by`` over a struct key makes Spark sort the input of the aggregate. Instead, a first
level hash-aggregates on a 64-bit key ("tick") that orders trades exactly within
``(bucket, id_block)``: the microseconds into the bucket, then the low bits of the trade
id; the high bits are the ``id_block``, one more grouping key that rarely has more than one
value. A second level, over at most a few rows per candle, orders by the whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits that the microseconds within a bucket need; the rest of a long is for the trade id.
_OFFSET_BITS = {"minute": 26, "hour": 32, "day": 37}

MARKET = ("bucket", "symbol")


def flow() -> dict[str, Column]:
    """What flows through a group of trades: sums and counts that merge by adding up."""
    return {
        "volume_usdt": F.sum("quote_qty"),
        "num_trades": F.count("trade_id"),
        "price_sum": F.sum("price"),
        "price_count": F.count("price"),
    }


def _id_bits(every: str) -> int:
    if every not in _OFFSET_BITS:
        raise ValueError(f"every must be one of {', '.join(_OFFSET_BITS)}, not {every!r}")
    return 63 - _OFFSET_BITS[every]


def _ticked(trades: DataFrame, every: str) -> DataFrame:
    """Add ``bucket``, ``id_block`` and ``tick`` to trades."""
    bits = _id_bits(every)
    bucket = F.date_trunc(every, "trade_time")
    into = F.unix_micros("trade_time") - F.unix_micros(bucket)
    low = F.col("trade_id").bitwiseAND((1 << bits) - 1)
    return (
        trades.withColumn("bucket", bucket)
        .withColumn("id_block", F.shiftright("trade_id", bits))
        .withColumn("tick", F.shiftleft(into, bits).bitwiseOR(low))
    )


def _event_key(tick: str, every: str) -> Column:
    """(trade_time in micros, trade_id), rebuilt from bucket, id block and tick."""
    bits = _id_bits(every)
    low = F.col(tick).bitwiseAND((1 << bits) - 1)
    return F.struct(
        (F.unix_micros("bucket") + F.shiftright(tick, bits)).alias("at"),
        F.shiftleft("id_block", bits).bitwiseOR(low).alias("id"),
    )


def facets(trades: DataFrame, every: str = "minute", by: tuple[str, ...] = MARKET) -> DataFrame:
    """Mergeable trade statistics per ``by`` and id block, by hash aggregation only.

    ``by`` may name columns of ``trades`` besides ``bucket``. Candles, pressure and ranking
    are all roll-ups of this table (``candles_of``, ``pressure.pressure_of``,
    ``ranking.ranking_of``), so one pass over trades serves the three.
    """
    return (
        _ticked(trades, every)
        .groupBy(*by, "id_block")
        .agg(
            F.min_by("price", "tick").alias("open"),
            F.min("tick").alias("first_tick"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "tick").alias("close"),
            F.max("tick").alias("last_tick"),
            F.sum("quantity").alias("volume_base"),
            *[measure.alias(name) for name, measure in flow().items()],
        )
    )


def last_price(every: str) -> Column:
    """Aggregate over facet rows: the price of the last trade."""
    return F.max_by("close", _event_key("last_tick", every))


def candles_of(facet_rows: DataFrame, every: str = "minute") -> DataFrame:
    """Candles per bucket and symbol from ``facets``."""
    return (
        facet_rows.groupBy("bucket", "symbol")
        .agg(
            F.min_by("open", _event_key("first_tick", every)).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            last_price(every).alias("close"),
            F.sum("volume_base").alias("volume_base"),
            F.sum("volume_usdt").alias("volume_usdt"),
            F.sum("num_trades").alias("num_trades"),
        )
        .withColumnRenamed("bucket", "candle_time")
        .withColumn("computed_at", F.current_timestamp())
    )


def ohlcv(trades: DataFrame, every: str = "minute") -> DataFrame:
    """Candles over the whole history of ``trades``; ``every`` is minute, hour or day."""
    return candles_of(facets(trades, every), every)
