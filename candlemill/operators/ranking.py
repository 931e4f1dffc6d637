"""Volume ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import AsOf, trailing
from .candles import facets, last_price


def range_pct(low: Column, high: Column) -> Column:
    """Price range in percent of the low; NULL where the low is zero."""
    return F.try_divide(high - low, low) * 100


def ranking_of(facet_rows: DataFrame, every: str = "minute") -> DataFrame:
    """One row per symbol from ``facets``. Unsorted: a table has no order, readers sort."""
    return (
        facet_rows.groupBy("symbol")
        .agg(
            F.sum("volume_usdt").alias("total_volume_usdt"),
            F.sum("num_trades").alias("total_trades"),
            F.min("low").alias("price_low"),
            F.max("high").alias("price_high"),
            last_price(every).alias("last_price"),
        )
        .withColumn("price_range_pct", range_pct(F.col("price_low"), F.col("price_high")))
        .withColumn("computed_at", F.current_timestamp())
    )


def ranking(trades: DataFrame, as_of: AsOf = None, interval: str = "24 HOURS") -> DataFrame:
    """Volume, trades, price range and last price per symbol over the trailing window.

    Aggregated per hour first, so that a symbol with most of the trades is combined from
    many tasks' partial results.
    """
    return ranking_of(facets(trailing(trades, interval, as_of), "hour"), "hour")
