"""The reports that read Silver and Gold. Every limited report has a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import AsOf, trailing


def newest_dates(df: DataFrame, n: int, date_column: str = "trade_date") -> DataFrame:
    """Only the newest date partitions, as many as are needed to hold ``n`` rows.

    Counting rows per partition reads file footers alone; the bound it gives prunes the
    scan. Exact: a row outside these dates is older than ``n`` rows inside them. Rows
    without a date sort last in a descending order; they are kept only while the dated
    rows are fewer than ``n``.
    """
    per_date = df.groupBy(date_column).agg(F.count(F.lit(1)).alias("held"))
    newer = F.sum("held").over(W.orderBy(F.col(date_column).desc_nulls_last()))
    enough = per_date.withColumn("held", newer).filter(F.col("held") >= n)
    bound = enough.select(F.max(date_column)).scalar()
    return df.filter(F.coalesce(F.col(date_column) >= bound, bound.isNull()))


def since_nth_newest(df: DataFrame, column: str, n: int) -> DataFrame:
    """Only the rows that can be among the ``n`` newest by ``column``.

    The n-th newest value is found by reading that column alone; as a bound on the scan it
    lets Spark skip, by their statistics, the files and row groups that are older.
    """
    newest = df.select(column).orderBy(F.desc(column)).limit(n)
    bound = newest.agg(F.min(column)).scalar()
    return df.filter((F.col(column) >= bound) | F.col(column).isNull())


def latest_trades(trades: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` trades."""
    if "trade_date" in trades.columns:
        newest = newest_dates(trades, n)
    else:
        newest = since_nth_newest(trades, "trade_time", n)
    return (
        newest.select(
            "trade_time", "symbol", "price", "quantity", "quote_qty", "side", "trade_id"
        )
        .orderBy(F.desc("trade_time"), F.desc("trade_id"))
        .limit(n)
        .drop("trade_id")
    )


def latest_candles(candles: DataFrame, symbol: str, n: int = 60) -> DataFrame:
    """The newest ``n`` candles of a symbol. (candle_time is unique within a symbol.)

    Of a table partitioned by date, only the dates that hold the symbol's newest candles.
    """
    of_symbol = candles.filter(F.col("symbol") == symbol)
    if "candle_date" in candles.columns:
        of_symbol = newest_dates(of_symbol, n, "candle_date")
    return (
        of_symbol.select("candle_time", "open", "high", "low", "close", "volume_usdt", "num_trades")
        .orderBy(F.desc("candle_time"))
        .limit(n)
    )


def pressure_by_symbol(pressure: DataFrame) -> DataFrame:
    """Pressure totals per symbol and side. ``avg_price`` is the plain mean of the
    per-minute means: minutes count equally, not trades."""
    return (
        pressure.groupBy("symbol", "side")
        .agg(
            F.sum("volume_usdt").alias("total_volume_usdt"),
            F.sum("num_trades").alias("total_trades"),
            F.avg("avg_price").alias("avg_price"),
        )
        .orderBy("symbol", "side")
    )


def buy_sell_pivot(pressure: DataFrame) -> DataFrame:
    """Buy and sell volume side by side per minute and symbol; a missing side is NULL."""
    volume = {s: F.when(F.col("side") == s, F.col("volume_usdt")) for s in ("buy", "sell")}
    return pressure.groupBy("window_time", "symbol").agg(
        F.max(volume["buy"]).alias("buy_volume"), F.max(volume["sell"]).alias("sell_volume")
    )


def latest_pivot(pressure: DataFrame, symbol: str, n: int = 60) -> DataFrame:
    """The newest ``n`` minutes of ``buy_sell_pivot`` for a symbol."""
    return (
        buy_sell_pivot(pressure.filter(F.col("symbol") == symbol))
        .orderBy(F.desc("window_time"))
        .limit(n)
    )


def ranking_report(ranking: DataFrame) -> DataFrame:
    """The ranking, largest volume first, with the price range rounded to two decimals."""
    return ranking.select(
        "symbol",
        "total_volume_usdt",
        "total_trades",
        "price_low",
        "price_high",
        "last_price",
        F.round("price_range_pct", 2).alias("volatilidad_pct"),  # name that dashboards use
    ).orderBy(F.desc("total_volume_usdt"), "symbol")


def recent_stats(trades: DataFrame, as_of: AsOf = None, interval: str = "30 MINUTES") -> DataFrame:
    """Trades, mean price and volume per symbol over the trailing half hour, in decimals."""
    exact = "decimal(18,8)"
    return (
        trailing(trades, interval, as_of)
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("trades"),
            F.round(F.avg(F.col("price").cast(exact)), 2).alias("avg_price"),
            F.round(F.sum(F.col("quote_qty").cast(exact)), 2).alias("volume_usdt"),
        )
        .orderBy(F.desc("volume_usdt"), "symbol")
    )


def newest_rows(
    df: DataFrame, time_column: str, n: int = 10, date_column: str | None = None
) -> DataFrame:
    """The newest ``n`` rows of any table by its time column; ties by the other columns.

    ``date_column`` names a partition column with the dates of ``time_column``, if the table
    has one: then only the newest partitions are read.
    """
    ties = [F.col(f.name) for f in df.schema if f.name != time_column]
    if date_column is not None:
        df = newest_dates(df, n, date_column)
    return since_nth_newest(df, time_column, n).orderBy(F.desc(time_column), *ties).limit(n)
