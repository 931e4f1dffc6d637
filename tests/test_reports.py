from decimal import Decimal

from pyspark.sql import functions as F
from rows import NOON, as_set, trades

from candlemill.operators import reports
from candlemill.operators.candles import ohlcv
from candlemill.operators.pressure import pressure
from candlemill.operators.ranking import ranking

DAY = 24 * 3600


def test_latest_trades_break_ties_by_id(spark):
    df = trades(spark, *[(n, "A", float(n), 1.0, False, n // 2) for n in range(10)])
    out = reports.latest_trades(df, 3)
    assert out.columns == ["trade_time", "symbol", "price", "quantity", "quote_qty", "side"]
    assert [r["price"] for r in out.collect()] == [9.0, 8.0, 7.0]


def partitioned(spark, tmp_path, *rows):
    df = trades(spark, *rows).withColumn("trade_date", F.col("trade_time").cast("date"))
    df.write.partitionBy("trade_date").parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_latest_trades_read_only_the_newest_dates(spark, tmp_path):
    df = partitioned(spark, tmp_path, *[(n, "A", float(n), 1.0, False, n * DAY // 4)
                                        for n in range(40)])
    assert reports.newest_dates(df, 5).select("trade_date").distinct().count() == 2
    assert [r["price"] for r in reports.latest_trades(df, 5).collect()] == [39, 38, 37, 36, 35]
    plan = reports.latest_trades(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [coalesce((trade_date" in plan


def test_latest_trades_of_a_table_with_fewer_rows(spark, tmp_path):
    df = partitioned(spark, tmp_path, (1, "A", 1.0, 1.0, False, 0), (2, "A", 2.0, 1.0, False, DAY))
    undated = df.withColumn("trade_time", F.lit(None).cast("timestamp")).withColumn(
        "trade_date", F.lit(None).cast("date"))
    assert reports.latest_trades(df, 5).count() == 2
    assert reports.latest_trades(df.unionByName(undated), 3).count() == 3
    assert reports.latest_trades(df.unionByName(undated), 9).count() == 4


def test_latest_candles(spark):
    df = trades(spark, *[(n, "AB"[n % 2], float(n), 1.0, False, 60 * n) for n in range(20)])
    out = reports.latest_candles(ohlcv(df), "A", 4)
    assert [r["close"] for r in out.collect()] == [18.0, 16.0, 14.0, 12.0]
    assert out.columns == ["candle_time", "open", "high", "low", "close", "volume_usdt",
                           "num_trades"]


def test_pressure_totals_average_minutes_not_trades(spark):
    df = trades(spark, (1, "A", 10.0, 1.0, False, 0), (2, "A", 10.0, 1.0, False, 1),
                (3, "A", 40.0, 1.0, False, 60), (4, "A", 5.0, 1.0, True, 0))
    rows = reports.pressure_by_symbol(pressure(df, NOON)).collect()
    assert [tuple(r) for r in rows] == [("A", "buy", 60.0, 3, 25.0), ("A", "sell", 5.0, 1, 5.0)]


def test_pivot_leaves_a_missing_side_null(spark):
    df = trades(spark, (1, "A", 10.0, 1.0, False, 0), (2, "A", 7.0, 1.0, True, 0),
                (3, "A", 4.0, 1.0, True, 60), (4, "B", 1.0, 1.0, True, 0))
    table = pressure(df, NOON)
    assert as_set(reports.buy_sell_pivot(table), "symbol", "buy_volume", "sell_volume") == {
        ("A", 10.0, 7.0), ("A", None, 4.0), ("B", None, 1.0)}
    newest = reports.latest_pivot(table, "A", 1).collect()
    assert [(r["buy_volume"], r["sell_volume"]) for r in newest] == [(None, 4.0)]


def test_ranking_report_is_sorted_and_rounded(spark):
    df = trades(spark, (1, "SOL", 150.0, 1.0, False, 0), (2, "ETH", 3000.0, 1.0, False, 0),
                (3, "BTC", 48000.0, 1.0, False, 0), (4, "BTC", 52000.0, 1.0, False, 0))
    rows = reports.ranking_report(ranking(df, NOON)).collect()
    assert [r["symbol"] for r in rows] == ["BTC", "ETH", "SOL"]
    assert rows[0]["volatilidad_pct"] == 8.33


def test_recent_stats_are_decimals(spark):
    df = trades(spark, (1, "A", 1.0, 1.0, False, -1801), (2, "A", 1.01, 1.0, False, -1800),
                (3, "A", 1.02, 1.0, False, 0), (4, "B", 9.0, 1.0, False, 0))
    out = reports.recent_stats(df, NOON)
    assert [tuple(r) for r in out.collect()] == [
        ("B", 1, Decimal("9.00"), Decimal("9.00")), ("A", 2, Decimal("1.02"), Decimal("2.03"))]
    assert dict(out.dtypes)["avg_price"] == "decimal(13,2)"
    assert dict(out.dtypes)["volume_usdt"] == "decimal(23,2)"


def test_newest_rows(spark):
    df = trades(spark, *[(n, "A", 1.0, 1.0, False, n // 3) for n in range(9)])
    assert [r["trade_id"] for r in reports.newest_rows(df, "trade_time", 4).collect()] == [6, 7, 8, 3]
