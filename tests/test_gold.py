from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from rows import NOON, TRADE, as_set, trades

from candlemill.operators.candles import candles_of, ohlcv
from candlemill.operators.pressure import pressure, pressure_of
from candlemill.operators.ranking import ranking, ranking_of
from candlemill.plans.gold import shared_facets

HOUR = 3600


def one(df):
    (row,) = df.collect()
    return row


def test_candle(spark):
    row = one(ohlcv(trades(
        spark,
        (1, "ADAEUR", 12.5, 4.0, False, 10),
        (2, "ADAEUR", 14.0, 0.5, True, 20),
        (3, "ADAEUR", 11.25, 8.0, False, 30),
    )))
    assert row["candle_time"] == NOON.replace(tzinfo=None)
    assert (row["open"], row["high"], row["low"], row["close"]) == (12.5, 14.0, 11.25, 11.25)
    assert row["volume_base"] == pytest.approx(12.5)
    assert row["volume_usdt"] == pytest.approx(50 + 7 + 90)
    assert row["num_trades"] == 3 and row["computed_at"] is not None


def test_candles_per_symbol_and_minute(spark):
    df = trades(spark, (1, "A", 1.0, 1.0, False, 0), (2, "B", 1.0, 1.0, False, 0),
                (3, "A", 1.0, 1.0, False, 59), (4, "A", 1.0, 1.0, False, 60))
    assert ohlcv(df).count() == 3
    assert ohlcv(df, every="day").count() == 2


def test_open_and_close_by_time_then_id(spark):
    rows = [(i, "A", float(i), 1.0, False, 0) for i in (5, 3, 9, 7)]
    row = one(ohlcv(trades(spark, *rows)))
    assert (row["open"], row["close"]) == (3.0, 9.0)


@pytest.mark.parametrize("every", ["minute", "hour", "day"])
def test_tie_break_is_exact_for_any_id(spark, every):
    ids = [-(2**62), -1, 0, 1, 2**26, 2**31 + 1, 2**37, 2**37 + 1, 2**62]
    for order in (ids, ids[::-1]):
        row = one(ohlcv(trades(spark, *[(i, "A", float(n), 1.0, False, 0)
                                        for n, i in enumerate(order)]), every))
        assert row["open"] == float(order.index(min(ids)))
        assert row["close"] == float(order.index(max(ids)))


def test_time_goes_before_id(spark):
    row = one(ohlcv(trades(spark, (2**62, "A", 1.0, 1.0, False, 0), (-5, "A", 2.0, 1.0, False, 1))))
    assert (row["open"], row["close"]) == (1.0, 2.0)


def test_candles_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).select(
        F.col("id").alias("trade_id"), F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        (F.col("id") * 7 % 101).cast("double").alias("price"), F.lit(1.0).alias("quantity"),
        F.lit(1.0).alias("quote_qty"), F.lit(True).alias("is_buyer_maker"),
        F.lit("sell").alias("side"),
        F.timestamp_millis(F.lit(1717430400000) + F.col("id") % 600 * 1000).alias("trade_time"),
    )
    plain = ["candle_time", "symbol", "open", "high", "low", "close", "volume_base", "num_trades"]
    expected = as_set(
        df.groupBy(F.date_trunc("minute", "trade_time"), "symbol").agg(
            F.min_by("price", F.struct("trade_time", "trade_id")), F.max("price"), F.min("price"),
            F.max_by("price", F.struct("trade_time", "trade_id")), F.sum("quantity"),
            F.count("trade_id"),
        ),
        "*",
    )
    assert as_set(ohlcv(df), *plain) == expected
    assert as_set(ohlcv(df.repartition(7)), *plain) == expected


def test_null_price_and_null_ids(spark):
    df = spark.createDataFrame(
        [(1, "A", None, 1.0, 1.0, True, "sell", NOON), (2, "A", 2.0, 1.0, 1.0, True, "sell", NOON),
         (None, "A", 3.0, 1.0, 1.0, True, "sell", NOON)], TRADE)
    row = one(ohlcv(df))
    assert (row["open"], row["high"], row["num_trades"]) == (None, 3.0, 2)
    assert one(pressure(df, as_of=NOON))["num_trades"] == 2


def test_unknown_resolution(spark):
    with pytest.raises(ValueError, match="minute, hour, day"):
        ohlcv(trades(spark), every="month")


def test_pressure_by_side(spark):
    df = trades(spark, (1, "A", 6.0, 1.0, False, 0), (2, "A", 7.5, 2.0, True, 1),
                (3, "A", 8.0, 1.0, False, 2))
    assert as_set(pressure(df, as_of=NOON), "side", "num_trades", "volume_usdt", "avg_price") == {
        ("buy", 2, 14.0, 7.0), ("sell", 1, 15.0, 7.5)}


def test_window_has_an_inclusive_lower_bound_only(spark):
    day = 24 * HOUR
    df = trades(spark, (1, "A", 1.0, 1.0, False, -day - 1), (2, "A", 2.0, 1.0, False, -day),
                (3, "A", 3.0, 1.0, False, 0), (4, "A", 4.0, 1.0, False, HOUR))
    row = one(ranking(df, as_of=NOON))
    assert (row["total_trades"], row["price_low"], row["last_price"]) == (3, 2.0, 4.0)
    assert pressure(df, as_of=NOON).count() == 3


def test_window_ends_now_by_default(spark):
    df = trades(spark, (1, "A", 1.0, 1.0, False, 0)).unionByName(
        trades(spark, (2, "A", 2.0, 1.0, False, 0)).withColumn("trade_time", F.now()))
    assert one(ranking(df))["price_low"] == 2.0


def test_ranking(spark):
    df = trades(spark, (1, "X", 40.0, 0.5, False, 0), (2, "X", 45.0, 2.0, True, 5),
                (3, "X", 42.0, 1.0, True, HOUR), (4, "Y", 3.0, 1.0, False, 0))
    rows = {r["symbol"]: r for r in ranking(df, as_of=NOON).collect()}
    x = rows["X"]
    assert x["total_volume_usdt"] == pytest.approx(20 + 90 + 42)
    assert (x["total_trades"], x["price_low"], x["price_high"]) == (3, 40.0, 45.0)
    assert x["last_price"] == 42.0
    assert x["price_range_pct"] == pytest.approx(12.5)


def test_range_of_a_zero_low_is_null(spark):
    df = trades(spark, (1, "A", 0.0, 1.0, False, 0), (2, "A", 5.0, 1.0, False, 1))
    assert one(ranking(df, as_of=NOON))["price_range_pct"] is None


def test_shared_facets_give_the_same_tables(spark):
    # The window starts inside a minute, and a symbol has all its trades outside of it.
    rows = [(n, "AB"[n % 2], float(n % 17), float(n % 5), n % 3 == 0, n * 7) for n in range(400)]
    df = trades(spark, *rows, (-1, "C", 1.0, 1.0, True, 0))
    as_of = NOON + timedelta(days=1, seconds=1000)
    minutes = shared_facets(df, as_of)
    recent = minutes.filter("recent")
    for direct, shared in (
        (ohlcv(df), candles_of(minutes)),
        (pressure(df, as_of), pressure_of(recent)),
        (ranking(df, as_of), ranking_of(recent)),
    ):
        columns = [F.round(c, 6) if t == "double" else c for c, t in direct.dtypes
                   if c != "computed_at"]
        assert as_set(shared, *columns) == as_set(direct, *columns)
    assert ranking_of(recent).count() == 2
