import pytest
from pyspark.sql import Observation
from rows import NOON, NOON_MS, as_set

from candlemill.operators.inserts import absent_from, normalize_trades
from candlemill.schemas import TRADE_ROW
from candlemill.sources.tables import insert_if_absent

PAYLOAD = "id long, price string, qty string, quoteQty string, isBuyerMaker boolean, time long"


def payloads(spark, *rows):
    return spark.createDataFrame(rows, PAYLOAD)


def test_payload_becomes_a_trade_row(spark):
    out = normalize_trades(payloads(spark, (1, "3.50", "2", "7.0", True, NOON_MS)), "ADAEUR")
    assert out.columns == TRADE_ROW.fieldNames()
    assert as_set(out, "trade_id", "symbol", "price", "quantity", "quote_qty", "trade_time") == {
        (1, "ADAEUR", 3.5, 2.0, 7.0, NOON.replace(tzinfo=None))}


def test_what_is_not_a_trade_is_rejected_and_counted(spark):
    seen = Observation()
    out = normalize_trades(
        payloads(spark, (1, "x", "2", "7", True, NOON_MS), (2, "1", None, "7", True, NOON_MS),
                 (None, "1", "2", "7", True, NOON_MS), (3, "1", "2", "2", None, NOON_MS),
                 (4, "1", "2", "2", False, NOON_MS)),
        "A", metrics=seen)
    assert as_set(out, "trade_id") == {(4,)}
    assert seen.get == {"rows": 5, "rejected": 4}


def test_absent_from_keeps_one_of_several_copies(spark):
    incoming = spark.createDataFrame([(1, 5.0), (2, 9.0), (2, 8.0), (3, 1.0)], "trade_id long, p double")
    table = spark.createDataFrame([(1, 0.0), (7, 0.0)], "trade_id long, p double")
    assert as_set(absent_from(incoming, table), "*") == {(2, 8.0), (3, 1.0)}


def test_hot_key_in_the_batch(spark):
    incoming = spark.range(3000).selectExpr("if(id % 3 = 0, id, -1L) AS trade_id", "id AS p")
    table = spark.range(0, 3000, 6).selectExpr("id AS trade_id")
    out = absent_from(incoming, table)
    assert out.count() == 501 and as_set(out.filter("trade_id = -1"), "p") == {(1,)}


def test_second_insert_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "trades")
    first = normalize_trades(
        payloads(spark, *[(n, "1", "2", "2", True, NOON_MS + n) for n in range(5)]), "A")
    assert insert_if_absent(first, path) == 5
    assert insert_if_absent(first, path) == 0
    more = normalize_trades(
        payloads(spark, *[(n, "9", "2", "2", True, NOON_MS + n) for n in range(3, 8)]), "A")
    assert insert_if_absent(more, path) == 3
    assert as_set(spark.read.parquet(path), "trade_id", "price") == {
        (n, 1.0 if n < 5 else 9.0) for n in range(8)}


def test_nothing_to_insert(spark, tmp_path):
    none = normalize_trades(payloads(spark), "A")
    assert insert_if_absent(none, str(tmp_path / "trades")) == 0


@pytest.mark.parametrize("broadcast", ["10485760", "-1"], ids=["broadcast", "shuffle"])
def test_joins_agree_with_and_without_broadcast(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        incoming = spark.range(100).selectExpr("id % 50 AS trade_id", "id AS p")
        table = spark.range(0, 200, 2).selectExpr("id AS trade_id")
        assert as_set(absent_from(incoming, table), "*") == {(n, n) for n in range(1, 50, 2)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
