from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from rows import as_set, bronze, envelope, payload, records

from candlemill import schemas
from candlemill.operators.envelope import to_bronze
from candlemill.operators.health import bronze_quality
from candlemill.operators.refine import refine


def silver(spark, *rows, **options):
    return refine(bronze(spark, *rows), **options)


def test_payload_is_typed(spark):
    row = silver(spark, ("c", 1, payload(612, price=12.5))).collect()[0]
    assert (row["trade_id"], row["symbol"], row["price"]) == (612, "ADAEUR", 12.5)
    assert row["trade_time"] == datetime(2024, 6, 3, 12, 0)
    assert row["processed_at"] is not None


def test_silver_follows_its_contract(spark):
    out = silver(spark, ("c", 1, payload()))
    assert out.columns == schemas.SILVER.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.SILVER]


def test_epoch_milliseconds(spark):
    row = silver(spark, ("c", 1, payload(trade_time=1700000000000))).collect()[0]
    assert row["trade_time"] == datetime(2023, 11, 14, 22, 13, 20)


@pytest.mark.parametrize("maker, side", [(False, "buy"), (True, "sell"), (None, "buy")])
def test_side(spark, maker, side):
    assert silver(spark, ("c", 1, payload(maker=maker))).collect()[0]["side"] == side


@pytest.mark.parametrize("op, kept", [("c", 1), ("r", 1), ("u", 0), ("d", 0), ("t", 0), (None, 0)])
def test_only_inserts_and_snapshot_rows(spark, op, kept):
    assert silver(spark, (op, 1, payload())).count() == kept


def test_quote_quantity_is_taken_from_the_payload(spark):
    row = silver(spark, ("c", 1, payload(price=2.5, quantity=6.0))).collect()[0]
    assert row["quote_qty"] == pytest.approx(15.0)


def test_lowest_lsn_survives(spark):
    rows = [("c", 11, payload(7, price=2.0)), ("c", 10, payload(7, price=1.0))]
    assert as_set(silver(spark, *rows), "lsn", "price") == {(10, 1.0)}


def test_lowest_offset_survives_between_equal_lsns(spark):
    rows = [("c", 10, payload(7, price=2.0), 5), ("c", 10, payload(7, price=1.0), 4)]
    assert as_set(silver(spark, *rows), "price") == {(1.0,)}


def test_missing_lsn_loses(spark):
    rows = [("c", None, payload(7, price=2.0)), ("c", 10, payload(7, price=1.0))]
    assert as_set(silver(spark, *rows), "price") == {(1.0,)}


def test_survivors_do_not_depend_on_partitioning(spark):
    rows = [("c", 1000 - n, payload(n % 40, price=float(n))) for n in range(400)]
    base = bronze(spark, *rows)
    first = as_set(refine(base.repartition(1)), "trade_id", "lsn", "price")
    assert first == as_set(refine(base.repartition(7)), "trade_id", "lsn", "price")
    assert len(first) == 40


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = [("c", n, payload(1 if n % 3 else n)) for n in range(300)]
    out = refine(bronze(spark, *rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one before the exchange, one after
    assert out.count() == 101


def test_key_per_symbol(spark):
    rows = [("c", 1, payload(7, "A")), ("c", 2, payload(7, "B"))]
    assert silver(spark, *rows).count() == 1
    assert silver(spark, *rows, keys=("symbol", "trade_id")).count() == 2


@pytest.mark.parametrize(
    "after", [None, "garbage", {"symbol": "A"}, payload(None), payload("7")],
    ids=["null", "garbage", "absent id", "null id", "quoted id"],
)
def test_rows_without_a_trade_id_are_rejected_and_counted(spark, after):
    seen = Observation()
    rows = [("c", 1, after), ("c", 2, after), ("c", 3, payload(8))]
    assert as_set(silver(spark, *rows, metrics=seen), "trade_id") == {(8,)}
    assert seen.get == {"rows": 3, "rejected": 2}


def test_quoted_price_is_null(spark):
    assert silver(spark, ("c", 1, payload(price="3.5"))).collect()[0]["price"] is None


def test_time_outside_the_range_is_null(spark):
    assert as_set(silver(spark, ("c", 1, payload(trade_time=2**62))), "trade_time") == {(None,)}


def test_bronze_without_positions(spark):
    df = bronze(spark, ("c", 1, payload())).select("op", "event_ts_ms", "lsn", "after",
                                                   F.lit("2024-01-01").alias("ingested_at"))
    row = refine(df).collect()[0]
    assert row["ingested_at"] == datetime(2024, 1, 1)


def test_quality_report(spark):
    df = to_bronze(records(
        spark,
        envelope(payload(1)), envelope(payload(2, maker=None), op="r"), envelope(payload(3), op="u"),
        envelope(payload(4), op="d"), envelope("garbage"), "not json",
        envelope(payload(5, trade_time=1717416000000000)), envelope(payload(6, trade_time=None)),
    ))
    assert bronze_quality(df).collect()[0].asDict() == {
        "records": 8, "unparseable": 1, "inserts": 5, "updates": 1, "deletes": 1,
        "without_trade_id": 1, "unknown_maker": 1, "implausible_time": 1,
    }


def test_json_is_parsed_once(spark):
    plan = silver(spark, ("c", 1, payload()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
