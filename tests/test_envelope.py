import json

import pytest
from rows import NOON, NOON_MS, envelope, payload, records

from candlemill import schemas
from candlemill.operators.envelope import parse_envelope, to_bronze


def parsed(spark, *values):
    return parse_envelope(records(spark, *values)).collect()


@pytest.mark.parametrize("op", ["c", "r", "u", "d", "t"])
def test_op_is_carried_through(spark, op):
    assert parsed(spark, envelope(json.dumps(payload()), op=op))[0]["op"] == op


def test_position_and_source(spark):
    row = parsed(spark, envelope(json.dumps(payload()), table="trades", lsn=31))[0]
    assert (row["lsn"], row["source_table"], row["event_ts_ms"]) == (31, "trades", NOON_MS)
    assert (row["offset"], row["partition"]) == (0, 0)
    assert row["kafka_timestamp"] == NOON.replace(tzinfo=None)


@pytest.mark.parametrize("wrap", [json.dumps, lambda p: p], ids=["escaped", "nested"])
def test_after_is_json_text(spark, wrap):
    after = parsed(spark, envelope(wrap(payload())))[0]["after"]
    assert json.loads(after)["symbol"] == "ADAEUR"


@pytest.mark.parametrize(
    "value", ["not json", "", {"payload": {"op": "c"}}], ids=["garbage", "empty", "wrapped"]
)
def test_what_cannot_be_parsed_is_kept_with_nulls(spark, value):
    rows = parsed(spark, value, envelope(payload()))
    assert len(rows) == 2
    bad = next(r for r in rows if r["offset"] == 0)
    assert (bad["op"], bad["after"], bad["lsn"]) == (None, None, None)


def test_null_value_is_kept(spark):
    df = spark.createDataFrame([(None, None, "t", 0, 5, NOON)], schemas.CHANGE_RECORD)
    row = parse_envelope(df).collect()[0]
    assert (row["offset"], row["op"]) == (5, None)


def test_looser_record_types_are_accepted(spark):
    value = bytearray(json.dumps(envelope(payload())).encode())
    df = spark.createDataFrame(
        [(0, 0, NOON_MS, value)], "offset long, partition long, timestamp long, value binary"
    )
    row = parse_envelope(df).collect()[0]
    assert row["op"] == "c" and row["kafka_timestamp"] is not None


def test_bronze_follows_its_contract(spark):
    out = to_bronze(records(spark, envelope(payload())))
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in schemas.BRONZE
    ]
    assert out.collect()[0]["ingested_at"] is not None
