import pytest
from pyspark.sql import Observation
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructType

from candlemill import schemas
from candlemill.operators.contract import conform


@pytest.mark.parametrize("name", ["before", "after", "op", "ts_ms", "source", "transaction"])
def test_envelope_has_field(name):
    assert name in schemas.ENVELOPE.fieldNames()


@pytest.mark.parametrize("name", ["db", "schema", "table", "ts_ms", "lsn"])
def test_envelope_source_has_field(name):
    source = schemas.ENVELOPE["source"].dataType
    assert isinstance(source, StructType) and name in source.fieldNames()


@pytest.mark.parametrize(
    "name, kind",
    [
        ("trade_id", LongType), ("symbol", StringType), ("price", DoubleType),
        ("quantity", DoubleType), ("quote_qty", DoubleType), ("is_buyer_maker", BooleanType),
        ("trade_time", LongType),
    ],
)
def test_trade_payload_field(name, kind):
    assert isinstance(schemas.TRADE_PAYLOAD[name].dataType, kind)


def test_silver_requires_a_trade_id_and_nothing_else():
    assert [f.name for f in schemas.SILVER if not f.nullable] == ["trade_id"]


def test_layers_have_their_time_column():
    for layer in schemas.LAYERS.values():
        assert layer.time_column in layer.schema.fieldNames()


SMALL = schemas._schema(required=("id",), id=LongType(), price=DoubleType())


def test_conform_orders_casts_and_rejects(spark):
    df = spark.createDataFrame([("1.5", 7, "x"), ("2", None, "y")], "price string, id int, z string")
    out = conform(df, SMALL)
    assert out.dtypes == [("id", "bigint"), ("price", "double")]
    assert [tuple(r) for r in out.collect()] == [(7, 1.5)]


def test_conform_counts_rejects_in_the_same_pass(spark):
    seen = Observation()
    df = spark.createDataFrame([(1, 1.0), (None, 2.0), (None, 3.0)], "id long, price double")
    assert conform(df, SMALL, metrics=seen).count() == 1
    assert seen.get == {"rows": 3, "rejected": 2}


def test_conform_carries_extra_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 9)], "id long, price double, offset long")
    assert conform(df, SMALL, carry=["offset"]).columns == ["id", "price", "offset"]


def test_conform_names_missing_columns(spark):
    with pytest.raises(ValueError, match="price"):
        conform(spark.range(1), SMALL)
