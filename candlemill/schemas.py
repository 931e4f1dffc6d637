"""Contracts: the schema of every input and table, and where each table lives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_LONG, _INT, _DOUBLE = LongType(), IntegerType(), DoubleType()
_TEXT, _FLAG, _TIME, _BYTES = StringType(), BooleanType(), TimestampType(), BinaryType()


def _schema(required: tuple[str, ...] = (), **fields: DataType) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in fields.items()])


# Field names, types and order of the change feed and of the tables.
CHANGE_RECORD = _schema(
    key=_BYTES, value=_BYTES, topic=_TEXT, partition=_INT, offset=_LONG, timestamp=_TIME
)
ENVELOPE = _schema(
    before=_TEXT,
    after=_TEXT,
    op=_TEXT,
    ts_ms=_LONG,
    source=_schema(db=_TEXT, schema=_TEXT, table=_TEXT, ts_ms=_LONG, lsn=_LONG),
    transaction=_TEXT,
)
TRADE_PAYLOAD = _schema(
    required=("trade_id",),
    trade_id=_LONG,
    symbol=_TEXT,
    price=_DOUBLE,
    quantity=_DOUBLE,
    quote_qty=_DOUBLE,
    is_buyer_maker=_FLAG,
    trade_time=_LONG,
)
BRONZE = _schema(
    offset=_LONG,
    partition=_INT,
    kafka_timestamp=_TIME,
    op=_TEXT,
    event_ts_ms=_LONG,
    source_table=_TEXT,
    lsn=_LONG,
    before=_TEXT,
    after=_TEXT,
    ingested_at=_TIME,
)
SILVER = _schema(
    required=("trade_id",),
    lsn=_LONG,
    ingested_at=_TIME,
    processed_at=_TIME,
    trade_id=_LONG,
    symbol=_TEXT,
    price=_DOUBLE,
    quantity=_DOUBLE,
    quote_qty=_DOUBLE,
    is_buyer_maker=_FLAG,
    trade_time=_TIME,
    side=_TEXT,
)
OHLCV = _schema(
    candle_time=_TIME,
    symbol=_TEXT,
    open=_DOUBLE,
    high=_DOUBLE,
    low=_DOUBLE,
    close=_DOUBLE,
    volume_base=_DOUBLE,
    volume_usdt=_DOUBLE,
    num_trades=_LONG,
    computed_at=_TIME,
)
PRESSURE = _schema(
    window_time=_TIME,
    symbol=_TEXT,
    side=_TEXT,
    volume_usdt=_DOUBLE,
    num_trades=_LONG,
    avg_price=_DOUBLE,
    computed_at=_TIME,
)
RANKING = _schema(
    symbol=_TEXT,
    total_volume_usdt=_DOUBLE,
    total_trades=_LONG,
    price_low=_DOUBLE,
    price_high=_DOUBLE,
    last_price=_DOUBLE,
    price_range_pct=_DOUBLE,
    computed_at=_TIME,
)
# The operational trades table: every column is NOT NULL there.
TRADE_ROW = _schema(
    required=(
        "trade_id", "symbol", "price", "quantity", "quote_qty", "is_buyer_maker", "trade_time",
    ),
    trade_id=_LONG,
    symbol=_TEXT,
    price=_DOUBLE,
    quantity=_DOUBLE,
    quote_qty=_DOUBLE,
    is_buyer_maker=_FLAG,
    trade_time=_TIME,
)


@dataclass(frozen=True)
class Layer:
    """A table of the lake: its folder, contract, "how recent" column and date partition."""

    name: str
    subdir: str
    schema: StructType
    time_column: str
    date_column: str | None = None  # physical partition column, derived from date_of
    date_of: str | None = None
    snapshots: bool = False  # replaced as a whole by each run

    @property
    def physical(self) -> StructType:
        """The contract plus the partition column, as stored."""
        extra = [StructField(self.date_column, DateType())] if self.date_column else []
        return StructType(self.schema.fields + extra)


# Folders and layer names that readers of the tables use.
LAYERS = {
    layer.name: layer
    for layer in (
        Layer("bronze", "bronze/trades", BRONZE, "ingested_at", "ingest_date", "ingested_at"),
        Layer("silver", "silver/trades", SILVER, "ingested_at", "trade_date", "trade_time"),
        Layer("ohlcv", "gold/ohlcv", OHLCV, "computed_at", "candle_date", "candle_time", True),
        Layer("pressure", "gold/buy_sell_pressure", PRESSURE, "computed_at", snapshots=True),
        Layer("ranking", "gold/volume_ranking", RANKING, "computed_at", snapshots=True),
    )
}
