"""The ``events`` test table read as trades, change records and exchange payloads.

All three are plain projections, so they work on a batch and on a stream alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import side_of

EVENTS = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, spread over the shuffle partitions.

    A file of one row group is read by one task; the records' JSON work and the Bronze write
    after it would run there too. Spread by id, an event's copies stay in one task, in order.
    """
    # A stream must be given a folder or a glob; the glob matches one file or a folder.
    events = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")
    return events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")


def _trade_columns() -> dict[str, Column]:
    quantity = F.get_json_object("props", "$.k").try_cast("int") + 1
    maker = F.col("user_id") % 2 == 0
    return {
        "trade_id": F.col("event_id"),
        "symbol": F.col("event_type"),
        "price": F.col("value"),
        "quantity": quantity.cast("double"),
        "quote_qty": F.round(F.col("value") * quantity, 2),
        "is_buyer_maker": maker,
        "trade_time": F.col("ts").cast("timestamp"),
        "side": side_of(maker),
    }


def trades_of(events: DataFrame) -> DataFrame:
    """Each event as a trade: one symbol per event type, quantity from its properties."""
    return events.select(*[c.alias(name) for name, c in _trade_columns().items()])


def changes_of(events: DataFrame) -> DataFrame:
    """Each event as the change record of its trade: inserts, snapshot rows, updates and
    deletes, some records delivered twice and some not JSON (rules of FIXTURES section 4)."""
    n = F.col("event_id")
    copies = F.when(n % 10 == 3, F.array(F.lit(0), F.lit(1_000_000))).otherwise(F.array(F.lit(0)))
    op = (
        F.when(n % 20 == 0, "u").when(n % 20 == 1, "d").when(n % 20 == 2, "r").otherwise("c")
    )
    trade = _trade_columns()
    millis = F.unix_millis(trade["trade_time"])
    after = F.struct(
        *[trade[c].alias(c) for c in trade if c not in ("trade_time", "side")],
        millis.alias("trade_time"),
    )
    source = F.struct(
        F.lit("crypto").alias("db"),
        F.lit("public").alias("schema"),
        F.lit("trades").alias("table"),
        millis.alias("ts_ms"),
        F.col("offset").alias("lsn"),
    )
    envelope = F.struct(
        F.lit(None).cast("string").alias("before"),
        after.alias("after"),
        op.alias("op"),
        millis.alias("ts_ms"),
        source.alias("source"),
    )
    value = F.when(n % 97 == 5, F.lit("not json")).otherwise(F.to_json(envelope))
    return (
        events.withColumn("copy", F.explode(copies))
        .withColumn("offset", n + F.col("copy"))
        .select(
            F.lit(None).cast("binary").alias("key"),
            value.cast("binary").alias("value"),
            F.lit("dbserver1.public.trades").alias("topic"),
            (n % 3).cast("int").alias("partition"),
            F.col("offset"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )
    )


def payloads_of(events: DataFrame) -> DataFrame:
    """Each event as an exchange would report the trade; the symbol is the request's."""
    trade = _trade_columns()
    return events.select(
        trade["trade_id"].alias("id"),
        trade["price"].cast("string").alias("price"),
        trade["quantity"].cast("string").alias("qty"),
        trade["quote_qty"].cast("string").alias("quoteQty"),
        trade["is_buyer_maker"].alias("isBuyerMaker"),
        F.unix_millis(trade["trade_time"]).alias("time"),
        trade["symbol"].alias("symbol"),
    )
