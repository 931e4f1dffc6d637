"""Exchange payloads to trade rows, and which of them a table does not hold yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import epoch_millis
from ..schemas import TRADE_ROW
from .contract import conform


def normalize_trades(
    payload: DataFrame, symbol: str | Column, *, metrics: str | Observation | None = None
) -> DataFrame:
    """Trade rows from exchange payloads (id, price, qty, quoteQty as text, isBuyerMaker,
    time in epoch ms). The payload names no symbol: it comes with the request.

    Rows with a value that is missing or not a number are rejected and counted.
    """
    rows = payload.select(
        F.col("id").alias("trade_id"),
        (F.lit(symbol) if isinstance(symbol, str) else symbol).alias("symbol"),
        F.col("price").try_cast("double").alias("price"),
        F.col("qty").try_cast("double").alias("quantity"),
        F.col("quoteQty").try_cast("double").alias("quote_qty"),
        F.col("isBuyerMaker").alias("is_buyer_maker"),
        epoch_millis(F.col("time")).alias("trade_time"),
    )
    return conform(rows, TRADE_ROW, metrics=metrics)


def one_per_key(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: of several copies, the one with the smallest other values."""
    others = [F.col(c) for c in incoming.columns if c not in keys]
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*others))
    return incoming.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def absent_from(
    incoming: DataFrame, table: DataFrame, keys: Sequence[str] = ("trade_id",)
) -> DataFrame:
    """Rows of ``incoming`` whose key the table lacks, one per key.

    The usual case is a small batch against a huge table. So the table is first reduced to
    the keys that occur in the batch (a semi join: Spark broadcasts the batch's keys when
    they are small, and then the table is scanned for its key columns but never shuffled),
    and the batch is anti-joined with that. Copies within the batch are removed before each
    join, so no key is hot in either.
    """
    keys = list(keys)
    wanted = incoming.select(*keys).distinct()
    held = table.select(*keys).join(wanted, keys, "left_semi")
    return one_per_key(incoming, keys).join(held, keys, "left_anti")
