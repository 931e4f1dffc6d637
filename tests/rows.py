"""Small literal inputs."""

import json
from datetime import datetime, timedelta, timezone

from candlemill.schemas import BRONZE, CHANGE_RECORD

NOON = datetime(2024, 6, 3, 12, 0, tzinfo=timezone.utc)
NOON_MS = int(NOON.timestamp() * 1000)

TRADE = (
    "trade_id long, symbol string, price double, quantity double, quote_qty double, "
    "is_buyer_maker boolean, side string, trade_time timestamp"
)


def payload(trade_id=1, symbol="ADAEUR", price=12.5, quantity=4.0, maker=False, **more):
    trade = {  # fixed values: the payload's keys
        "trade_id": trade_id,
        "symbol": symbol,
        "price": price,
        "quantity": quantity,
        "quote_qty": price * quantity if isinstance(price, float) else None,
        "is_buyer_maker": maker,
        "trade_time": NOON_MS,
        "ingested_at": None,
    }
    return {**trade, **more}


def envelope(after, op="c", table="trades", lsn=907):
    # The envelope's keys.
    source = {"db": "crypto", "schema": "public", "table": table, "ts_ms": NOON_MS, "lsn": lsn}
    return {"op": op, "ts_ms": NOON_MS, "before": None, "after": after, "source": source,
            "transaction": None}


def records(spark, *values, partition=0):
    """Change records holding these envelopes (dicts) or raw texts."""
    rows = [
        (None, (v if isinstance(v, str) else json.dumps(v)).encode(), "t", partition, n, NOON)
        for n, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, CHANGE_RECORD)


def bronze(spark, *rows):
    """Bronze rows from (op, lsn, payload) or (op, lsn, payload, offset)."""
    full = []
    for n, (op, lsn, after, *offset) in enumerate(rows):
        text = after if after is None or isinstance(after, str) else json.dumps(after)
        full.append((offset[0] if offset else n, 0, NOON, op, NOON_MS, "trades", lsn, None, text,
                     NOON))
    return spark.createDataFrame(full, BRONZE)


def trades(spark, *rows):
    """Trades from (id, symbol, price, quantity, maker, seconds after noon)."""
    full = [
        (i, s, p, q, p * q, m, "sell" if m else "buy", NOON + timedelta(seconds=at))
        for i, s, p, q, m, at in rows
    ]
    return spark.createDataFrame(full, TRADE)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}
