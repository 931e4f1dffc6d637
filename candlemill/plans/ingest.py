"""The ingest job: exchange payloads into the table of trades, each trade once.

``spark-submit ... -m candlemill.plans.ingest --payloads PATH --table PATH``
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.inserts import normalize_trades
from ..session import get_session, prepared
from ..sources.tables import insert_if_absent

# What an exchange reports; all but the id may come as text.
PAYLOADS = (
    "id long, price string, qty string, quoteQty string, isBuyerMaker boolean, time long, "
    "symbol string"
)


def ingest(payloads: DataFrame, table: str, *, table_format: str = "parquet") -> dict[str, int]:
    """Normalise payloads and insert the trades that the table lacks.

    Returns how many payloads were ``read``, ``rejected`` for a column that must not be null,
    and ``inserted``; the rest were in the table already, or repeated.
    """
    prepared(payloads.sparkSession)
    seen, fit = Observation(), Observation()
    counted = payloads.observe(seen, F.count(F.lit(1)).alias("rows"))
    trades = normalize_trades(counted, F.col("symbol"))
    trades = trades.observe(fit, F.count(F.lit(1)).alias("rows"))
    inserted = insert_if_absent(trades, table, table_format=table_format)
    read = seen.get.get("rows", 0)
    return {"read": read, "rejected": read - fit.get.get("rows", 0), "inserted": inserted}


def main(argv: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser(description="Insert exchange payloads that are new.")
    parser.add_argument("--payloads", required=True, help="files with one payload per row")
    parser.add_argument("--format", default="json")
    parser.add_argument("--table", required=True)
    args = parser.parse_args(argv)
    spark = get_session()
    counts = ingest(spark.read.format(args.format).schema(PAYLOADS).load(args.payloads), args.table)
    print(", ".join(f"{name}: {n}" for name, n in counts.items()))
    return counts


if __name__ == "__main__":
    main()
