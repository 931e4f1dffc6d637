"""Reports on the state of the feed and the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TRADE_PAYLOAD
from .refine import INSERTS


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def feed_offsets(records: DataFrame) -> DataFrame:
    """The end offset of each feed partition: one past the largest offset seen. Takes
    Bronze or change records; reads their two position columns only."""
    return records.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def feed_messages(records: DataFrame) -> DataFrame:
    """Messages on the topic: the sum of the end offsets."""
    return feed_offsets(records).agg(F.sum("end_offset").alias("messages"))


# Trade times outside of these years are counted as implausible (a wrong unit, mostly); such
# trades are kept like any other.
PLAUSIBLE_YEARS = (2000, 2100)


def bronze_quality(bronze: DataFrame) -> DataFrame:
    """What Silver will make of these Bronze rows, counted in one pass."""
    first, end = (F.unix_millis(F.lit(f"{year}-01-01T00:00:00Z").cast("timestamp")) for year in PLAUSIBLE_YEARS)
    at = F.col("trade_time")
    insert = F.col("op").isin(*INSERTS)
    seen = bronze.select("op", F.inline(F.array(F.from_json("after", TRADE_PAYLOAD))))
    return seen.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("op").isNull()).alias("unparseable"),
        F.count_if(insert).alias("inserts"),
        F.count_if(F.col("op") == "u").alias("updates"),
        F.count_if(F.col("op") == "d").alias("deletes"),
        F.count_if(insert & F.col("trade_id").isNull()).alias("without_trade_id"),
        F.count_if(
            insert & F.col("trade_id").isNotNull() & F.col("is_buyer_maker").isNull()
        ).alias("unknown_maker"),
        F.count_if(insert & ((at < first) | (at >= end))).alias("implausible_time"),
    )


def layer_report(tables: dict[str, tuple[DataFrame | None, str]], spark) -> DataFrame:
    """One row per layer: does it exist, how many rows, how recent.

    ``tables`` maps a layer name to its table (None where there is none yet) and its time
    column. Each table is scanned for that one column.
    """

    def summary(name: str, table: DataFrame | None, time_column: str) -> DataFrame:
        if table is None:
            rows, newest = F.lit(0).cast("long"), F.lit(None).cast("timestamp")
            source = spark.range(1)
        else:
            rows, newest = F.count(F.lit(1)), F.max(time_column).cast("timestamp")
            source = table.agg(rows.alias("rows"), newest.alias("latest_ts"))
            rows, newest = F.col("rows"), F.col("latest_ts")
        return source.select(
            F.lit(name).alias("layer"),
            F.lit(table is not None).alias("present"),
            rows.alias("rows"),
            newest.alias("latest_ts"),
        )

    parts = [summary(name, table, column) for name, (table, column) in tables.items()]
    return reduce(DataFrame.unionByName, parts)
