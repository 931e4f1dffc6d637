"""The Gold job: candles, pressure and ranking from Silver.

``spark-submit ... -m candlemill.plans.gold --layer ohlcv|pressure|ranking|all``
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LakeConfig
from ..functions import AsOf, trailing, trailing_floor
from ..operators.candles import MARKET, facets, ohlcv
from ..operators.pressure import pressure, pressure_of
from ..operators.ranking import ranking, ranking_of
from ..session import get_session, prepared
from ..sources.scratch import scratch_dir
from ..sources.tables import drop_path, read_built_from, read_layer, replace_layer

WINDOW = "24 HOURS"
GOLD = ("ohlcv", "pressure", "ranking")


def shared_facets(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Minute facets by side, with the trailing window told apart: the minute that the
    window's start falls into is split in two, so the window stays exact."""
    recent = F.coalesce(F.col("trade_time") >= trailing_floor(WINDOW, as_of), F.lit(False))
    return facets(silver.withColumn("recent", recent), "minute", (*MARKET, "side", "recent"))


def rows_per_date(silver: DataFrame) -> DataFrame:
    """The rows of each date partition: read from file footers, no column is opened."""
    return silver.groupBy("trade_date").agg(F.count(F.lit(1)).alias("rows"))


def touched_dates(spark: SparkSession, cfg: LakeConfig, now: DataFrame) -> DataFrame | None:
    """Trade dates (``touched``) whose Silver rows are not those the candles were built from.

    ``now`` counts the rows of each date. Silver only gains rows, so an equal count means
    equal rows; no clock is compared, and it does not matter when a row was stamped and when
    it became visible. None means that everything has to be built. The dates stay in Spark:
    a corrupt time may give one that Python's calendar lacks.
    """
    built = read_built_from(spark, cfg, "ohlcv")
    if built is None:
        return None
    built = built.select(F.col("trade_date").alias("built_date"), F.col("rows").alias("built_rows"))
    both = now.join(built, F.col("trade_date").eqNullSafe(F.col("built_date")), "full_outer")
    changed = ~F.col("rows").eqNullSafe(F.col("built_rows"))
    # Where one side lacks the date, the other names it; both are null for rows without a time.
    return both.filter(changed).select(F.coalesce("trade_date", "built_date").alias("touched"))


def _candles(
    spark: SparkSession, cfg: LakeConfig, silver: DataFrame, incremental: bool, scratch: str
) -> int:
    """Build the candles, all or those of touched dates, and publish them as one snapshot."""
    rows_per_date(silver).write.parquet(f"{scratch}/rows")
    now = spark.read.parquet(f"{scratch}/rows")
    touched = touched_dates(spark, cfg, now) if incremental else None
    if touched is None:
        return replace_layer(ohlcv(silver), cfg, "ohlcv", built_from=now)
    touched.write.parquet(f"{scratch}/touched")
    touched = spark.read.parquet(f"{scratch}/touched")

    def is_touched(column: str):
        return F.col(column).eqNullSafe(F.col("touched"))

    fresh = ohlcv(silver.join(touched, is_touched("trade_date"), "left_semi"))
    kept = read_layer(spark, cfg, "ohlcv").join(touched, is_touched("candle_date"), "left_anti")
    candles = fresh.unionByName(kept.drop("candle_date"))
    return replace_layer(candles, cfg, "ohlcv", built_from=now)


def run_gold(
    spark: SparkSession,
    cfg: LakeConfig,
    layer: str = "all",
    *,
    as_of: AsOf = None,
    incremental: bool = False,
) -> dict[str, int]:
    """Build one Gold table, or all of them. Returns the rows of each.

    The candles need the whole history; ``incremental`` aggregates only the dates of which
    Silver has got rows since, and carries the other candles over, so its result is that of
    a full build. The window's two tables read the trailing window once.
    """
    prepared(spark)
    if layer not in (*GOLD, "all"):
        raise ValueError(f"layer must be one of {', '.join(GOLD)} or all, not {layer!r}")
    silver = read_layer(spark, cfg, "silver")
    if layer == "pressure":
        return {layer: replace_layer(pressure(silver, as_of, WINDOW), cfg, layer)}
    if layer == "ranking":
        return {layer: replace_layer(ranking(silver, as_of, WINDOW), cfg, layer)}

    # Written once and read by what follows; survives the loss of executors in between.
    kept = scratch_dir(spark, "gold")
    try:
        rows = {"ohlcv": _candles(spark, cfg, silver, incremental, kept)}
        if layer == "ohlcv":
            return rows
        minutes = shared_facets(trailing(silver, WINDOW, as_of), as_of)
        minutes.drop("open", "first_tick", "volume_base").write.parquet(f"{kept}/facets")
        recent = spark.read.parquet(f"{kept}/facets").filter("recent")
        rows["pressure"] = replace_layer(pressure_of(recent), cfg, "pressure")
        rows["ranking"] = replace_layer(ranking_of(recent), cfg, "ranking")
    finally:
        drop_path(spark, kept)
    return rows


def main(argv: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser(description="Build Gold tables from Silver.")
    parser.add_argument("--layer", required=True, choices=[*GOLD, "all"])
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="end of the window")
    parser.add_argument("--incremental", action="store_true", help="only touched dates")
    args = parser.parse_args(argv)
    cfg = LakeConfig.from_env()
    spark = get_session(table_format=cfg.table_format)
    rows = run_gold(spark, cfg, args.layer, as_of=args.as_of, incremental=args.incremental)
    for name, count in rows.items():
        print(f"{name}: {count} rows")
    return rows


if __name__ == "__main__":
    main()
