import os
import time
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from rows import NOON, NOON_MS, as_set, payload
from test_streaming import cfg, deliver  # noqa: F401  (cfg is a fixture)

from candlemill.config import LakeConfig
from candlemill.operators.candles import ohlcv
from candlemill.operators import reports
from candlemill.operators.pressure import pressure
from candlemill.operators.ranking import ranking
from candlemill.plans import gold
from candlemill.plans.inspect import lake_report, newest, require_layers, show_lake
from candlemill.sources.tables import (
    read_layer,
    register_views,
    replace_layer,
    table_path,
)
from candlemill.schemas import LAYERS
from candlemill.streaming.queries import run_streams

DAY_MS = 24 * 3600 * 1000


def values(df, *drop):
    columns = [F.round(c, 6) if t == "double" else c for c, t in df.dtypes
               if c not in ("computed_at", *drop)]
    return as_set(df, *columns)


def fill(spark, cfg, *ids, days_back=0):
    deliver(spark, cfg, *[
        payload(n, "AB"[n % 2], float(n + 1), 1.0, n % 3 == 0,
                trade_time=NOON_MS - days_back * DAY_MS + n * 20_000)
        for n in ids
    ])
    run_streams(spark, cfg, once=True)


def test_whole_lake(spark, cfg, capsys):  # noqa: F811
    require_fails = pytest.raises(FileNotFoundError, match="bronze, silver")
    with require_fails:
        require_layers(spark, cfg, "bronze", "silver")
    assert as_set(lake_report(spark, cfg), "layer", "present", "rows") == {
        (name, False, 0) for name in LAYERS}

    fill(spark, cfg, *range(40))
    fill(spark, cfg, *range(40, 60), days_back=3)
    silver = read_layer(spark, cfg, "silver")
    rows = gold.run_gold(spark, cfg, as_of=NOON + timedelta(minutes=20))
    as_of = NOON + timedelta(minutes=20)
    for name, direct in (("ohlcv", ohlcv(silver)), ("pressure", pressure(silver, as_of)),
                         ("ranking", ranking(silver, as_of))):
        table = read_layer(spark, cfg, name)
        assert rows[name] == table.count() == direct.count()
        assert values(table, "candle_date") == values(direct)
        single = gold.run_gold(spark, cfg, name, as_of=as_of)
        assert single == {name: rows[name]}
        assert values(read_layer(spark, cfg, name), "candle_date") == values(direct)

    require_layers(spark, cfg, *LAYERS)
    report = {r["layer"]: r for r in lake_report(spark, cfg).collect()}
    assert report["bronze"]["rows"] == 60 and report["ohlcv"]["rows"] == rows["ohlcv"]
    assert all(r["latest_ts"] is not None for r in report.values())
    assert newest(spark, cfg, "ranking", 1).count() == 1
    show_lake(spark, cfg, 2)
    assert "candle_time" in capsys.readouterr().out

    assert set(register_views(spark, cfg)) == set(LAYERS)
    top = spark.sql("SELECT symbol FROM ranking ORDER BY total_volume_usdt DESC LIMIT 1")
    assert top.count() == 1
    path = table_path(spark, cfg, LAYERS["silver"])
    assert spark.sql(f"SELECT count(*) AS n FROM parquet.`{path}`").collect()[0]["n"] == 60


def same_as_full(spark, cfg, as_of=NOON):
    silver = read_layer(spark, cfg, "silver")
    assert values(read_layer(spark, cfg, "ohlcv"), "candle_date") == values(ohlcv(silver))
    assert values(read_layer(spark, cfg, "ranking")) == values(ranking(silver, as_of))
    assert values(read_layer(spark, cfg, "pressure")) == values(pressure(silver, as_of))
    return ohlcv(silver).count()


def touched(spark, cfg):
    found = gold.touched_dates(spark, cfg, gold.rows_per_date(read_layer(spark, cfg, "silver")))
    return found if found is None else {str(r[0]) for r in found.selectExpr("string(touched)").collect()}


def test_incremental_is_a_full_build_of_the_touched_dates(spark, cfg):  # noqa: F811
    fill(spark, cfg, *range(10), days_back=40)
    fill(spark, cfg, *range(10, 20), days_back=20)
    assert touched(spark, cfg) is None
    gold.run_gold(spark, cfg, as_of=NOON, incremental=True)
    same_as_full(spark, cfg)
    first = table_path(spark, cfg, LAYERS["ohlcv"])
    held = spark.read.parquet(first).count()
    assert touched(spark, cfg) == set()

    fill(spark, cfg, *range(20, 30), days_back=20)  # back-filled
    fill(spark, cfg, *range(30, 40))
    assert touched(spark, cfg) == {"2024-05-14", "2024-06-03"}
    rows = gold.run_gold(spark, cfg, as_of=NOON, incremental=True)
    assert rows["ohlcv"] == same_as_full(spark, cfg)
    assert table_path(spark, cfg, LAYERS["ohlcv"]) != first
    assert spark.read.parquet(first).count() == held  # a reader that is still on it


def test_incremental_after_an_empty_first_run(spark, cfg):  # noqa: F811
    fill(spark, cfg)
    gold.run_gold(spark, cfg, as_of=NOON, incremental=True)
    fill(spark, cfg, *range(5), days_back=40)
    gold.run_gold(spark, cfg, as_of=NOON, incremental=True)
    assert same_as_full(spark, cfg) > 0


def test_a_time_beyond_the_calendar_does_not_stop_the_job(spark, cfg):  # noqa: F811
    fill(spark, cfg, *range(4))
    deliver(spark, cfg, payload(77, "A", 2.0, 1.0, False, trade_time=NOON_MS * 1000),
            payload(78, "A", 2.0, 1.0, False, trade_time=None))
    run_streams(spark, cfg, once=True)
    for ids in ((10, 11), (12,)):
        gold.run_gold(spark, cfg, "ohlcv", incremental=True)
        candles = read_layer(spark, cfg, "ohlcv").select(F.sum("num_trades")).collect()[0][0]
        assert candles == read_layer(spark, cfg, "silver").count()
        fill(spark, cfg, *ids)


def test_rows_that_become_visible_late_are_not_missed(spark, cfg):  # noqa: F811
    fill(spark, cfg, *range(4), days_back=2)
    gold.run_gold(spark, cfg, as_of=NOON, incremental=True)
    # Stamped long before the last run, visible only now.
    late = read_layer(spark, cfg, "silver").limit(1).selectExpr(
        "lsn", "ingested_at", "processed_at - INTERVAL 9 DAYS AS processed_at",
        "999L AS trade_id", "symbol", "price", "quantity", "quote_qty", "is_buyer_maker",
        "trade_time", "side", "trade_date")
    plain = LakeConfig(root=f"{cfg.root}-late", checkpoints=cfg.checkpoints)
    read_layer(spark, cfg, "silver").write.partitionBy("trade_date").parquet(plain.path("silver/trades"))
    gold.run_gold(spark, plain, as_of=NOON, incremental=True)
    late.write.partitionBy("trade_date").mode("append").parquet(plain.path("silver/trades"))
    gold.run_gold(spark, plain, as_of=NOON, incremental=True)
    same_as_full(spark, plain)


def test_a_lost_job_leaves_the_old_table(spark, cfg, monkeypatch):  # noqa: F811
    fill(spark, cfg, *range(4))
    gold.run_gold(spark, cfg, as_of=NOON)
    before = values(read_layer(spark, cfg, "ohlcv"))
    fill(spark, cfg, *range(4, 8))
    lost = F.udf(lambda x: 1 / 0, "double")
    monkeypatch.setattr(gold, "ohlcv", lambda df: ohlcv(df).withColumn("open", lost("open")))
    with pytest.raises(Exception, match="division"):
        gold.run_gold(spark, cfg, "ohlcv", incremental=True)
    assert values(read_layer(spark, cfg, "ohlcv")) == before
    monkeypatch.undo()
    gold.run_gold(spark, cfg, as_of=NOON, incremental=True)
    same_as_full(spark, cfg)


def test_readers_see_only_finished_snapshots(spark, cfg):  # noqa: F811
    fill(spark, cfg, *range(4))
    silver = read_layer(spark, cfg, "silver")
    counts = [replace_layer(ranking(silver.limit(n), NOON), cfg, "ranking") for n in (4, 4, 1)]
    assert counts[-1] == 1
    root = cfg.path(LAYERS["ranking"].subdir)
    assert len(os.listdir(root)) == 3  # readers may be on the older ones for a day
    abandoned = f"{root}/snapshot-20200101T000000000000"
    os.makedirs(abandoned)
    replace_layer(ranking(silver.limit(1), NOON), replace(cfg, keep_hours=0.0), "ranking")
    assert len(os.listdir(root)) == 1
    unfinished = f"{root}/snapshot-99999999T000000"
    ranking(silver, NOON).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs",
                                       "false").parquet(unfinished)
    assert not os.path.exists(f"{unfinished}/_SUCCESS")
    assert read_layer(spark, cfg, "ranking").count() == 1


def test_window_prunes_silver_partitions(spark, cfg):  # noqa: F811
    fill(spark, cfg, *range(4), days_back=9)
    fill(spark, cfg, *range(4, 8))
    plan = ranking(read_layer(spark, cfg, "silver"), NOON)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trade_time,2024-06-02" in text
    assert "trade_date#" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "quantity" not in text.split("ReadSchema")[1]
    assert plan.select(F.sum("total_trades")).collect()[0][0] == 4


def test_newest_candles_prune_dates(spark, cfg):  # noqa: F811
    fill(spark, cfg, *range(4), days_back=9)
    fill(spark, cfg, *range(4, 8))
    gold.run_gold(spark, cfg, "ohlcv")
    candles = reports.latest_candles(read_layer(spark, cfg, "ohlcv"), "A", 1)
    text = candles._jdf.queryExecution().executedPlan().toString()
    assert "candle_date" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert as_set(candles, "close") == {(7.0,)}


def test_unknown_layers_are_refused(spark, cfg):  # noqa: F811
    with pytest.raises(ValueError, match="layer must be one of"):
        gold.run_gold(spark, cfg, "candles")
    with pytest.raises(FileNotFoundError, match="silver"):
        gold.run_gold(spark, cfg)


def test_command_line(spark, cfg, monkeypatch, capsys):  # noqa: F811
    fill(spark, cfg, *range(4))
    monkeypatch.setenv("DELTA_LAKE_PATH", cfg.root)
    monkeypatch.setenv("CHECKPOINT_BASE", cfg.checkpoints)
    assert gold.main(["--layer", "ranking", "--as-of", "2024-06-03T12:00:00"]) == {"ranking": 2}
    assert "ranking: 2 rows" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        gold.main(["--layer", "nothing"])


def test_as_of_without_a_zone_is_utc(spark, cfg, monkeypatch):  # noqa: F811
    day = 24 * 3600
    deliver(spark, cfg, *[payload(n, "A", 1.0, 1.0, False, trade_time=NOON_MS - 1000 * (day + at))
                          for n, at in enumerate((-7200, 7200))])
    run_streams(spark, cfg, once=True)
    monkeypatch.setenv("DELTA_LAKE_PATH", cfg.root)
    monkeypatch.setenv("CHECKPOINT_BASE", cfg.checkpoints)
    for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        try:
            gold.main(["--layer", "ranking", "--as-of", "2024-06-03T12:00"])
        finally:
            monkeypatch.setenv("TZ", "UTC")
            time.tzset()
        assert [r["total_trades"] for r in read_layer(spark, cfg, "ranking").collect()] == [1]


def test_config_from_environment():
    cfg = LakeConfig.from_env({
        "DELTA_LAKE_PATH": "s3a://x/lake/", "KAFKA_TOPIC_PREFIX": "db.public",
        "KAFKA_BOOTSTRAP_SERVERS": "k:1", "LAKE_ADMISSION": "50", "LAKE_TABLE_FORMAT": "delta"})
    assert cfg.path("silver/trades") == "s3a://x/lake/silver/trades"
    assert (cfg.topic, cfg.bootstrap_servers, cfg.admission) == ("db.public.trades", "k:1", 50)
    assert cfg.table_format == "delta" and cfg.checkpoints == "./checkpoints"
    assert cfg.single_node().admission == 2000
