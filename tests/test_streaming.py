import threading
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from rows import as_set, envelope, payload, records

from candlemill.config import LakeConfig
from candlemill.operators.envelope import to_bronze
from candlemill.operators.refine import refine
from candlemill.schemas import LAYERS, SILVER
from candlemill.sources.changes import read_changes
from candlemill.sources.tables import read_layer
from candlemill.streaming.progress import ProgressLog, progress_frame
from candlemill.streaming.queries import run_streams, start_bronze, start_silver

VALUES = [c for c in SILVER.fieldNames() if not c.endswith("ed_at")]


@pytest.fixture
def cfg(tmp_path):
    (tmp_path / "feed").mkdir()
    return LakeConfig(
        root=str(tmp_path / "lake"), checkpoints=str(tmp_path / "checkpoints"),
        feed_format="parquet", feed_path=str(tmp_path / "feed"), state_partitions=3,
    )


def deliver(spark, cfg, *trades, op="c"):
    """Add one file of change records to the feed."""
    values = [t if isinstance(t, str) else envelope(t, op=op, lsn=t["trade_id"]) for t in trades]
    records(spark, *values).coalesce(1).write.mode("append").parquet(cfg.feed_path)


def silver_ids(spark, cfg):
    return sorted(r["trade_id"] for r in read_layer(spark, cfg, "silver").collect())


def test_stream_equals_batch(spark, cfg):
    deliver(spark, cfg, *[payload(n, price=float(n)) for n in range(50)], "not json")
    deliver(spark, cfg, payload(100), op="d")
    deliver(spark, cfg, payload(101), op="r")
    run_streams(spark, cfg, once=True)
    batch = refine(to_bronze(read_changes(spark, cfg, stream=False)))
    assert read_layer(spark, cfg, "bronze").count() == 53
    assert as_set(read_layer(spark, cfg, "silver"), *VALUES) == as_set(batch, *VALUES)
    assert batch.count() == 51


def test_restart_continues_where_it_stopped(spark, cfg):
    deliver(spark, cfg, payload(1), payload(2))
    run_streams(spark, cfg, once=True)
    run_streams(spark, cfg, once=True)
    assert silver_ids(spark, cfg) == [1, 2]
    deliver(spark, cfg, payload(2, price=9.0), payload(3))
    run_streams(spark, cfg, once=True)
    assert silver_ids(spark, cfg) == [1, 2, 3]
    assert read_layer(spark, cfg, "bronze").count() == 4
    # The copy that came in a later micro-batch did not replace the first one.
    prices = as_set(read_layer(spark, cfg, "silver").filter("trade_id = 2"), "price")
    assert prices == {(12.5,)}


def test_admission_limits_each_micro_batch(spark, cfg):
    for n in range(3):
        deliver(spark, cfg, payload(n))
    limited = LakeConfig(**{**cfg.__dict__, "admission": 1})
    query = start_bronze(spark, limited, once=True)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]


@pytest.mark.parametrize(
    "options", [{"hot_key_splits": 4}, {"forget_after": "1 day"},
                {"forget_after": "1 day", "hot_key_splits": 4}],
    ids=["split", "bounded", "both"],
)
def test_variants_of_deduplication_agree(spark, cfg, options):
    cfg = LakeConfig(**{**cfg.__dict__, **options})
    deliver(spark, cfg, *[payload(n % 7 if n % 3 else 1) for n in range(90)])
    run_streams(spark, cfg, once=True)
    deliver(spark, cfg, *[payload(n) for n in range(9)])
    run_streams(spark, cfg, once=True)
    assert silver_ids(spark, cfg) == list(range(9))


def test_bounded_mode_keeps_late_trades(spark, cfg):
    """The watermark follows arrival: a trade from years ago is late, yet it is kept."""
    cfg = LakeConfig(**{**cfg.__dict__, "forget_after": "1 minute"})
    deliver(spark, cfg, payload(1, trade_time=1_800_000_000_000))
    run_streams(spark, cfg, once=True)
    deliver(spark, cfg, payload(2, trade_time=1_000_000_000_000))
    run_streams(spark, cfg, once=True)
    assert silver_ids(spark, cfg) == [1, 2]


def test_progress(spark, cfg):
    deliver(spark, cfg, payload(1), payload(2), {"trade_id": None}, "not json")
    queries = run_streams(spark, cfg, once=True)
    assert [q.name for q in queries] == ["bronze_trades", "silver_trades"]
    frame = progress_frame(spark, *queries)
    totals = frame.groupBy("name").agg(F.sum("input_rows"), F.sum("rejected"))
    assert as_set(totals, "*") == {("bronze_trades", 4, None), ("silver_trades", 4, 1)}
    assert as_set(frame.filter("input_rows > 0"), F.col("duration_ms") > 0) == {(True,)}


def test_every_micro_batch_is_recorded(spark, cfg):
    cfg = replace(cfg, admission=1)
    for n in range(24):
        deliver(spark, cfg, payload(n))
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "6")  # Spark forgets all but these
    try:
        queries = run_streams(spark, cfg, once=True)
    finally:
        spark.conf.unset(key)
    assert all(len(q.recentProgress) <= 6 for q in queries)
    log = ProgressLog(spark, cfg.progress_path).read()
    assert as_set(log.groupBy("name").agg(F.sum("input_rows")), "*") == {
        ("bronze_trades", 24), ("silver_trades", 24)}
    assert log.filter("name = 'bronze_trades'").count() == 24
    assert log.count() == log.select("name", "batch_id").distinct().count()


def test_continuous_run_ends_both_queries(spark, cfg):
    cfg = replace(cfg, trigger="1 second")
    deliver(spark, cfg, payload(1), payload(2))
    ended = []

    def watch():
        for _ in range(240):
            time.sleep(0.5)
            active = {q.name: q for q in spark.streams.active}
            rows = {n: sum(p["numInputRows"] for p in q.recentProgress) for n, q in active.items()}
            if rows.get("bronze_trades") == 2 and rows.get("silver_trades") == 2:
                ended.append("bronze")
                active["bronze_trades"].stop()
                return

    watcher = threading.Thread(target=watch)
    watcher.start()
    queries = run_streams(spark, cfg)
    watcher.join()
    assert ended and not any(q.isActive for q in queries)
    log = ProgressLog(spark, cfg.progress_path).read()
    assert as_set(log.groupBy("name").agg(F.sum("input_rows")), "*") == {
        ("bronze_trades", 2), ("silver_trades", 2)}
    assert silver_ids(spark, cfg) == [1, 2]


def test_session_settings_are_given_back(spark, cfg):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = (spark.conf.get(key, None), spark.conf.get("spark.sql.shuffle.partitions"))
    deliver(spark, cfg, payload(1))
    run_streams(spark, cfg, once=True)
    assert (spark.conf.get(key, None), spark.conf.get("spark.sql.shuffle.partitions")) == before


def test_silver_may_start_before_bronze_has_data(spark, cfg):
    cfg = LakeConfig(**{**cfg.__dict__, "trigger": "1 second"})
    silver = start_silver(spark, cfg)
    bronze = start_bronze(spark, cfg)
    try:
        assert silver.isActive and bronze.isActive
        deliver(spark, cfg, payload(1))
        bronze.processAllAvailable()
        silver.processAllAvailable()
        assert silver_ids(spark, cfg) == [1]
    finally:
        bronze.stop()
        silver.stop()


def test_silver_is_partitioned_by_trade_date(spark, cfg):
    deliver(spark, cfg, payload(1), payload(2, trade_time=0), payload(3, trade_time=None))
    run_streams(spark, cfg, once=True)
    df = read_layer(spark, cfg, "silver")
    assert df.schema.names == LAYERS["silver"].physical.names
    assert as_set(df, "trade_id", F.col("trade_date").cast("string")) == {
        (1, "2024-06-03"), (2, "1970-01-01"), (3, None)}
