import pytest

from candlemill.config import LakeConfig
from candlemill.session import get_session
from candlemill.sources.changes import file_options, kafka_options, read_changes
from candlemill.sources.events import EVENTS, changes_of, trades_of
from candlemill.sources.relational import read_table
from candlemill.sources.scratch import scratch_dir


def test_kafka_options():
    options = kafka_options(LakeConfig(admission=2000, feed_options={"minPartitions": "64"}))
    assert options == {
        "kafka.bootstrap.servers": "localhost:9092", "subscribe": "dbserver1.public.trades",
        "startingOffsets": "earliest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "2000", "minPartitions": "64",
    }
    assert "maxOffsetsPerTrigger" not in kafka_options(LakeConfig())


def test_file_options():
    assert file_options(LakeConfig(admission=3)) == {
        "ignoreMissingFiles": "true", "maxFilesPerTrigger": "3"}
    assert "maxFilesPerTrigger" not in file_options(LakeConfig(admission=3), stream=False)


def test_file_feed_needs_a_path(spark):
    with pytest.raises(ValueError, match="feed_path"):
        read_changes(spark, LakeConfig(feed_format="parquet"))


def test_split_reads_need_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        read_table(spark, "jdbc:x:y", "trades", split_on="trade_id")


def test_active_session_is_reused_and_set_to_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert get_session() is spark
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(f"{shared}/candlemill/x-") and one != two


def test_change_records_follow_the_rules(spark):
    events = spark.createDataFrame([], EVENTS)
    assert trades_of(events).columns[0] == "trade_id"
    ids = spark.range(200).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' AS ts", "id AS user_id", "'a' AS event_type",
        "1.0D AS value", "'{\"k\": 1}' AS props")
    records = changes_of(ids)
    assert records.count() == 220
    assert records.filter("string(value) = 'not json'").count() == 3
    assert records.filter("offset >= 1000000").count() == 20


def test_stream_of_one_row_group_is_spread(spark, tmp_path):
    """A file of one row group is read by one task; its events go on in several."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from candlemill.sources.events import stream_events

    n = 400
    table = pa.table({
        "event_id": pa.array(range(n), pa.int64()),
        "ts": pa.array([None] * n, pa.timestamp("us")),
        "user_id": pa.array(range(n), pa.int64()),
        "event_type": pa.array(["view"] * n),
        "value": pa.array([1.0] * n),
        "props": pa.array(['{"k": 1}'] * n),
    })
    pq.write_table(table, str(tmp_path / "events.parquet"), row_group_size=n)
    out = str(tmp_path / "out")
    query = (
        stream_events(spark, str(tmp_path)).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    written = spark.read.parquet(out)
    assert sorted(r.event_id for r in written.collect()) == list(range(n))
    assert written.inputFiles().__len__() > 1
