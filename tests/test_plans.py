"""The physical plans keep the properties that matter at scale."""

from datetime import datetime

import pytest

import __spark_entry__ as entry
from candlemill.functions import latest
from candlemill.operators.candles import facets, ohlcv
from candlemill.operators.inserts import absent_from
from candlemill.operators.pressure import pressure
from candlemill.operators.ranking import ranking
from candlemill.operators.refine import refine
from candlemill.operators.reports import latest_trades, newest_rows, recent_stats
from candlemill.schemas import LAYERS
from candlemill.session import prepared


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    spark.createDataFrame([], LAYERS["silver"].physical).write.mode("overwrite").parquet(path)
    return spark.read.schema(LAYERS["silver"].physical).parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schema(text):
    return text.split("ReadSchema: struct<")[1].split(">")[0]


@pytest.mark.parametrize("every", ["minute", "hour", "day"])
def test_trades_are_hash_aggregated_before_the_first_shuffle(silver, every):
    text = plan(facets(silver, every))
    assert "SortAggregate" not in text and "Sort [" not in text
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2


def test_candles_read_only_what_they_need(silver):
    columns = read_schema(plan(ohlcv(silver)))
    assert not any(c in columns for c in ("lsn", "side", "ingested_at", "is_buyer_maker"))


@pytest.mark.parametrize("table", [pressure, ranking, recent_stats])
def test_clock_bound_reaches_the_scan(silver, table):
    text = plan(table(silver))
    assert "GreaterThanOrEqual(trade_time," in text
    assert "GreaterThanOrEqual(trade_date," in text


def test_pressure_takes_one_shuffle(silver):
    assert plan(pressure(silver)).count("Exchange") == 1


def test_operation_filter_reaches_the_bronze_scan(spark, tmp_path):
    spark.createDataFrame([], LAYERS["bronze"].schema).write.parquet(str(tmp_path / "b"))
    text = plan(refine(spark.read.parquet(str(tmp_path / "b"))))
    assert "In(op, [c,r])" in text
    assert "before" not in text.split("ReadSchema")[1]


def test_no_global_sort_for_the_newest_rows(silver):
    text = plan(latest_trades(silver.drop("trade_date")))
    assert "TakeOrderedAndProject" in text and "Exchange rangepartitioning" not in text


def test_the_table_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    held = spark.range(20_000).selectExpr("id AS trade_id", "1.0D AS price", "string(id) AS note")
    held.write.parquet(str(tmp_path / "t"))
    batch = spark.range(19_995, 20_005).selectExpr("id AS trade_id", "1.0D AS price")
    out = absent_from(batch, spark.read.parquet(str(tmp_path / "t")))
    assert out.count() == 5
    out.collect()
    final = plan(out).split("== Initial Plan ==")[0].splitlines()
    scan = next(n for n, line in enumerate(final) if "FileScan" in line)
    assert read_schema(final[scan]) == "trade_id:bigint"
    above = " ".join(final[scan - 4 : scan])
    assert "LeftSemi" in above and "hashpartitioning" not in above


def test_no_python_in_any_batch_plan(spark):
    for name, query in entry.queries().items():
        if name.startswith(("bronze_stream", "silver_stream", "stream_", "lake_", "insert_sink")):
            continue
        if name in entry._llm()[0]:
            continue
        text = plan(query(spark, "/root/testdata/sf0.001"))
        assert not any(w in text for w in ("Python", "Pandas", "CartesianProduct")), name
        assert "BroadcastNestedLoopJoin" not in text, name


def scanned_rows(df):
    """Rows the table scan of a collected query returned."""
    df.collect()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().get("numOutputRows").get().value())
        elif node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            walk(node.plan())
        for n in range(node.children().size()):
            walk(node.children().apply(n))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_time_bounds_skip_row_groups(spark, tmp_path):
    day = spark.range(0, 86_400, 1, 24).selectExpr(
        "id AS trade_id", "timestamp_seconds(1717372800 + id) AS trade_time", "'A' AS symbol",
        "1.0D AS price", "1.0D AS quantity", "1.0D AS quote_qty", "true AS is_buyer_maker",
        "'sell' AS side")
    prepared(spark)
    day.write.parquet(str(tmp_path / "t"))
    trades = spark.read.parquet(str(tmp_path / "t"))
    hour = 3600
    assert scanned_rows(pressure(trades, latest(trades), "30 MINUTES")) <= hour
    assert scanned_rows(ranking(trades, datetime(2024, 6, 4), "30 MINUTES")) <= hour
    assert scanned_rows(latest_trades(trades)) <= hour
    assert scanned_rows(newest_rows(trades, "trade_time")) <= hour
    assert scanned_rows(ohlcv(trades)) == 24 * hour
