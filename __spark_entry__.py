"""

All queries read the ``events`` table, as trades or as the change records of trades
(``candlemill.sources.events``), and run over the whole of it. Time windows end at the
newest trade. Sums are rounded to 2 and means to 6 decimals, since the last bits of a
floating-point sum depend on the order of its terms; decimals are given as doubles and
audit stamps are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.config import LakeConfig
from candlemill.functions import latest, trailing
from candlemill.operators import reports
from candlemill.operators.candles import candles_of, ohlcv
from candlemill.operators.envelope import parse_envelope, to_bronze
from candlemill.operators.health import (
    bronze_quality,
    feed_messages,
    feed_offsets,
    layer_report,
    row_count,
)
from candlemill.operators.inserts import absent_from, normalize_trades
from candlemill.operators.pressure import pressure, pressure_of
from candlemill.operators.ranking import ranking, ranking_of
from candlemill.operators.refine import refine
from candlemill.plans.gold import WINDOW, run_gold, shared_facets
from candlemill.plans.ingest import ingest
from candlemill.plans.inspect import lake_report
from candlemill.session import prepared
from candlemill.sources.events import (
    changes_of,
    payloads_of,
    read_events,
    stream_events,
    trades_of,
)
from candlemill.sources.scratch import scratch_dir
from candlemill.sources.tables import read_layer, register_views
from candlemill.streaming.progress import ProgressLog
from candlemill.streaming.queries import run_streams

STAMPS = (
    "ingested_at", "processed_at", "computed_at", "ingest_date", "trade_date", "candle_date",
)
SUMS = ("volume_base", "volume_usdt", "total_volume_usdt", "buy_volume", "sell_volume")
MEANS = ("avg_price", "price_range_pct")
SYMBOL = "view"


def _comparable(df: DataFrame) -> DataFrame:
    """Without audit stamps, times without zone, floating sums and means rounded."""
    out = []
    for field in df.schema:
        column, kind = F.col(field.name), field.dataType.typeName()
        if field.name in STAMPS:
            continue
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "double" and field.name in (*SUMS, *MEANS):
            column = F.round(column, 2 if field.name in SUMS else 6)
        elif kind == "decimal":
            column = column.cast("double")
        out.append(column.alias(field.name))
    return df.select(*out)


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_of(read_events(prepared(spark), sf_dir))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_of(read_events(prepared(spark), sf_dir))


def _pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _trades(spark, sf_dir)
    return pressure(trades, latest(trades))


def _ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _trades(spark, sf_dir)
    return ranking(trades, latest(trades))


def _facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _trades(spark, sf_dir)
    return shared_facets(trades, latest(trades))


def _lake_config(spark: SparkSession, **options) -> LakeConfig:
    home = scratch_dir(prepared(spark), "lake")
    return LakeConfig(root=f"{home}/tables", checkpoints=f"{home}/checkpoints", **options)


@cache
def _streamed_once(spark: SparkSession, sf_dir: str, options: tuple) -> LakeConfig:
    cfg = _lake_config(spark, **dict(options))
    run_streams(spark, cfg, changes_of(stream_events(spark, sf_dir)), once=True)
    return cfg


def _streamed(spark: SparkSession, sf_dir: str, **options) -> LakeConfig:
    """A lake whose Bronze and Silver were filled by the two streaming queries, once per
    session and input. It is removed when the program ends."""
    return _streamed_once(prepared(spark), sf_dir, tuple(sorted(options.items())))


@cache
def _gilded_once(spark: SparkSession, sf_dir: str) -> LakeConfig:
    cfg = _streamed(spark, sf_dir)
    run_gold(spark, cfg, as_of=latest(read_layer(spark, cfg, "silver")))
    return cfg


def _gilded(spark: SparkSession, sf_dir: str) -> LakeConfig:
    """A whole lake: streamed Bronze and Silver, then all Gold tables; also as views."""
    cfg = _gilded_once(prepared(spark), sf_dir)
    register_views(spark, cfg)
    return cfg


def trades_view(spark, sf_dir):
    return _comparable(_trades(spark, sf_dir))


def _envelope_facts(bronze: DataFrame) -> DataFrame:
    """Bronze without JSON text (whose formatting is not SQL's), but with an id from it."""
    trade_id = F.get_json_object("after", "$.trade_id").cast("long")
    return _comparable(bronze.withColumn("after_id", trade_id).drop("before", "after"))


def cdc_parse(spark, sf_dir):
    return _envelope_facts(parse_envelope(_changes(spark, sf_dir)))


def bronze_stream(spark, sf_dir):
    cfg = _streamed(spark, sf_dir)
    return _envelope_facts(read_layer(spark, cfg, "bronze"))


def silver_batch(spark, sf_dir):
    return _comparable(refine(to_bronze(_changes(spark, sf_dir))))


def silver_stream(spark, sf_dir):
    cfg = _streamed(spark, sf_dir)
    return _comparable(read_layer(spark, cfg, "silver").drop("lsn"))


def silver_stream_bounded(spark, sf_dir):
    cfg = _streamed(spark, sf_dir, forget_after="1 day", hot_key_splits=4)
    return _comparable(read_layer(spark, cfg, "silver").drop("lsn"))


def stream_progress(spark, sf_dir):
    cfg = _streamed(spark, sf_dir)
    # A file counts its rows before the change records are derived from them.
    return (
        ProgressLog(spark, cfg.progress_path)
        .read()
        .groupBy("name")
        .agg(F.sum("input_rows").alias("input_rows"), F.sum("rejected").alias("rejected"))
    )


def gold_ohlcv(spark, sf_dir):
    return _comparable(ohlcv(_trades(spark, sf_dir)))


def gold_ohlcv_hour(spark, sf_dir):
    return _comparable(ohlcv(_trades(spark, sf_dir), every="hour"))


def gold_ohlcv_day(spark, sf_dir):
    return _comparable(ohlcv(_trades(spark, sf_dir), every="day"))


def gold_pressure(spark, sf_dir):
    return _comparable(_pressure(spark, sf_dir))


def gold_ranking(spark, sf_dir):
    return _comparable(_ranking(spark, sf_dir))


def shared_ohlcv(spark, sf_dir):
    return _comparable(candles_of(_facets(spark, sf_dir)))


def _recent_facets(spark, sf_dir):
    trades = _trades(spark, sf_dir)
    window = trailing(trades, WINDOW, latest(trades))
    return shared_facets(window, latest(trades)).filter("recent")


def shared_pressure(spark, sf_dir):
    return _comparable(pressure_of(_recent_facets(spark, sf_dir)))


def shared_ranking(spark, sf_dir):
    return _comparable(ranking_of(_recent_facets(spark, sf_dir)))


def latest_trades(spark, sf_dir):
    return _comparable(reports.latest_trades(_trades(spark, sf_dir)))


def latest_candles(spark, sf_dir):
    return _comparable(reports.latest_candles(ohlcv(_trades(spark, sf_dir)), SYMBOL))


def pressure_by_symbol(spark, sf_dir):
    return _comparable(reports.pressure_by_symbol(_pressure(spark, sf_dir)))


def buy_sell_pivot(spark, sf_dir):
    return _comparable(reports.buy_sell_pivot(_pressure(spark, sf_dir)))


def latest_pivot(spark, sf_dir):
    return _comparable(reports.latest_pivot(_pressure(spark, sf_dir), SYMBOL))


def ranking_report(spark, sf_dir):
    return _comparable(reports.ranking_report(_ranking(spark, sf_dir)))


def recent_stats(spark, sf_dir):
    trades = _trades(spark, sf_dir)
    return _comparable(reports.recent_stats(trades, latest(trades)))


def newest_rows(spark, sf_dir):
    trades = _trades(spark, sf_dir)
    return _comparable(reports.newest_rows(trades, "trade_time", 10))


def sql_scan(spark, sf_dir):
    """The consumer's way in: SQL text over a table path."""
    prepared(spark)
    return spark.sql(
        """
        SELECT event_type AS symbol,
               max(CASE WHEN user_id % 2 = 1 THEN value END) AS buy_high,
               max(CASE WHEN user_id % 2 = 0 THEN value END) AS sell_high,
               count(*) AS trades
        FROM parquet.`{path}`
        GROUP BY event_type
        ORDER BY symbol
        """.format(path=f"{sf_dir}/events.parquet")
    )


def normalize(spark, sf_dir):
    payloads = payloads_of(read_events(prepared(spark), sf_dir))
    return _comparable(normalize_trades(payloads, F.col("symbol")))


def insert_if_absent(spark, sf_dir):
    """The table holds all buys; every trade is delivered, twice: the sells are new."""
    trades = _trades(spark, sf_dir)
    return _comparable(absent_from(trades.unionByName(trades), trades.filter("side = 'buy'")))


def cdc_offsets(spark, sf_dir):
    return feed_offsets(_changes(spark, sf_dir))


def cdc_messages(spark, sf_dir):
    return feed_messages(_changes(spark, sf_dir))


def bronze_counts(spark, sf_dir):
    return bronze_quality(to_bronze(_changes(spark, sf_dir)))


def silver_count(spark, sf_dir):
    return row_count(refine(to_bronze(_changes(spark, sf_dir))))


def layer_rows(spark, sf_dir):
    trades = _trades(spark, sf_dir)
    changes = _changes(spark, sf_dir)
    tables = {
        "feed": (changes, "timestamp"),
        "silver": (refine(to_bronze(changes)), "trade_time"),
        "ohlcv": (ohlcv(trades), "candle_time"),
        "pressure": (pressure(trades, latest(trades)), "window_time"),
        "ranking": (None, "computed_at"),
    }
    return _comparable(layer_report(tables, spark))


def lake_layers(spark, sf_dir):
    cfg = _gilded(spark, sf_dir)
    return lake_report(spark, cfg).drop("latest_ts")


def lake_candles(spark, sf_dir):
    cfg = _gilded(spark, sf_dir)
    return _comparable(read_layer(spark, cfg, "ohlcv"))


def lake_ranking(spark, sf_dir):
    cfg = _gilded(spark, sf_dir)
    return _comparable(read_layer(spark, cfg, "ranking"))


def _llm() -> tuple[dict, dict]:
    """The text-corpus queries and their SQL; nothing where that subpackage is not installed."""
    try:
        from candlemill.llm.catalogue import ORACLE_SQL, QUERIES
    except ImportError:
        return {}, {}
    return QUERIES, ORACLE_SQL


def lake_candles_incremental(spark, sf_dir):
    """Two deliveries that share all dates; the second Gold run builds what has changed."""
    cfg = _lake_config(spark, feed_format="parquet", feed_path=scratch_dir(prepared(spark), "feed"))
    changes = _changes(spark, sf_dir)
    for part in (0, 1):
        delivery = changes.filter(F.pmod(F.col("offset"), F.lit(7)) % 2 == part)
        delivery.write.mode("append").parquet(cfg.feed_path)
        run_streams(spark, cfg, once=True)
        run_gold(spark, cfg, "ohlcv", incremental=True)
    return _comparable(read_layer(spark, cfg, "ohlcv"))


def lake_pressure(spark, sf_dir):
    _gilded(spark, sf_dir)
    return _comparable(spark.table("pressure"))


def lake_latest_trades(spark, sf_dir):
    _gilded(spark, sf_dir)
    return _comparable(reports.latest_trades(spark.table("silver")))


def lake_latest_candles(spark, sf_dir):
    _gilded(spark, sf_dir)
    return _comparable(reports.latest_candles(spark.table("ohlcv"), SYMBOL))


def lake_pivot(spark, sf_dir):
    _gilded(spark, sf_dir)
    return _comparable(reports.latest_pivot(spark.table("pressure"), SYMBOL))


def lake_ranking_report(spark, sf_dir):
    _gilded(spark, sf_dir)
    return _comparable(
        spark.sql(
            """
            SELECT symbol, total_volume_usdt, total_trades, price_low, price_high, last_price,
                   round(price_range_pct, 2) AS volatilidad_pct
            FROM ranking ORDER BY total_volume_usdt DESC, symbol
            """
        )
    )


def lake_recent_stats(spark, sf_dir):
    """The stats job at the end of a cycle, over the lake's Silver."""
    cfg = _gilded(spark, sf_dir)
    silver = read_layer(spark, cfg, "silver")
    return _comparable(reports.recent_stats(silver, latest(silver)))


def insert_sink(spark, sf_dir):
    """Three deliveries to one table: the buys, then every trade twice; the last adds none."""
    path = scratch_dir(prepared(spark), "trades")
    payloads = payloads_of(read_events(spark, sf_dir))
    deliveries = (payloads.filter("NOT isBuyerMaker"), payloads.unionByName(payloads), payloads)
    rows = [(n, *ingest(d, path).values()) for n, d in enumerate(deliveries, 1)]
    return spark.createDataFrame(rows, "delivery long, read long, rejected long, inserted long")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: minute candles of all trades."""
    return gold_ohlcv(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    return {
        "trades_view": trades_view,
        "cdc_parse": cdc_parse,
        "bronze_stream": bronze_stream,
        "bronze_quality": bronze_counts,
        "silver_batch": silver_batch,
        "silver_stream": silver_stream,
        "silver_stream_bounded": silver_stream_bounded,
        "stream_progress": stream_progress,
        "gold_ohlcv": gold_ohlcv,
        "gold_ohlcv_hour": gold_ohlcv_hour,
        "gold_ohlcv_day": gold_ohlcv_day,
        "gold_pressure": gold_pressure,
        "gold_ranking": gold_ranking,
        "shared_ohlcv": shared_ohlcv,
        "shared_pressure": shared_pressure,
        "shared_ranking": shared_ranking,
        "latest_trades": latest_trades,
        "latest_candles": latest_candles,
        "pressure_by_symbol": pressure_by_symbol,
        "buy_sell_pivot": buy_sell_pivot,
        "latest_pivot": latest_pivot,
        "ranking_report": ranking_report,
        "recent_stats": recent_stats,
        "newest_rows": newest_rows,
        "sql_scan": sql_scan,
        "normalize_trades": normalize,
        "insert_if_absent": insert_if_absent,
        "cdc_offsets": cdc_offsets,
        "cdc_messages": cdc_messages,
        "row_count": silver_count,
        "layer_report": layer_rows,
        "lake_layers": lake_layers,
        "lake_candles": lake_candles,
        "lake_ranking": lake_ranking,
        "lake_candles_incremental": lake_candles_incremental,
        "lake_pressure": lake_pressure,
        "lake_latest_trades": lake_latest_trades,
        "lake_latest_candles": lake_latest_candles,
        "lake_pivot": lake_pivot,
        "lake_ranking_report": lake_ranking_report,
        "lake_recent_stats": lake_recent_stats,
        "insert_sink": insert_sink,
        **_llm()[0],
    }


# --- SQL counterparts -------------------------------------------------------------------

_TRADES = """trades AS (
    SELECT event_id AS trade_id, event_type AS symbol, value AS price,
           CAST(TRY_CAST(props->>'$.k' AS INT) + 1 AS DOUBLE) AS quantity,
           round(value * (TRY_CAST(props->>'$.k' AS INT) + 1), 2) AS quote_qty,
           user_id % 2 = 0 AS is_buyer_maker, ts AS trade_time,
           CASE WHEN user_id % 2 = 0 THEN 'sell' ELSE 'buy' END AS side
    FROM events)"""

_CHANGES = """changes AS (
    SELECT e.event_id, e.event_id + c.shift AS "offset",
           CAST(e.event_id % 3 AS INT) AS "partition", e.ts AS kafka_timestamp,
           e.event_id % 97 <> 5 AS parsed,
           CASE WHEN e.event_id % 97 = 5 THEN NULL WHEN e.event_id % 20 = 0 THEN 'u'
                WHEN e.event_id % 20 = 1 THEN 'd' WHEN e.event_id % 20 = 2 THEN 'r'
                ELSE 'c' END AS op
    FROM events e
    JOIN (VALUES (0), (1000000)) AS c(shift) ON c.shift = 0 OR e.event_id % 10 = 3)"""

_SILVER = """silver AS (
    SELECT trade_id AS lsn, trade_id, symbol, price, quantity, quote_qty, is_buyer_maker,
           date_trunc('milliseconds', trade_time) AS trade_time, side
    FROM trades WHERE trade_id % 20 NOT IN (0, 1) AND trade_id % 97 <> 5)"""

_WINDOW = """recent AS (
    SELECT * FROM {source}
    WHERE trade_time >= (SELECT max(trade_time) FROM {source}) - INTERVAL 24 HOURS)"""

_PRESSURE = """pressure AS (
    SELECT date_trunc('minute', trade_time) AS window_time, symbol, side,
           sum(quote_qty) AS volume_usdt, count(trade_id) AS num_trades, avg(price) AS avg_price
    FROM recent GROUP BY ALL)"""

_RANKING = """ranking AS (
    SELECT symbol, sum(quote_qty) AS total_volume_usdt, count(trade_id) AS total_trades,
           min(price) AS price_low, max(price) AS price_high,
           arg_max(price, (trade_time, trade_id)) AS last_price,
           CASE WHEN min(price) <> 0 THEN (max(price) - min(price)) / min(price) * 100 END
               AS price_range_pct
    FROM recent GROUP BY symbol)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_RECENT = _with(_TRADES, _WINDOW.format(source="trades"))


def _candles(every: str, source: str = "trades") -> str:
    return f"""SELECT date_trunc('{every}', trade_time)::TIMESTAMP AS candle_time, symbol,
           arg_min(price, (trade_time, trade_id)) AS open, max(price) AS high,
           min(price) AS low, arg_max(price, (trade_time, trade_id)) AS close,
           round(sum(quantity), 2) AS volume_base, round(sum(quote_qty), 2) AS volume_usdt,
           count(trade_id) AS num_trades
    FROM {source} GROUP BY ALL"""


_PRESSURE_OUT = """SELECT window_time::TIMESTAMP AS window_time, symbol, side,
       round(volume_usdt, 2) AS volume_usdt, num_trades, round(avg_price, 6) AS avg_price
FROM pressure"""

_RANKING_OUT = """SELECT symbol, round(total_volume_usdt, 2) AS total_volume_usdt, total_trades,
       price_low, price_high, last_price, round(price_range_pct, 6) AS price_range_pct
FROM ranking"""

_SILVER_OUT = "trade_id, symbol, price, quantity, quote_qty, is_buyer_maker, trade_time, side"

_BRONZE_OUT = """SELECT "offset", "partition", kafka_timestamp, op,
       CASE WHEN parsed THEN epoch_us(kafka_timestamp) // 1000 END AS event_ts_ms,
       CASE WHEN parsed THEN 'trades' END AS source_table,
       CASE WHEN parsed THEN "offset" END AS lsn,
       CASE WHEN parsed THEN event_id END AS after_id
FROM changes"""

_PIVOT_OUT = """SELECT window_time::TIMESTAMP AS window_time, symbol,
       round(max(CASE WHEN side = 'buy' THEN volume_usdt END), 2) AS buy_volume,
       round(max(CASE WHEN side = 'sell' THEN volume_usdt END), 2) AS sell_volume
FROM pressure"""

_TRADE_OUT = """SELECT trade_id, symbol, price, quantity, quote_qty, is_buyer_maker,
       date_trunc('milliseconds', trade_time) AS trade_time FROM trades"""

# Money in hundredths, halves rounded up in integers, as a decimal rounds them.
_STATS = """, half AS (
    SELECT symbol, price, quote_qty FROM trades
    WHERE trade_time >= (SELECT max(trade_time) FROM trades) - INTERVAL 30 MINUTES),
sums AS (
    SELECT symbol, count(*) AS trades,
           CAST(sum(CAST(round(price * 1e8) AS HUGEINT)) AS HUGEINT) AS p,
           CAST(sum(CAST(round(quote_qty * 1e8) AS HUGEINT)) AS HUGEINT) AS q
    FROM half GROUP BY symbol)
SELECT symbol, trades,
       CAST((2 * p + trades * 1000000) // (2 * trades * 1000000) AS DOUBLE) / 100 AS avg_price,
       CAST((2 * q + 1000000) // 2000000 AS DOUBLE) / 100 AS volume_usdt
FROM sums"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL over the given tables."""
    silver = _with(_TRADES, _SILVER)
    changes = _with(_CHANGES)
    in_lake = _with(_TRADES, _SILVER, _WINDOW.format(source="silver"))
    pressured = f"{_RECENT}, {_PRESSURE}\n"
    ranked = f"{_RECENT}, {_RANKING}\n"
    return {
        "trades_view": f"{_with(_TRADES)} SELECT * FROM trades",
        "cdc_parse": changes + _BRONZE_OUT,
        "bronze_stream": changes + _BRONZE_OUT,
        "bronze_quality": f"""{changes} SELECT count(*) AS records,
            count(*) FILTER (op IS NULL) AS unparseable,
            count(*) FILTER (op IN ('c', 'r')) AS inserts,
            count(*) FILTER (op = 'u') AS updates, count(*) FILTER (op = 'd') AS deletes,
            CAST(0 AS BIGINT) AS without_trade_id,
            count(*) FILTER (op IN ('c', 'r') AND event_id IN
                (SELECT event_id FROM events WHERE user_id IS NULL)) AS unknown_maker,
            CAST(0 AS BIGINT) AS implausible_time
            FROM changes""",
        "silver_batch": f"{silver} SELECT lsn, {_SILVER_OUT} FROM silver",
        "silver_stream": f"{silver} SELECT {_SILVER_OUT} FROM silver",
        "silver_stream_bounded": f"{silver} SELECT {_SILVER_OUT} FROM silver",
        "stream_progress": f"""{changes}
            SELECT 'bronze_trades' AS name, CAST(count(*) AS BIGINT) AS input_rows,
                   CAST(NULL AS BIGINT) AS rejected FROM events
            UNION ALL
            SELECT 'silver_trades', count(*), CAST(0 AS BIGINT) FROM changes""",
        "gold_ohlcv": _with(_TRADES) + _candles("minute"),
        "gold_ohlcv_hour": _with(_TRADES) + _candles("hour"),
        "gold_ohlcv_day": _with(_TRADES) + _candles("day"),
        "gold_pressure": pressured + _PRESSURE_OUT,
        "gold_ranking": ranked + _RANKING_OUT,
        "shared_ohlcv": _with(_TRADES) + _candles("minute"),
        "shared_pressure": pressured + _PRESSURE_OUT,
        "shared_ranking": ranked + _RANKING_OUT,
        "latest_trades": f"""{_with(_TRADES)}
            SELECT trade_time, symbol, price, quantity, quote_qty, side FROM trades
            ORDER BY trade_time DESC, trade_id DESC LIMIT 100""",
        "latest_candles": f"""{_with(_TRADES)}, candles AS ({_candles("minute")})
            SELECT candle_time, open, high, low, close, volume_usdt, num_trades FROM candles
            WHERE symbol = '{SYMBOL}' ORDER BY candle_time DESC LIMIT 60""",
        "pressure_by_symbol": f"""{pressured} SELECT symbol, side,
            round(sum(volume_usdt), 2) AS total_volume_usdt,
            CAST(sum(num_trades) AS BIGINT) AS total_trades,
            round(avg(avg_price), 6) AS avg_price
            FROM pressure GROUP BY symbol, side ORDER BY symbol, side""",
        "buy_sell_pivot": f"{pressured} {_PIVOT_OUT} GROUP BY window_time, symbol",
        "latest_pivot": f"""{pressured} {_PIVOT_OUT} WHERE symbol = '{SYMBOL}'
            GROUP BY window_time, symbol ORDER BY window_time DESC LIMIT 60""",
        "ranking_report": f"""{ranked} SELECT symbol,
            round(total_volume_usdt, 2) AS total_volume_usdt, total_trades, price_low,
            price_high, last_price, round(price_range_pct, 2) AS volatilidad_pct
            FROM ranking ORDER BY total_volume_usdt DESC, symbol""",
        "recent_stats": _with(_TRADES) + _STATS,
        "newest_rows": f"""{_with(_TRADES)} SELECT * FROM trades
            ORDER BY trade_time DESC, trade_id, symbol LIMIT 10""",
        "sql_scan": """SELECT event_type AS symbol,
            max(CASE WHEN user_id % 2 = 1 THEN value END) AS buy_high,
            max(CASE WHEN user_id % 2 = 0 THEN value END) AS sell_high,
            count(*) AS trades FROM events GROUP BY event_type ORDER BY symbol""",
        "normalize_trades": _with(_TRADES) + _TRADE_OUT,
        "insert_if_absent": f"{_with(_TRADES)} SELECT * FROM trades WHERE side = 'sell'",
        "cdc_offsets": f"""{changes} SELECT "partition", max("offset") + 1 AS end_offset
            FROM changes GROUP BY "partition" """,
        "cdc_messages": f"""{changes} SELECT CAST(sum(e) AS BIGINT) AS messages FROM
            (SELECT max("offset") + 1 AS e FROM changes GROUP BY "partition")""",
        "row_count": f"{silver} SELECT count(*) AS rows FROM silver",
        "layer_report": f"""{_with(_TRADES, _SILVER, _CHANGES, _WINDOW.format(source="trades"))}
            SELECT 'feed' AS layer, true AS present, count(*) AS rows,
                   max(kafka_timestamp) AS latest_ts FROM changes
            UNION ALL SELECT 'silver', true, count(*), max(trade_time) FROM silver
            UNION ALL SELECT 'ohlcv', true, count(*), max(m)::TIMESTAMP FROM
                (SELECT DISTINCT date_trunc('minute', trade_time) AS m, symbol FROM trades)
            UNION ALL SELECT 'pressure', true, count(*), max(m)::TIMESTAMP FROM
                (SELECT DISTINCT date_trunc('minute', trade_time) AS m, symbol, side FROM recent)
            UNION ALL SELECT 'ranking', false, 0, NULL""",
        "lake_layers": f"""{in_lake}, {_CHANGES}
            SELECT 'bronze' AS layer, true AS present, count(*) AS rows FROM changes
            UNION ALL SELECT 'silver', true, count(*) FROM silver
            UNION ALL SELECT 'ohlcv', true, count(*) FROM
                (SELECT DISTINCT date_trunc('minute', trade_time), symbol FROM silver)
            UNION ALL SELECT 'pressure', true, count(*) FROM
                (SELECT DISTINCT date_trunc('minute', trade_time), symbol, side FROM recent)
            UNION ALL SELECT 'ranking', true, count(DISTINCT symbol) FROM recent""",
        "lake_candles": silver + _candles("minute", "silver"),
        "lake_ranking": f"{in_lake}, {_RANKING}\n{_RANKING_OUT}",
        "lake_candles_incremental": silver + _candles("minute", "silver"),
        "lake_pressure": f"{in_lake}, {_PRESSURE}\n{_PRESSURE_OUT}",
        "lake_latest_trades": f"""{silver}
            SELECT trade_time, symbol, price, quantity, quote_qty, side FROM silver
            ORDER BY trade_time DESC, trade_id DESC LIMIT 100""",
        "lake_latest_candles": f"""{silver}, candles AS ({_candles("minute", "silver")})
            SELECT candle_time, open, high, low, close, volume_usdt, num_trades FROM candles
            WHERE symbol = '{SYMBOL}' ORDER BY candle_time DESC LIMIT 60""",
        "lake_pivot": f"""{in_lake}, {_PRESSURE}\n{_PIVOT_OUT} WHERE symbol = '{SYMBOL}'
            GROUP BY window_time, symbol ORDER BY window_time DESC LIMIT 60""",
        "lake_ranking_report": f"""{in_lake}, {_RANKING}\n SELECT symbol,
            round(total_volume_usdt, 2) AS total_volume_usdt, total_trades, price_low,
            price_high, last_price, round(price_range_pct, 2) AS volatilidad_pct
            FROM ranking ORDER BY total_volume_usdt DESC, symbol""",
        "lake_recent_stats": silver + _STATS.replace("FROM trades", "FROM silver"),
        "insert_sink": f"""{_with(_TRADES)}, n AS (SELECT count(*) AS a,
                count(*) FILTER (NOT is_buyer_maker) AS b,
                count(*) FILTER (is_buyer_maker IS NULL) AS r,
                count(*) FILTER (is_buyer_maker) AS s FROM trades)
            SELECT CAST(1 AS BIGINT) AS delivery, CAST(b AS BIGINT) AS read,
                   CAST(0 AS BIGINT) AS rejected, CAST(b AS BIGINT) AS inserted FROM n
            UNION ALL SELECT 2, 2 * a, 2 * r, s FROM n
            UNION ALL SELECT 3, a, r, 0 FROM n""",
        **_llm()[1],
    }
