"""Bronze and Silver as streaming queries, and the job that runs both."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import LakeConfig
from ..operators.envelope import to_bronze
from ..operators.refine import refine
from ..schemas import LAYERS
from ..session import STATE_STORE, prepared
from ..sources.changes import read_changes
from ..sources.tables import append_stream, make_dir, stream_layer
from .progress import ProgressLog


@contextmanager
def _state_settings(spark: SparkSession, cfg: LakeConfig) -> Iterator[None]:
    """Settings a stateful query takes over when it starts; the session gets its own back.

    Deduplication keeps a state entry per trade, far too many for the executors' heaps.
    """
    wanted = dict(STATE_STORE)
    if cfg.state_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(cfg.state_partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start_bronze(
    spark: SparkSession, cfg: LakeConfig, changes: DataFrame | None = None, *, once: bool = False
) -> StreamingQuery:
    """Append every change record to Bronze, unfiltered. No shuffle: one task per feed
    partition (or file) from source to table."""
    feed = read_changes(spark, cfg) if changes is None else changes
    return append_stream(
        to_bronze(feed),
        cfg,
        "bronze",
        query=f"bronze_{cfg.table}",
        checkpoint=cfg.checkpoint(f"bronze/{cfg.table}"),
        once=once,
    )


def start_silver(spark: SparkSession, cfg: LakeConfig, *, once: bool = False) -> StreamingQuery:
    """Append the new trades of Bronze to Silver. One shuffle, on the deduplication keys."""
    make_dir(spark, cfg.path(LAYERS["bronze"].subdir))
    trades = refine(
        stream_layer(spark, cfg, "bronze"),
        cfg.dedup_keys,
        forget_after=cfg.forget_after,
        hot_key_splits=cfg.hot_key_splits,
        metrics="silver_contract",
    )
    with _state_settings(spark, cfg):
        return append_stream(
            trades,
            cfg,
            "silver",
            query=f"silver_{cfg.table}",
            checkpoint=cfg.checkpoint(f"silver/{cfg.table}"),
            once=once,
        )


def run_streams(
    spark: SparkSession, cfg: LakeConfig, changes: DataFrame | None = None, *, once: bool = False
) -> list[StreamingQuery]:
    """Feed to Silver. Continuous: when either query ends, stops the other and returns, with
    the error of the one that failed. ``once``: brings both tables up to date and returns.

    Every micro-batch is recorded under ``cfg.progress_path`` while the queries run.
    """
    prepared(spark)
    log = ProgressLog(spark, cfg.progress_path)
    bronze = start_bronze(spark, cfg, changes, once=once)
    if once:
        log.follow([bronze])
    silver = start_silver(spark, cfg, once=once)
    log.follow([silver] if once else [bronze, silver])
    return [bronze, silver]


if __name__ == "__main__":
    from ..session import get_session

    config = LakeConfig.from_env()
    run_streams(get_session(table_format=config.table_format), config)
