"""Session factory."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

# State on local disk instead of the heap, saved by its changes instead of as a whole.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Delta's session hooks, needed only when tables are kept as Delta.
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def get_session(
    app_name: str = "candlemill",
    *,
    table_format: str = "parquet",
    packages: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """The active session if there is one, else a new one; ``prepared`` either way.

    The master is never set here: ``spark-submit`` (or ``SPARK_MASTER``) names the cluster.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return prepared(active)
    builder = SparkSession.builder.appName(os.environ.get("SPARK_APP_NAME", app_name))
    if os.environ.get("SPARK_MASTER"):
        builder = builder.master(os.environ["SPARK_MASTER"])
    settings = dict(STATE_STORE)
    if table_format == "delta":
        settings |= DELTA_CONF
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    for key, value in {**settings, **(conf or {})}.items():
        builder = builder.config(key, value)
    return prepared(builder.getOrCreate())


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that all jobs rely on.

    Trade times carry no zone at the source, so buckets and dates are cut in UTC. Parquet
    timestamps are written as 64-bit values: the default 96-bit form has no statistics, and
    without them no time bound can skip a row group.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark
