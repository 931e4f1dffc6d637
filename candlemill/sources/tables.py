"""The lake's tables: reading, appending, replacing, refreshing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import LakeConfig
from ..operators.contract import conform
from ..operators.inserts import absent_from, one_per_key
from ..schemas import LAYERS, Layer
from ..session import prepared

_SNAPSHOT, _STAMP = "snapshot-", "%Y%m%dT%H%M%S%f"
_STATE = "_built_from"  # what a snapshot was built from; readers of the table skip it


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop objects (metadata calls only)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def make_dir(spark: SparkSession, path: str) -> None:
    """Create a folder, so that a stream over it can start before its first file comes."""
    fs, where = _hadoop(spark, path)
    fs.mkdirs(where)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote."""
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Finished snapshots of a table, oldest first. A snapshot is finished, and thereby
    published, once its job has written ``_SUCCESS``."""
    fs, where = _hadoop(spark, f"{path}/{_SNAPSHOT}*/_SUCCESS")
    return sorted(f.getPath().getParent().toString() for f in fs.globStatus(where) or [])


def _expired(spark: SparkSession, path: str, keep_hours: float) -> list[str]:
    """Snapshots that are neither the published one nor younger than ``keep_hours``, finished
    or left behind by a lost job."""
    fs, where = _hadoop(spark, f"{path}/{_SNAPSHOT}*")
    folders = [f.getPath().toString() for f in fs.globStatus(where) or []]
    oldest = datetime.now(timezone.utc) - timedelta(hours=keep_hours)
    published = _snapshots(spark, path)[-1:]
    stamp = f"{_SNAPSHOT}{oldest.strftime(_STAMP)}"
    return [f for f in folders if f not in published and f.rsplit("/", 1)[1] < stamp]


def table_path(spark: SparkSession, cfg: LakeConfig, layer: Layer) -> str | None:
    """Where the current data of a layer lies, or None if there is none yet."""
    path = cfg.path(layer.subdir)
    if cfg.table_format == "delta":
        return path if path_exists(spark, f"{path}/_delta_log") else None
    if layer.snapshots:
        finished = _snapshots(spark, path)
        return finished[-1] if finished else None
    return path if path_exists(spark, path) else None


def _reader(spark: SparkSession, cfg: LakeConfig, layer: Layer, *, stream: bool):
    reader = (spark.readStream if stream else spark.read).format(cfg.table_format)
    # Delta keeps its schema in its log; for files the contract saves an inference job, and
    # a stream over files cannot start without it.
    return reader if cfg.table_format == "delta" else reader.schema(layer.physical)


def read_layer(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """A whole table of the lake."""
    layer = LAYERS[name]
    path = table_path(spark, cfg, layer)
    if path is None:
        raise FileNotFoundError(f"layer {name} has no data under {cfg.path(layer.subdir)}")
    return _reader(spark, cfg, layer, stream=False).load(path)


def stream_layer(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """A table of the lake as a stream of its new rows."""
    layer = LAYERS[name]
    return _reader(spark, cfg, layer, stream=True).load(cfg.path(layer.subdir))


def register_views(spark: SparkSession, cfg: LakeConfig) -> list[str]:
    """A temporary view per existing layer, for SQL; returns their names."""
    present = [n for n, layer in LAYERS.items() if table_path(spark, cfg, layer)]
    for name in present:
        read_layer(spark, cfg, name).createOrReplaceTempView(name)
    return present


def _with_date(df: DataFrame, layer: Layer) -> DataFrame:
    if layer.date_column is None:
        return df
    return df.withColumn(layer.date_column, F.col(layer.date_of).cast("date"))


def _by_date(df: DataFrame, layer: Layer) -> DataFrame:
    """In contract form, and gathered by date before a partitioned write: otherwise each
    task would write a file into every date. Spark splits a date that is too big."""
    conformed = _with_date(conform(df, layer.schema), layer)
    return conformed.hint("rebalance", layer.date_column) if layer.date_column else conformed


def append_stream(
    df: DataFrame, cfg: LakeConfig, name: str, *, query: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Start a named query that appends to a layer; ``once`` stops when it has caught up."""
    layer = LAYERS[name]
    prepared(df.sparkSession)
    writer = (
        _with_date(df, layer)
        .writeStream.queryName(query)
        .format(cfg.table_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", cfg.path(layer.subdir))
    )
    if layer.date_column:
        writer = writer.partitionBy(layer.date_column)
    trigger = {"availableNow": True} if once else {"processingTime": cfg.trigger}
    return writer.trigger(**trigger).start()


def replace_layer(
    df: DataFrame, cfg: LakeConfig, name: str, *, built_from: DataFrame | None = None
) -> int:
    """Replace a Gold table as a whole and return the rows it now holds.

    Parquet: each run writes a new snapshot folder, which readers see only when it is
    complete, so no reader meets a half-written or missing table and a lost job leaves the
    old one in place. Superseded snapshots go once they are ``cfg.keep_hours`` old.
    ``built_from`` is a small table about the input, published together with the rows.
    """
    layer, spark = LAYERS[name], prepared(df.sparkSession)
    root = path = cfg.path(layer.subdir)
    lake_files = cfg.table_format != "delta"
    if lake_files:
        path = f"{root}/{_SNAPSHOT}{datetime.now(timezone.utc).strftime(_STAMP)}"
        if built_from is not None:
            built_from.write.parquet(f"{path}/{_STATE}")
    written = Observation()
    rows = _by_date(df, layer).observe(written, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.format(cfg.table_format)
    if layer.date_column:
        writer = writer.partitionBy(layer.date_column)
    # The snapshot's folder is new, so there is nothing to overwrite in it.
    writer = writer.mode("append") if lake_files else writer.mode("overwrite")
    writer.option("overwriteSchema", "true").save(path)
    if lake_files:
        for old in _expired(spark, root, cfg.keep_hours):
            drop_path(spark, old)
    elif built_from is not None:
        # Later than the rows: if the job is lost in between, dates are built once more.
        built_from.write.mode("overwrite").parquet(f"{root}{_STATE}")
    return written.get.get("rows", 0)


def read_built_from(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame | None:
    """What the published table was built from, if that is known."""
    layer = LAYERS[name]
    current = table_path(spark, cfg, layer)
    if current is None:
        return None
    path = f"{cfg.path(layer.subdir)}{_STATE}" if cfg.table_format == "delta" else f"{current}/{_STATE}"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def insert_if_absent(
    incoming: DataFrame,
    path: str,
    *,
    table_format: str = "parquet",
    keys: Sequence[str] = ("trade_id",),
) -> int:
    """Append the rows whose key the table lacks; return how many there were.

    For batch tables, as the operational trades table is. (The file log of a streaming sink
    hides files that others append to its folder.)
    """
    spark = prepared(incoming.sparkSession)
    if table_format == "delta" and path_exists(spark, f"{path}/_delta_log"):
        return _merge_if_absent(incoming, path, keys)
    if path_exists(spark, path):
        table = spark.read.schema(incoming.schema).format(table_format).load(path)
    else:
        table = spark.createDataFrame([], incoming.schema)
    inserted = Observation()
    (
        absent_from(incoming, table, keys)
        .observe(inserted, F.count(F.lit(1)).alias("rows"))
        .write.format(table_format)
        .mode("append")
        .save(path)
    )
    return inserted.get.get("rows", 0)


def _merge_if_absent(incoming: DataFrame, path: str, keys: Sequence[str]) -> int:
    """The same on a Delta table, safe against concurrent writers."""
    same = " AND ".join(f"held.`{key}` = new.`{key}`" for key in keys)
    merged = incoming.sparkSession.sql(
        f"MERGE INTO delta.`{path}` AS held USING {{new}} AS new ON {same} "
        "WHEN NOT MATCHED THEN INSERT *",
        new=one_per_key(incoming, keys),
    )
    return merged.collect()[0]["num_inserted_rows"]
