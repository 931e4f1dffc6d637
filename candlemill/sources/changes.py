"""The change feed: Kafka, or files with the same record shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import LakeConfig
from ..schemas import CHANGE_RECORD


def kafka_options(cfg: LakeConfig, *, stream: bool = True) -> dict[str, str]:
    """Options of Spark's Kafka source for this feed."""
    options = {
        "kafka.bootstrap.servers": cfg.bootstrap_servers,
        "subscribe": cfg.topic,
        "startingOffsets": cfg.starting_offsets,
        # A stream may go on after lost records; a batch that lacks some would look complete.
        "failOnDataLoss": str(cfg.fail_on_data_loss or not stream).lower(),
    }
    if stream and cfg.admission is not None:
        options["maxOffsetsPerTrigger"] = str(cfg.admission)
    return options | dict(cfg.feed_options)


def file_options(cfg: LakeConfig, *, stream: bool = True) -> dict[str, str]:
    """The same limits for a feed of files; a stream starts from all files, oldest first."""
    options = {"ignoreMissingFiles": str(stream and not cfg.fail_on_data_loss).lower()}
    if stream and cfg.admission is not None:
        options["maxFilesPerTrigger"] = str(cfg.admission)
    return options | dict(cfg.feed_options)


def read_changes(spark: SparkSession, cfg: LakeConfig, *, stream: bool = True) -> DataFrame:
    """Change records of the table, as a stream or as a batch over what is there now.

    ``feed_format`` "kafka" needs Spark's Kafka connector on the classpath; any file format
    (parquet, json, ...) reads ``feed_path``.
    """
    reader = spark.readStream if stream else spark.read
    if cfg.feed_format == "kafka":
        return reader.format("kafka").options(**kafka_options(cfg, stream=stream)).load()
    if cfg.feed_path is None:
        raise ValueError(f"feed_format {cfg.feed_format!r} needs a feed_path")
    return (
        reader.format(cfg.feed_format)
        .schema(CHANGE_RECORD)
        .options(**file_options(cfg, stream=stream))
        .load(cfg.feed_path)
    )
