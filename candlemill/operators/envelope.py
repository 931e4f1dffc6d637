"""Change records to Bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BRONZE, ENVELOPE
from .contract import conform


def parse_envelope(records: DataFrame) -> DataFrame:
    """Flatten the JSON envelope of each change record, batch or streaming.

    Every record gives one row: what cannot be parsed (or is wrapped in another object) has
    NULL in all envelope columns. ``before`` and ``after`` stay JSON text, whether they came
    as a nested object or as an escaped string.

    The parsed struct passes through ``inline``, so a later filter on ``op`` or any other
    field stays above it and does not make Catalyst parse the JSON a second time.
    """
    parsed = records.select(
        "offset",
        "partition",
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(F.from_json(F.col("value").cast("string"), ENVELOPE))),
    )
    return parsed.select(
        "offset",
        "partition",
        "kafka_timestamp",
        "op",
        F.col("ts_ms").alias("event_ts_ms"),
        F.col("source.table").alias("source_table"),
        F.col("source.lsn").alias("lsn"),
        "before",
        "after",
    )


def to_bronze(records: DataFrame) -> DataFrame:
    """Bronze rows: the flattened envelope, unfiltered, with its arrival stamp."""
    stamped = parse_envelope(records).withColumn("ingested_at", F.current_timestamp())
    return conform(stamped, BRONZE)
