"""Micro-batch progress as a table."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = (
    "name string, batch_id long, started string, input_rows long, rows_per_second double, "
    "duration_ms long, rejected long"
)


def _rows(query: StreamingQuery, after: int = -1) -> list[tuple]:
    rows = []
    for p in query.recentProgress:
        if p["batchId"] <= after:
            continue
        contract = (p["observedMetrics"] or {}).get("silver_contract")
        rate = p["processedRowsPerSecond"]
        rows.append(
            (
                p["name"],
                p["batchId"],
                p["timestamp"],
                p["numInputRows"],
                float(rate) if rate is not None else None,
                p["durationMs"].get("triggerExecution", 0),
                contract["rejected"] if contract is not None else None,
            )
        )
    return rows


def progress_frame(spark: SparkSession, *queries: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch of the queries. Spark keeps a fixed number of them
    per query (``spark.sql.streaming.numRecentProgressUpdates``); ``ProgressLog`` has all."""
    return spark.createDataFrame([r for q in queries for r in _rows(q)], PROGRESS)


class ProgressLog:
    """A table of all micro-batches, written while the queries run.

    It looks for new ones every ``poll`` seconds, far more often than Spark forgets them.
    """

    def __init__(self, spark: SparkSession, path: str, poll: float = 2.0):
        self.spark, self.path, self.poll = spark, path, poll
        self._last: dict[str, int] = {}

    def record(self, queries: Sequence[StreamingQuery]) -> None:
        """Append the micro-batches that finished since the last call."""
        new = []
        for query in queries:
            # A trigger without data repeats the number of the batch to come; it is recorded
            # once, with its rows.
            rows = [r for r in _rows(query, self._last.get(query.name, -1)) if r[3]]
            if rows:
                self._last[query.name] = max(r[1] for r in rows)
                new += rows
        if new:
            self.spark.createDataFrame(new, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def follow(self, queries: Sequence[StreamingQuery]) -> None:
        """Record until one of the queries ends; stop the others and raise its error, if any."""
        try:
            while all(query.isActive for query in queries):
                time.sleep(self.poll if len(queries) > 1 else 0.2)
                self.record(queries)
        finally:
            for query in queries:
                query.stop() if query.isActive else None
            self.record(queries)
        for query in queries:
            query.awaitTermination()

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)
