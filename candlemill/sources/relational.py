"""Relational tables over JDBC. Needs the database's driver on the classpath."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table of the operational database. Filters and columns are pushed to it by Spark.

    ``split_on`` (a numeric or time column), ``bounds`` and ``splits`` read ranges of the
    table in parallel; without them one task reads it all, which suits only small tables.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split_on is not None:
        if bounds is None or splits is None:
            raise ValueError("split_on needs bounds and splits")
        reader = reader.options(
            partitionColumn=split_on,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=str(splits),
        )
    return reader.options(**(options or {})).load()
