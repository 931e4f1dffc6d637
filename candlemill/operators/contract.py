"""Contracts applied to data: column order, types and required values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def missing_required(schema: StructType) -> Column:
    """True for a row that lacks a value the contract requires."""
    lacking = [F.col(f.name).isNull() for f in schema if not f.nullable]
    return reduce(or_, lacking, F.lit(False))


def conform(
    df: DataFrame,
    schema: StructType,
    *,
    carry: Sequence[str] = (),
    metrics: str | Observation | None = None,
) -> DataFrame:
    """The contract's columns in order and cast, without rows that lack a required value.

    ``carry`` keeps further columns behind the contract's. ``metrics`` counts the rows seen
    and rejected during the same pass: a name (shown in a stream's progress) or an
    ``Observation`` (for a batch).
    """
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing from the input: {', '.join(absent)}")
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], *carry)
    rejected = missing_required(schema)
    if metrics is not None:
        typed = typed.observe(
            metrics,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(rejected).alias("rejected"),
        )
    if all(f.nullable for f in schema):
        return typed
    return typed.filter(~rejected)
