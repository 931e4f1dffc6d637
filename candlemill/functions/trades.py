"""Trade-specific expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def side_of(is_buyer_maker: Column) -> Column:
    """The aggressor's side. A buyer who was the maker was hit by a seller; an unknown maker
    counts as a buy (such rows are counted by ``operators.health.bronze_quality``)."""
    return F.when(is_buyer_maker, F.lit("sell")).otherwise(F.lit("buy"))
