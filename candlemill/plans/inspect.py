"""Look at the lake: ``spark-submit ... -m candlemill.plans.inspect``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import LakeConfig
from ..operators.health import layer_report
from ..operators.reports import newest_rows
from ..schemas import LAYERS
from ..session import get_session
from ..sources.tables import read_layer, table_path


def lake_report(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """One row per layer of the lake: present, rows, newest time stamp."""
    tables = {
        name: (
            read_layer(spark, cfg, name) if table_path(spark, cfg, layer) else None,
            layer.time_column,
        )
        for name, layer in LAYERS.items()
    }
    return layer_report(tables, spark)


def newest(spark: SparkSession, cfg: LakeConfig, name: str, n: int = 10) -> DataFrame:
    """The newest rows of a layer, by that layer's own time column."""
    layer = LAYERS[name]
    dated = layer.date_column if layer.date_of == layer.time_column else None
    return newest_rows(read_layer(spark, cfg, name), layer.time_column, n, dated)


def require_layers(spark: SparkSession, cfg: LakeConfig, *names: str) -> None:
    """Raise if one of the layers has no data; run before a job that reads them."""
    lacking = [n for n in names if table_path(spark, cfg, LAYERS[n]) is None]
    if lacking:
        raise FileNotFoundError(f"no data yet in: {', '.join(lacking)}")


def show_lake(spark: SparkSession, cfg: LakeConfig, n: int = 10) -> None:
    """Print the report, then schema and newest rows of each layer that has data."""
    lake_report(spark, cfg).show(truncate=False)
    for name, layer in LAYERS.items():
        if table_path(spark, cfg, layer):
            print(name)
            read_layer(spark, cfg, name).printSchema()
            newest(spark, cfg, name, n).show(n, truncate=False)


if __name__ == "__main__":
    config = LakeConfig.from_env()
    show_lake(get_session(table_format=config.table_format), config)
