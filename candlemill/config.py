"""Where the lake lives and how its jobs run."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class LakeConfig:
    """Paths and options of one lake. Nothing here depends on the size of the cluster.

    ``root`` and ``checkpoints`` are resolved by Spark, so on a cluster they name a shared
    file system (``hdfs://``, ``s3a://``, ...), never a folder of one machine.
    """

    root: str = "./lakehouse"
    checkpoints: str = "./checkpoints"
    table: str = "trades"
    table_format: str = "parquet"  # or "delta", when its jars are on the classpath

    # Change feed: a Kafka topic, or files with the same six record columns under feed_path.
    # Default broker, topic prefix and table, as the feed is published.
    feed_format: str = "kafka"
    feed_path: str | None = None
    feed_options: Mapping[str, str] = field(default_factory=dict)
    bootstrap_servers: str = "localhost:9092"
    topic_prefix: str = "dbserver1.public"
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    # Offsets (Kafka) or files admitted per trigger; None admits everything that waits.
    admission: int | None = None

    trigger: str = "60 seconds"
    dedup_keys: tuple[str, ...] = ("trade_id",)
    # Forget a key this long after it arrived; None remembers every key for ever.
    forget_after: str | None = None
    # Spread the copies of a hot key over this many tasks before the exact deduplication.
    hot_key_splits: int = 0
    # A Gold snapshot stays this long after a newer one, for readers that are still on it.
    keep_hours: float = 24.0
    # Shuffle width of the stateful query, fixed by its first checkpoint; None: session value.
    state_partitions: int | None = None

    @property
    def topic(self) -> str:
        return f"{self.topic_prefix}.{self.table}"

    def path(self, subdir: str) -> str:
        return f"{self.root.rstrip('/')}/{subdir}"

    def checkpoint(self, query: str) -> str:
        return f"{self.checkpoints.rstrip('/')}/{query}"

    @property
    def progress_path(self) -> str:
        """Where the streams record their micro-batches."""
        return f"{self.checkpoints.rstrip('/')}/progress/{self.table}"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> "LakeConfig":
        """Settings from environment variables; unset ones keep their defaults."""
        # Variable names that deployments of this pipeline already set.
        names = {
            "root": "DELTA_LAKE_PATH",
            "checkpoints": "CHECKPOINT_BASE",
            "bootstrap_servers": "KAFKA_BOOTSTRAP_SERVERS",
            "topic_prefix": "KAFKA_TOPIC_PREFIX",
        }
        own = {
            "table_format": "LAKE_TABLE_FORMAT",
            "feed_format": "LAKE_FEED_FORMAT",
            "feed_path": "LAKE_FEED_PATH",
            "trigger": "LAKE_TRIGGER",
        }
        given = {f: env[v] for f, v in {**names, **own}.items() if env.get(v)}
        if env.get("LAKE_ADMISSION"):
            given["admission"] = int(env["LAKE_ADMISSION"])
        return cls(**given)

    def single_node(self) -> "LakeConfig":
        """The operating limits of a one-machine deployment; too small for a cluster."""
        # Admission per trigger, trigger interval, shuffle width.
        return replace(self, admission=2000, trigger="60 seconds", state_partitions=2)
