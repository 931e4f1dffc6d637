"""Folders for intermediate tables and for the streams run by checks."""

from __future__ import annotations

import atexit
import tempfile
from uuid import uuid4

from pyspark import SparkContext
from pyspark.sql import SparkSession

_MADE: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder that the session names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of this machine. Results may
    read their scratch folders until they are used, so the folders go when the program ends,
    or earlier with ``sweep``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="candlemill-")
    if not _MADE:
        atexit.register(sweep)
    path = f"{shared.rstrip('/')}/candlemill/{purpose}-{uuid4().hex}"
    _MADE.append(path)
    return path


def sweep() -> None:
    """Delete all scratch folders of this program; results that still read them are lost."""
    jvm = SparkContext._jvm
    while _MADE and jvm is not None:
        path = _MADE.pop()
        try:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)
        except Exception as error:  # at exit the JVM may be gone; say what stays behind
            print(f"scratch folder left: {path} ({type(error).__name__})")
