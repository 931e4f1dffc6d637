"""Helpers shared by the operators: settled tables, row addresses, words and their hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.sources.scratch import scratch_dir

# Returns freed memory to the system; only the GNU C library has it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

ARROW_BYTES = 8 << 20  # of an Arrow batch between the JVM and a Python worker
ROW_BITS = 16  # rows of one Arrow batch, at most 65,536


def shipped(spark: SparkSession) -> SparkSession:
    """The session, whose Python workers can import this package and get batches of few MB."""
    context = spark.sparkContext
    if not getattr(context, "_candlemill", False):
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="candlemill-code-"), "candlemill.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))  # Spark itself copies it to the executors
        context._candlemill = True
    # Batches by size instead of rows, as texts may be long.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` written to the shared scratch folder and read back.

    Cuts the lineage: a lost executor neither repeats the work nor changes generated names.
    """
    path = scratch_dir(shipped(df.sparkSession), purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_IDS = 2_000_000  # ids (8 bytes each) that are broadcast; above it Spark decides


def without(docs: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id ``gone`` (a settled column ``_gone`` of ids) has.

    Rows without an id always stay. A list of few ids goes to the tasks, so that the texts
    need not be shuffled; beyond ``BROADCAST_IDS`` Spark joins as it sees fit.
    """
    few = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, docs[id_col] == gone["_gone"], "left_anti")


def keyed(docs: DataFrame, id_col: str, below: bool) -> tuple[DataFrame, str]:
    """``docs`` and the name of a column by which rows without an id can be named as well.

    Where no id is null that is ``id_col`` and nothing is written. Else a column is added, whose
    name no other has: the id, and for rows without one a key of their own, below all ids or
    above all of them. Only those rows are settled, so that their keys stay. Where the ids leave
    no room for a key, it is null.
    """
    ids = F.col(id_col).cast("bigint")
    known = docs.agg(F.min(ids).alias("low"), F.max(ids).alias("high"), F.count_if(F.col(id_col).isNull()).alias("unnamed")).first()
    if not known.unnamed:
        return docs, id_col
    key = "_key"
    while key.lower() in map(str.lower, docs.columns):
        key += "_"
    number = F.monotonically_increasing_id() + 1
    edge = F.lit(known.low if below else known.high).cast("bigint")
    edge = F.coalesce(edge, F.lit(0).cast("bigint"))
    own = F.try_subtract(edge, number) if below else F.try_add(edge, number)
    unnamed = settled(docs.filter(F.col(id_col).isNull()).withColumn(key, own), "rows-without-id")
    return docs.filter(F.col(id_col).isNotNull()).withColumn(key, ids).unionByName(unnamed), key


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``doc_id`` and ``text`` (null: empty), in an order that a retry repeats.

    Row addresses are places in Arrow batches, so a task that runs again has to meet its
    rows in the same order, wherever they were shuffled from.
    """
    shipped(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    pairs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    return pairs.sortWithinPartitions("doc_id")


def batch_ids() -> Iterator[int]:
    """Numbers for the batches of this task, unique over all tasks of the stage."""
    context = TaskContext.get()
    first = (context.partitionId() if context else 0) << 26
    return iter(range(first, first + (1 << 26)))


def released() -> None:
    """Give unused memory back: Python workers live on from task to task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def pieces(batches: Iterator[pa.RecordBatch], max_bytes: int = 24 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the text of each has at most about ``max_bytes`` bytes.

    A single longer text stays whole, as a batch of its own.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and (total + size > max_bytes or i - start >= 1 << ROW_BITS):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)
    released()


def text_bytes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes (A-Z lower-cased if asked), and where each starts."""
    texts = pa.array(texts) if not isinstance(texts, pa.Array) else texts
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    # (The library's own function for this reads sliced arrays wrongly.)
    return data | (((data >= 65) & (data <= 90)).view(np.uint8) << 5) if lower else data, ends - ends[0]


_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, step: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), step, np.uint64)]))


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span ``data[start:end]``; equal bytes, equal hash."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(starts), np.uint64)
        lengths = ends - starts
        # Horner's rule over all spans at once; the few long ones go on alone.
        live = np.arange(len(starts))
        k = 0
        while len(live):
            total[live] = total[live] * _STEP + _BYTE[data[starts[live] + k]]
            k += 1
            live = live[lengths[live] > k]
        return mixed(total + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the number of words of each text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[doc_starts] = True  # a word never crosses two texts
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    bounds = np.searchsorted(starts, doc_starts)
    return starts, ends, np.diff(bounds)


def ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each counted item its owner, and its number within the owner."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - np.repeat(first, counts)
