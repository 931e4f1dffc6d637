"""Exact deduplication by deterministic block naming.

A text (A-Z lower-cased) is cut into blocks of ``block_bytes`` bytes. All distinct blocks are
sorted, and a block's name is its place in that order, an integer. Then adjacent names are
paired, the distinct pairs are sorted and named in turn, and so on until one name is left.
Names are never hashes: two texts with as many blocks have the same last name exactly if they
are equal, so (number of blocks, name) is a text's identity, free of collisions.

Each Arrow batch names its own blocks first and sends every distinct block once, so a block
that a third of all rows share arrives once per batch and not once per row; the rows themselves
only carry integers. Rounds after the first touch only texts that still have several names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlemill.llm.common import (
    batch_ids, id_and_text, pieces, ranges, settled, table, text_bytes, without,
)

BLOCK_BYTES = 4096
_ROWS = "batch long, local int, row int, idx int, n_blocks int, doc_id long, sha string, block binary"


def _cut(block_bytes: int):
    schema = pa.schema(
        [("batch", pa.int64()), ("local", pa.int32()), ("row", pa.int32()), ("idx", pa.int32()),
         ("n_blocks", pa.int32()), ("doc_id", pa.int64()), ("sha", pa.string()), ("block", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = batch_ids()
        for batch in pieces(batches):
            data, starts = text_bytes(batch.column("text"))
            sizes = np.diff(starts)
            counts = np.maximum(1, -(-sizes // block_bytes))
            row, idx = ranges(counts)
            cuts = np.append(starts[:-1][row] + idx * block_bytes, starts[-1])
            blocks = pa.Array.from_buffers(
                pa.large_binary(), len(row), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]
            )
            local = blocks.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            first = np.zeros(len(row), bool)
            first[np.unique(local, return_index=True)[1]] = True
            whole = data.tobytes()
            shas = [hashlib.sha256(whole[a:b]).hexdigest() for a, b in zip(starts[:-1], starts[1:])]
            heads = np.where(idx == 0, row, -1)
            ids = batch.column("doc_id")
            at_head = pa.array(heads, mask=heads < 0)
            once = pa.array(np.where(first, np.arange(len(row)), -1), mask=~first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(row), next(numbers))),
                    pa.array(local.astype(np.int32)),
                    pa.array(row.astype(np.int32)),
                    pa.array(idx.astype(np.int32)),
                    pa.array(counts[row].astype(np.int32)),
                    ids.take(at_head),
                    pa.array(shas, pa.string()).take(at_head),
                    blocks.take(once).cast(pa.binary()),
                ],
                schema=schema,
            )

    return run


def _block_names(cut: DataFrame) -> DataFrame:
    """(batch, local) -> name: the place of the block in the order of all distinct blocks."""
    sent = cut.filter("block IS NOT NULL").select("batch", "local", "block")
    ordered = sent.repartition("block").sortWithinPartitions("block", "batch", "local")
    placed = ordered.withColumn("place", F.monotonically_increasing_id())
    alike = Window.partitionBy("block").orderBy("batch", "local")
    return placed.select("batch", "local", F.first("place").over(alike).alias("name"))


def _pair_names(pairs: DataFrame) -> DataFrame:
    """(a, b) -> name: the place of the pair in the order of all distinct pairs."""
    return (
        pairs.groupBy("a", "b").agg(F.lit(1).alias("one")).drop("one").sortWithinPartitions("a", "b")
        .withColumn("name", F.monotonically_increasing_id())
    )


def identities(cut: DataFrame) -> DataFrame:
    """(batch, row, n_blocks, name) for each text of ``cut``."""
    names = settled(_block_names(cut), "dedup-names")
    level = settled(
        cut.select("batch", "local", "row", "idx", "n_blocks")
        .join(names, ["batch", "local"])
        .select("batch", "row", "n_blocks", "idx", "name"),
        "dedup-level",
    )
    done = [level.filter("n_blocks = 1").drop("idx")]
    left = level.filter("n_blocks > 1")
    blocks = left.agg(F.max("n_blocks")).first()[0] or 1
    round_ = 0
    while blocks > 1:
        round_ += 1
        blocks = -(-blocks // 2)
        odd = F.col("idx") % 2 == 1
        pairs = settled(
            left.groupBy("batch", "row", "n_blocks", F.expr("idx div 2").alias("idx")).agg(
                F.max(F.when(~odd, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b"),
            ),
            "dedup-pairs",
        )
        # Both sides of the join are read from files, so a pair that very many texts share
        # can be split by Spark's skew handling.
        named = settled(_pair_names(pairs), "dedup-names")
        level = settled(
            pairs.join(named, ["a", "b"]).select("batch", "row", "n_blocks", "idx", "name"), "dedup-level"
        )
        last = F.col("n_blocks") <= 2**round_
        done.append(level.filter(last).drop("idx"))
        left = level.filter(~last)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. A null text is empty; all empty texts
    are equal. A null id counts as the smallest, so it stays only where all ids of its group
    are null, and then ``keep_id`` is null. Of repeated rows with the largest id one is marked
    ``kept``. An empty table gives an empty result.
    """
    rows = id_and_text(docs, id_col, text_col).mapInArrow(_cut(block_bytes), _ROWS)
    cut = settled(rows, "dedup-blocks")
    heads = cut.filter("idx = 0").select("batch", "row", "doc_id", "sha")
    texts = settled(identities(cut).join(heads, ["batch", "row"]), "dedup-texts")
    stay = F.max(F.struct("doc_id", "batch", "row")).alias("stay")
    groups = settled(
        texts.groupBy("n_blocks", "name").agg(stay, F.count("*").alias("group_size")), "dedup-groups"
    )
    me = (F.col("stay.batch") == F.col("batch")) & (F.col("stay.row") == F.col("row"))
    return texts.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.col("stay.doc_id").alias("keep_id"), "group_size", me.alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, columns as they were.

    Rows without an id cannot be named, so they stay. Rows that share an id stay together if
    one of them stays. Where ids repeat, of rows that are the same in every column, with an id
    or without, one is left.
    """
    found = settled(exact_dedup(docs, id_col, text_col), "dedup-found")
    kept = found.filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    gone = (
        found.filter("doc_id IS NOT NULL AND NOT kept").select(F.col("doc_id").alias("_gone"))
        .distinct().join(kept, F.col("_gone") == F.col("_kept"), "left_anti")
    )
    left = without(docs, id_col, settled(gone, "dedup-gone"))
    repeated = found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    return left.distinct() if repeated.limit(1).count() else left


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)"""
