"""Quality scores by nearest-neighbour voting among labelled documents.

A document is a bag of terms: its words, hashed to ``WORD_TERMS`` terms, and its form, which is
pairs of neighbouring character classes, and how many of its words, neighbouring words and
lines repeat. Terms are weighted by frequency and inverse document frequency and projected on
the leading singular vectors of a bounded sample of labelled documents (latent semantic
vectors). The sample's vectors are broadcast;
every document is compared with all of them by exact blocked cosine products, and its
``NEIGHBOURS`` nearest vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import ranges, released, spans_hash, table, text_bytes, word_spans

SAMPLE = 4096  # labelled documents that are fitted and broadcast, at most
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 8  # a neighbour's weight is its similarity to this power
ACCEPT = 0.7
BLOCK = 512  # documents per product
TEXT_BLOCK = 2 << 20  # bytes of text handled at once
ROW_BLOCK = 1024  # texts whose terms are held at once
FOLDS, HELD_OUT = 4, 2

CLASSES = 16


def _classes() -> np.ndarray:
    """The class of each byte."""
    kind = np.full(256, 15, np.uint8)  # other signs and control characters
    kind[np.arange(ord("a"), ord("z") + 1)] = 0
    kind[np.arange(ord("A"), ord("Z") + 1)] = 1
    kind[np.arange(ord("0"), ord("9") + 1)] = 2
    kind[ord(" ")], kind[ord("\n")], kind[[9, 11, 12, 13]] = 3, 4, 5
    kind[ord(".")], kind[ord(",")] = 6, 7
    kind[[ord(c) for c in "!?"]] = 8
    kind[[ord(c) for c in "|<>{}[]\\/=_~^"]] = 9
    kind[[ord(c) for c in "#$%&*@+"]] = 10
    kind[[ord(c) for c in "\"'()-:;"]] = 11
    kind[0x80:0xC0], kind[0xC0:0xE0], kind[0xE0:] = 12, 13, 14
    return kind


_KIND = _classes()
FORM_TERMS = CLASSES * CLASSES + 6
WORD_BITS = 10
WORD_TERMS = 1 << WORD_BITS
FEATURES = FORM_TERMS + WORD_TERMS


def _repeats(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each text the share of its items that came before."""
    total = np.bincount(owner, minlength=n)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    again = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[1:][again], minlength=n) / np.maximum(total, 1)


def form(texts: pa.Array) -> np.ndarray:
    """One row of term frequencies per text; zeros for an empty one."""
    data, starts = text_bytes(texts, lower=False)
    n = len(starts) - 1
    out = np.zeros((n, FEATURES), np.float32)
    if not len(data):
        return out
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    kind = _KIND[data].astype(np.int32)
    pair = kind[:-1] * CLASSES + kind[1:]
    inside = owner[1:] == owner[:-1]
    counts = np.bincount(owner[1:][inside] * CLASSES * CLASSES + pair[inside], minlength=n * CLASSES * CLASSES)
    out[:, : CLASSES * CLASSES] = counts.reshape(n, -1) / np.maximum(sizes - 1, 1)[:, None]
    begin, end, words = word_spans(data, starts)
    hashes = spans_hash(data, begin, end)
    word_owner, _ = ranges(words)
    term = word_owner * WORD_TERMS + (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    counts = np.bincount(term, minlength=n * WORD_TERMS).reshape(n, -1)
    out[:, FORM_TERMS:] = counts / np.maximum(words, 1)[:, None]
    same = (hashes[1:] == hashes[:-1]) & (word_owner[1:] == word_owner[:-1])
    beside = np.bincount(word_owner[1:][same], minlength=n) / np.maximum(words, 1)
    repeated = _repeats(hashes, word_owner, n)
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([starts[:-1][sizes > 0], breaks + 1]))
    edges = edges[edges < len(data)]
    line_owner = np.searchsorted(starts[1:], edges, side="right")
    ends = np.append(edges[1:], len(data))
    first = np.searchsorted(begin, edges)
    last = np.searchsorted(begin, ends)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * np.uint64(0x9E3779B97F4A7C15), dtype=np.uint64)])
    lines = sums[last] - sums[first]
    some = last > first
    repeated_lines = _repeats(lines[some], line_owner[some], n) if some.any() else np.zeros(n)
    for k, share in enumerate((beside, repeated, repeated_lines)):
        out[:, CLASSES * CLASSES + 2 * k] = share
        out[:, CLASSES * CLASSES + 2 * k + 1] = np.where(words > 0, 1 - share, 0)
    return out


class Model:
    """Term weights, projection, and the labelled vectors."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray, rank: int = RANK):
        seen = (terms > 0).sum(axis=0)
        self.idf = (np.log((1 + len(terms)) / (1 + seen)) + 1).astype(np.float32)
        weighted = self.weigh(terms)
        _, vectors = np.linalg.eigh(weighted.T @ weighted)
        self.project = np.ascontiguousarray(vectors[:, ::-1][:, :rank]).astype(np.float32)
        self.vectors = self._unit(weighted @ self.project)
        self.labels = labels.astype(np.float32)

    def weigh(self, terms: np.ndarray) -> np.ndarray:
        return np.sqrt(terms) * self.idf

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(length > 0, length, 1)

    def score(self, terms: np.ndarray) -> np.ndarray:
        near = min(NEIGHBOURS, len(self.labels))
        prior = float(self.labels.mean())
        out = np.full(len(terms), prior)
        asked = self._unit(self.weigh(terms) @ self.project)
        for at in range(0, len(asked), BLOCK):
            cosine = asked[at : at + BLOCK] @ self.vectors.T
            top = np.argpartition(cosine, -near, axis=1)[:, -near:]
            weight = np.maximum(np.take_along_axis(cosine, top, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            vote = (weight * self.labels[top]).sum(axis=1)
            out[at : at + BLOCK] = np.where(total > 0, vote / np.where(total > 0, total, 1), prior)
        return np.where(terms.any(axis=1), out, prior)


def blocks(texts: pa.Array, max_bytes: int = TEXT_BLOCK) -> Iterator[pa.Array]:
    """The texts in runs of at most about ``max_bytes``; a longer one alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > max_bytes:
            yield texts.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if len(texts) > start:
        yield texts.slice(start)


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of ``blocks`` of at most ``ROW_BLOCK`` texts."""
    for block in blocks(texts):
        for at in range(0, len(block), ROW_BLOCK):
            yield block.slice(at, ROW_BLOCK)


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(id_col: str, folds: int = FOLDS, out: int = HELD_OUT) -> Column:
    """Whether a row's labels must not be learned; a row without an id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == out, F.lit(True))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held: Column, sample: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(text, label) of at most ``sample`` labelled documents, those whose id hashes lowest.

    Only so many ids are ever gathered, so they can be broadcast.
    """
    known = (
        labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("_id").isNotNull() & F.col("label").isNotNull()).dropDuplicates(["_id"])
    )
    known = known.withColumn(id_col, F.col("_id")).filter(~held).select("_id", "label")
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), _text(text_col).alias("text"))
    return rows.join(F.broadcast(chosen), "_id").select("text", "label")


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> Model | None:
    """The model of a bounded labelled sample; None where there are no labels to learn."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label")
            at = 0
            for texts in _parts(batch.column("text")):
                rows = [r.tobytes() for r in form(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), label.slice(at, len(rows))], names=["terms", "label"])
                at += len(rows)

    rows = labelled_sample(docs, labels, "quality", held_out(id_col), sample, id_col, text_col)
    got = rows.mapInArrow(terms, "terms binary, label int").toArrow()
    if not got.num_rows:
        return None
    matrix = np.stack([np.frombuffer(t, np.float32) for t in got.column("terms").to_pylist()])
    order = np.lexsort(np.column_stack([matrix, got.column("label").to_numpy()]).T)  # no order of arrival
    return Model(matrix[order], got.column("label").to_numpy()[order])


def score_column(spark: SparkSession, model: Model | None, text_col: str = "text") -> Column:
    """The score of a text as a column: one pass over the rows, nothing is shuffled."""
    if model is None:
        return F.lit(0.5).cast("double")
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [shared.value.score(form(part)) for part in _parts(texts)]
        released()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scored(_text(text_col))


def quality(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels are learned from rows that are not held out. A null or empty text scores the share
    of label 1 in the sample. Without any label every score is 0.5. Null labels are not
    learned; of several labels of an id one is. Equal texts score the same. An empty table
    gives an empty result.
    """
    score = score_column(docs.sparkSession, fit(docs, labels, sample, id_col, text_col), text_col)
    scored = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def drop_rejected(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is below ``ACCEPT``; all of them without labels."""
    model = fit(docs, labels, sample, id_col, text_col)
    if model is None:
        return docs
    return docs.filter(score_column(docs.sparkSession, model, text_col) >= ACCEPT)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
