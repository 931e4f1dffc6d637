"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled documents is split in three. The first part gives the lexicon:
words and word beginnings that toxic documents have far more often. The second trains the
trees on a few dense features (lexicon densities, how near a second person stands, capitals,
punctuation, obfuscated spellings), the third calibrates them. Scoring is one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.boosted import Calibrated
from candlemill.llm.common import ranges, released, settled, table, text_bytes, word_spans
from candlemill.llm.quality import blocks, held_out, labelled_sample

SAMPLE = 16_384  # labelled documents that are fitted, at most
LEXICON = 4_096  # entries, at most
LEAST_DOCS, LEAST_ODDS = 3, 2.5
STEMS = (4, 5, 6)  # characters of a word's beginning
NEAR = 6  # words
FLAG = 0.5
FOLDS, HELD_OUT = 5, 0
TEXT_BLOCK = 2 << 20

# Second-person words of the languages of the corpus.
YOU = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch ihr sie tu te toi ton vous votre "
    "tú ti tus usted ustedes vos vosotros".split()
)
# Signs and digits that stand for letters.
LIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "€": "e"})
EDGE = ".,!?;:\"'()[]{}<>|#%&*“”‘’«»¿¡…—–-_/\\~^`+="
FEATURES = 16


def entries(word: str) -> list[str]:
    """What the lexicon knows a word by: the word itself, and its beginnings."""
    core = word.strip(EDGE)
    return [core, *(f"{core[:n]}*" for n in STEMS if len(core) > n)] if core else []


def plain(word: str) -> str:
    """The word as it would be without obfuscation: signs read as letters or left out."""
    read = word.translate(LIKE)
    return "".join(c for c in read if c.isalpha())


def _lexicon_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic: dict[str, list[int]] = {}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            for entry in {e for w in set(text.lower().split()) for e in entries(w)}:
                toxic.setdefault(entry, [0, 0])[1 if label else 0] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(toxic)), pa.array([v[1] for v in toxic.values()], pa.int64()), pa.array([v[0] for v in toxic.values()], pa.int64())],
            names=["entry", "toxic", "clean"],
        )


def lexicon(rows: DataFrame) -> dict[str, float]:
    """Entry -> log odds, of a sample (text, label)."""
    label = F.col("label") == 1
    toxic, clean = rows.agg(F.count(F.when(label, 1)), F.count(F.when(~label, 1))).first()
    if not toxic or not clean:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    counts = rows.mapInArrow(_lexicon_counts, "entry string, toxic long, clean long")
    found = (
        counts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= LEAST_DOCS).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "entry").limit(LEXICON)
    )
    return {r["entry"]: r["odds"] for r in found.collect()}


class Words:
    """What is known about a word: odds of the word, of a beginning, and what kind it is."""

    def __init__(self, odds: dict[str, float]):
        self.odds = odds

    def look(self, word: str) -> tuple[float, float, bool, bool, bool]:
        core = word.strip(EDGE)
        whole, stem, hidden = self.odds.get(core, 0.0), 0.0, False
        for n in STEMS:
            if len(core) > n:
                stem = max(stem, self.odds.get(f"{core[:n]}*", 0.0))
        odd = not core.isalpha() and any(c.isalpha() for c in core) and not all(c.isalpha() or c in "'’-." for c in core)
        if not whole and not core.isalpha() and core:
            read = plain(core)
            if len(read) > 2 and self.odds.get(read):
                whole, hidden = self.odds[read], True
        return whole, stem, core in YOU, odd, hidden

    def features(self, texts: pa.Array) -> np.ndarray:
        raw, starts = text_bytes(texts, lower=False)
        n = len(starts) - 1
        out = np.zeros((n, FEATURES))
        if not len(raw):
            return out
        begin, end, counts = word_spans(raw, starts)
        owner, _ = ranges(counts)
        # Words with one blank less between them than bytes: contiguous for the dictionary.
        sizes = end - begin
        edges = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.repeat(begin - edges[:-1], sizes) + np.arange(edges[-1])
        words = pa.Array.from_buffers(
            pa.large_string(), len(begin), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw[inside]))]
        ).dictionary_encode()
        which = words.indices.to_numpy(zero_copy_only=False)
        looked = [self.look(w.lower()) for w in words.dictionary.to_pylist()]
        known = np.array(looked, np.float64).reshape(-1, 5)[which] if looked else np.zeros((0, 5))
        whole, stem, you, odd, hidden = known.T
        hit = (whole > 0) | (stem > 0)
        per = np.maximum(counts, 1)

        def total(values, at=owner, size=n):
            return np.bincount(at, weights=values, minlength=size)

        best = np.maximum(whole, stem)
        places = np.flatnonzero(you)
        if len(places):
            right = np.clip(np.searchsorted(places, np.arange(len(you))), 0, len(places) - 1)
            left = np.maximum(right - 1, 0)
            here = np.arange(len(you))
            near = ((np.abs(places[right] - here) <= NEAR) & (owner[places[right]] == owner)) | (
                (np.abs(places[left] - here) <= NEAR) & (owner[places[left]] == owner)
            )
        else:
            near = np.zeros(len(you), bool)
        byte_owner = np.repeat(np.arange(n), np.diff(starts))
        upper = (raw >= 65) & (raw <= 90)
        letters = upper | (raw >= 97) & (raw <= 122) | (raw >= 128)
        caps = np.concatenate([[0], np.cumsum(upper)])
        lets = np.concatenate([[0], np.cumsum(letters)])
        shout = (caps[end] - caps[begin] == lets[end] - lets[begin]) & (lets[end] - lets[begin] > 1)
        size = np.maximum(np.diff(starts), 1)
        sign = (raw > 32) & (raw < 128) & ~letters & ~((raw >= 48) & (raw <= 57))
        top = np.zeros(n)
        np.maximum.at(top, owner, best)
        # Distinct hits.
        pair = np.unique(owner[hit].astype(np.int64) * max(len(looked), 1) + which[hit])
        distinct = np.bincount(pair // max(len(looked), 1), minlength=n) if len(pair) else np.zeros(n)
        columns = [
            total(whole > 0) / per, np.log1p(total(whole > 0)), total(stem > 0) / per, np.log1p(total(stem > 0)),
            np.log1p(distinct), total(best) / per, top, total(hit & near) / per, total(you) / per,
            total(upper, byte_owner) / size, total(shout) / per, total(raw == 33, byte_owner) / per,
            total(raw == 63, byte_owner) / per, total(sign, byte_owner) / size, total(odd) / per, total(hidden) / per,
        ]
        return np.column_stack(columns)


def _features(odds: dict[str, float], passed: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(odds)
        for batch in batches:
            at = 0
            for texts in blocks(batch.column("text"), TEXT_BLOCK):
                rows = words.features(texts)
                kept = [batch.column(c).slice(at, len(texts)) for c in passed]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * FEATURES), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([*kept, flat], names=[*passed, "features"])
                at += len(texts)
        released()

    return run


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[dict[str, float], Calibrated]:
    """The lexicon and the calibrated trees of a bounded labelled sample, equal texts once."""
    rows = labelled_sample(docs, labels, "toxic", held_out(id_col, FOLDS, HELD_OUT), sample, id_col, text_col)
    rows = settled(rows.dropDuplicates(["text"]).withColumn("part", F.pmod(F.xxhash64("text"), F.lit(10))), "toxicity-sample")
    odds = lexicon(rows.filter("part < 5").select("text", "label"))
    rest = rows.filter("part >= 5").select("text", "label", F.when(F.col("part") < 8, 0).otherwise(1).alias("fold"))
    return odds, Calibrated(rest.mapInArrow(_features(odds, ["label", "fold"]), "label int, fold int, features array<double>"))


def toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels are learned from rows that are not held out; a row without an id is held out. A
    null or empty text has zero in every feature and is scored like any other. With labels of
    one kind only, every score is the share of label 1; without labels it is 0.5. Equal texts
    score the same. An empty table gives an empty result.
    """
    odds, model = fit(docs, labels, sample, id_col, text_col)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col, FOLDS, HELD_OUT).alias("held_out"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    made = rows.mapInArrow(_features(odds, ["doc_id", "held_out"]), "doc_id long, held_out boolean, features array<double>")
    return model.score(made).withColumn("predicted", (F.col("score") >= FLAG).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
