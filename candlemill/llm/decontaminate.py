"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed is a window of words of which a fixed mask may ignore some, so it still matches where
an ignored word was replaced. Seeds of test items and of documents are joined by hash. Around
each hit the document is laid over the item word by word, and the overlap counts if enough
words agree.

A word is a run of ``[^\\x20\\x09-\\x0D]`` after lower-casing; words are compared by a 64-bit
hash. A region is min(n, ``REGION``) words of an item of n words in a row. It is a leak if at
least ``MIN_SHARE`` of its words equal the words of the document that it is laid over.

``MASKS`` hit every such region: unequal words part its equal ones into gaps, and either a gap
has four words or two gaps beside each other have two words or more (of 20 words with 4
changes, 16 words are in 5 gaps; of 15 words with 3 changes, 12 in 4). The tests try all
patterns. Only a region of 5 words is not covered; items of fewer than ``SHORT`` words are
found word for word, which for fewer than 5 words is what ``MIN_SHARE`` asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import settled, table, without

# Masks whose ignored words are so few that some window of each leaked region is equal.
MASKS = ("1111", "11011")
SHORT = 6
REGION = 20
MIN_SHARE = 0.8
# Seeds of test items that are broadcast (about 40 bytes each); above it the join shuffles.
BROADCAST_SEEDS = 1_000_000


def _hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(mask: str, at: Column) -> Column:
    kept = [F.get("words", at + k) for k, bit in enumerate(mask) if bit == "1"]
    return F.xxhash64(F.lit(mask), *kept)


def _seeds(rows: DataFrame, masks: list[str], keep: list[str]) -> DataFrame:
    """``keep`` columns, ``at`` and ``seed`` of every window of every mask."""
    last = F.size("words") - min(map(len, masks))
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    windows = rows.select(*keep, "words", F.explode(places).alias("at"))
    fits = [F.when(F.col("at") + len(m) <= F.size("words"), _seed(m, F.col("at"))) for m in masks]
    return (
        windows.select(*keep, "words", "at", F.explode(F.array(*fits)).alias("seed"))
        .filter("seed IS NOT NULL")
    )


def _region(n_words: Column) -> Column:
    return F.least(n_words, F.lit(REGION))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, one: total + one)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_share: float = MIN_SHARE,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """(doc_id, item_id, matched, region): the best region of each leaked item in a document.

    Every item that has such a region in a document is found (of at least ``MIN_SHARE``; a lower
    ``min_share`` finds those that a seed hits). Items of fewer than ``SHORT`` words are found
    only word for word. Null or empty texts and
    items match nothing. Rows that share an id are judged apart and reported together; rows
    without an id are reported under a null id, and items without one under a null item.
    An empty table gives an empty result.
    """
    items = settled(
        benchmark.select(F.col(item_col).alias("item_id"), _hashes(F.col(item_text_col)).alias("words"))
        .filter("size(words) > 0")
        .withColumn("n_words", F.size("words"))
        .withColumn("item", F.xxhash64("words")),
        "decontaminate-items",
    )
    lengths = sorted(r[0] for r in items.filter(F.col("n_words") < SHORT).select("n_words").distinct().collect())
    own = _seeds(items.filter(F.col("n_words") >= SHORT), list(MASKS), ["item", "n_words"])
    for n in lengths:
        own = own.unionByName(_seeds(items.filter(F.col("n_words") == n), ["1" * n], ["item", "n_words"]))
    own = settled(own.select("item", "n_words", "seed", F.col("at").alias("q")).distinct(), "decontaminate-seeds")
    masks = [*MASKS, *("1" * n for n in lengths)]
    texts = docs.select(F.col(id_col).alias("doc_id"), _hashes(F.col(text_col)).alias("words"))
    if own.count() <= broadcast_seeds:
        found = _seeds(texts, masks, ["doc_id"]).join(F.broadcast(own), "seed")
    else:
        # Rows are named, as ids may be null or repeated: a hit goes back to its own row only.
        texts = settled(texts.withColumn("row", F.monotonically_increasing_id()), "decontaminate-texts")
        found = (
            _seeds(texts, masks, ["row"]).select("row", "at", "seed").join(own, "seed")
            .select("row", "at", "item", "n_words", "q").distinct().join(texts, "row")
        )
    # All regions that hold the hit's first word: the item's words from ``start`` to ``end``.
    region = _region(F.col("n_words"))
    start = F.greatest(F.lit(0), F.col("q") - region + 1)
    end = F.least(F.col("n_words"), F.col("q") + region)
    # Of the document only the words below them go on from here (``missing`` are before its
    # first): Spark keeps all hits of a text in memory unless the stage ends in the
    # ``distinct``, so nothing but functions that Spark compiles may stand before it.
    found = found.withColumn("start", start).withColumn("end", end).withColumn("first", F.col("at") - F.col("q") + F.col("start"))
    there = F.least(F.col("end") - F.col("start"), F.size("words") - F.col("first"))
    laid = F.slice("words", F.col("first") + F.col("missing") + 1, there - F.col("missing"))
    hits = (
        found.withColumn("missing", F.greatest(F.lit(0), -F.col("first")))
        .select("doc_id", "item", "start", "end", "missing", laid.alias("laid"))
    )
    theirs = items.select("item", "n_words", F.col("words").alias("item_words")).distinct()
    beside = F.col("start") + F.col("missing")
    same = F.zip_with("laid", F.slice("item_words", beside + 1, F.size("laid")), lambda x, y: (x == y).cast("int"))
    needed = F.when(F.col("n_words") < SHORT, F.col("n_words")).otherwise(F.ceil(F.col("region") * min_share - 1e-9))
    # Words beyond either end of the document equal nothing.
    equal = F.concat(
        F.array_repeat(F.lit(0), F.col("missing")),
        F.col("same"),
        F.array_repeat(F.lit(0), F.col("end") - beside - F.size("same")),
    )
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(0), F.size("equal") - F.col("region")),
            lambda k: _sum(F.slice("equal", k + 1, F.col("region"))),
        )
    )
    return (
        hits.distinct().join(theirs, "item")
        .select("doc_id", "item", "start", "end", "missing", "n_words", same.alias("same"), region.alias("region"))
        .withColumn("needed", needed)
        .filter(_sum(F.col("same")) >= F.col("needed"))
        .select("doc_id", "item", "needed", "region", equal.alias("equal"))
        .select("doc_id", "item", "needed", "region", best.alias("matched"))
        .groupBy("doc_id", "item", "needed", "region")
        .agg(F.max("matched").alias("matched"))
        .filter(F.col("matched") >= F.col("needed"))  # here, so that ``best`` is found once
        # Equal items are laid once; here each gets its rows.
        .join(items.select("item", "item_id").distinct(), "item")
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("matched", "region")).alias("best"))
        .select("doc_id", "item_id", "best.matched", "best.region")
    )


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that hold a leak; rows without an id cannot be named and stay."""
    found = settled(leaks(docs, benchmark, id_col, **options), "decontaminate-leaks")
    gone = found.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("_gone")).distinct()
    return without(docs, id_col, settled(gone, "decontaminate-gone"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _oracle() -> str:
    """SQL by three masks of 12 words and the region around each hit; it finds fewer leaks than ``leaks``."""
    masks, span = ("111011010101", "110101101011", "101011011101"), 12
    seeds = " UNION ALL ".join(
        f"SELECT item_id, n, q, {i} AS m, [{', '.join(f'w[q + {k + 1}]' for k, b in enumerate(m) if b == '1')}] AS s "
        "FROM i, unnest(range(0, n - 11)) AS u(q) WHERE n >= 12"
        for i, m in enumerate(masks)
    )
    doc_seeds = seeds.replace("item_id, n, q", "rid, q AS p").replace("FROM i,", "FROM d,")
    return f"""
WITH i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
                  len(w) AS n FROM benchmark),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, len(w) AS n
      FROM documents),
si AS ({seeds}), sd AS ({doc_seeds}),
h AS (SELECT DISTINCT rid, item_id, p - q AS diagonal, n, least(n, {REGION}) AS r,
             greatest(0, least(q + {span // 2} - least(n, {REGION}) // 2, n - least(n, {REGION}))) AS b
      FROM sd JOIN si USING (m, s)),
v AS (SELECT doc_id, item_id, r AS region,
             len(list_filter(range(b, b + r), lambda k: diagonal + k >= 0 AND d.w[diagonal + k + 1] = i.w[k + 1])) AS matched
      FROM h JOIN d USING (rid) JOIN i USING (item_id))
SELECT doc_id, item_id, CAST(max(matched) AS INT) AS matched, CAST(any_value(region) AS INT) AS region
FROM v WHERE matched >= ceil(region * {MIN_SHARE} - 1e-9) GROUP BY doc_id, item_id"""


ORACLE = _oracle()
