"""Filter interaction audit with sorted posting lists.

Every row gets the set of filters that it fails. A part's rows are sorted by id and cut into
segments, ranges of ids; a segment keeps one sorted posting list per filter (the places of
its failing rows) and one per mark (good, toxic). What a filter removes after others is its
list without theirs, and what they leave is all rows without their union. Both are merges of
k lists that gallop: each list leaps by doubling steps to the next id range, and a range that
no other list enters is taken as it is. Segments are disjoint, so sizes add up: Spark sums
them over all segments of a part, and the orders of the filters only look sums up.

Segments hold a bounded number of rows, whatever the size of a part: rows are dealt by ranges
of (part, id), and rows that share both by their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import released, settled, shipped, table

MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 2
FILTERS = ("A", "B", "C", "D", "E")
MARKS = ("good", "toxic")
RANGE = 1024  # entries of the leading list that one id range of a merge holds
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SIZES = "part string, filter string, before int, rows long, removed long, good long, toxic long, after long"


def text_conditions(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides alone: short, repetitive, capitals, signs."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT_PERCENT,
        "C": upper * 100 > F.length(text) * UPPER_PERCENT,
        "D": text.rlike(r"[#$%&*|]"),
    }


def failing(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """(doc_id, part, A..E, good, toxic, number): what each row fails, and its marks.

    E fails where a smaller id has the same text; a row without an id is neither smaller nor
    larger than any, and rows that share an id are no copies of each other. Texts are equal
    where their SHA-256 is. A row is good (toxic) if a row of ``labels`` with its id says so.
    """
    shipped(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text")
    )
    rows = settled(
        texts.select(
            "doc_id", "part", *(c.alias(k) for k, c in text_conditions(F.col("text")).items()),
            F.unhex(F.sha2(F.col("text"), 256)).alias("sha"), F.monotonically_increasing_id().alias("number"),
        ),
        "audit-rows",
    )
    # Only texts of several ids are joined back; all others have no smaller copy. Both sides of
    # the join are read from files, so Spark can split a text that very many rows share.
    first = settled(
        rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last").select("sha", "first"),
        "audit-copies",
    )
    known = (
        labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    marks = [F.coalesce(F.col(m), F.lit(False)).alias(m) for m in MARKS]
    return (
        rows.join(first, "sha", "left").select("doc_id", "part", *"ABCD", copy.alias("E"), "number")
        .join(known, "doc_id", "left").select("doc_id", "part", *FILTERS, *marks, "number")
    )


def _segments(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part").dictionary_encode().indices.to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
            offsets = pa.array(edges, pa.int32())
            lists = []
            for name in names:
                at = np.flatnonzero(batch.column(name).to_numpy(zero_copy_only=False))
                cuts = np.searchsorted(at, edges)
                places = at - edges[np.searchsorted(edges, at, side="right") - 1]
                lists.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(places, pa.int32())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("part").take(pa.array(edges[:-1])), pa.ListArray.from_arrays(offsets, batch.column("doc_id")), *lists],
                names=["part", "ids", *names],
            )

    return run


def posting_lists(rows: DataFrame, filters: tuple[str, ...] = FILTERS, marks: tuple[str, ...] = MARKS) -> DataFrame:
    """(part, ids, one list per filter and mark): the segments of each part.

    ``ids`` are a segment's ids in order; a posting list holds the places among them that
    fail the filter (have the mark), rising. The id of an entry ``k`` is ``ids[k]``.
    """
    names = [*filters, *marks]
    dealt = rows.select("part", "doc_id", *names, "number").repartitionByRange("part", "doc_id", "number")
    kinds = ", ".join(f"{n} array<int>" for n in names)
    return dealt.sortWithinPartitions("part", "doc_id", "number").mapInArrow(_segments(names), f"part string, ids array<bigint>, {kinds}")


def leap(sorted_list: np.ndarray, value: int, start: int) -> int:
    """The first place from ``start`` on whose entry is ``value`` or more, by doubling steps."""
    step, low = 1, start
    while start + step <= len(sorted_list) and sorted_list[start + step - 1] < value:
        low = start + step
        step *= 2
    return low + int(np.searchsorted(sorted_list[low : min(start + step, len(sorted_list))], value))


def union_size(lists: list[np.ndarray]) -> int:
    """The number of distinct entries of k sorted lists."""
    lists = sorted((x for x in lists if len(x)), key=len)
    if not lists:
        return 0
    lead, total, at = lists.pop(), 0, [0] * len(lists)
    for k in range(0, len(lead), RANGE):
        here, rest = lead[k : k + RANGE], k + RANGE < len(lead)
        # The first range begins at the beginning, the last one has no end.
        stops = [leap(x, lead[k + RANGE], a) if rest else len(x) for x, a in zip(lists, at)]
        slices = [x[a:b] for x, a, b in zip(lists, at, stops) if a < b]
        total += len(np.unique(np.concatenate([here, *slices]))) if slices else len(here)
        at = stops
    return total


def difference(entries: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """The entries of a sorted list that are in none of the k others."""
    left, at = [], [0] * len(lists)
    for k in range(0, len(entries), RANGE):
        here = entries[k : k + RANGE]
        for i, other in enumerate(lists):
            if not len(here):
                break
            begin = leap(other, here[0], at[i])
            at[i] = end = leap(other, here[-1] + 1, begin)
            if begin < end:
                near = other[begin:end]
                place = np.searchsorted(near, here)
                here = here[near[np.minimum(place, len(near) - 1)] != here]
        left.append(here)
    return np.concatenate(left) if left else entries


def merged_sizes(lists: list[np.ndarray], marks: list[np.ndarray], rows: int) -> list[tuple[int, ...]]:
    """For each filter and set of others before it: (filter, set, removed, marked ..., left after)."""
    n, out = len(lists), []
    unions = {0: 0}
    for size in range(1, n + 1):
        for chosen in combinations(range(n), size):
            unions[sum(1 << i for i in chosen)] = union_size([lists[i] for i in chosen])
    for f in range(n):
        others = [i for i in range(n) if i != f]
        for size in range(n):
            for chosen in combinations(others, size):
                before = sum(1 << i for i in chosen)
                gone = difference(lists[f], [lists[i] for i in chosen])
                marked = (len(gone) - len(difference(gone, [m])) for m in marks)
                out.append((f, before, len(gone), *marked, rows - unions[before | 1 << f]))
    return out


def _sizes(filters: tuple[str, ...], marks: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lists = [np.asarray(batch.column(name)[k].values.to_numpy(zero_copy_only=False), np.int64) for name in (*filters, *marks)]
                rows = len(batch.column("ids")[k])
                found = merged_sizes(lists[: len(filters)], lists[len(filters) :], rows)
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("part")[k].as_py()] * len(found), pa.string()),
                        pa.array([filters[f] for f in columns[0]]), pa.array(columns[1], pa.int32()),
                        pa.array([rows] * len(found), pa.int64()), *(pa.array(c, pa.int64()) for c in columns[2:]),
                    ],
                    names=["part", "filter", "before", "rows", "removed", *marks, "after"],
                )
        released()

    return run


def set_sizes(lists: DataFrame) -> DataFrame:
    """(part, filter, before, rows, removed, good, toxic, after), summed over the segments.

    ``before`` is the set of filters applied earlier (bit k: the k-th filter); ``removed`` are
    the rows that the filter then takes, ``good`` and ``toxic`` those of them that are marked,
    ``after`` the rows that are left. One row per part, filter and set.
    """
    found = lists.mapInArrow(_sizes(FILTERS, MARKS), _SIZES)
    return found.groupBy("part", "filter", "before").agg(*(F.sum(c).alias(c) for c in ("rows", "removed", *MARKS, "after")))


def audit(sizes: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the table of ``set_sizes``.

    A part's 80 sizes become one row, which all 120 orders look up; nothing else is shuffled.
    """
    n = len(FILTERS)
    steps = []
    for order in permutations(range(n)):
        name = "".join(FILTERS[i] for i in order)
        steps += [(name, k + 1, FILTERS[i], sum(1 << j for j in order[:k])) for k, i in enumerate(order)]
    spark = sizes.sparkSession
    orders = spark.createDataFrame(steps, "filter_order string, step int, filter string, before int")
    # Orders in which exactly the filters of a set come before one.
    weights = [F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]
    weight = F.element_at(F.array(*weights), F.bit_count("before") + 1)
    alone = F.when(F.col("before") == 0, F.col("removed"))
    every = [(1 << n) - 1 - (1 << i) for i in range(n)]
    last = F.when(F.element_at(F.create_map(*(F.lit(x) for f, s in zip(FILTERS, every) for x in (f, s))), F.col("filter")) == F.col("before"), F.col("removed"))
    # 16 rows for each part and filter, however large the part is.
    of_filter = sizes.groupBy("part", "filter").agg(
        F.sum(alone).alias("fails"), F.sum(last).alias("unique_fails"), F.sum(weight * F.col("removed")).alias("shapley"),
        F.collect_list(F.struct("before", "after", "removed", *MARKS)).alias("sets"),
    )
    return (
        of_filter.select("part", "filter", "fails", "unique_fails", "shapley", F.inline("sets"))
        .join(F.broadcast(orders), ["filter", "before"])
        .select(
            "part", "filter_order", "step", F.col("after").alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
            "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
        )
    )


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """What each filter removes at each step of every order of the five, per part.

    Columns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley. Null texts are empty, null parts are the empty string; rows without
    an id and repeated rows count each on its own (see ``failing`` for E). An empty table
    gives an empty result.
    """
    lists = settled(posting_lists(failing(docs, labels, **columns)), "audit-lists")
    return audit(settled(set_sizes(lists), "audit-sizes"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = f"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
marked AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < {MIN_WORDS} THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS fails
    FROM split LEFT JOIN known USING (doc_id)),
kinds AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY part, fails),
letters AS (SELECT unnest([0, 1, 2, 3, 4]) AS f),
orders AS (SELECT a.f AS a, b.f AS b, c.f AS c, d.f AS d, e.f AS e
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE (1 << a.f) + (1 << b.f) + (1 << c.f) + (1 << d.f) + (1 << e.f) = 31),
steps AS (SELECT substr('ABCDE', a + 1, 1) || substr('ABCDE', b + 1, 1) || substr('ABCDE', c + 1, 1)
        || substr('ABCDE', d + 1, 1) || substr('ABCDE', e + 1, 1) AS filter_order,
    s AS step, CASE s WHEN 1 THEN a WHEN 2 THEN b WHEN 3 THEN c WHEN 4 THEN d ELSE e END AS f,
    CASE WHEN s > 1 THEN 1 << a ELSE 0 END + CASE WHEN s > 2 THEN 1 << b ELSE 0 END
    + CASE WHEN s > 3 THEN 1 << c ELSE 0 END + CASE WHEN s > 4 THEN 1 << d ELSE 0 END AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
counts AS (SELECT part, filter_order, step, f,
    sum(CASE WHEN fails & (before | (1 << f)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (fails >> f) & 1 = 1 AND fails & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (fails >> f) & 1 = 1 AND fails & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = 1 << f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (fails >> f) & 1 = 1 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (fails >> f) & 1 = 1 AND fails & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM kinds, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts"""
