"""Near copies by SimHash, with vantage-point trees over the fingerprints.

A fingerprint has 64 bits; bit b is set if it is set in over half of the hashes of the text's
word shingles, repeats included. Two documents link if their fingerprints differ in at most
``DISTANCE`` bits. Equal fingerprints are one class with its smallest id; the classes are
partitioned by vantage-point trees:

1. A node has a vantage point v and a radius m. A fingerprint at distance d of v belongs
   inside if d <= m, else outside; by the triangle bound the inside may hold a partner of it
   if d <= m + DISTANCE, so such a fingerprint of the boundary goes to both. Any pair within
   DISTANCE meets in a leaf.
2. Trees are built from bounded samples of the shard they split. They are applied until no
   shard is larger than ``SHARD`` or no tree divides it any more; shards are spread by Spark.
   A shard that no tree divides (a dense family) is dealt to pairs of blocks.
3. In a shard further vantage points are taken until a few fingerprints are left, which are
   compared in full. Of the links found there one label per hanging-together part is sent.

Exact: no candidate is dropped, and no shard or family is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import mixed, pieces, ranges, released, settled, shipped, table, text_bytes, word_spans
from candlemill.llm.components import components

SHINGLE, DISTANCE, SEED = 3, 2, 42
SHARD = 16_384  # fingerprints that one task compares
SAMPLE = 2_048  # fingerprints from which a shard's tree is built
LEAVES = 64  # of one tree
FULL = 384  # fingerprints that are compared without further vantage points
TRIED = 8  # vantage points of which the best is taken
GAIN = 0.98  # a split must leave less than this share of the pairs
DENSE = 0.5  # of a shard's size, over which a leaf of its tree counts as not divided
BROADCAST_TREES = 2_000  # trees (about 2 kB each) that are broadcast; beyond it Spark decides
BATCH_BYTES = 3 << 20
_VOTES = 1 << 15  # hashes that are counted at a time


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words one after another with one blank between them, and their spans there."""
    sizes = ends - starts
    begins = np.cumsum(sizes + 1) - sizes - 1
    out = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    word, at = ranges(sizes)
    out[begins[word] + at] = data[starts[word] + at]
    return out.tobytes(), begins, begins + sizes


def fingerprints_of(texts: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """The SimHash of each text; zero for one without words."""
    from xxhash import xxh64_intdigest

    data, doc_starts = text_bytes(texts)
    starts, ends, n_words = word_spans(data, doc_starts)
    out = np.zeros(len(n_words), np.uint64)
    if not len(starts):
        return out
    joined, begins, stops = _joined(data, starts, ends)
    view = memoryview(joined)
    n = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    doc, at = ranges(n)
    first = (np.cumsum(n_words) - n_words)[doc] + at
    last = np.minimum(first + size, np.cumsum(n_words)[doc]) - 1
    spans = zip(begins[first].tolist(), stops[last].tolist())
    hashes = np.fromiter((xxh64_intdigest(view[a:b], SEED) for a, b in spans), np.uint64, len(doc))
    votes = np.zeros((len(n_words), 64), np.int64)
    for k in range(0, len(hashes), _VOTES):
        part, owner = hashes[k : k + _VOTES], doc[k : k + _VOTES]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edges = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
        votes[owner[edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int64)
    chosen = np.packbits(2 * votes > n[:, None], axis=1, bitorder="little")
    return chosen.view("<u8").ravel().astype(np.uint64)


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            found = fingerprints_of(batch.column("text"), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "bits"])

    return run


def simhash(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, bits): the fingerprint of each row, as a signed 64-bit number.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z; a text of fewer words than a
    shingle is one shingle, and one without words, empty or null has fingerprint zero.
    """
    shipped(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(_fingerprints(size), "doc_id long, bits long")


def split_of(prints: np.ndarray, within: int, rng: np.random.Generator) -> tuple[np.uint64, int, float]:
    """The best of ``TRIED`` vantage points, its radius, and the share of pairs that it leaves."""
    best = (prints[0], -1, 1.0)
    for v in prints[rng.integers(0, len(prints), TRIED)]:
        below = np.cumsum(np.bincount(np.bitwise_count(prints ^ v), minlength=65 + within))
        inside, outside = below[within:] / len(prints), 1 - below[: len(below) - within] / len(prints)
        cost = inside**2 + outside**2
        radius = int(cost.argmin())
        if cost[radius] < best[2]:
            best = (v, radius, float(cost[radius]))
    return best


def sides(prints: np.ndarray, vantage: np.uint64, radius: int, within: int) -> tuple[np.ndarray, np.ndarray]:
    """Who goes inside and who goes outside; those of the boundary go to both."""
    far = np.bitwise_count(prints ^ vantage).astype(np.int64)
    return far <= radius + within, far > radius


def build(sample: np.ndarray, leaves: int, within: int) -> list[tuple[int, int, int, int]]:
    """A tree of (vantage, radius, inside, outside); a child below zero is leaf ``-1 - child``.

    The largest leaf is split until there are enough or no split is worth it.
    """
    rng = np.random.default_rng(len(sample))
    nodes: list[list[int]] = []
    open_ = [(sample, None)]  # (fingerprints, where its place is written)
    done = []
    while open_ and len(open_) + len(done) < leaves:
        open_.sort(key=lambda x: len(x[0]))
        prints, link = open_.pop()
        vantage, radius, left = split_of(prints, within, rng) if len(prints) > 16 else (0, 0, 1.0)
        if left >= GAIN:
            done.append((prints, link))
            continue
        nodes.append([int(np.uint64(vantage).view(np.int64)), radius, 0, 0])
        if link:
            nodes[link[0]][link[1]] = len(nodes) - 1
        inside, outside = sides(prints, vantage, radius, within)
        open_ += [(prints[inside], (len(nodes) - 1, 2)), (prints[outside], (len(nodes) - 1, 3))]
    for number, (_, link) in enumerate(open_ + done):
        if link:
            nodes[link[0]][link[1]] = -1 - number
    return [tuple(x) for x in nodes]


def _trees(within: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        sample = np.unique(group.column("bits").to_numpy()).view(np.uint64)
        nodes = build(sample, LEAVES, within)
        flat = [x for node in nodes for x in node]
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "tree": pa.array([flat], pa.list_(pa.int64()))})

    return run


def _descend(within: int):
    """Fingerprints with their shard's tree -> the leaves they belong to, as new shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            bits = batch.column("bits").to_numpy()
            order = np.argsort(shard, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                if not len(rows):
                    continue
                tree = np.asarray(batch.column("tree")[int(rows[0])].as_py(), np.int64).reshape(-1, 4)
                todo = [(0, bits[rows].view(np.uint64))]
                while todo:
                    at, prints = todo.pop()
                    if at < 0:
                        parent = np.full(len(prints), shard[rows[0]], np.int64)
                        leaf = mixed(parent.view(np.uint64) * np.uint64(LEAVES) + np.uint64(-1 - at)).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(parent), pa.array(leaf), pa.array(prints.view(np.int64))], names=["parent", "shard", "bits"]
                        )
                        continue
                    vantage, radius, first, second = tree[at]
                    inside, outside = sides(prints, vantage.view(np.uint64), int(radius), within)
                    todo += [(int(child), prints[side]) for child, side in ((first, inside), (second, outside)) if side.any()]

    return run


def _hashed(bits: str = "bits"):
    return F.xxhash64(F.col(bits), F.lit(7))


def sharded(prints: DataFrame, within: int = DISTANCE, most: int = SHARD) -> DataFrame:
    """(shard, bits): shards in which each pair within the distance meets at least once.

    ``prints``: distinct ``bits``, settled. Each round splits the shards over ``most`` by trees
    from about ``SAMPLE`` fingerprints each. What a tree leaves nearly as large as it was
    (``DENSE``), or cannot split, goes to pairs of blocks, so the number of rounds grows with
    the logarithm of the input.
    """
    done: list[DataFrame] = []
    # Written, as Spark would fold joins on a constant into nested loops.
    large = settled(prints.select(F.lit(1).cast("long").alias("shard"), "bits"), "simhash-whole")
    counts = settled(large.groupBy("shard").count(), "simhash-counts")
    while True:
        over = settled(counts.filter(F.col("count") > most), "simhash-over")
        n_over = over.count()
        small = (lambda df: F.broadcast(df)) if n_over <= BROADCAST_TREES else (lambda df: df)
        done.append(large.join(small(over), "shard", "left_anti"))
        if not n_over:
            break
        # A hash picks about SAMPLE of each large shard.
        share = F.lit(float(SAMPLE)) / F.col("count")
        picked = large.join(small(over), "shard").filter(F.pmod(_hashed(), F.lit(1 << 30)) < share * (1 << 30)).select("shard", "bits")
        trees = picked.groupBy("shard").applyInArrow(_trees(within), "shard long, tree array<long>").filter("size(tree) > 0")
        trees = settled(trees, "simhash-trees")
        whole = large.join(small(over.select("shard")), "shard", "left_semi").join(small(trees.select("shard")), "shard", "left_anti")
        done.append(blocked(whole, most))
        moved = settled(
            large.join(small(trees), "shard").select("shard", "bits", "tree").mapInArrow(_descend(within), "parent long, shard long, bits long"),
            "simhash-shards",
        )
        found = settled(moved.groupBy("parent", "shard").count(), "simhash-counts")
        before = over.select(F.col("shard").alias("parent"), F.col("count").alias("before"))
        dense = found.join(small(before), "parent").filter((F.col("count") > most) & (F.col("count") > DENSE * F.col("before")))
        dense = settled(dense.select("shard"), "simhash-dense")
        moved = moved.select("shard", "bits")
        done.append(blocked(moved.join(small(dense), "shard", "left_semi"), most))
        large = moved.join(small(dense), "shard", "left_anti")
        counts = found.select("shard", "count").join(small(dense), "shard", "left_anti")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def blocked(rows: DataFrame, most: int) -> DataFrame:
    """Dense shards dealt to pairs of blocks; each pair of fingerprints meets in one of them."""
    sizes = rows.groupBy("shard").count().select("shard", F.ceil(F.col("count") * 2 / most).alias("blocks"))
    own = F.pmod(_hashed(), F.col("blocks"))
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.xxhash64("shard", F.least(other, F.col("block")), F.greatest(other, F.col("block"))),
    )
    dealt = rows.join(sizes, "shard").withColumn("block", own)
    # Should two shards ever get the same name, they are only compared with each other as well.
    return dealt.select(F.explode(pair).alias("shard"), "bits")


def _parts(near: np.ndarray) -> np.ndarray:
    """The least index that each of n items reaches over a symmetric matrix of links."""
    label = np.arange(len(near))
    while True:
        least = np.where(near, label, len(near)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def links_among(prints: np.ndarray, within: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that link, enough of them to hold together all that links hold together.

    Those of a few fingerprints are compared in full: within them one pair per item is enough,
    between two such blocks all are sent.
    """
    todo = [prints]
    while todo:
        some = todo.pop()
        if len(some) > FULL:
            vantage, radius, left = split_of(some, within, rng)
            if left < GAIN:
                todo += [some[side] for side in sides(some, vantage, radius, within) if side.any()]
                continue
        for i in range(0, len(some), FULL):
            for j in range(i, len(some), FULL):
                near = np.bitwise_count(some[i : i + FULL, None] ^ some[None, j : j + FULL]) <= within
                if i == j:
                    if near.sum() > len(near):
                        label = _parts(near)
                        other = np.flatnonzero(label != np.arange(len(label)))
                        yield some[i + other], some[i + label[other]]
                else:
                    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                    a, b = np.nonzero(near[np.ix_(rows, columns)])
                    if len(a):
                        yield some[i + rows[a]], some[j + columns[b]]


def forest(prints: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint (sorted, distinct) that reaches a smaller one, and the least it reaches."""
    label = np.arange(len(prints))
    found = [x for pair in links_among(prints, within, np.random.default_rng(len(prints))) for x in pair]
    a, b = (np.searchsorted(prints, np.concatenate(found[k::2] or [prints[:0]])) for k in (0, 1))
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            other = np.flatnonzero(label != np.arange(len(label)))
            return prints[other], prints[label[other]]


def _links(within: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rest = None, []

        def closed() -> pa.RecordBatch:
            found = forest(np.unique(np.concatenate(rest).view(np.uint64)), within)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in found], names=["a", "b"])

        for batch in batches:
            shards, bits = batch.column("shard").to_numpy(), batch.column("bits").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)]])
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if shards[a] != shard and rest:
                    yield closed()
                    rest = []
                shard = shards[a]
                rest.append(bits[a:b])
        if rest:
            yield closed()
        released()

    return run


def near_classes(prints: DataFrame, within: int = DISTANCE, most: int = SHARD) -> DataFrame:
    """(node, label) of each of the distinct ``bits`` that links with another; settled."""
    shards = settled(sharded(prints, within, most), "simhash-dealt")
    tasks = max(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shards.count() // most))
    met = shards.repartition(tasks, "shard").sortWithinPartitions("shard")
    edges = settled(met.mapInArrow(_links(within), "a long, b long"), "simhash-links")
    return components(edges)


def simhash_components(
    docs: DataFrame, size: int = SHINGLE, within: int = DISTANCE, most: int = SHARD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest doc_id that links of at most ``within`` bits reach, the
    row's own included. Rows without an id are linked like any other but name no component: it
    is null where all its rows are without an id. Repeated rows are one class; texts without
    words have fingerprint zero and link like any other. An empty table gives an empty result.
    """
    shipped(docs.sparkSession)
    rows = settled(simhash(docs, size, id_col, text_col), "simhash-rows")
    classes = settled(rows.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-classes")
    nodes = near_classes(classes.select("bits"), within, most)
    joined = nodes.join(classes, nodes["node"] == classes["bits"]).select("bits", "label", "least")
    reached = joined.groupBy("label").agg(F.min("least").alias("reached"))
    named = joined.join(reached, "label").select("bits", "reached")
    # Only classes of several rows, or with links, have another id than the row's own.
    several = settled(
        classes.join(named, "bits", "left").select("bits", F.coalesce("reached", "least").alias("component_id")), "simhash-components"
    )
    return rows.join(several, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
