"""Exact Jaccard join on word n-grams with a token-group matrix.

Two documents link when ``100 * |A & B| >= 85 * |A | B|`` over their sets of 4-word shingles.

1. A shingle is a 48-bit hash. Each batch of documents asks once for every distinct shingle
   how many documents have it. A shingle of one document only can be in no intersection, so a
   document with too few shared shingles is linked with nothing; the rest keep their shared
   shingles, rarest first. Equal sets become one class.
2. Similar classes are partitioned into groups of at most ``GROUP`` (same smallest shingle,
   similar size) whose token union is stored. Groups that are larger than that are split, so
   no group grows with the data.
3. The matrix (token, group) holds the tokens of the unions that an intersection of the
   required size cannot avoid (prefixes in the order of rarity); it is joined with the same
   tokens of the querying groups. For each pair of groups the overlap of a query with the
   other group's union bounds all its similarities there; only queries over the bound open
   the group, and are compared with its members by one matrix product.
4. Links become components. Inside a group one link per part that hangs together is kept.

Hashes stand for shingles: two different shingles of a pair agree by chance with probability
2**-48, about 1e-9 for two texts of 500 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import (
    ROW_BITS, batch_ids, id_and_text, mixed, pieces, ranges, released, settled, spans_hash, table, text_bytes, without, word_spans,
)
from candlemill.llm.components import components

SHINGLE = 4
PERCENT = 85
GROUP = 256
SALT = 512  # classes of one smallest shingle that one task groups
BATCH_BYTES = 4 << 20
ORD = np.uint64(ROW_BITS)
ROW_MASK = np.uint64((1 << ROW_BITS) - 1)
ALONE, OFTEN, OWNERS, DOCS = range(4)

_SENT = "bucket int, batch long, kind int, data binary"
_ANSWER = "batch long, kind int, data binary, rarity binary"
_SETS = "row long, doc_id long, n long, h1 long, h2 long, tokens binary"
_GROUPS = "kind int, gid long, n_min long, n_max long, a long, b long, rows binary, sizes binary, parts binary, tokens binary"


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection with which sets of n and m tokens link."""
    return -(-percent * (n + m) // (100 + percent))


def packed(values: np.ndarray) -> bytes:
    """64-bit values, byte plane by byte plane: sorted values compress well that way."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, int]:
    """Distinct (48-bit shingle << 16 | row), sorted, and the number of rows."""
    data, starts = text_bytes(texts)
    begin, end, counts = word_spans(data, starts)
    words = spans_hash(data, begin, end)
    owner, place = ranges(counts)
    found = []
    with np.errstate(over="ignore"):
        for length in range(1, size + 1):
            # Windows of ``size`` words; a shorter text is one window of all its words.
            heads = np.flatnonzero((counts[owner] - place >= size) if length == size else (counts[owner] == length) & (place == 0))
            value = np.full(len(heads), length, np.uint64)
            for k in range(length):
                value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + words[heads + k])
            found.append((value & ~ROW_MASK) | owner[heads].astype(np.uint64))
    return np.unique(np.concatenate(found)), len(counts)


def home_of(number: int, buckets: int) -> int:
    """The bucket that takes a batch's own rows along; batches spread evenly over them."""
    return int(mixed(np.array([number], np.uint64))[0] % np.uint64(buckets))


def _send(buckets: int, size: int):
    bits = np.uint64(64 - (buckets.bit_length() - 1))
    schema = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = batch_ids()
        edges = (np.arange(1, buckets, dtype=np.uint64) << bits) if buckets > 1 else np.zeros(0, np.uint64)
        for batch in pieces(batches, BATCH_BYTES):
            number = next(numbers)
            keys, rows = shingles(batch.column("text"), size)
            token = keys >> ORD
            new = np.append(True, token[1:] != token[:-1]) if len(keys) else np.zeros(0, bool)
            heads = np.flatnonzero(new)
            times = np.diff(np.append(heads, len(keys)))
            alone = heads[times == 1]
            often = heads[times > 1]
            counted = (token[often] << ORD) | np.minimum(times[times > 1], 65535).astype(np.uint64)
            is_owner = np.ones(len(keys), bool)
            is_owner[alone] = False
            out = []
            for kind, values in ((ALONE, keys[alone]), (OFTEN, counted)):
                cuts = [0, *np.searchsorted(values, edges).tolist(), len(values)]
                out += [(b, number, kind, packed(values[x:y])) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
            home = home_of(number, buckets)
            if is_owner.any():
                out.append((home, number, OWNERS, packed(keys[is_owner])))
            # Size and two sums of scrambled tokens name each set.
            by_row = np.argsort((keys & ROW_MASK).astype(np.uint16), kind="stable")
            counts = np.bincount((keys & ROW_MASK).astype(np.int64), minlength=rows)
            doc = np.zeros((4, rows), np.int64)
            doc[0] = counts
            full = counts > 0
            at = (np.cumsum(counts) - counts)[full]
            with np.errstate(over="ignore"):
                for k, salt in ((1, 0x5851F42D4C957F2D), (2, 0x14057B7EF767814F)):
                    if full.any():
                        doc[k][full] = np.add.reduceat(mixed(token[by_row] ^ np.uint64(salt)), at).view(np.int64)
            ids = batch.column("doc_id")
            doc[3] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            null = np.packbits(ids.is_null().to_numpy(zero_copy_only=False))
            out.append((home, number, DOCS, np.int64(rows).tobytes() + doc.tobytes() + null.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def each(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one, so that large values are not all copied at once."""
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Neighbouring rows with one key, together."""
    now, rows = None, []
    for batch in batches:
        for row in each(batch):
            if rows and row[key] != now:
                yield now, rows
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield now, rows
    released()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each shingle of a bucket its number of documents; answers go back to the batches."""
    schema = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("data", pa.binary()), ("rarity", pa.binary())])
    for _, rows in runs(batches, "bucket"):
        out = [(r["batch"], r["kind"], r["data"], None) for r in rows if r["kind"] >= OWNERS]
        asked = [(r["batch"], r["kind"], unpacked(r["data"])) for r in rows if r["kind"] < OWNERS]
        if asked:
            token = np.concatenate([v >> ORD for _, _, v in asked])
            times = np.concatenate([np.ones(len(v), np.int64) if k == ALONE else (v & ROW_MASK).astype(np.int64) for _, k, v in asked])
            _, which = np.unique(token, return_inverse=True)
            total = np.bincount(which, weights=times)[which]
            rarity = np.minimum(4 * np.log2(total), 255).astype(np.uint8)
            start = 0
            for batch, kind, values in asked:
                here = slice(start, start + len(values))
                start += len(values)
                shared = total[here] > 1
                if shared.any():
                    out.append((batch, kind, packed(values[shared]), rarity[here][shared].tobytes()))
        for i in range(0, len(out), 64):
            part = out[i : i + 64]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _assemble(percent: int):
    """Each document's shared shingles, rarest first; null where they are too few to link."""
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
         ("tokens", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in runs(batches, "batch"):
            keys, rarity = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
            often, often_rarity, owners, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.uint64)], b""
            for r in rows:
                if r["kind"] == ALONE:
                    keys.append(unpacked(r["data"]))
                    rarity.append(np.frombuffer(r["rarity"], np.uint8))
                elif r["kind"] == OFTEN:
                    often.append(unpacked(r["data"]) >> ORD)
                    often_rarity.append(np.frombuffer(r["rarity"], np.uint8))
                elif r["kind"] == OWNERS:
                    owners.append(unpacked(r["data"]))
                else:
                    docs = r["data"]
            token, known = np.concatenate(often), np.concatenate(often_rarity)
            order = np.argsort(token)
            own = np.concatenate(owners)
            if len(own):
                keys.append(own)
                rarity.append(known[order][np.searchsorted(token[order], own >> ORD)])
            key, rare = np.concatenate(keys), np.concatenate(rarity)
            count = int(np.frombuffer(docs[:8], np.int64)[0])
            doc = np.frombuffer(docs[8 : 8 + 32 * count], np.int64).reshape(4, count)
            null = np.unpackbits(np.frombuffer(docs[8 + 32 * count :], np.uint8))[:count].astype(bool)
            row = (key & ROW_MASK).astype(np.int64)
            shared = np.bincount(row, minlength=count)
            keep = (doc[0] > 0) & (100 * shared >= percent * doc[0])
            kept = keep[row]
            key, rare, row = key[kept], rare[kept], row[kept]
            order = np.lexsort((key >> ORD, rare, row))
            body = (key[order] >> ORD).tobytes()
            ends = np.cumsum(np.where(keep, shared, 0)) * 8
            tokens = [body[b - 8 * s : b] if k else None for b, s, k in zip(ends.tolist(), shared.tolist(), keep.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array((number << ROW_BITS) + np.arange(count)), pa.array(doc[3], mask=null),
                 pa.array(doc[0]), pa.array(doc[1]), pa.array(doc[2]), pa.array(tokens, pa.binary())],
                schema=schema,
            )

    return run


def shared_sets(docs: DataFrame, size: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Step 1: (row, doc_id, n, h1, h2, tokens) of every document."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = 1 << min(20, (4 * parts - 1).bit_length())
    sent = id_and_text(docs, id_col, text_col).mapInArrow(_send(buckets, size), _SENT)
    counted = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_count, _ANSWER)
    return counted.repartition(parts, "batch").sortWithinPartitions("batch").mapInArrow(_assemble(percent), _SETS)


class Members:
    """The classes of a group: rows, sizes and tokens, and the matrix over their union."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray, tokens: list[np.ndarray], parts: np.ndarray | None = None):
        self.rows, self.sizes, self.tokens = rows, sizes, tokens
        self.parts = rows.copy() if parts is None else parts
        self.union = np.unique(np.concatenate(tokens))
        self.matrix: np.ndarray | None = None

    def over(self, union: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Member and column of each token that ``union`` has."""
        owner = np.repeat(np.arange(len(self.tokens)), [len(t) for t in self.tokens])
        token = np.concatenate(self.tokens)
        at = np.minimum(np.searchsorted(union, token), len(union) - 1)
        there = union[at] == token
        return owner[there], at[there]

    def dense(self) -> np.ndarray:
        if self.matrix is None:
            self.matrix = np.zeros((len(self.rows), len(self.union)), np.float32)
            self.matrix[self.over(self.union)] = 1
        return self.matrix

    def links(self, other: "Members", percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs, as places in self and in other: bound first, then the matrix product."""
        owner, at = self.over(other.union)
        bound = np.bincount(owner, minlength=len(self.rows))
        smallest, largest = other.sizes.min(), other.sizes.max()
        opens = bound >= least_overlap(self.sizes, np.full_like(self.sizes, smallest), percent)
        opens &= (100 * largest >= percent * self.sizes) & (100 * self.sizes >= percent * smallest)
        query = np.flatnonzero(opens)
        if not len(query):
            return query, query
        seat = np.full(len(self.rows), -1)
        seat[query] = np.arange(len(query))
        asked = np.zeros((len(query), len(other.union)), np.float32)
        of_query = opens[owner]
        asked[seat[owner[of_query]], at[of_query]] = 1
        common = np.rint(asked @ other.dense().T).astype(np.int64)
        union = self.sizes[query][:, None] + other.sizes[None, :] - common
        mine, theirs = np.nonzero(100 * common >= percent * union)
        return query[mine], theirs

    def join_parts(self, percent: int) -> None:
        """Label the parts of the group that hang together by links inside it."""
        a, b = self.links(self, percent)
        label = np.arange(len(self.rows))
        while True:
            least = label.copy()
            np.minimum.at(least, a, label[b])
            least = least[least]
            if (least == label).all():
                break
            label = least
        self.parts = self.rows[label]


def _ragged(tokens: list[np.ndarray]) -> bytes:
    sizes = np.array([len(t) for t in tokens], np.int64)
    return sizes.tobytes() + np.concatenate(tokens).astype(np.uint64).tobytes()


def _members(row: dict, prefix: str = "") -> Members:
    rows = np.frombuffer(row[f"{prefix}rows"], np.int64)
    data = row[f"{prefix}tokens"]
    sizes = np.frombuffer(data[: 8 * len(rows)], np.int64)
    flat = np.frombuffer(data[8 * len(rows) :], np.uint64)
    tokens = np.split(flat, np.cumsum(sizes)[:-1])
    return Members(rows, np.frombuffer(row[f"{prefix}sizes"], np.int64), tokens, np.frombuffer(row[f"{prefix}parts"], np.int64))


def _prefix(n: int, tokens: np.ndarray, least: int) -> np.ndarray:
    """The rarest tokens of which an overlap of ``least`` must hold one; the unshared come first."""
    return tokens[: max(0, n - least + 1 - (n - len(tokens)))]


GROUP_ROW, MATRIX_ROW, QUERY_ROW, LINK_ROW = range(4)


def _group(percent: int, group: int):
    """Groups with their union, their rows of the matrix, their queries and inner links."""
    kinds = [pa.int32(), *[pa.int64()] * 5, *[pa.binary()] * 4]
    schema = pa.schema(list(zip([c.split()[0] for c in _GROUPS.split(", ")], kinds)))

    def emit(rows: list[dict], number: int) -> Iterator[pa.RecordBatch]:
        tokens = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
        sizes = np.array([r["n"] for r in rows], np.int64)
        members = Members(np.array([r["row"] for r in rows], np.int64), sizes, tokens)
        if len(rows) > 1:
            members.join_parts(percent)
        low, high = int(sizes.min()), int(sizes.max())
        stored = np.unique(np.concatenate([_prefix(n, t, -(-2 * percent * n // (100 + percent))) for n, t in zip(sizes.tolist(), tokens)]))
        asked = np.unique(np.concatenate([_prefix(n, t, -(-percent * n // 100)) for n, t in zip(sizes.tolist(), tokens)]))
        inner = members.parts != members.rows
        a = [None, *stored.astype(np.int64).tolist(), *asked.astype(np.int64).tolist(), *members.rows[inner].tolist()]
        b = [None] * (1 + len(stored) + len(asked)) + members.parts[inner].tolist()
        kind = [GROUP_ROW] + [MATRIX_ROW] * len(stored) + [QUERY_ROW] * len(asked) + [LINK_ROW] * int(inner.sum())
        rest = [None] * (len(kind) - 1)
        columns = [
            kind, [number] * len(kind), [low] * len(kind), [high] * len(kind), a, b, [members.rows.tobytes(), *rest],
            [sizes.tobytes(), *rest], [members.parts.tobytes(), *rest], [_ragged(tokens), *rest],
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = batch_ids()
        rows: list[dict] = []
        for batch in batches:
            for row in each(batch):
                alike = rows and row["label"] == rows[0]["label"] and row["salt"] == rows[0]["salt"]
                if rows and not (alike and len(rows) < group and 10 * row["n"] <= 11 * rows[0]["n"]):
                    yield from emit(rows, next(numbers))
                    rows = []
                rows.append(row)
        if rows:
            yield from emit(rows, next(numbers))

    return run


def _open(percent: int):
    """Links between the parts of two groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            last, theirs = None, None
            for row in each(batch):
                if row["gid"] != last:
                    last, theirs = row["gid"], _members(row)
                mine = _members(row, "q_")
                a, b = mine.links(theirs, percent)
                if len(a):
                    pairs = np.unique(np.stack([mine.parts[a], theirs.parts[b]]), axis=1)
                    left.append(pairs[0])
                    right.append(pairs[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    return run


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest token of each class: similar sets mostly share it."""
    for batch in batches:
        least = [int(np.frombuffer(t, np.uint64).min()) for t in batch.column("tokens").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(least, pa.int64())], names=[*batch.schema.names, "label"]
        )


def links(classes: DataFrame, percent: int = PERCENT, group: int = GROUP) -> DataFrame:
    """(a, b) over the rows of ``classes`` (row, n, tokens): enough links to connect all that link."""
    labelled = settled(classes.mapInArrow(_label, "row long, n long, tokens binary, label long"), "join-classes")
    sizes = settled(labelled.groupBy("label").count(), "join-labels")
    salted = labelled.join(sizes, "label").select(
        "row", "n", "tokens", "label", F.pmod(F.xxhash64("row"), F.ceil(F.col("count") / SALT)).alias("salt")
    )
    ordered = salted.repartition("label", "salt").sortWithinPartitions("label", "salt", "n", "row")
    made = settled(ordered.mapInArrow(_group(percent, group), _GROUPS), "join-groups")
    groups = made.filter(F.col("kind") == GROUP_ROW).select("gid", "n_min", "n_max", "rows", "sizes", "parts", "tokens")
    matrix = made.filter(F.col("kind") == MATRIX_ROW).select(F.col("a").alias("token"), "gid", "n_min", "n_max")
    asks = made.filter(F.col("kind") == QUERY_ROW).select(
        F.col("a").alias("token"), F.col("gid").alias("q_gid"), F.col("n_min").alias("q_min"), F.col("n_max").alias("q_max")
    )
    # A query is at least as large as the set it finds, and not by too much.
    near = (F.col("n_min") <= F.col("q_max")) & (F.col("n_max") * 100 >= F.col("q_min") * percent)
    pairs = (
        asks.join(matrix, "token").filter((F.col("gid") != F.col("q_gid")) & near)
        .groupBy(F.least("gid", "q_gid").alias("gid"), F.greatest("gid", "q_gid").alias("q_gid")).agg(F.lit(1).alias("one"))
    )
    pairs = settled(pairs.drop("one"), "join-pairs")
    queries = groups.select(F.col("gid").alias("q_gid"), *(F.col(c).alias(f"q_{c}") for c in ("rows", "sizes", "parts", "tokens")))
    opened = pairs.join(groups, "gid").join(queries, "q_gid")
    inner = made.filter(F.col("kind") == LINK_ROW).select("a", "b")
    return opened.mapInArrow(_open(percent), "a long, b long").unionByName(inner)


def jaccard_components(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest id reachable by links. A text without words, empty or
    null, has no shingles and is linked with nothing; one of fewer than ``size`` words is one
    shingle. Repeated rows link like any equal texts. A row without an id links as well, but
    never names a component: where no row of it has an id, ``component_id`` is null. An empty
    table gives an empty result.
    """
    sets = settled(shared_sets(docs, size, percent, id_col, text_col), "join-sets")
    some = sets.filter("tokens IS NOT NULL")
    classes = settled(
        some.groupBy("n", "h1", "h2").agg(F.min("row").alias("class"), F.min("doc_id").alias("least")), "join-equal"
    )
    distinct = some.join(classes.select(F.col("class").alias("row")), "row", "left_semi").select("row", "n", "tokens")
    found = settled(links(distinct, percent), "join-links")
    labels = components(found)
    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "label", F.coalesce("label", "class")
    )
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    named = settled(named.join(least, "label").select("n", "h1", "h2", "component"), "join-named")
    plain = sets.select("doc_id", "n", "h1", "h2", F.col("tokens").isNotNull().alias("some"))
    alone = plain.filter("NOT some").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    joined = plain.filter("some").join(named, ["n", "h1", "h2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )
    return alone.unionByName(joined)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id.

    Rows without an id cannot be named and stay; rows that share an id stay or go together.
    """
    found = jaccard_components(docs, id_col=id_col, **options)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return without(docs, id_col, settled(gone, "join-gone"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
