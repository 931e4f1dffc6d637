"""Text scores by prediction by partial matching, next to a unigram baseline.

The model is a trie of byte contexts up to order ``ORDER``. Every byte that occurs in a
training text has a symbol of its own, the end of a text has one, and the bytes that never
occur share one evenly. Every training text is counted and every context is kept. A symbol is
predicted from the longest context that the trie has; the chance to escape to the next
shorter one is that of method D (half the distinct successors against the occurrences), and
symbols that the longer context knows are excluded there.

The trie is never in one place: the leaves are dealt to buckets by the last two symbols of
their context, so that a bucket has all contexts of order 2 and more above its leaves. Those
of orders 0 and 1 (at most 257 ** 2 leaves) are broadcast. Each batch of documents sends its
distinct leaves, with their counts in its training texts, once; the bucket adds up the counts
of all batches, builds its part of the trie and answers with the logarithms.

The baseline needs the count of every word in the whole corpus; words are asked for in the
same way. The answers go back to the batch's texts, which are taken apart again to sum them
up. No word or leaf, however frequent, is sent more than once per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import (
    batch_ids, mixed, pieces, ranges, settled, spans_hash, table, text_bytes, word_spans,
)
from candlemill.llm.jaccard_join import home_of, packed, runs, unpacked

ORDER, LOW_ORDER = 6, 1
SYMBOLS = 257  # the bytes and the end
FOLDS, HELD_OUT = 10, 0
BATCH_BYTES = 8 << 20
ASK, DOCS, TOTAL, LEAF = range(4)


def symbols_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each byte, and log10 of a byte's share of its symbol.

    Symbols have the fewest bits, 6 or more, that name each byte that occurs, the end (all
    bits set) and, below 9 bits, all other bytes as one (the last bit clear).
    """
    order = np.lexsort((np.arange(256), -counts))
    kinds = int((counts > 0).sum())
    bits = next(b for b in (6, 7, 8, 9) if kinds <= (1 << b) - 2)
    other = (1 << bits) - 2
    symbol = np.full(256, other, np.uint16)
    symbol[order[:other]] = np.arange(min(other, 256))
    rest = order[other:]
    share = np.zeros(256)
    share[rest] = -np.log10(max(len(rest), 1))
    return symbol, share


def bits_of(symbol: np.ndarray) -> int:
    return int(symbol.max() + 1).bit_length()


def _low(keys: np.ndarray, bits: int) -> np.ndarray:
    """The last ``bits`` bits of each key."""
    return keys & np.uint64((1 << bits) - 1)


def leaf_keys(data: np.ndarray, starts: np.ndarray, symbol: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of each text, end included: its trie leaf; and where each text starts.

    A text begins in the context of ``order`` ends.
    """
    bits = bits_of(symbol)
    n = len(starts) - 1
    sizes = np.diff(starts) + order + 1
    first = np.cumsum(sizes) - sizes
    real = np.ones(int(sizes.sum()), bool)
    for k in range(order):
        real[first + k] = False
    line = np.full(len(real), (1 << bits) - 1, np.uint64)
    is_byte = real.copy()
    is_byte[first + sizes - 1] = False
    line[is_byte] = symbol[data]
    key = line.copy()
    for k in range(1, order + 1):
        key[k:] |= line[:-k] << np.uint64(bits * k)
    return key[real], first - np.arange(n) * order


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the place of each key among them."""
    named = pa.array(keys).dictionary_encode()
    found = named.dictionary.to_numpy(zero_copy_only=False)
    order = np.argsort(found)
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    return found[order], place[named.indices.to_numpy(zero_copy_only=False)]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.add.reduceat(counts[order], heads)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class Trie:
    """Counts of the leaves of every order, and of the contexts above them.

    A context has its total, its number of distinct successors, and both again for the next
    shorter context without the successors that this one knows (exclusion).
    """

    def __init__(self, symbol, share, long_leaves=None, short_leaves=None):
        """``short_leaves``, if given, are those of order ``LOW_ORDER`` of the whole corpus."""
        self.symbol, self.share, self.bits = symbol, share, bits_of(symbol)
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        keys, counts = summed(*(long_leaves or none))
        self.leaves: list[tuple] = [none] * (ORDER + 1)
        for k in range(ORDER, -1, -1):
            if k == LOW_ORDER and short_leaves:
                keys, counts = summed(*short_leaves)
            self.leaves[k] = (keys, counts)
            keys, counts = summed(_low(keys, k * self.bits), counts)
        self.contexts: list[tuple] = []
        for k, (keys, counts) in enumerate(self.leaves):
            above = keys >> np.uint64(self.bits)
            heads = np.flatnonzero(np.append(True, above[1:] != above[:-1])) if len(keys) else np.zeros(0, np.int64)
            context = above[heads]
            total = np.add.reduceat(counts, heads) if len(heads) else counts
            kinds = np.diff(np.append(heads, len(keys)))
            rest, rest_kinds = np.zeros(len(heads), np.int64), np.zeros(len(heads), np.int64)
            if k and len(heads):
                short_keys, short_counts = self.leaves[k - 1]
                known = np.add.reduceat(short_counts[np.searchsorted(short_keys, _low(keys, k * self.bits))], heads)
                at = np.searchsorted(self.contexts[k - 1][0], _low(context, (k - 1) * self.bits))
                rest, rest_kinds = self.contexts[k - 1][1][at] - known, self.contexts[k - 1][2][at] - kinds
            self.contexts.append((context, total, kinds, rest, rest_kinds))

    def leaf_logs(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each leaf's symbol in its context."""
        out = np.zeros(len(keys))
        open_ = np.ones(len(keys), bool)
        excluding = np.zeros(len(keys), bool)
        left_total, left_kinds = np.zeros(len(keys)), np.zeros(len(keys))
        known = np.zeros(len(keys))  # symbols excluded by now
        for k in range(ORDER, -1, -1):
            context, total, kinds, rest, rest_kinds = self.contexts[k]
            at, has = _find(context, _low(keys, (k + 1) * self.bits) >> np.uint64(self.bits))
            if not has.any():
                continue
            leaf, hit = _find(self.leaves[k][0], _low(keys, (k + 1) * self.bits))
            n = np.where(excluding, left_total, total[at])
            d = np.where(excluding, left_kinds, kinds[at])
            # Nothing to escape to where every symbol is known: no mass is kept for it.
            more = known + d < SYMBOLS
            ends = open_ & has & hit
            count = self.leaves[k][1][leaf[ends]]
            out[ends] += np.log10((count - np.where(more[ends], 0.5, 0.0)) / n[ends])
            on = open_ & has & ~hit
            lost = on & (n > 0)
            out[lost] += np.log10(d[lost] / (2.0 * n[lost]))
            open_ &= ~ends
            known = np.where(on, kinds[at], known)
            left_total, left_kinds = np.where(on, rest[at], left_total), np.where(on, rest_kinds[at], left_kinds)
            excluding |= on
        # What no context knows is equally likely; the bytes that never occur are one symbol.
        out[open_] -= np.log10(np.maximum(SYMBOLS - known[open_], 1))
        other = (1 << self.bits) - 2
        rest = int((self.symbol == other).sum())
        if rest:
            out[open_ & (_low(keys, self.bits) == np.uint64(other))] += np.log10(rest)
        return out

    def score(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each text and its end."""
        keys, first = leaf_keys(data, starts, self.symbol)
        named, place = distinct(keys)
        return text_logs(self.leaf_logs(named)[place], first, data, starts, self.share)


def text_logs(logs: np.ndarray, first: np.ndarray, data: np.ndarray, starts: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The sums of the texts' leaves and of their bytes' shares."""
    out = np.add.reduceat(logs, first, dtype=np.float64)
    rare = share[data]
    if rare.any():
        out = out + np.where(np.diff(starts) > 0, np.add.reduceat(np.append(rare, 0.0), starts[:-1]), 0)
    return out


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << 18, np.int64)
    for batch in pieces(batches, BATCH_BYTES):
        keys = leaf_keys(*text_bytes(batch.column("text")), np.arange(256, dtype=np.uint16), 1)[0]
        counts += np.bincount(keys.astype(np.int64), minlength=1 << 18)
    keys = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(counts[keys])], names=["key", "n"])


def train(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Symbols, shares, and the leaves of order 1 of all rows of ``texts`` (text)."""
    got = texts.mapInArrow(_count_pairs, "key int, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    pairs, n = got.column("key").to_numpy().astype(np.int64), got.column("n").to_numpy()
    ends = (1 << 9) - 1
    counts = np.zeros(ends + 1, np.int64)
    np.add.at(counts, pairs & ends, n)
    symbol, share = symbols_of(counts[:256])
    bits = bits_of(symbol)
    code = np.full(ends + 1, (1 << bits) - 1, np.uint64)
    code[:256] = symbol
    return symbol, share, (code[pairs >> 9] << np.uint64(bits) | code[pairs & ends], n)


def _zipped(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unzipped(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


def _dealt(leaves: np.ndarray, bits: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted leaves by bucket, and where each bucket starts.

    Leaves whose contexts end in the same two symbols share a bucket.
    """
    bucket = (mixed(_low(leaves >> np.uint64(bits), 2 * bits)) % np.uint64(buckets)).astype(np.uint32)
    return np.argsort(bucket, kind="stable"), np.append(0, np.cumsum(np.bincount(bucket, minlength=buckets)))


_SENT = "bucket int, batch long, kind int, words binary, numbers binary"
_ANSWER = "batch long, kind int, words binary, numbers binary"
_SCORED = "kind int, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, n_all long, n_distinct long"


def _ask(shared, buckets: int):
    edge = np.uint64(64 - (buckets.bit_length() - 1))
    schema = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), ("words", pa.binary()), ("numbers", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol = shared.value[0]
        numbers = batch_ids()
        edges = (np.arange(1, buckets, dtype=np.uint64) << edge) if buckets > 1 else np.zeros(0, np.uint64)
        for batch in pieces(batches, BATCH_BYTES):
            number = next(numbers)
            data, starts = text_bytes(batch.column("text"))
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            begin, end, counts = word_spans(data, starts)
            # Equal words are named once before they are hashed.
            words, which = np.unique(spans_hash(data, begin, end), return_inverse=True)
            owner, _ = ranges(counts)
            learned = np.bincount(which[~held[owner]], minlength=len(words)).astype(np.uint32)
            cuts = [0, *np.searchsorted(words, edges).tolist(), len(words)]
            out = [(b, number, ASK, packed(words[x:y]), learned[x:y].tobytes()) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
            del begin, end, which, owner
            leaves, place = distinct(leaf_keys(data, starts, symbol)[0])
            learned = np.bincount(place[np.repeat(~held, np.diff(starts) + 1)], minlength=len(leaves)).astype(np.uint32)
            del place
            order, cuts = _dealt(leaves, bits_of(symbol), buckets)
            leaves, learned = leaves[order], learned[order]
            out += [
                (b, number, LEAF, _zipped(packed(leaves[x:y])), _zipped(learned[x:y].tobytes()))
                for b, (x, y) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if y > x
            ]
            doc = np.zeros((3, len(held)), np.int64)
            ids = batch.column("doc_id")
            doc[0] = np.diff(starts)
            doc[1] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            doc[2] = held + 2 * ids.is_null().to_numpy(zero_copy_only=False)
            out.append((home_of(number, buckets), number, DOCS, _zipped(data.tobytes()), doc.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _answer(shared):
    """The corpus count of each word of a bucket and the logarithm of each leaf, back to the batches that asked."""
    schema = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("words", pa.binary()), ("numbers", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, share, pairs = shared.value
        for bucket, rows in runs(batches, "bucket"):
            out = [(r["batch"], r["kind"], r["words"], r["numbers"]) for r in rows if r["kind"] == DOCS]
            asked = [(r["batch"], unpacked(r["words"]), np.frombuffer(r["numbers"], np.uint32)) for r in rows if r["kind"] == ASK]
            if asked:
                _, which = np.unique(np.concatenate([w for _, w, _ in asked]), return_inverse=True)
                total = np.bincount(which, weights=np.concatenate([n for _, _, n in asked])).astype(np.int64)
                mine = total[which]
                start = 0
                for batch, words, _ in asked:
                    out.append((batch, ASK, words[:1].tobytes(), mine[start : start + len(words)].tobytes()))
                    start += len(words)
                sums = np.array([total.sum(), (total > 0).sum()], np.int64)
                out.append((-1 - bucket, TOTAL, None, sums.tobytes()))
            asked = [(r["batch"], unpacked(_unzipped(r["words"])), _unzipped(r["numbers"])) for r in rows if r["kind"] == LEAF]
            if asked:
                sizes = [len(v) for _, v, _ in asked]
                leaves, place = distinct(np.concatenate([v for _, v, _ in asked]))
                counts = np.bincount(place, weights=np.frombuffer(b"".join(n for _, _, n in asked), np.uint32), minlength=len(leaves))
                batches_of = [b for b, _, _ in asked]
                del asked, rows
                seen = counts > 0
                trie = Trie(symbol, share, (leaves[seen], counts[seen].astype(np.int64)), pairs)
                logs = trie.leaf_logs(leaves).astype(np.float32)
                name = int(bucket).to_bytes(8, "little")
                for batch, part in zip(batches_of, np.split(place, np.cumsum(sizes)[:-1])):
                    out.append((batch, LEAF, name, _zipped(logs[part].tobytes())))
            for i in range(0, len(out), 16):
                part = out[i : i + 16]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    return run


def _sum_up(shared, buckets: int):
    names = [c.split()[0] for c in _SCORED.split(", ")]
    types = [pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, share, _ = shared.value
        for _, rows in runs(batches, "batch"):
            if rows[0]["kind"] == TOTAL:
                n_all, n_distinct = np.frombuffer(rows[0]["numbers"], np.int64).tolist()
                columns = [[TOTAL], [None], [None], [None], [None], [None], [None], [n_all], [n_distinct]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
                continue
            # The buckets are ranges of hashes: by their first word they follow one another.
            asked = sorted((int(np.frombuffer(r["words"], np.uint64)[0]), r["numbers"]) for r in rows if r["kind"] == ASK)
            count = np.frombuffer(b"".join(n for _, n in asked), np.int64)
            told = sorted((int.from_bytes(r["words"], "little"), r["numbers"]) for r in rows if r["kind"] == LEAF)
            home = next(r for r in rows if r["kind"] == DOCS)
            data = np.frombuffer(_unzipped(home["words"]), np.uint8)
            doc = np.frombuffer(home["numbers"], np.int64)
            doc = doc.reshape(3, len(doc) // 3)
            n = doc.shape[1]
            starts = np.append(0, np.cumsum(doc[0]))
            begin, end, counts = word_spans(data, starts)
            _, which = np.unique(spans_hash(data, begin, end), return_inverse=True)
            owner, _ = ranges(counts)
            logs = np.bincount(owner, weights=np.log10(count + 0.1)[which], minlength=n)
            known = np.bincount(owner, weights=(count > 0)[which], minlength=n).astype(np.int64)
            del begin, end, which, owner, rows, home
            keys, first = leaf_keys(data, starts, symbol)
            leaves, place = distinct(keys)
            del keys
            of_leaf = np.empty(len(leaves), np.float32)
            of_leaf[_dealt(leaves, bits_of(symbol), buckets)[0]] = np.frombuffer(b"".join(_unzipped(v) for _, v in told), np.float32)
            score = text_logs(of_leaf[place], first, data, starts, share)
            del place, told
            nothing = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, DOCS, np.int32)), pa.array(doc[1].copy(), mask=doc[2] >= 2), pa.array(doc[2] % 2 == 1),
                 pa.array(counts + 1), pa.array(known), pa.array(logs.astype(np.float64)), pa.array(score), nothing, nothing],
                names=names,
            )

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lower-cased (A-Z). Documents that are not held out are learned; a row without
    an id is held out. A null or empty text has one token, its end. Without any training text
    ``train_tokens`` is 0, every word has count 0 and all bytes are equally likely. Repeated
    rows are counted and scored like any other. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(id_col).cast("bigint").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        held.alias("held_out"),
    )
    shared = spark.sparkContext.broadcast(train(rows.filter("NOT held_out").select("text")))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = 1 << min(20, (4 * parts - 1).bit_length())
    sent = rows.sortWithinPartitions("doc_id").mapInArrow(_ask(shared, buckets), _SENT)
    answered = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_answer(shared), _ANSWER)
    # There are few batches for each task, so they are dealt to more tasks than usual: dealt to
    # as many tasks as batches, some would get several times the mean.
    back = answered.repartition(4 * parts, "batch").sortWithinPartitions("batch").mapInArrow(_sum_up(shared, buckets), _SCORED)
    found = settled(back, "lm-scores")
    n_all, n_distinct, ends = found.agg(
        F.coalesce(F.sum("n_all"), F.lit(0)), F.coalesce(F.sum("n_distinct"), F.lit(0)), F.count(F.when(~F.col("held_out"), 1))
    ).first()
    n_all, n_distinct = n_all + ends, n_distinct + (ends > 0)
    norm = float(np.log10(n_all + 0.1 * (n_distinct + 1)))
    base = F.col("logs") + float(np.log10(ends + 0.1)) - F.col("n_tokens") * norm
    return found.filter(F.col("kind") == DOCS).select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(n_all).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score",
    )


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
