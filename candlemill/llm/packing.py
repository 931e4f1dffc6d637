"""Order-preserving packing of token sequences by dynamic programming.

The documents of a task, in their order, are one stream of tokens that is cut into windows of
at most ``WINDOW`` tokens. Cuts lie after a document (free), after a sentence (costs
``CUT_SENTENCE``) or, only where a sentence leaves no other place, every ``HARD_STEP`` tokens
(costs ``CUT_WORD``). The cost of a cut at j after one at i is its penalty plus the padding
of the window; with P the position in the stream,

    best[j] = penalty[j] + WINDOW - P[j] + min(best[i] + P[i] : P[j] - P[i] <= WINDOW)

so the minimum slides over a window of positions, and a monotone queue finds it in constant
time. The last window of a batch stays open and goes on with the next batch; only the last
one of a task may be short. Nothing is shuffled: a task packs the rows that it reads.

Tokens are those of the whole text. A text is split at single blanks and newlines between
other characters and before a sign that follows a letter, where the tokenizer splits as
well, so each distinct word of a batch is encoded once.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import id_and_text, pieces, released, table, text_bytes

WINDOW = 2048
END_ID = 1
CUT_SENTENCE, CUT_WORD, HARD_STEP = 8, 48, 128
BATCH_BYTES = 3 << 20
_OUT = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in ".,!?;:"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def split_points(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sorted positions where a chunk begins: every text, and single blanks and newlines.

    Only between characters that are no white space of any kind, as far as the neighbouring
    bytes show it; the white space beyond ASCII begins with C2, E1, E2 or E3.
    """
    n = len(data)
    padded = np.concatenate([np.full(3, 32, np.uint8), data, np.full(1, 32, np.uint8)])
    here, before, after = padded[3:-1], padded[2:-2], padded[4:]
    black = ~((padded <= 32) & ((padded >= 9) & (padded <= 13) | (padded >= 28)))
    lead = (padded == 0xC2) | (padded == 0xE1) | (padded == 0xE2) | (padded == 0xE3)
    wide = (before >= 0x80) & (lead[1 : n + 1] | lead[:n])
    alone = black[2:-2] & ~wide & black[4:] & ~lead[4:] & (after != 0)
    first = np.zeros(n + 1, bool)
    first[starts] = True
    single = alone & ~first[:n] & ~first[1:]
    blank, line = single & (here == 32), single & (here == 10)
    begins = blank | line
    begins[1:] |= line[:-1]
    # A sign after a letter or digit begins a chunk, too (letters beyond ASCII: those of C3).
    upper = before & 0xDF
    letter = (upper >= 65) & (upper <= 90) | (before >= 48) & (before <= 57)
    letter |= (before >= 0x80) & (padded[1 : n + 1] == 0xC3) & (before != 0x97) & (before != 0xB7)
    sign = _SIGN[here] & letter
    begins |= sign & ~first[:n]
    begins |= first[:n]
    return np.flatnonzero(begins)


def _white(data: np.ndarray) -> np.ndarray:
    """The bytes at which white space of any kind begins, controls and zero bytes included."""
    one, two = np.append(data[1:], 0), np.append(data[2:], [0, 0])
    one, two = one[: len(data)], two[: len(data)]
    white = (data <= 32) & ((data >= 9) & (data <= 13) | (data >= 28)) | (data == 0)
    white |= (data == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (data == 0xE1) & (one == 0x9A) & (two == 0x80)
    white |= (data == 0xE2) & (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF))
    return white | (data == 0xE2) & (one == 0x81) & (two == 0x9F) | (data == 0xE3) & (one == 0x80) & (two == 0x80)


# How byte-level BPE splits a text, and its printable stand-ins of bytes.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_of() -> dict[str, int]:
    others = [b for b in range(256) if b not in _PRINTABLE]
    return {chr(b): b for b in _PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Token ids of texts; the distinct chunks of a batch are encoded in one call.

    The vocabulary is that of a tokenizer file of byte-level BPE whose merges have rising ids.
    A rank encoder with the same vocabulary gives the same ids several times faster; it knows
    no special tokens, so chunks that hold one go to the tokenizer itself, and so does every
    chunk of a file of another kind.
    """

    def __init__(self, path: str):
        import json
        import os
        from pathlib import Path

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self._tokenizer, self.ranks = path, None, None
        made = json.loads(Path(path).read_text(encoding="utf-8"))
        self.special = tuple(t["content"].encode() for t in made.get("added_tokens") or ())
        model, before = made["model"], made.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if plain and model.get("type") == "BPE" and not made.get("normalizer") and not model.get("dropout"):
            byte_of = _byte_of()
            words = {t: i for t, i in model["vocab"].items() if t.encode() not in self.special}
            merged = [words.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
            if merged == sorted(set(merged)) and len(words) == 256 + len(merged) and all(c in words for c in byte_of):
                from tiktoken import Encoding

                ranks = {bytes(byte_of[c] for c in t): i for t, i in words.items()}
                self.ranks = Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
                self.line = self.ranks.encode_ordinary("\n")

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def each(self, chunks: list[bytes]) -> list[list[int]]:
        """The ids of chunks, one by one."""
        out = []
        for chunk in chunks:
            if self.ranks is None or any(s in chunk for s in self.special):
                out.append(self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids)
            else:
                out.append(self.ranks.encode_ordinary(chunk.decode()))
        return out

    def ids_of(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct chunks (large_binary) end to end, and each one's first and number.

        Chunks without white space but a blank at their beginning are encoded as lines of one
        text: a line's end is split off before it and after it.
        """
        edges = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
        data = np.frombuffer(chunks.buffers()[2], np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        odd = _white(data)
        odd[edges[:-1]] &= data[edges[:-1]] != 32
        odd |= data == ord("<") if self.special else False
        odd = np.add.reduceat(odd, edges[:-1], dtype=np.int64) > 0
        odd |= (np.diff(edges) == 1) & (data[edges[:-1]] == 32)
        if self.ranks is None or len(self.line) != 1:
            odd[:] = True
        ids, sizes = np.zeros(0, np.uint32), np.zeros(len(chunks), np.int64)
        first = np.zeros(len(chunks), np.int64)
        if not odd.all():
            lined = data[np.repeat(~odd, np.diff(edges))]
            length = np.diff(edges)[~odd]
            text = np.full(len(lined) + len(length), 10, np.uint8)
            inside = np.ones(len(text), bool)
            inside[np.cumsum(length + 1) - 1] = False
            text[inside] = lined
            ids = self.ranks.encode_to_numpy(text.tobytes().decode())
            ends = np.flatnonzero(ids == self.line[0])
            if len(ends) != len(length):
                raise ValueError(f"{len(length)} chunks gave {len(ends)} lines")
            sizes[~odd] = np.diff(ends, prepend=-1) - 1
            first[~odd] = np.append(0, ends[:-1] + 1)
        if odd.any():
            lists = self.each(chunks.filter(pa.array(odd)).to_pylist())
            sizes[odd] = [len(x) for x in lists]
            first[odd] = len(ids) + np.cumsum(sizes[odd]) - sizes[odd]
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(lists), np.uint32)])
        return ids, first, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids with an end id after each text, tokens per text, and sentence ends."""
        data, starts = text_bytes(texts, lower=False)
        n_docs = len(starts) - 1
        if not len(data):
            return np.full(n_docs, END_ID, np.uint32), np.ones(n_docs, np.int64), np.zeros(0, np.int64)
        begins = split_points(data, starts[:-1][np.diff(starts) > 0])
        edges = np.append(begins, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        ids, first, sizes = self.ids_of(chunks.dictionary)
        slot = chunks.indices.to_numpy(zero_copy_only=False)
        size = sizes[slot]
        doc = np.searchsorted(starts[1:], begins, side="right")
        tokens = np.bincount(doc, weights=size, minlength=n_docs).astype(np.int64) + 1
        after = np.cumsum(size) + doc  # place in the stream after each chunk
        out = np.full(int(tokens.sum()), END_ID, np.uint32)
        place = np.repeat(after - size, size)
        within = np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size)
        out[place + within] = ids[np.repeat(first[slot], size) + within]
        return out, tokens, after[_STOP[data[edges[1:] - 1]]]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder per worker process; it holds the vocabulary and nothing of the texts."""
    return Encoder(path)


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """Indices of the chosen cuts; ``at[0]`` is the start, the last cut may leave a tail.

    ``at`` rises by at most ``window`` from one place to the next.
    """
    position, cost = at.tolist(), penalty.tolist()
    best, back = [0] * len(position), [0] * len(position)
    queue: deque[tuple[int, int]] = deque([(position[0], 0)])
    for j in range(1, len(position)):
        here = position[j]
        while position[queue[0][1]] < here - window:
            queue.popleft()
        value, i = queue[0]
        best[j] = cost[j] + window - here + value
        back[j] = i
        key = best[j] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    # What follows the last cut stays open: as if the stream ended here, without its padding.
    end = position[-1]
    while position[queue[0][1]] < end - window or len(queue) > 1 and queue[0][1] == len(position) - 1:
        queue.popleft()
    cuts, j = [], queue[0][1]
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


class Packer:
    """The open stream of one task."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.base = 0  # stream position of ids[0]
        self.ids = np.zeros(0, np.uint32)
        self.marks = np.zeros(0, np.int64)  # sentence ends after base
        self.doc_at = np.zeros(0, np.int64)  # where documents begin, some before base
        self.doc_size = np.zeros(0, np.int64)
        self.doc_id: pa.Array = pa.array([], pa.int64())

    def add(self, ids, sizes, marks, doc_id) -> None:
        begin = self.base + len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        self.marks = np.concatenate([self.marks, marks + begin])
        self.doc_at = np.concatenate([self.doc_at, begin + np.cumsum(sizes) - sizes])
        self.doc_size = np.concatenate([self.doc_size, sizes])
        self.doc_id = pa.concat_arrays([self.doc_id, doc_id])

    def cut(self, last: bool = False) -> pa.RecordBatch | None:
        """The pieces of all closed windows; with ``last`` those of the open one, too."""
        end = self.base + len(self.ids)
        if end == self.base:
            return None
        docs = self.doc_at + self.doc_size
        # A sentence's end just before the end id is no place of its own.
        soft = self.marks[~np.isin(self.marks + 1, docs)]
        places = np.unique(np.concatenate([[self.base], docs, soft]))
        gaps = np.diff(places)
        wide = np.flatnonzero(gaps > HARD_STEP)
        hard = [np.arange(places[k] + HARD_STEP, places[k + 1], HARD_STEP) for k in wide]
        at = np.unique(np.concatenate([places, *hard]))
        penalty = np.where(np.isin(at, docs), 0, np.where(np.isin(at, soft), CUT_SENTENCE, CUT_WORD))
        closed = at[best_cuts(at, penalty, self.window)]
        if last:
            closed = np.append(closed[closed < end], end)
        if not len(closed):
            return None
        stop = closed[-1]
        edges = np.unique(np.concatenate([[self.base], closed, docs[docs <= stop]]))
        begins, ends = edges[:-1], edges[1:]
        doc = np.searchsorted(docs, begins, side="right")
        window = np.searchsorted(closed, begins, side="right")
        opens = np.concatenate([[self.base], closed])[window]
        cuts = ((edges - self.base) * 4).astype(np.int64)
        body = np.ascontiguousarray(self.ids[: stop - self.base])
        out = pa.RecordBatch.from_arrays(
            [
                self.doc_id.take(pa.array(doc)),
                pa.array(begins - self.doc_at[doc]),
                pa.array(ends - begins),
                pa.array(self.doc_size[doc]),
                pa.array(self.sequence + window),
                pa.array(begins - opens),
                pa.Array.from_buffers(
                    pa.large_binary(), len(begins), [None, pa.py_buffer(cuts), pa.py_buffer(body)]
                ).cast(pa.binary()),
            ],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )
        left = docs > stop
        self.sequence += len(closed)
        self.ids, self.marks = self.ids[stop - self.base :], self.marks[self.marks > stop]
        self.doc_at, self.doc_size, self.doc_id = self.doc_at[left], self.doc_size[left], self.doc_id.filter(pa.array(left))
        self.base = int(stop)
        return out


def _packer(tokenizer: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        packer = Packer(window, TaskContext.get().partitionId() << 32)
        for batch in pieces(batches, BATCH_BYTES):
            packer.add(*encoder.encode(batch.column("text")), batch.column("doc_id"))
            closed = packer.cut()
            if closed is not None:
                yield closed
        rest = packer.cut(last=True)
        if rest is not None:
            yield rest
        released()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers. Every id
    of every text, and the end id after it, lies in exactly one piece; a null or empty text is
    its end id alone. Repeated rows and rows without an id are packed like any other. The order
    is that of the rows by id within each task, and ``sequence_id`` rises with it. An empty
    table gives an empty result.
    """
    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(_packer(tokenizer or default_tokenizer(), window), _OUT)


def packed(docs: DataFrame, **options) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack(docs, **options).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
