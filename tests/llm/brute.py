"""Plain versions of what the operators compute."""

import random
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(LOWER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def components(rows, size, percent):
    """(doc_id or None, text) rows -> the component id of each row, by comparing all pairs."""
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    roots = [root(i) for i in range(len(rows))]
    least = {}
    for (doc_id, _), r in zip(rows, roots):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return [least.get(r) for r in roots]


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def prose(rng: random.Random, n, vocabulary=400):
    syllables = "er on an re he in ed nd ha at en es or nt ea ti to st".split()
    made = ["".join(rng.choice(syllables) for _ in range(1 + i % 3)) + str(i % 7) for i in range(vocabulary)]
    return " ".join(rng.choice(made) for _ in range(n))
