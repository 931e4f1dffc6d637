import itertools
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from candlemill.llm import decontaminate, packing, ppm
from candlemill.llm.common import spans_hash, text_bytes, word_spans
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ODD = [
    "", "a  b", " x", "x ", "\n\n a\n b\nc  \n", "don't 'll x's", "é à ñ\né", "1 2 3 ?! .\n\n\n\t\tx", "a\r\nb c",
    "<|endoftext|> a <|endoftext|>b", "e f 　g\nh", "a's,b x.y;z|w ,a .b é,ñ. €, 5,6 7.5 ×, ,,, a,,b a.\nb",
    "\u0085 a\u0085 b c", "日本,語. 日,", "x \x00 y", "\x1c \x1d a\x1eb", "no sentence " * 900, "word" * 3000,
]


def test_words_of_texts_beside_one_another():
    texts = ["a b", "", "c", " d\x0be ", "É\xa0f"]
    data, starts = text_bytes(pa.array(["x", *texts]).slice(1))
    begin, end, counts = word_spans(data, starts)
    found = [data[b:e].tobytes().decode() for b, e in zip(begin, end)]
    assert found == [w for t in texts for w in brute.words(t)] and counts.tolist() == [len(brute.words(t)) for t in texts]
    assert len(set(spans_hash(data, begin, end).tolist())) == len(set(found))


def test_packing_holds_every_id_once(docs_of):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    texts = ODD + [None] + [". ".join(brute.prose(rng, rng.randrange(1, 30)) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.packed(docs_of(rows)).toPandas()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], np.uint32)
        at = 0
        for piece in got[got.doc_id == doc_id].sort_values("start").itertuples():
            assert piece.start == at and piece.doc_tokens == len(ids)
            assert piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
    ordered = got.sort_values(["sequence_id", "offset"])
    groups = ordered.groupby("sequence_id")
    assert (ordered.offset == groups.length.cumsum() - ordered.length).all()
    assert groups.length.sum().max() <= 2048 and (got.length > 0).all()


def test_ids_are_those_of_the_tokenizer():
    import pyarrow.parquet as pq
    import public_tokenizers

    encoder = packing.Encoder(packing.default_tokenizer())
    assert encoder.ranks is not None
    texts = [t or "" for t in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()] + ODD
    texts += ["a<b <c> <|endoftext|", " ", "  ", "\u2003x\u2003 y\u3000", "don't\n\nwe'll\n x\n", "x\u00a0. y\u0085", "\u1680a b\u202f c", "\x00\n\x1f a"]
    ids, sizes, _ = encoder.encode(pa.array(texts))
    for text, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert got.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1]
    other = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.ranks is None and other.each([b"some words"]) == [other.tokenizer.encode("some words", add_special_tokens=False).ids]


def test_packing_of_repeats_nulls_and_nothing(docs_of):
    assert packing.pack(docs_of([])).collect() == []
    got = packing.pack(docs_of([(None, "a b"), (1, "a"), (1, "a"), (2, None)], 1)).collect()
    assert sum(r.length for r in got) == 3 + 2 + 2 + 1
    assert {bytes(r.ids)[-4:] for r in got if r.start + r.length == r.doc_tokens} == {b"\x01\0\0\0"}


def test_cuts_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        at = np.cumsum([0] + [rng.randrange(1, 9) for _ in range(rng.randrange(2, 12))])
        penalty = np.array([0] + [rng.choice([0, 2, 5]) for _ in at[1:]])
        window = 10

        def cost(cuts):
            places = [0, *cuts]
            steps = [at[b] - at[a] for a, b in zip(places, places[1:])]
            if any(s > window for s in steps):
                return None
            closed = sum(window - s for s in steps) + sum(penalty[c] for c in cuts)
            return closed - at[places[-1]] * 0 + (at[places[-1]] if at[-1] - at[places[-1]] <= window else 10**9)

        options = [[i + 1 for i in range(len(at) - 2) if mask >> i & 1] for mask in range(1 << (len(at) - 2))]
        best = min(c for c in map(cost, options) if c is not None)
        assert cost(packing.best_cuts(at, penalty, window)) == best


def planted():
    rng = random.Random(4)
    items = [(i, brute.prose(rng, n)) for i, n in enumerate([14, 20, 45, 59, 12, 30])] + [(6, "only five words right here"), (7, None), (8, "")]
    texts = []
    for i, text in items[:6]:
        w = text.split()
        changed = list(w)
        for k in range(0, len(w), 9):
            changed[k] = "other"
        texts += [f"{brute.prose(rng, 40)} {text.upper()} {brute.prose(rng, 5)}", text, " ".join(changed), " ".join(w[::2])]
    texts += [brute.prose(rng, 300), "only five words right here", "x only five words right here y", "only five words wrong here", "", None]
    return items, [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("most", [10**6, 0])
def test_leaks_against_sql(docs_of, items_of, most):
    items, rows = planted()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    expected = set(con.execute(decontaminate.ORACLE).fetchall())
    got = {tuple(r) for r in decontaminate.leaks(docs_of(rows), items_of(items), broadcast_seeds=most).collect()}
    short = {r for r in got if r[1] == 6}
    assert {(r[0], r[1]) for r in short} == {(i, 6) for i, t in rows if t and "only five words right here" in t}
    assert got - short == expected and {(4 * k + 1, k) for k in range(6)} <= {r[:2] for r in got}


def test_leaks_of_nulls_and_nothing(docs_of, items_of):
    items, rows = planted()
    assert decontaminate.leaks(docs_of([]), items_of(items)).collect() == []
    assert decontaminate.leaks(docs_of(rows), items_of([])).collect() == []
    again = [(None, rows[1][1]), (1, rows[1][1]), (1, rows[1][1]), (2, "clean text of no interest")]
    got = decontaminate.leaks(docs_of(again), items_of([*items[:1], (None, items[1][1])])).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(None, 0), (1, 0)}
    left = decontaminate.drop_leaked(docs_of(again), items_of(items))
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 2]
    assert left.columns == ["doc_id", "text", "row", "n", "tokens"]


def test_decontamination_runs_no_python(spark):
    plan = decontaminate.op10_decontaminate(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_baseline_scores(docs_of):
    rng = random.Random(6)
    rows = [(i, brute.prose(rng, rng.randrange(0, 80))) for i in range(80)] + [(80, None), (81, ""), (5, "repeated id"), (None, "no id")]
    counts = {}
    for doc_id, text in rows:
        if doc_id is not None and brute.fold(doc_id, 10):
            for w in [*brute.words(text), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text in rows:
        tokens = [*brute.words(text), None]
        base = sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        held = doc_id is None or brute.fold(doc_id, 10) == 0
        expected.append((doc_id or -1, held, len(tokens), sum(w in counts for w in tokens), n, round(base, 6)))
    got = ppm.lm_scores(docs_of(rows)).collect()
    assert sorted((r[0] or -1, *r[1:5], round(r.base_score, 6)) for r in got) == sorted(expected)
    assert all(r.score < 0 and np.isfinite(r.score) for r in got)


def test_scores_of_nothing(docs_of):
    assert ppm.lm_scores(docs_of([])).collect() == []
    got = ppm.lm_scores(docs_of([(None, "a"), (None, None)])).collect()
    assert {r.train_tokens for r in got} == {0} and {r.n_known for r in got} == {0}


def trie(texts, order_counts=None):
    data, starts = text_bytes(pa.array(texts))
    symbol, share = ppm.symbols_of(np.bincount(data, minlength=256))
    keys, counts = np.unique(ppm.leaf_keys(data, starts, symbol)[0], return_counts=True)
    return ppm.Trie(symbol, share, (keys, counts)), keys


def test_each_context_adds_up_to_one():
    model, keys = trie(["abracadabra", "banana band", "", "cab"])
    contexts = np.unique(np.concatenate([keys >> np.uint64(6), np.array([0, 12345, 2**36 - 1], np.uint64)]))
    every = (contexts[:, None] << np.uint64(6)) | np.arange(64, dtype=np.uint64)
    total = (10 ** model.leaf_logs(every.ravel()).reshape(every.shape)).sum(axis=1)
    assert np.allclose(total, 1)


def test_a_known_text_is_likelier():
    rng = random.Random(8)
    known = [brute.prose(rng, 200) for _ in range(20)]
    model, _ = trie(known)
    data, starts = text_bytes(pa.array([known[0], known[0][::-1]]))
    score = model.score(data, starts)
    assert score[0] > 1.5 * score[1]


def ppm_logs(known, asked, order=6):
    """Method D with exclusion over all contexts, by the letter."""
    def symbols(text):
        return [256] * order + list(brute.lower(text).encode()) + [256]

    seen = {}
    for line in map(symbols, known):
        for i in range(order, len(line)):
            for k in range(order + 1):
                after = seen.setdefault(tuple(line[i - k : i]), {})
                after[line[i]] = after.get(line[i], 0) + 1
    out = []
    for line in map(symbols, asked):
        total = 0.0
        for i in range(order, len(line)):
            out_of, chance = set(), 1.0
            for k in range(order, -1, -1):
                after = {s: c for s, c in seen.get(tuple(line[i - k : i]), {}).items() if s not in out_of}
                n, more = sum(after.values()), len(out_of) + len(after) < 257
                if line[i] in after:
                    chance *= (after[line[i]] - (0.5 if more else 0)) / n
                    break
                if n:
                    chance *= len(after) / (2 * n)
                out_of |= after.keys()
            else:
                chance /= 257 - len(out_of)
            total += np.log10(chance)
        out.append(total)
    return out


def test_scores_of_many_scripts_are_those_of_all_contexts(docs_of):
    rng = random.Random(12)
    letters = [*map(chr, range(97, 123)), *map(chr, range(0x430, 0x450)), *map(chr, range(0x4E00, 0x9E00, 150))]
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))) for i in range(60)] + [(None, "~{|} \u00ff never"), (60, None)]
    known = [t or "" for i, t in rows if i is not None and brute.fold(i, 10)]
    assert len(set("".join(known).encode())) > 64
    got = {r.doc_id: r.score for r in ppm.lm_scores(docs_of(rows)).collect()}
    expected = ppm_logs(known, [t or "" for _, t in rows])
    assert [got[i] for i, _ in rows] == pytest.approx(expected, rel=1e-6)


def test_no_context_is_dropped_from_a_large_corpus(docs_of):
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)
    rng = np.random.default_rng(3)
    rows = [(i, rng.choice(letters, 100_000).tobytes().decode()) for i in range(30)]
    got = ppm.lm_scores(docs_of(rows)).filter("NOT held_out").collect()
    assert len(got) >= 24 and all(r.score / 100_000 > -0.35 for r in got)  # each context but few occurs once


def test_every_leaked_pattern_holds_a_seed():
    masks = [[k for k, bit in enumerate(m) if bit == "1"] for m in decontaminate.MASKS]
    for n in range(decontaminate.SHORT, decontaminate.REGION + 1):
        for gone in itertools.combinations(range(n), n - math.ceil(n * decontaminate.MIN_SHARE - 1e-9)):
            assert any(q + m[-1] < n and not {q + k for k in m} & set(gone) for m in masks for q in range(n)), (n, gone)


@pytest.mark.parametrize("most", [10**6, 0])
def test_leaks_against_all_alignments(docs_of, items_of, most):
    rng = random.Random(31)
    sizes = [3, 4, *range(6, 21), 25, 40, 60]
    items = [(i, brute.prose(rng, n)) for i, n in enumerate(sizes)]
    rows = []
    for i, text in items:
        for changes in range(1, 6):
            w = text.split()
            for k in rng.sample(range(len(w)), min(len(w), changes)) if changes < 5 else range(0, len(w), 6):
                w[k] = "other"
            at = rng.randrange(2) * rng.randrange(10)
            rows.append((len(rows), " ".join([brute.prose(rng, at), *w, brute.prose(rng, rng.randrange(5))])))
    rows += [(None, rows[k][1]) for k in range(0, len(rows), 3)] + [(None, "of no interest")] * 5
    expected = {}
    for doc_id, text in rows:
        d = brute.words(text)
        for item_id, item in items:
            w = brute.words(item)
            size = min(len(w), 20)
            for shift in range(-len(w), len(d) + 1):
                same = [0 <= k + shift < len(d) and d[k + shift] == x for k, x in enumerate(w)]
                best = max(sum(same[k : k + size]) for k in range(len(w) - size + 1))
                if best >= math.ceil(size * 0.8 - 1e-9):
                    key = (doc_id, item_id, size)
                    expected[key] = max(best, expected.get(key, 0))
    got = decontaminate.leaks(docs_of(rows), items_of(items), broadcast_seeds=most).collect()
    assert {(r.doc_id, r.item_id, r.region): r.matched for r in got} == expected and len(got) == len(expected)


def test_hits_return_to_their_own_row(docs_of, items_of):
    items, rows = planted()
    plan = decontaminate.leaks(docs_of([(None, t) for _, t in rows]), items_of(items), broadcast_seeds=0)._jdf.queryExecution()
    assert "<=>" not in plan.optimizedPlan().toString()


@pytest.mark.parametrize("most", [10**6, 0])
def test_long_text_of_many_hits_fits_in_memory(docs_of, items_of, most):
    passage = [f"w{k}" for k in range(30)]
    rows = [(1, " ".join(passage * 600)), (2, " ".join(["x", *passage[:15]])), (3, " ".join(passage[9:])), (4, "no leak at all in here")]
    items = [(k, " ".join(passage)) for k in range(3)]
    got = decontaminate.leaks(docs_of(rows), items_of(items), broadcast_seeds=most)
    expected = {(i, k, matched, 20) for i, matched in ((1, 20), (3, 20)) for k in range(3)}
    assert {tuple(r) for r in got.collect()} == expected
    # The hits of a text are held in memory at once unless their stage ends in the aggregate.
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0].splitlines()
    laid = next(k for k, line in enumerate(final) if "slice(words" in line)
    assert "HashAggregate" in final[laid - 1] and final[laid].split("*(")[1][:2] == final[laid - 1].split("*(")[1][:2]
