import random

import numpy as np
import pyarrow as pa
import pytest

from candlemill.llm import quality, toxicity, urls
from tests.llm import brute


def corpus(seed, n=360):
    """Documents with their labels: one in four is junk, one in four is toxic."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = brute.prose(rng, rng.randrange(30, 120)).split()
        junk, toxic = i % 4 == 1, i % 4 == 2
        if junk:
            w = rng.choice([[x.upper() + "!!" for x in w], [f"{x} |" for x in w], [x for x in w for _ in range(9)]])
        if toxic:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["moron", "scum,", "worthless", "lostra" + rng.choice(["ei", "un", "schaft"])])
            w.insert(3, "you")
        docs.append((i, " ".join(w)))
        labels.append((i, 0 if junk else 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def learned():
    return corpus(11)


def test_quality_on_held_out_rows(docs_of, labels_of, learned):
    docs, labels = learned
    odd = [(1000, None), (1001, ""), (None, docs[0][1]), (0, docs[0][1]), (1002, "word " * 50_000)]
    got = quality.quality(docs_of(docs + odd), labels_of(labels + [(None, 1, 0), (2000, 1, 0), (2001, None, None)])).collect()
    assert len(got) == len(docs) + len(odd)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if brute.fold(i, 4) == 2}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert len({r.score for r in got if r.doc_id in (1000, 1001)}) == 1
    kept = quality.drop_rejected(docs_of(docs + odd), labels_of(labels))
    assert kept.columns == ["doc_id", "text", "row", "n", "tokens"]
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i is not None} == {r.doc_id for r in got if r.predicted and r.doc_id is not None}


def test_quality_without_labels_or_rows(docs_of, labels_of, learned):
    docs, labels = learned
    assert quality.quality(docs_of([]), labels_of(labels)).collect() == []
    assert {r.score for r in quality.quality(docs_of(docs[:5]), labels_of([])).collect()} == {0.5}
    assert quality.drop_rejected(docs_of(docs[:5]), labels_of([])).count() == 5


def test_votes_are_those_of_all_pairs(learned):
    docs, labels = learned
    terms = quality.form(pa.array([t for _, t in docs]))
    model = quality.Model(terms[:200], np.array([q for _, q, _ in labels[:200]]))
    got = model.score(terms[200:])
    for row, score in zip(terms[200:], got):
        vector = model.weigh(row) @ model.project
        cosine = model.vectors @ (vector / np.linalg.norm(vector))
        top = np.argsort(cosine)[-quality.NEIGHBOURS :]
        weight = np.maximum(cosine[top].astype(float), 0) ** quality.SHARPNESS
        assert score == pytest.approx((weight * model.labels[top]).sum() / weight.sum(), abs=1e-3)


def test_quality_sees_words_of_texts_of_one_form():
    """Two topics whose words are anagrams of one another's letters, in the same pattern."""
    rng = random.Random(4)
    made = {k: ["".join(rng.sample("abcdefgh", 6)) for _ in range(120)] for k in (0, 1)}
    labels = np.array([k % 2 for k in range(300)])
    texts = [" ".join(rng.choice(made[k]) for _ in range(80)) for k in labels]
    terms = quality.form(pa.array(texts))
    score = quality.Model(terms[:200], labels[:200]).score(terms[200:])
    assert ((score >= 0.5) == labels[200:]).mean() >= 0.95
    plain = terms.copy()
    plain[:, quality.FORM_TERMS :] = 0
    score = quality.Model(plain[:200], labels[:200]).score(plain[200:])
    assert ((score >= 0.5) == labels[200:]).mean() < 0.8


def test_terms_do_not_depend_on_blocks():
    texts = pa.array(["", "a b", None, "x " * 40, "É ü"] * 500).fill_null("")
    parts = np.concatenate([quality.form(part) for part in quality._parts(texts.slice(1))])
    assert np.allclose(parts, quality.form(texts.slice(1))) and len(parts) == len(texts) - 1
    assert np.allclose(parts[2][quality.FORM_TERMS :].sum(), 1) and not parts[1].any()


def test_toxicity_on_held_out_rows(docs_of, labels_of, learned):
    docs, labels = corpus(12, 900)
    odd = [(1000, None), (1001, ""), (None, docs[2][1]), (2, docs[2][1]), (1002, "long " * 50_000)]
    got = toxicity.toxicity(docs_of(docs + odd), labels_of(labels + [(None, 1, 1), (2001, None, None)])).collect()
    assert len(got) == len(docs) + len(odd)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if brute.fold(i, 5) == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_without_labels_or_rows(docs_of, labels_of, learned):
    docs, labels = learned
    assert {r.score for r in toxicity.toxicity(docs_of(docs[:5]), labels_of([])).collect()} == {0.5}
    ones = [(i, 1, 1) for i, _ in docs[:30]]
    assert {r.score for r in toxicity.toxicity(docs_of(docs[:30]), labels_of(ones)).collect()} == {1.0}
    assert toxicity.toxicity(docs_of([]), labels_of(labels)).collect() == []


def test_features_of_words():
    words = toxicity.Words({"idiot": 4.0, "lowe*": 3.0})
    assert words.look("idiot!") == (4.0, 0.0, False, False, False)
    assert words.look("1d10t") == (4.0, 0.0, False, True, True)
    assert words.look("loweist,")[1] == 3.0 and words.look("you")[2] and not words.look("fine.")[3]
    row = words.features(pa.array(["You are an idiot!", "", "all is WELL"]))
    assert row.shape == (3, toxicity.FEATURES) and not row[1].any()
    assert row[0][0] == 0.25 and row[0][7] == 0.25 and row[2][10] == pytest.approx(1 / 3)


URLS = [
    "https://a.com/x", "http://example.com/en/1", "http://WWW.Example.com/en/1?q=/fr/", "http://m.www.example.com/en/", "http://example.com/EN/1",
    "http://example.com", "http://example.com?x=1", "http://b.net/es/1#top", "http://b.net/fr/", "http://net/es/", "http://anet/es/", "http://b.net/en/1",
    "http://u:p@x.com:80/", "no scheme", "", None, "http://x.org/a/b/c?x=1&y=2", "https://x.org//en/?q", "://x.com/", "a://b://c.com/",
]


def ref(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min(rest.find(c) if c in rest else len(rest) for c in "/?#")
    host, rest = brute.lower(rest[:end]), rest[end:]
    path = rest[: min(rest.find(c) if c in rest else len(rest) for c in "?#")]
    fits = [r for r, _ in urls.RULES if (host == r[: r.index("/")] or host.endswith("." + r[: r.index("/")])) and path.startswith(r[r.index("/") :])]
    return host, path, max(fits, key=len, default=None)


def test_urls_by_rule(pages_of):
    rows = [(i, u, None) for i, u in enumerate(URLS * 3)] + [(None, URLS[0], None), (0, URLS[0], None)]
    got = urls.judge(pages_of(rows)).collect()
    assert len(got) == len(rows)
    rules = dict(urls.RULES)
    for r in got:
        host, path, rule = ref(URLS[(r.page_id or 0) % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == rules[rule] if rule else r.verdict in ("allow", "block")
        assert (r.score is None) == (rule is not None)


def test_urls_without_rules_or_rows(pages_of):
    assert urls.judge(pages_of([])).collect() == []
    got = urls.judge(pages_of([(1, "http://x.org/", None)])).collect()
    assert [(r.rule, r.verdict, r.score) for r in got] == [(None, "block", 0.5)]
    got = urls.judge(pages_of([(1, "http://a.com/", None)]), rules=()).collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "block")]


def test_lexical_features():
    assert urls.suffixes("a.b.example.com") == ["com", "example.com", "b.example.com"]
    assert urls.entropy("") == 0 and urls.entropy("aabb") == 1
    row = urls.features("https://a1.example.com/x/yy?p=1&q=2#t", "a1.example.com", "/x/yy", {"com": 0.9}, 0.5)
    assert row[3] == 2 and row[9] == 2 and row[-3:] == [0.9, 0.5, 0.5]
