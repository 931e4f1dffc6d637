import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlemill.llm import quality
from candlemill.llm.common import keyed
from tests.llm import brute
from tests.llm.test_models import corpus


@pytest.fixture(scope="module")
def world(docs_of, labels_of, items_of, tmp_path_factory):
    """Documents with junk, exact and near copies, and benchmark passages; each kind by id."""
    rng = random.Random(21)
    docs, labels = corpus(21, 240)
    items = [(i, brute.prose(rng, 30)) for i in range(4)]
    clean = [(i, t) for i, t in docs if i % 4 in (0, 3)]
    more = []
    for k, (i, text) in enumerate(clean[:20]):
        more.append((1000 + k, text.upper() if k % 2 else text))
    for k, (i, text) in enumerate(clean[20:40]):
        words = text.split()
        words[len(words) // 2] = "changed"
        more.append((2000 + k, " ".join(words)))
    for k in range(12):
        more.append((3000 + k, f"{brute.prose(rng, 30)} {items[k % 4][1]} {brute.prose(rng, 20)}"))
    more += [(4000, None), (4001, ""), (4002, "short")]
    folder = tmp_path_factory.mktemp("world")
    tables = {
        "documents": docs_of(docs + more).select("doc_id", "text", "row", "n"),
        "labels": labels_of(labels), "benchmark": items_of(items),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder), docs + more, items


def test_the_stages_are_those_asked_for():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_each_stage_does_its_whole_work(spark, world):
    folder, rows, items = world
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    text = dict(rows)
    judged = quality.quality(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    expected = {r.doc_id for r in judged.collect() if r.predicted}
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        out = stages[name](spark, docs, folder)
        out.write.mode("overwrite").parquet(f"{folder}/stage-{name}")
        return spark.read.parquet(f"{folder}/stage-{name}")

    docs = run("quality", docs)
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == expected
    assert sum(i % 4 == 1 for i in expected if i < 1000) <= 3  # junk
    assert sum(i % 4 != 1 for i in expected if i < 1000) >= 175  # clean documents stay

    docs = run("exact_dedup", docs)
    last = {}
    for i in sorted(expected):
        last[brute.lower(text[i])] = i
    expected = set(last.values())
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == expected

    docs = run("near_dedup", docs)
    left = [(i, text[i]) for i in sorted(expected)]
    expected = {i for (i, _), c in zip(left, brute.components(left, 5, 80)) if i == c}
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == expected
    assert len(left) - len(expected) >= 8

    docs = run("decontamination", docs)
    leaked = {i for i in expected if any(t in (text[i] or "") for _, t in items)}
    assert leaked and docs.columns == columns
    assert {r.doc_id for r in docs.collect()} == expected - leaked

    pieces = run("packing", docs).toPandas()
    assert set(pieces.doc_id) == expected - leaked
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert pieces.groupby("sequence_id").length.sum().max() <= 2048


def test_run_gives_the_last_stage(spark, world):
    folder, _, _ = world
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 100


def test_stages_of_empty_tables(spark, tmp_path, docs_of, labels_of, items_of):
    for name, df in {"labels": labels_of([]), "benchmark": items_of([])}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "row", "n", "tokens"] and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0


def without_ids(docs_of):
    """Texts by kind; kinds that are repeated have a copy with an id, or none."""
    rng = random.Random(33)
    text = {k: brute.prose(rng, 60) for k in "abcdef"}
    near = {k: " ".join(["changed", *t.split()[1:]]) for k, t in text.items()}
    leak = brute.prose(rng, 30)
    rows = [
        (7, text["a"]), (None, text["a"].upper()), (None, text["b"]), (None, text["b"]), (None, text["c"]), (-3, near["c"]),
        (None, text["d"]), (None, near["d"]), (None, text["e"]), (9, text["f"]),
        (None, f"{text['e']} {leak}"), (11, leak), (None, None), (None, ""),
    ]
    docs = docs_of(rows).withColumn("_KEY", F.lit("mine")).withColumn("_gone", F.lit(1))
    return docs, text, near, leak


def test_stages_judge_rows_without_an_id(spark, tmp_path, docs_of, items_of):
    docs, text, near, leak = without_ids(docs_of)
    items_of([(1, leak)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        out = stages[name](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        return out, sorted(((r.doc_id, r.text or "") for r in out.collect()), key=str)

    docs, left = run("exact_dedup", docs)
    texts = [t for _, t in left]
    assert len(texts) == 11 == len(set(texts)) and (7, text["a"]) in left and (None, text["b"]) in left
    docs, left = run("near_dedup", docs)
    texts = [t for _, t in left]
    assert (-3, near["c"]) in left and text["c"] not in texts and (text["d"] in texts) != (near["d"] in texts)
    assert len(left) == 9 and (None, "") in left
    docs, left = run("decontamination", docs)
    assert len(left) == 7 and not any(leak in t for _, t in left) and (None, text["e"]) in left


def test_keys_of_rows_without_an_id(spark, docs_of):
    docs = docs_of([(3, "x"), (5, "y"), (None, "z"), (None, "z")])
    same, key = keyed(docs.filter("doc_id > 0"), "doc_id", below=True)
    assert key == "doc_id" and same.columns == docs.columns
    for below in (True, False):
        named, key = keyed(docs, "doc_id", below)
        keys = [r[key] for r in named.filter("doc_id IS NULL").collect()]
        assert len(set(keys)) == 2 and all(k < 3 if below else k > 5 for k in keys)
    none, key = keyed(docs.filter("doc_id IS NULL"), "doc_id", below=False)
    assert len({r[key] for r in none.collect()} - {None}) == 2
    ends = docs_of([(-(2**63), "x"), (2**63 - 1, "x"), (None, "x"), (None, "q")])
    for name in ("exact_dedup", "near_dedup"):
        left = dict(corpus_pipeline.STAGES)[name](spark, ends, "")
        assert left.filter("doc_id IS NOT NULL").count() >= 1 and "q" in [r.text for r in left.collect()]
