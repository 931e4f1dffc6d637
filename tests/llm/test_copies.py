import hashlib
import random

import duckdb
import pytest

from candlemill.llm import exact_dedup, jaccard_join
from candlemill.llm.components import components
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def cases():
    rng = random.Random(1)
    long = brute.prose(rng, 300)
    rows = [
        (1, "Same Text"), (2, "same text"), (3, "same text"), (4, "SAME TEXT É"), (5, "same text é"), (6, None), (7, ""),
        (8, long), (9, long.upper()), (10, long + "x"), (11, "x" + long), (12, long), (None, "same text"), (None, "no id"),
        (None, "no id"), (13, "twice"), (13, "twice"), (14, " "), (15, "\n"),
    ]
    return rows


@pytest.mark.parametrize("block", [64, 4096])
def test_exact_dedup_names_equal_texts(docs_of, block):
    rows = cases()
    got = exact_dedup.exact_dedup(docs_of(rows), block_bytes=block).collect()
    assert len(got) == len(rows)
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(brute.lower(text), []).append(doc_id)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_hash[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    for sha, ids in by_hash.items():
        kept = [r for r in got if r.text_sha256 == sha and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


def test_exact_dedup_of_nothing(docs_of):
    assert exact_dedup.exact_dedup(docs_of([])).collect() == []
    assert exact_dedup.drop_copies(docs_of([])).collect() == []


def test_drop_copies_keeps_columns_and_rows_without_id(docs_of):
    left = exact_dedup.drop_copies(docs_of(cases()))
    assert left.columns == ["doc_id", "text", "row", "n", "tokens"]
    ids = [r.doc_id for r in left.collect()]
    # 12 is the last of its group, 9 and 8 are its copies; 13 is twice the same row.
    assert sorted(i for i in ids if i is not None) == [3, 4, 5, 7, 10, 11, 12, 13, 14, 15]
    assert ids.count(None) == 2


def test_exact_dedup_against_sql(spark):
    got = sorted(tuple(r) for r in exact_dedup.op1_exact_dedup(spark, SF).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert got == sorted(con.execute(exact_dedup.ORACLE).fetchall())


def near_copies(seed=2):
    rng = random.Random(seed)
    rows = []
    for family in range(12):
        base = brute.prose(rng, rng.choice([3, 4, 5, 12, 60, 150])).split()
        for _ in range(rng.choice([1, 2, 6, 30])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(40)}"
            if rng.random() < 0.3:
                copy = copy[: max(1, len(copy) - rng.randrange(8))]
            rows.append((len(rows), " ".join(copy)))
    shared = brute.prose(rng, 50)
    rows += [(len(rows) + i, f"{brute.prose(rng, 60)} {shared}") for i in range(40)]
    n = len(rows)
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "one two three"), (None, rows[0][1]), (3, rows[3][1])]


@pytest.mark.parametrize("size,percent,group", [(4, 85, 256), (5, 80, 256), (4, 85, 4)])
def test_jaccard_components_against_all_pairs(docs_of, monkeypatch, size, percent, group):
    monkeypatch.setattr(jaccard_join.links, "__defaults__", (85, group))
    monkeypatch.setattr(jaccard_join, "SALT", 8)
    rows = near_copies()
    expected = {}
    for (doc_id, text), label in zip(rows, brute.components(rows, size, percent)):
        expected.setdefault((doc_id, len(brute.shingles(text, size)), label), 0)
        expected[doc_id, len(brute.shingles(text, size)), label] += 1
    got = {}
    for r in jaccard_join.jaccard_components(docs_of(rows), size, percent).collect():
        got[tuple(r)] = got.get(tuple(r), 0) + 1
    assert got == expected


def test_jaccard_of_nothing_and_of_no_words(docs_of):
    assert jaccard_join.jaccard_components(docs_of([])).collect() == []
    got = jaccard_join.jaccard_components(docs_of([(1, None), (2, ""), (None, "")])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]


def test_drop_near_copies_leaves_one_of_each_component(docs_of):
    rows = [r for r in near_copies(3) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    labels = brute.components(rows, 5, 80)
    left = jaccard_join.drop_near_copies(docs_of(rows), size=5, percent=80)
    assert left.columns == ["doc_id", "text", "row", "n", "tokens"]
    assert sorted(r.doc_id for r in left.collect()) == sorted({x for x in labels})


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i + 1, i) for i in range(100, 160)]
    hub = [(1, i) for i in range(1000, 1500)]
    edges = spark.createDataFrame(path + hub + [(7, 7), (9, 8), (8, 9)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in (1, *range(1000, 1500))}, 8: 8, 9: 8}
