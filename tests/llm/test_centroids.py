import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from candlemill.llm import centroids

SF = "/root/testdata/sf0.001"


def frame(spark, rows, kind=T.FloatType()):
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(kind)), T.StructField("vector", T.StringType()),
         T.StructField("cluster", T.IntegerType()), T.StructField("apex", T.StringType())]
    )
    df = spark.createDataFrame([(*r, "x", 5, "y") for r in rows], schema)
    return df.repartition(3) if rows else df


def plain(rows, k=8, rounds=10):
    """The contract in Python integers."""
    rows = [(i, [math.floor(x * 1024) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in rows)
    middle = [v for _, v in named[:k]]

    def near(v):
        gaps = [sum((a - b) ** 2 for a, b in zip(v, m)) for m in middle]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        own = {}
        for _, v in rows:
            own.setdefault(near(v)[0], []).append(v)
        for c, members in own.items():
            middle[c] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *near(v)) for i, v in rows]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    fits = lambda x: x if x < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    whole = {c: inertia[c] if all(d < 1 << 63 for _, e, d in found if e == c) else 1 << 64 for c in inertia}
    return [(i, c, fits(d), fits(whole[c]), fits(sum(whole.values())), digest[c]) for i, c, d in found]


def key(row):
    return tuple((x is None, x or 0) for x in row[:3])


def vectors(seed, n, spread=0.2, scale=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    near = [rng.choice(middles) for _ in range(n)]
    return [(i, [float(np.float32(scale * (x + rng.gauss(0, spread)))) for x in near[i]]) for i in range(n)]


def odd():
    rows = vectors(1, 120)
    bad = [None, [], [1.0] * 63, [1.0] * 65, [1.0] * 63 + [None], [1.0] * 63 + [math.nan], [math.inf] + [0.0] * 63]
    return rows + [(900 + i, v) for i, v in enumerate(bad)] + [(None, rows[0][1]), (None, rows[1][1]), rows[2], rows[2], (3, rows[5][1])]


@pytest.mark.parametrize(
    "rows", [odd(), vectors(2, 5), vectors(3, 60, spread=1.0), [(i, [0.5] * 64) for i in range(20)], [(1, [-0.0001] * 64)]]
)
def test_clusters_against_plain_integers(spark, rows):
    got = centroids.clustered(frame(spark, rows))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("scale", [3e4, 1e6, 1e30])
def test_large_components_stay_exact(spark, scale):
    rows = vectors(4, 40, scale=scale) + vectors(5, 10)
    got = centroids.clustered(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


def test_doubles_and_empty_tables(spark):
    rows = vectors(6, 30)
    got = centroids.clustered(frame(spark, rows, T.DoubleType()))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)
    for rows in ([], [(1, None)]):
        assert centroids.clustered(frame(spark, rows)).collect() == []


def test_clusters_against_sql(spark):
    got = sorted(tuple(r) for r in centroids.op12_centroids(spark, SF).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    assert got == sorted(con.execute(centroids.ORACLE).fetchall())


def test_bounds_hold_and_save_comparisons():
    x = centroids.grid(np.array([v for _, v in vectors(7, 400)]))
    simplex = centroids.Simplex(x[:64], 12)
    assert len(simplex.pivots) >= 6
    middle = x[100:108]
    apexes, ends = simplex.project(x), simplex.project(middle)
    true = np.sqrt(((x[:, None] - middle) ** 2).sum(axis=2))
    place = ((apexes[:, None, :-1] - ends[:, :-1]) ** 2).sum(axis=2)
    assert (np.sqrt(place + (apexes[:, None, -1] - ends[:, -1]) ** 2) <= true + 1e-3).all()
    assert (np.sqrt(place + (apexes[:, None, -1] + ends[:, -1]) ** 2) >= true - 1e-3).all()
    left = centroids.possible(apexes, ends)
    assert left[np.arange(len(x)), true.argmin(axis=1)].all()
    assert left.mean() < 0.5  # of the comparisons
    assert (centroids.nearest(x, apexes, middle, ends) == true.argmin(axis=1)).all()


def test_pivots_that_span_nothing():
    same = np.full((10, 64), 7.0)
    simplex = centroids.Simplex(same, 12)
    assert simplex.project(same).shape == (10, 1) and not simplex.project(same).any()
    assert centroids.nearest(same, simplex.project(same), same[:3], simplex.project(same[:3])).tolist() == [0] * 10
    line = np.outer(np.arange(10.0), np.ones(64))
    assert len(centroids.Simplex(line, 12).pivots) == 2


def test_sums_in_parts():
    for number in (0, 5, -5, (1 << 40) - 1, 1 << 40, -(1 << 90) - 12345):
        assert sum(part << 40 * place for place, part in centroids._limbs(number)) == number
