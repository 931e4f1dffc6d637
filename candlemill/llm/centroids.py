"""Centroid clustering in exact integers, with N-simplex projection as the filter.

A vector's distances to a few fixed pivots are cached as the coordinates of an apex over the
simplex that the pivots span: its place in the pivots' hull, and its height over it. For two
apexes a and b the Euclidean distance of the vectors lies between

    sqrt(|a' - b'|^2 + (a_h - b_h)^2)   and   sqrt(|a' - b'|^2 + (a_h + b_h)^2)

where a' are the places and a_h the heights. In each round a centroid whose lower bound lies
over the least upper bound of all centroids cannot be the nearest one; the rest are compared
in exact integers. Bounds are widened by more than their rounding errors, so they only save
work and decide nothing.

Vectors stay where they are: a round is one pass that sends sums per cluster, added up by
Spark. The driver holds k centroids and the pivots only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import released, settled, shipped, table

CLUSTERS, ROUNDS, DIMENSION, SCALE, SEED = 8, 10, 64, 1024, "3"
PIVOTS = 12
CANDIDATES = 64  # vectors among which pivots are chosen
LEAST_HEIGHT = 0.1  # of a pivot over the ones before, as a share of its distance to the first
SLACK = 1e-5  # of the distances to the first pivot, by which bounds are widened
SMALL = 1 << 27  # components below it have squared distances below 2**63
LIMB = 40  # bits of a part of a sum
BOUNDS = 1 << 20  # coordinates of bounds that are computed at a time


def grid(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as whole doubles; exact, as the scale is a power of two."""
    return np.floor(values.astype(np.float64) * scale)


def _large(*values: np.ndarray) -> bool:
    return any(np.abs(v).max(initial=0) >= SMALL for v in values)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole doubles, row by row: 64-bit, or unbounded integers."""
    if not _large(x, y):
        gap = x.astype(np.int64) - y.astype(np.int64)
        return np.einsum("ij,ij->i", gap, gap)
    whole = np.frompyfunc(int, 1, 1)
    gap = whole(x) - whole(y)
    return (gap * gap).sum(axis=1)


class Simplex:
    """Apex coordinates over pivots (rows of whole doubles) that span a simplex."""

    def __init__(self, candidates: np.ndarray, most: int = PIVOTS):
        self.pivots = candidates[:1]
        self.base = np.zeros((1, 0))  # coordinates of the pivots themselves
        while len(candidates) and len(self.pivots) < most:
            apexes = self.project(candidates)
            reach = np.sqrt((apexes**2).sum(axis=1))
            tall = int(np.argmax(apexes[:, -1]))  # the candidate that stands highest over the hull
            if not apexes[tall, -1] > LEAST_HEIGHT * reach[tall]:
                break
            self.base = np.vstack([np.pad(self.base, ((0, 0), (0, 1))), apexes[tall]])
            self.pivots = np.vstack([self.pivots, candidates[tall]])

    def project(self, x: np.ndarray) -> np.ndarray:
        """One row per vector: its place in the pivots' hull, then its height."""
        far = np.stack([squared(x, p[None, :]).astype(np.float64) for p in self.pivots], axis=1)
        n = len(self.pivots) - 1
        out = np.zeros((len(x), n + 1))
        for j in range(n):
            v = self.base[j + 1]
            out[:, j] = (far[:, 0] + v @ v - far[:, j + 1]) / 2 - out[:, :j] @ v[:j]
            out[:, j] /= v[j]
        out[:, n] = np.sqrt(np.maximum(far[:, 0] - (out[:, :n] ** 2).sum(axis=1), 0))
        return out


def possible(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids (apexes as well) the bounds leave for each vector."""
    reach = np.sqrt((apexes**2).sum(axis=1))[:, None] + np.sqrt((centroids**2).sum(axis=1))
    place = ((apexes[:, None, :-1] - centroids[:, :-1]) ** 2).sum(axis=2)
    lower = np.sqrt(place + (apexes[:, None, -1] - centroids[:, -1]) ** 2)
    upper = np.sqrt(place + (apexes[:, None, -1] + centroids[:, -1]) ** 2)
    widened = SLACK * reach + 1e-3
    return lower - widened <= (upper + widened).min(axis=1)[:, None]


def nearest(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray) -> np.ndarray:
    """The number of each vector's nearest centroid; of equally near ones the smallest."""
    step = max(1, BOUNDS // centroid_apexes.size)
    blocks = [possible(apexes[i : i + step], centroid_apexes) for i in range(0, len(apexes), step)]
    open_ = np.concatenate(blocks) if blocks else np.zeros((0, len(centroids)), bool)
    found = open_.argmax(axis=1)  # right where one is left
    unsure = np.flatnonzero(open_.sum(axis=1) != 1)
    if not len(unsure):
        return found
    best = np.full(len(x), math.inf, object) if _large(x, centroids) else np.full(len(x), np.iinfo(np.int64).max)
    for k in range(len(centroids)):
        rows = unsure[open_[unsure, k]]
        if len(rows):
            gap = squared(x[rows], centroids[k : k + 1])
            nearer = (gap < best[rows]).astype(bool)
            best[rows[nearer]], found[rows[nearer]] = gap[nearer], k
    return found


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = batch.column(name)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _projected(simplex: Simplex, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apexes = simplex.project(grid(_matrix(batch, "vector"), scale))
                flat = pa.array(apexes.ravel())
                offsets = pa.array(np.arange(batch.num_rows + 1) * apexes.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vector"), pa.ListArray.from_arrays(offsets, flat)], names=["vec_id", "vector", "apex"]
                )

    return run


def _limbs(number: int) -> Iterator[tuple[int, int]]:
    """(place, part) of a number in base 2**LIMB, each part with its sign."""
    sign, number, place = (-1 if number < 0 else 1), abs(number), 0
    while number:
        yield place, sign * (number & ((1 << LIMB) - 1))
        number >>= LIMB
        place += 1


def _sums(centroids: list[list[int]], simplex: Simplex, scale: int):
    """Per task: rows of each cluster (component -1), and its components' sums in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.array(centroids, np.float64)
        apexes = simplex.project(middle)
        count = [0] * len(centroids)
        total = [[0] * middle.shape[1] for _ in centroids]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = grid(_matrix(batch, "vector"), scale)
            cluster = nearest(x, _matrix(batch, "apex"), middle, apexes)
            whole = x.astype(np.int64) if not _large(x) else np.frompyfunc(int, 1, 1)(x)
            for k in np.unique(cluster):
                own = whole[cluster == k]
                count[k] += len(own)
                total[k] = [a + int(b) for a, b in zip(total[k], own.sum(axis=0))]
        rows = [(k, -1, 0, n) for k, n in enumerate(count) if n]
        rows += [(k, j, *limb) for k, n in enumerate(count) if n for j, sum_ in enumerate(total[k]) for limb in _limbs(sum_)]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["cluster", "component", "place", "part"]
        )
        released()

    return run


def _assigned(centroids: list[list[int]], simplex: Simplex, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.array(centroids, np.float64)
        apexes = simplex.project(middle)
        for batch in batches:
            if batch.num_rows:
                x = grid(_matrix(batch, "vector"), scale)
                cluster = nearest(x, _matrix(batch, "apex"), middle, apexes)
                far = squared(x, middle[cluster])
                far = pa.array([int(d) if d < 1 << 63 else None for d in far], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), far], names=["vec_id", "cluster", "distance"])
        released()

    return run


def usable(vectors: DataFrame, dimension: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vector) of the rows with ``dimension`` components, none null or non-finite."""
    finite = F.forall(F.col(vec_col), lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = vectors.filter((F.size(vec_col) == dimension) & finite)
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vector"))


def centroid_clusters(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimension: int = DIMENSION,
    scale: int = SCALE,
    seed: str = SEED,
    pivots: int = PIVOTS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every usable vector, settled, and the final centroids.

    Centroids start as the k vectors with the least SHA-256 of ``seed:vec_id``; of rows that
    share an id the one with the smaller components comes first, and a row without an id is
    hashed as ``seed:``. With fewer than k vectors there are as many centroids. A vector equally near to
    several goes to the first of them. Vectors of another length, null ones, and those with a
    null or non-finite component are left out; repeated rows count each on its own. Components
    may be of any size; a squared distance of 2**63 or more is exact in the clustering and
    null in the result. An empty table gives no rows and no centroids.
    """
    spark = shipped(vectors.sparkSession)
    rows = usable(vectors, dimension, id_col, vec_col)
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(named, "vector").limit(max(k, CANDIDATES)).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    begin = grid(np.array([r["vector"] for r in first], np.float64), scale)
    simplex = Simplex(begin, pivots)
    centroids = [[int(x) for x in row] for row in begin[:k]]
    cached = settled(
        rows.mapInArrow(_projected(simplex, scale), f"vec_id long, vector {rows.schema['vector'].dataType.simpleString()}, apex array<double>"),
        "centroid-vectors",
    )
    for _ in range(rounds):
        parts = cached.mapInArrow(_sums(centroids, simplex, scale), "cluster int, component int, place int, part long")
        sums = parts.groupBy("cluster", "component", "place").agg(F.sum("part").alias("part")).collect()
        count, total = {}, {}
        for r in sums:
            if r["component"] < 0:
                count[r["cluster"]] = r["part"]
            else:
                key = r["cluster"], r["component"]
                total[key] = total.get(key, 0) + (r["part"] << LIMB * r["place"])
        for c, n in count.items():
            centroids[c] = [total.get((c, j), 0) // n for j in range(dimension)]
    return settled(cached.mapInArrow(_assigned(centroids, simplex, scale), "vec_id long, cluster int, distance long"), "centroid-assigned"), centroids


def clustered(vectors: DataFrame, **options) -> DataFrame:
    """The assignment with each cluster's and the whole inertia and a digest of its centroid.

    An inertia that holds a null distance, or is 2**63 or more, is null.
    """
    rows, centroids = centroid_clusters(vectors, **options)
    found = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"), F.min(F.col("distance").isNotNull()).alias("whole"))
    sums = {r["cluster"]: int(r["sum"]) if r["whole"] else None for r in found.collect()}
    fits = lambda x: x if x is not None and x < 1 << 63 else None
    total = None if None in sums.values() else fits(sum(sums.values()))
    lines = [
        (c, fits(inertia), total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, inertia in sorted(sums.items())
    ]
    ends = rows.sparkSession.createDataFrame(lines, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(ends), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """All rounds as one chain of tables, one row per component."""
    rounds = []
    for r in range(ROUNDS + 1):
        rounds.append(f"""
far{r} AS MATERIALIZED (SELECT n, c, CAST(sum((x.v - y.v) * (x.v - y.v)) AS BIGINT) AS d FROM x JOIN c{r} y USING (j) GROUP BY n, c),
near{r} AS MATERIALIZED (SELECT n, min(c) AS c, any_value(least) AS d
    FROM far{r} JOIN (SELECT n, min(d) AS least FROM far{r} GROUP BY n) USING (n) WHERE d = least GROUP BY n)""")
        if r < ROUNDS:
            rounds.append(f"""
sum{r} AS MATERIALIZED (SELECT c, j, CAST(sum(v) AS BIGINT) AS s, count(*) AS m FROM near{r} JOIN x USING (n) GROUP BY c, j),
c{r + 1} AS MATERIALIZED (SELECT c, j, CASE WHEN m IS NULL THEN v
    ELSE CAST((s - (((s % m) + m) % m)) // m AS BIGINT) END AS v FROM c{r} LEFT JOIN sum{r} USING (c, j))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)), embedding) - 1 AS n, vec_id, embedding
    FROM embeddings WHERE len(embedding) = {DIMENSION}
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMENSION}),
places AS (SELECT unnest(range(1, {DIMENSION + 1})) AS j),
x AS MATERIALIZED (SELECT n, j, CAST(floor(CAST(embedding[j] AS DOUBLE) * {SCALE}) AS BIGINT) AS v FROM kept, places),
c0 AS MATERIALIZED (SELECT n AS c, j, v FROM x WHERE n < {CLUSTERS}),{','.join(rounds)},
digests AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
    CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{ROUNDS} JOIN kept USING (n) JOIN digests USING (c)"""


ORACLE = _oracle()
