import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import balls as B


def brute(rows, clusters, rounds, scale=256, seed=2):
    """rows: (id, ints). Full search with Python numbers."""
    key = lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centres = [list(r[1]) for r in sorted(rows, key=key)[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in rows]
        for j in range(len(centres)):
            members = [v for (_, v), o in zip(rows, own, strict=True) if o == j]
            if members:
                centres[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in rows]
    total = sum(d for _, _, d in found)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i if i is not None else -1, c, d, sum(e for _, o, e in found if o == c), total, sha[c]) for i, c, d in found)


def got(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    want = duckdb.sql(B.op12_sql().replace("FROM embeddings", f"FROM '{sf}/embeddings.parquet'")).fetchall()
    assert got(B.op12_ball_kmeans(spark, sf)) == sorted(want)


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_full_search_with_ties_and_copies(spark, seed):
    rng = np.random.default_rng(seed)
    grid = rng.integers(-3, 4, (300, 4)) / 256  # small whole numbers: many equal distances
    blobs = rng.normal(0, 0.03, (300, 4)) + rng.choice([-1, 0, 1], (300, 1))
    vectors = np.vstack([grid, blobs, np.repeat(grid[:1], 200, axis=0)])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in enumerate(vectors.tolist())]
    assert got(B.ball_kmeans(table, dim=4, clusters=17, rounds=4)) == brute(rows, 17, 4)


def test_balls_compare_only_relevant_neighbours():
    rng = np.random.default_rng(3)
    middle = rng.normal(0, 1000, (20, 8))
    v = (np.repeat(middle, 200, axis=0) + rng.normal(0, 40, (4000, 8))).astype(np.int64)
    first = B.Balls(middle.astype(np.int64))
    own, distance, taken = first.nearest(v)
    assert taken == 4000 * 20
    radius = np.array([math.sqrt(distance[own == j].max()) for j in range(20)])
    balls = B.Balls.around(first.centres, radius)
    again, same, taken = balls.nearest(v, own)
    assert (again == own).all() and (same == distance).all() and taken < 4000 * 1.5
    core = balls.relevant(own, distance) == 1
    for j in np.unique(own[core]):
        half = min(math.dist(first.centres[j], c) for k, c in enumerate(first.centres) if k != j) / 2
        assert np.sqrt(distance[core & (own == j)]).max() < half + 1e-6 or radius[j] < half


def test_stale_clusters_are_put_right():
    """Vectors whose cluster is not the nearest, with the radius of that wrong cluster."""
    rng = np.random.default_rng(4)
    centres, v = rng.integers(-50, 50, (12, 5)), rng.integers(-60, 60, (500, 5))
    own = rng.integers(0, 12, 500)
    d = ((v[:, None] - centres[None]) ** 2).sum(2)
    radius = np.array([math.sqrt(d[own == j, j].max()) for j in range(12)])
    cluster, distance, _ = B.Balls.around(centres, radius).nearest(v, own)
    assert (cluster == d.argmin(1)).all() and (distance == d.min(1)).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (2, None), (3, []), (4, [0.1]), (5, [0.1, 0.2, 0.3]), (6, [None, 0.1]), (7, [nan, 0.1]), (8, [0.1, -inf]), (9, [-0.001, 0.0039]), (None, [0.5, 0.5]), (1, [0.5, 0.25]), (10, [1e30, -1e30]), (11, [-0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for clash in ("id", "v", "cluster", "distance", "n", "far", "total", "inertia", "centroid_sha256"):
        table = table.withColumn(clash, F.lit("clash"))
    clip = lambda x: max(-B.LARGEST, min(B.LARGEST, math.floor(256 * x)))
    fits = [(i, [clip(x) for x in v]) for i, v in rows if i in (1, 9, None, 10, 11)]
    for clusters in (2, 40):
        assert got(B.ball_kmeans(table, dim=2, clusters=clusters)) == brute(fits, clusters, 5)
    assert B.ball_kmeans(table.where("false"), dim=2).count() == 0
    floats = table.select(F.col("vec_id").cast("string").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    assert B.ball_kmeans(floats, dim=2).count() == len(fits)
