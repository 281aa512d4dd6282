"""Ball k-means over integer vectors, exact to the last unit.

A cluster is a ball: its centroid, and a radius that no member exceeds. Cluster j is a
neighbour of i if half the distance of their centroids is at most i's radius; no member of i can
be nearer to any other centroid. Within a ball, members closer than half the distance of the
nearest neighbour are the stable core and keep their cluster; an annulus begins at half the
distance of each further neighbour, and its members are compared exactly with the neighbours up
to there and with nobody else. All comparisons are of whole squared distances, and those at the
border are compared, so the result is that of a full search, ties to the smaller number
included.

Each round is a narrow Arrow pass that writes vector, cluster and distance, and a sum of k rows
a task; the driver holds k centroids. A radius after a move is bounded by the old one plus the
move, so no pass is needed to find it.

Defined cases: vectors of another length, null ones, and those with a null or non-finite
component are left out. Components beyond 2^19 count as 2^19, so that distances fit in 64 bits;
sums of distances that don't fit raise. With fewer vectors than clusters there are as many
clusters as vectors; equal vectors may be several centroids, of which the first gets all
members. Null ids come last among the starting vectors; equal ids are taken in order of their
components, and each row is a vector. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import written

DIM, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
LARGEST = 1 << 27
#: Components of vectors less centroids that are held at once.
HELD = 1 << 21


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """id and v: floor(scale * component) of every vector of `dim` finite components."""
    schema = T.StructType([T.StructField("id", table.schema[id_col].dataType), T.StructField("v", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fits = np.flatnonzero(b.column(1).value_lengths().fill_null(-1).to_numpy() == dim)
            own = b.take(pa.array(fits))
            x = own.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)  # null is nan
            finite = np.isfinite(x).all(1)
            v = np.clip(np.floor(scale * x[finite]), -LARGEST, LARGEST).astype(np.int32)
            yield pa.RecordBatch.from_arrays([own.column(0).filter(pa.array(finite)), _lists(v)], names=["id", "v"])

    return table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(run, schema)


def _lists(v: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel()))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim).astype(np.int64)


@dataclass
class Balls:
    """centres; neighbours of each by distance (the cluster itself first); squared distances to them times a quarter's reach."""

    centres: np.ndarray
    order: np.ndarray | None = None
    apart: np.ndarray | None = None

    @classmethod
    def around(cls, centres: np.ndarray, radius: np.ndarray) -> Balls:
        """Neighbours by radius; clusters that are none stand at an infinite distance."""
        between = ((centres[:, None] - centres[None]) ** 2).sum(2)
        near = np.sqrt(between.astype(float)) / 2 <= radius[:, None] * (1 + 1e-9)
        apart = np.where(near, between, np.iinfo(np.int64).max)
        np.fill_diagonal(apart, -1)
        order = np.argsort(apart, axis=1, kind="stable")
        return cls(centres, order, np.take_along_axis(apart, order, 1))

    def relevant(self, own: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """How many of its cluster's row of `order` each vector is compared with: 1 in the stable core, one more an annulus."""
        return (self.apart[own] <= 4 * distance[:, None]).sum(1)

    def nearest(self, v: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centre (ties: the smaller number) and squared distance of each vector, and how many distances it took."""
        cluster, distance, taken = np.empty(len(v), np.int32), np.empty(len(v), np.int64), 0
        step = max(1, HELD // self.centres.size)
        for a in range(0, len(v), step):
            part = v[a : a + step]
            if own is None:
                count = np.full(len(part), len(self.centres))
            else:
                mine = own[a : a + step]
                count = self.relevant(mine, ((part - self.centres[mine]) ** 2).sum(1))
            first = np.cumsum(count) - count
            row = np.repeat(np.arange(len(part)), count)
            rank = np.arange(len(row)) - first[row]
            j = rank if own is None else self.order[mine[row], rank]
            d = ((part[row] - self.centres[j]) ** 2).sum(1)
            least = np.minimum.reduceat(d, first)
            distance[a : a + step] = least
            cluster[a : a + step] = np.minimum.reduceat(np.where(d == least[row], j, len(self.centres)), first)
            taken += len(row)
        return cluster, distance, taken


def assigned(state: DataFrame, balls: Balls, keep_vectors: bool = True) -> DataFrame:
    """id, cluster, distance (and v) of each vector; state: id, v and, after the first round, cluster."""
    first = "cluster" not in state.columns
    dim = balls.centres.shape[1]
    schema = T.StructType([state.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()), *([state.schema["v"]] if keep_vectors else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cluster, distance, _ = balls.nearest(_matrix(b.column(1), dim), None if first else b.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster), pa.array(distance), *([b.column(1)] if keep_vectors else [])], names=schema.names)

    return state.select("id", "v", *([] if first else ["cluster"])).mapInArrow(run, schema)


def moved(state: DataFrame, balls: Balls) -> Balls:
    """The balls of the state's clusters: mean vectors rounded down, radii from members and move."""
    k, dim = balls.centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, far, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches:
            cluster = b.column(0).to_numpy()
            n += np.bincount(cluster, minlength=k)
            np.maximum.at(far, cluster, b.column(1).to_numpy())
            np.add.at(total, cluster, _matrix(b.column(2), dim))
        some = np.flatnonzero(n)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * dim, pa.int32()), pa.array(total[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(far[some]), sums], names=["cluster", "n", "far", "total"])

    parts = state.select("cluster", "distance", "v").mapInArrow(run, "cluster long, n long, far long, total array<long>")
    sums = F.array(*[F.sum(F.col("total")[i]) for i in range(dim)])
    centres, radius = balls.centres.copy(), np.full(k, -1.0)
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("far").alias("far"), sums.alias("total")).collect():  # k rows
        c = r["cluster"]
        centres[c] = [t // r["n"] for t in r["total"]]
        radius[c] = r["far"] ** 0.5 + float(((centres[c] - balls.centres[c]) ** 2).sum()) ** 0.5
    return Balls.around(centres, radius)


def ball_kmeans(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each kept vector."""
    spark = table.sparkSession
    vectors = integer_vectors(table, id_col, vector_col, dim, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = [r["v"] for r in vectors.orderBy(key.asc_nulls_last(), "v").limit(clusters).collect()]
    balls = Balls(np.array(start, np.int64).reshape(-1, dim))
    state = vectors
    for _ in range(rounds):
        state = written(assigned(state, balls))
        balls = moved(state, balls)
    final = written(assigned(state, balls, keep_vectors=False))
    inertia = dict(final.groupBy("cluster").agg(F.sum("distance")).collect())  # a row a cluster
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in balls.centres.tolist()]
    ends = [(c, total, sum(inertia.values()), sha[c]) for c, total in inertia.items()]
    described = spark.createDataFrame(ends, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = final.join(F.broadcast(described), "cluster")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_kmeans(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_sql() -> str:
    """The same by a full search: each round's nearest centroids and means."""

    def near(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (SELECT row_id, (min(ROW(k.v2 - 2 * list_dot_product(k.v, c.v) + list_dot_product(c.v, c.v), c.cluster))) AS best FROM kept k CROSS JOIN c{n} c GROUP BY row_id),
b{n} AS MATERIALIZED (SELECT row_id, best[2] AS cluster, CAST(best[1] AS BIGINT) AS distance FROM a{n})"""

    def mean(n: int) -> str:
        return f"""s{n} AS (SELECT cluster, i, sum(CAST(v[i] AS HUGEINT)) AS total, count(*) AS n FROM b{n} JOIN kept USING (row_id), range(1, {DIM + 1}) t(i) GROUP BY cluster, i),
m{n} AS (SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS v FROM s{n} GROUP BY cluster),
c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (cluster))"""

    parts = [
        f"""given AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE len(embedding) = {DIM}),
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) AS row_id, vec_id, v, list_dot_product(v, v) AS v2 FROM (SELECT vec_id, list_transform(e, lambda x: floor({SCALE} * x)) AS v FROM given WHERE len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) - 1 AS cluster, v FROM kept QUALIFY row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) <= {CLUSTERS})"""
    ]
    for n in range(ROUNDS):
        parts += [near(n), mean(n)]
    parts.append(near(ROUNDS))
    return f"""WITH {", ".join(parts)}
SELECT k.vec_id, CAST(b.cluster AS INTEGER) AS cluster, b.distance, CAST(sum(b.distance) OVER (PARTITION BY b.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(b.distance) OVER () AS BIGINT) AS inertia,
sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM b{ROUNDS} b JOIN kept k USING (row_id) JOIN c{ROUNDS} c ON c.cluster = b.cluster"""
