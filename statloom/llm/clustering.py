"""Centroid clustering: ball k-means over integer vectors, exact in every comparison that it makes."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm import common

#: Squared distances stay below this: four times as much fits into a long.
FAR = 1 << 60
#: Rows whose distances are computed at once in a task.
BLOCK = 8_192


def bound(dimensions: int) -> int:
    """Components of integer vectors lie within this, so that no squared distance exceeds FAR."""
    return math.isqrt(FAR // dimensions) // 2


def integer_vectors(rows: DataFrame, id_column: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, v): vectors with exactly so many components, none null or non-finite, each as floor(scale * component)."""
    x = F.col(f"`{vector}`")
    whole = (F.size(x) == dimensions) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < float(bound(dimensions))))
    return rows.where(F.coalesce(whole, F.lit(False))).select(F.col(f"`{id_column}`").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int")).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of `seed:vec_id`; of equal ids the smaller vector first, null ids last."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(rank.alias("rank"), "v").orderBy(F.col("rank").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


class Balls:
    """Clusters as balls: centroids, squared radius bounds, and of each the others in the order of distance."""

    def __init__(self, centroids: np.ndarray, radius: np.ndarray) -> None:
        self.centroids = centroids
        gap = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2)  # squared distances of centroids
        self.near: list[tuple[np.ndarray, np.ndarray]] = []
        for j, row in enumerate(gap):
            # a member at distance d can be as near to another centroid only if that one is within 2 d, d at most the radius
            others = np.array([i for i in np.argsort(row, kind="stable") if i != j and row[i] <= 4 * radius[j]], np.int64)
            self.near.append((others, row[others]))

    def assign(self, vectors: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each vector's nearest centroid (ties: the smaller number) and squared distance, and how many distances it took.

        cluster: the ball that each vector is a member of. Members nearer to its centre than half the way to the nearest
        neighbour are the stable core and stay. The rest are in annuli, cut where half the way to the next neighbour lies:
        in the i-th annulus the i nearest neighbours are compared, and no others.
        """
        new, dist, looked = cluster.copy(), np.empty(len(cluster), np.int64), len(cluster)
        for j in np.unique(cluster):
            at = np.flatnonzero(cluster == j)
            x = vectors[at]
            own = ((x - self.centroids[j]) ** 2).sum(1)
            best, who = own.copy(), np.full(len(at), j)
            others, gaps = self.near[j]
            annulus = np.searchsorted(gaps, 4 * own, side="right")  # neighbours with gap <= 2 d, equality for ties
            for i, other in enumerate(others):
                inside = np.flatnonzero(annulus > i)
                if not len(inside):
                    break  # annuli are nested: no member reaches a further neighbour
                looked += len(inside)
                d = ((x[inside] - self.centroids[other]) ** 2).sum(1)
                better = (d < best[inside]) | (d == best[inside]) & (other < who[inside])
                best[inside[better]], who[inside[better]] = d[better], other
            new[at], dist[at] = who, best
        return new, dist, looked


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def _assigned(rows: DataFrame, balls: Balls, dimensions: int) -> DataFrame:
    """vec_id, v, cluster, distance of rows that are members of `cluster`."""
    kind = next(t for n, t in rows.dtypes if n == "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                new, dist, _ = balls.assign(_matrix(batch.column("v"), dimensions), batch.column("cluster").to_numpy().astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(new.astype(np.int32)), pa.array(dist)], names=["vec_id", "v", "cluster", "distance"])

    return rows.select("vec_id", "v", "cluster").mapInArrow(run, f"vec_id {kind}, v array<int>, cluster int, distance long")


def _sums(rows: DataFrame, dimensions: int) -> DataFrame:
    """cluster, n, radius (largest squared distance), inertia, s (componentwise sums): a row for each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            v, c, d = _matrix(batch.column("v"), dimensions), batch.column("cluster").to_numpy(), batch.column("distance").to_numpy()
            for j in np.unique(c):
                at = c == j
                n, r, inertia, s = held.get(int(j), (0, 0, 0, np.zeros(dimensions, np.int64)))
                held[int(j)] = [n + int(at.sum()), max(r, int(d[at].max())), inertia + (int((d[at] >> 32).sum()) << 32) + int((d[at] & 0xFFFFFFFF).sum()), s + v[at].sum(0)]
        if held:
            cols = zip(*((j, n, r, Decimal(i), s.tolist()) for j, (n, r, i, s) in held.items()), strict=True)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.decimal128(38), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["cluster", "n", "radius", "inertia", "s"])

    partial = rows.select("v", "cluster", "distance").mapInArrow(run, "cluster int, n long, radius long, inertia decimal(38,0), s array<long>")
    total = [F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(dimensions)]
    return partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("inertia").alias("inertia"), *total).select("cluster", "n", "radius", "inertia", F.array(*[f"s{i}" for i in range(dimensions)]).alias("s"))


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, dimensions: int = 64, scale: int = 64, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each kept vector with cluster, distance (squared), cluster_inertia, inertia and centroid_sha256.

    Vectors of another length, null ones, and ones with null, NaN or infinite components, or with components beyond
    bound() as integers, are left out. Centroids are numbered in the order of the hashes of their ids. `rounds` times each vector goes to the
    nearest (ties: the smaller number) and centroids become floors of means; one without vectors stays. Then all are assigned
    once more. With fewer vectors than k there are so many clusters; an empty table gives an empty one. Rows that repeat an id
    are vectors of their own, null ids too, which centroids start from only if ids run out. Equal vectors go to one cluster, as
    every vector is judged alone; nothing is shuffled but k sums a task. An inertia
    beyond a long is null. Extra columns are ignored, whatever their names.

    Balls are carried from round to round: a cluster's squared radius is known from its members, and, after its centre has
    moved, bounded by radius and move; k centroids and k sums (k is a parameter) are all that the driver sees.
    """
    spark = rows.sparkSession
    common.prepare(spark)
    vectors = integer_vectors(rows, id_column, vector, dimensions, scale)
    centroids = first_centroids(vectors, k, seed)
    kind = next(t for n, t in vectors.dtypes if n == "vec_id")
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    # at first all are members of one ball without a known radius
    now, done = vectors.withColumn("cluster", F.lit(0)), []
    reach = np.full(len(centroids), FAR)
    for turn in range(rounds + 1):
        now = common.save(_assigned(now, Balls(centroids, reach), dimensions), f"clusters-{turn}", done)
        found = {r.cluster: r for r in _sums(now, dimensions).collect()}
        if turn == rounds:
            break
        done, moved = [now], centroids.copy()
        for j, r in found.items():
            moved[j] = np.array(r.s, np.int64) // r.n
        move = ((moved - centroids) ** 2).sum(1)
        radius = np.array([found[j].radius if j in found else 0 for j in range(len(centroids))])
        # the roots' rounding is covered by the added 1
        reach = np.minimum((np.ceil(np.sqrt(radius.astype(float)) + np.sqrt(move.astype(float))) + 1).astype(np.int64), math.isqrt(FAR)) ** 2
        centroids = moved
    inertia = {j: int(r.inertia) for j, r in found.items()}

    def shown(total: int) -> int | None:
        return total if total < 1 << 63 else None

    stats = spark.createDataFrame([(j, shown(x), shown(sum(inertia.values())), centroid_digest(centroids[j])) for j, x in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return now.select("vec_id", "cluster", "distance").join(F.broadcast(stats), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(k: int = 16, rounds: int = 3, seed: int = 1, dimensions: int = 64, scale: int = 64) -> str:
    """The same rows by comparing every vector with every centroid."""
    out = [
        f"""e AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions})""",
        "x AS MATERIALIZED (SELECT rid, vec_id, unnest(v) AS c, unnest(range(len(v))) AS i FROM e)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM e ORDER BY h, v LIMIT {k}))",
    ]
    for t in range(rounds + 1):
        out += [
            f"p{t} AS (SELECT cluster, unnest(v) AS c, unnest(range(len(v))) AS i FROM c{t})",
            f"d{t} AS (SELECT rid, cluster, sum((x.c - p.c) * (x.c - p.c)) AS d FROM x JOIN p{t} p USING (i) GROUP BY ALL)",
            f"a{t} AS MATERIALIZED (SELECT rid, cluster, d FROM d{t} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, cluster) = 1)",
        ]
        if t < rounds:
            floor = "CAST((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
            out += [
                f"m{t} AS (SELECT cluster, list(m ORDER BY i) AS v FROM (SELECT cluster, i, {floor} AS m FROM x JOIN a{t} USING (rid) GROUP BY ALL) GROUP BY ALL)",
                f"c{t + 1} AS MATERIALIZED (SELECT c{t}.cluster, coalesce(m{t}.v, c{t}.v) AS v FROM c{t} LEFT JOIN m{t} USING (cluster))",
            ]
    last = rounds
    return f"""
        WITH {", ".join(out)}
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
        FROM a{last} JOIN e USING (rid) JOIN c{last} USING (cluster)"""
