"""Centroid clustering in whole numbers: distances, choice and updates are JVM expressions, so every digit is exact.

A vector's components become integers once and are stored. A round is one pass: zip_with and aggregate give the squared
distance to each literal centroid array, array_min of (distance, cluster) structs chooses, and column sums per cluster
are aggregated on the map side. Only k rows of sums, bounded by k and the dimension, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlab.llm.storage import store

#: Integers are held within +-LARGEST, so that a squared distance of 64 components fits 64 bits.
LARGEST = 1 << 26


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, dimension: int, scale: int) -> DataFrame:
    """id and v = floor(scale * x) of the vectors with exactly `dimension` components, none null, NaN or infinite."""
    x = f"`{vector_col}`"
    fit = f"size({x}) = {int(dimension)} AND forall({x}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(CAST(x AS DOUBLE)) < DOUBLE('Infinity'))"
    whole = f"transform({x}, x -> CAST(floor(greatest(-{LARGEST}D, least({LARGEST}D, {int(scale)}D * CAST(x AS DOUBLE)))) AS BIGINT))"
    return rows.where(F.col(vector_col).isNotNull() & F.expr(fit)).select(F.col(id_col).alias("id"), F.expr(whole).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes, in their order; equal hashes are ordered by the vectors."""
    name = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256).alias("name")
    return [list(r.v) for r in vectors.select(name, "v").orderBy(F.asc_nulls_last("name"), "v").limit(k).collect()]


def nearest(centroids: Sequence[Sequence[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid; the smaller number wins a tie."""

    def to(j: int, centroid: Sequence[int]) -> str:
        point = "array(" + ", ".join(f"{int(c)}L" for c in centroid) + ")"
        return f"named_struct('distance', aggregate(zip_with(v, {point}, (x, c) -> (x - c) * (x - c)), 0L, (a, b) -> a + b), 'cluster', {j})"

    return F.expr("array_min(array(" + ", ".join(to(j, c) for j, c in enumerate(centroids)) + "))")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every non-empty centroid goes to the componentwise floor of its vectors' mean."""
    chosen = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    out = list(centroids)
    for r in chosen.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # at most k rows
        out[r["cluster"]] = [s // r["n"] for s in r[2:]]
    return out


def clusters(rows: DataFrame, k: int, rounds: int, dimension: int = 64, scale: int = 256, seed: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector that is kept.

    Kept are vectors with exactly `dimension` components, none null, NaN or infinite; component x counts as
    floor(scale * x), held within +-LARGEST. Clusters start at the k vectors with the smallest sha256 of seed and id,
    are moved `rounds` times and assigned once more; an empty cluster stays where it is. Fewer than k vectors give as
    many clusters as vectors. Repeated rows count each and come out each. A null id has no hash, so it starts a
    cluster last. An inertia beyond 64 bits is null. An empty table gives no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    vectors = store(whole_vectors(rows, id_col, vector_col, dimension, scale), "vectors")
    centroids = first_centroids(vectors, k, seed)
    kind = rows.schema[id_col].dataType.simpleString()
    if not centroids:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    best = vectors.select("id", nearest(centroids).alias("best"))
    placed = store(best.select("id", F.col("best.cluster").alias("cluster"), F.col("best.distance").alias("distance")), "clusters")
    inertia = {r.cluster: int(r.total) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("total")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    whole = fits(sum(inertia.values()))
    facts = [(j, fits(n), whole, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for j, n in sorted(inertia.items())]
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(about), "cluster").select(  # at most k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
