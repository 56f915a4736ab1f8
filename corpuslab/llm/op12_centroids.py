"""Operator 12, centroid clustering by the threshold algorithm.

Vectors are integers. For each dimension the centroids are sorted by their component. From
a vector's own value the sorted lists are walked outward, one centroid a list and step; each
centroid met for the first time gets its exact squared distance. No centroid that has not
been met can be nearer than the sum of the squared frontier distances, so a vector is done
once that sum strictly exceeds its best exact distance (ties are met before) or all
centroids have been met.

A round is one map over the written integer vectors, in which each task sums its vectors by
centroid, and a grouping of those few sums (decimals); only centroids and their sums pass
through the driver. All of it is 64-bit integer arithmetic.

Defined results: rows whose vector is null, of another length than ``dims``, or holds null or
non-finite components are dropped. Rows that share a vec_id count one by one (equal hashes
are ordered by vector); a null vec_id gives no first centroid but is assigned. With fewer
rows than ``k`` there are fewer centroids; without any row with an id, one of zeros. A
centroid without vectors stays; ties go to the smaller number. Components beyond
``vectors.bound`` (131,072 in absolute value at 64 dimensions) are taken as that bound, as no
64-bit distance could hold more. Extra columns are not read; empty in, empty out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import bound, dense, scaled, summed

FAR = np.iinfo(np.int64).max


def nearest(x: np.ndarray, centroids: np.ndarray, exact=None) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest centroid (the smaller number of equals) and the squared
    distance. ``exact`` is told how many exact distances a step takes."""
    n, dims = x.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    of_dim = np.arange(dims)
    right = np.stack([np.searchsorted(lists[:, j], x[:, j]) for j in range(dims)], axis=1) if n else np.zeros((0, dims), np.int64)
    left = right - 1
    far = np.full((n, k), FAR, np.int64)
    live = np.arange(n)
    for _ in range(k):
        if not len(live):
            break
        here, l, r = x[live], left[live], right[live]
        below = np.where(l >= 0, here - lists[np.maximum(l, 0), of_dim], FAR)
        above = np.where(r < k, lists[np.minimum(r, k - 1), of_dim] - here, FAR)
        down = below <= above
        met = order[np.where(down, l, r), of_dim]
        new = np.zeros((len(live), k), bool)
        new[np.arange(len(live))[:, None], met] = True
        new &= far[live] == FAR
        row, c = np.nonzero(new)
        diff = here[row] - centroids[c]
        far[live[row], c] = np.einsum("ij,ij->i", diff, diff)
        if exact is not None:
            exact(len(row))
        frontier = np.minimum(below, above)
        left[live] = l - down
        right[live] = r + ~down
        seen = far[live]
        done = (np.einsum("ij,ij->i", frontier, frontier) > seen.min(axis=1)) | (seen != FAR).all(axis=1)
        live = live[~done]
    best = far.argmin(axis=1)
    return best, far[np.arange(n), best]


def _sums(centroids: np.ndarray, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for b in batches:
            for _, x in dense(b, centroids.shape[1], most):
                of, _ = nearest(x, centroids)
                np.add.at(total, of, x)
                counts += np.bincount(of, minlength=len(centroids))
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(counts[full]), pa.array(list(total[full]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "sums"])
    return run


def _assigned(centroids: np.ndarray, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in dense(b, centroids.shape[1], most):
                of, far = nearest(x, centroids)
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(of, pa.int32()), pa.array(far)], names=["id", "cluster", "distance"])
    return run


def fit(rows: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> np.ndarray:
    """Centroids of the written integer vectors (id, v)."""
    most = bound(dims)
    first = (rows.filter("id IS NOT NULL").select("v", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"))
             .orderBy("h", "v").limit(k).collect())
    centroids = np.clip(np.array([r["v"] for r in first] or [[0] * dims], np.int64).reshape(-1, dims), -most, most)
    for _ in range(rounds):
        partial = rows.select("v").mapInArrow(_sums(centroids, most), "cluster int, n bigint, sums array<bigint>")
        centroids = centroids.copy()
        for (c,), n, total in summed(partial, ["cluster"], dims):
            centroids[c] = [s // n for s in total]
    return centroids


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
            column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """A row per kept vector (id, cluster, distance), and the centroids."""
    rows = scaled(vectors, {"id": "vec_id"}, column, scale, dims)
    centroids = fit(rows, k, rounds, dims, seed)
    schema = f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance bigint"
    return saved(rows.mapInArrow(_assigned(centroids, bound(dims)), schema), "clusters"), centroids


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256; there are as many
    sums as centroids."""
    sums = {r["cluster"]: int(r["total"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    of = lambda values, kind: F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster") + 1)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return rows.select(F.col("id").alias("vec_id"), "cluster", "distance", of([sums.get(i, 0) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
                       F.lit(sum(sums.values())).cast("bigint").alias("inertia"), of(digests, "string").alias("centroid_sha256"))


def sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The same in DuckDB."""
    steps = [f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id IS NULL, sha256('{seed}:' || CAST(vec_id AS VARCHAR)), embedding) - 1 AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cent0 AS MATERIALIZED (SELECT r AS c, v FROM kept WHERE r < {k})"""]
    near = """near{i} AS MATERIALIZED (
  SELECT x.r, min(list_sum(list_transform(list_zip(x.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) * {k} + b.c) AS m
  FROM kept x CROSS JOIN cent{i} b GROUP BY x.r)"""
    for i in range(rounds):
        steps.append(near.format(i=i, k=k))
        steps.append(f"""cent{i + 1} AS MATERIALIZED (
  SELECT b.c, coalesce(s.v, b.v) AS v FROM cent{i} b LEFT JOIN (
    SELECT c, list((total - ((total % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT y.m % {k} AS c, x.i, sum(x.e) AS total, count(*) AS n
      FROM (SELECT r, unnest(v) AS e, unnest(range(len(v))) AS i FROM kept) x JOIN near{i} y ON x.r = y.r
      GROUP BY y.m % {k}, x.i) GROUP BY c) s ON b.c = s.c)""")
    steps.append(near.format(i=rounds, k=k))
    steps.append(f"""SELECT x.vec_id, CAST(y.m % {k} AS INTEGER) AS cluster, CAST(y.m // {k} AS BIGINT) AS distance,
  CAST(sum(y.m // {k}) OVER (PARTITION BY y.m % {k}) AS BIGINT) AS cluster_inertia, CAST(sum(y.m // {k}) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(b.v, ',')) AS centroid_sha256
FROM kept x JOIN near{rounds} y ON x.r = y.r JOIN cent{rounds} b ON b.c = y.m % {k}""")
    return ",\n".join(steps)
