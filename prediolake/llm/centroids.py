"""Centroid clustering of vectors in exact integers, screened by float32 products with rounding-error intervals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save, through_arrow

#: Components up to this stay exact in 64-bit sums of squares of so many dimensions; beyond, whole numbers of any size are used.
_EXACT, _DIMS = 1 << 26, 256
_MOST = (1 << 63) - 1
_SUMS = "cluster int, dim int, total decimal(38,0), n long"


def _intervals(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above |c|^2 - 2 x.c, for each vector and centroid (integers up to _EXACT), from one float32 product.

    A sum of d products in float32, in any order and with or without fused steps, is off by at most
    d u / (1 - d u) times the sum of the absolute products (u = 2^-24), which is at most |x| |c|; two more u are for
    the factors' own rounding, and what double precision adds is covered by two more. Integers can't underflow.
    """
    d = vectors.shape[1] + 4
    u = 2.0**-24
    gamma = d * u / (1 - d * u)
    product = (vectors.astype(np.float32) @ centroids.T.astype(np.float32)).astype(np.float64)
    x, c = vectors.astype(np.float64), centroids.astype(np.float64)
    squares = (c * c).sum(axis=1)
    reach = 2 * gamma * np.sqrt((x * x).sum(axis=1))[:, None] * np.sqrt(squares)[None, :] * (1 + 1e-9)
    middle = squares[None, :] - 2 * product
    slack = reach + 1e-12 * (squares[None, :] + 2 * np.abs(product)) + 1e-9
    return middle - slack, middle + slack


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance to it, vectors whose intervals overlapped) of integer vectors; ties go to the smaller number.

    A centroid whose interval lies above another's is out. Vectors with one left are done; the others' shortlists are
    compared by exact integer distances. Components over _EXACT (and vectors of over _DIMS) have no interval and are compared with all centroids.
    """
    if not len(vectors):
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), 0
    if vectors.shape[1] > _DIMS or vectors.dtype == object or centroids.dtype == object or max(np.abs(vectors).max(), np.abs(centroids).max()) > _EXACT:
        x, c = vectors.astype(object), centroids.astype(object)
        squared = np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)
        best = np.array([min(range(len(c)), key=lambda j: (row[j], j)) for row in squared], dtype=np.int32)
        return best, squared[np.arange(len(x)), best], len(x)
    low, high = _intervals(vectors, centroids)
    listed = low <= high.min(axis=1)[:, None]
    best = np.argmax(listed, axis=1).astype(np.int32)
    open_ = np.flatnonzero(listed.sum(axis=1) > 1)
    if len(open_):
        exact = np.full((len(open_), len(centroids)), _MOST, dtype=np.int64)
        for j in range(len(centroids)):
            on = np.flatnonzero(listed[open_, j])
            exact[on, j] = ((vectors[open_[on]] - centroids[j]) ** 2).sum(axis=1)
        best[open_] = exact.argmin(axis=1)  # the first of equals
    return best, ((vectors - centroids[best]) ** 2).sum(axis=1), len(open_)


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _wide(centroids: Sequence[Sequence[int]]) -> np.ndarray:
    return np.array(centroids, dtype=object if any(abs(x) > _MOST for c in centroids for x in c) else np.int64)


def _summed(batches: Iterator[pa.RecordBatch], centroids: Sequence[Sequence[int]]) -> Iterator[pa.RecordBatch]:
    """One row for each centroid and dimension of a task: the sum over its vectors, and their number."""
    c = _wide(centroids)
    k, d = c.shape
    totals, counts = [[0] * d for _ in range(k)], [0] * k
    for b in batches:
        vectors = _matrix(b.column(0))
        best, _, _ = nearest(vectors, c)
        for j in np.unique(best):
            own = vectors[best == j]
            if np.abs(own).max() > _MOST // max(1, len(own)):
                own = own.astype(object)
            totals[j] = [a + int(s) for a, s in zip(totals[j], own.sum(axis=0), strict=True)]
            counts[j] += len(own)
    rows = [(j, i, Decimal(totals[j][i]), counts[j]) for j in range(k) if counts[j] for i in range(d)]
    if rows:
        cluster, dim, total, n = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(dim, pa.int32()), pa.array(total, pa.decimal128(38, 0)), pa.array(n, pa.int64())], ["cluster", "dim", "total", "n"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: Sequence[Sequence[int]]) -> Iterator[pa.RecordBatch]:
    c = _wide(centroids)
    for b in batches:
        best, squared, _ = nearest(_matrix(b.column(1)), c)
        distance = [int(x) if x <= _MOST else None for x in squared]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.int32()), pa.array(distance, pa.int64())], [b.schema.names[0], "cluster", "distance"])


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, x) of the rows with exactly ``dims`` components, none null or non-finite; x holds floor(scale * component), in doubles, within 64 bits."""
    finite = F.forall(F.col(vector_col), lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    kept = vectors.filter((F.size(vector_col) == dims) & finite)
    edge = float(1 << 62)
    whole = lambda v: F.floor(F.least(F.greatest(v.cast("double") * float(scale), F.lit(-edge)), F.lit(edge))).cast("long")
    return kept.select(F.col(id_col).alias("id"), F.transform(vector_col, whole).alias("x"))


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3:") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that is kept.

    Centroids start as the ``k`` vectors with the smallest sha256 of ``seed`` and id; each round assigns every vector
    and replaces the centroids by the floors of exact means. A round is one pass that gives a row for each centroid and
    dimension of a task, k * dims of which reach the driver. What is broadcast are the centroids.

    Left out: vectors that are null, of another number of components, or hold null or non-finite ones. Null ids come
    last among the starts, equal ids by their components; repeated rows are rows of their own; of fewer than k vectors
    each is a start; none: no rows. Components beyond 2^62 / scale count as that; a distance or inertia that no long
    holds is null. Columns not named are left aside, whatever their names.
    """
    spark = vectors.sparkSession
    kept = save(integer_vectors(vectors, id_col, vector_col, dims, scale), "centroid-vectors")
    first = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    starts = kept.select(first.alias("_at"), "x").orderBy(F.col("_at").asc_nulls_last(), "x").limit(k).collect()
    centroids = [[int(v) for v in r.x] for r in starts]
    kind = kept.schema["id"].dataType.simpleString()
    if not centroids:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        sums = through_arrow(kept.select("x"), partial(_summed, centroids=centroids), _SUMS)
        for r in sums.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            centroids[r.cluster][r.dim] = int(r.total) // r.n
    assigned = save(through_arrow(kept.select("id", "x"), partial(_assigned, centroids=centroids), f"id {kind}, cluster int, distance long"), "centroid-assigned")
    total = F.when(F.count(F.lit(1)) == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")))
    inertia = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(total.alias("total")).collect()}
    whole = None if None in inertia.values() else sum(inertia.values())
    fits = lambda n: None if n is None or n > _MOST else int(n)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    by_cluster = lambda values, sql: F.element_at(F.array(*(F.lit(v).cast(sql) for v in values)), F.col("cluster") + 1)
    return assigned.select(
        F.col("id").alias(id_col), "cluster", "distance", by_cluster([fits(inertia.get(j)) for j in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(fits(whole)).cast("long").alias("inertia"), by_cluster(digest, "string").alias("centroid_sha256"),
    )


def oracle(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3:") -> str:
    """The same in DuckDB SQL, every round a step of its own."""
    floor_div = "((s - ((s % n) + n) % n) // n)"
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, [CAST(floor({scale} * CAST(v AS DOUBLE)) AS BIGINT) FOR v IN embedding] AS x FROM embeddings "
        f"WHERE len(embedding) = {dims} AND len([v FOR v IN embedding IF v IS NOT NULL AND isfinite(v)]) = {dims})",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x FROM (SELECT sha256('{seed}' || CAST(vec_id AS VARCHAR)) AS h, x FROM kept ORDER BY h, x LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (SELECT i, vec_id, k.x, c.cluster, "
            f"CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(k.x, c.x)]) AS BIGINT) AS d FROM (SELECT row_number() OVER () AS i, * FROM kept) k, c{r} c) GROUP BY i, vec_id, x)"
        )
        if r < rounds:
            steps.append(
                f"m{r} AS MATERIALIZED (SELECT cluster, list(CAST({floor_div} AS BIGINT) ORDER BY dim) AS x FROM (SELECT cluster, dim, sum(v) AS s, count(*) AS n FROM "
                f"(SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS dim FROM a{r}) GROUP BY cluster, dim) GROUP BY cluster)"
            )
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.cluster)")
    return (
        f"WITH {', '.join(steps)} SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster"
    )
