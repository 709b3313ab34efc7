"""Clustering integer vectors around centroids, with squared differences looked up in tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from flatloom.llm.text import whole_row

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 40, 5, 256
# Vectors whose distances are added up together, so that the sums stay in the processor's cache.
SLICE_ROWS = 2048
# Components up to this size keep a squared distance, and the sum of 64 of them, within 64 bits.
LARGEST = 1 << 27

_PART = "cluster int, dimension int, total decimal(38,0), n long, inertia decimal(38,0)"


def is_vector(column: Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether an array has exactly ``dimensions`` components, none null, NaN or infinite."""
    finite = F.forall(column, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(column) == dimensions) & finite, F.lit(False))


def _integers(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """The vectors of a batch as rows of integers, ``floor(scale * x)``."""
    if not len(column):
        return np.zeros((0, dimensions), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.floor(scale * flat)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST} / {scale}: squared distances would leave 64 bits")
    return values.astype(np.int64).reshape(-1, dimensions)


def _slices(batch: pa.RecordBatch, dimensions: int, scale: int) -> Iterator[np.ndarray]:
    vectors = _integers(batch.column(batch.num_columns - 1), dimensions, scale)
    for at in range(0, len(vectors), SLICE_ROWS):
        yield vectors[at : at + SLICE_ROWS]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the first of equally near ones, and the squared distance.

    For each dimension the squared difference of every integer value that occurs there to every
    centroid is tabulated once; a vector's distances are then the sum of one table row for each
    dimension.
    """
    sums = np.zeros((len(vectors), len(centroids)), np.int64)
    for d in range(vectors.shape[1]):
        occurring, place = np.unique(vectors[:, d], return_inverse=True)
        table = (occurring[:, None] - centroids[None, :, d]) ** 2
        sums += table[place]
    cluster = sums.argmin(axis=1)
    return cluster, sums[np.arange(len(vectors)), cluster]


def _round(centroids: np.ndarray, scale: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a round adds up, in one row for each cluster and dimension that a task has seen."""
    k, dimensions = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        inertia = [0] * k
        for batch in batches:
            for vectors in _slices(batch, dimensions, scale):
                cluster, distance = nearest(vectors, centroids)
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                totals[found] += np.add.reduceat(vectors[order], first)
                counts += np.bincount(cluster, minlength=k)
                for c, x in zip(found.tolist(), np.add.reduceat(distance[order], first).tolist(), strict=True):
                    inertia[c] += x
        used = np.flatnonzero(counts)
        if not len(used):
            return
        number = pa.decimal128(38, 0)
        # The number of vectors and their distances stand in the row of the first dimension.
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, dimensions), pa.int32()),
                pa.array(np.tile(np.arange(dimensions), len(used)), pa.int32()),
                pa.array(totals[used].ravel().tolist()).cast(number),
                pa.array([int(counts[c]) if d == 0 else 0 for c in used for d in range(dimensions)], pa.int64()),
                pa.array([inertia[c] if d == 0 else 0 for c in used for d in range(dimensions)]).cast(number),
            ],
            ["cluster", "dimension", "total", "n", "inertia"],
        )

    return run


def _assignment(centroids: np.ndarray, scale: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(v, centroids) for v in _slices(batch, centroids.shape[1], scale)]
            cluster, distance = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
            columns = [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "cluster", "distance"])

    return run


def first_centroids(kept: DataFrame, id_column: str, k: int, scale: int) -> np.ndarray:
    """The integer vectors of the ``k`` rows whose ids come first by hash."""
    key = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(F.col("row")[id_column].alias("id"), "vector").orderBy(key, "vector").limit(k).collect()
    return _integers(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), len(rows[0]["vector"]) if rows else 0, scale)


def moved(centroids: np.ndarray, sums: list) -> np.ndarray:
    """The centroids at the floor of their vectors' means; one without vectors stays."""
    counts: dict[int, int] = {}
    for r in sums:
        counts[r["cluster"]] = counts.get(r["cluster"], 0) + r["n"]
    out = centroids.copy()
    for r in sums:
        out[r["cluster"], r["dimension"]] = int(r["total"]) // counts[r["cluster"]]
    return out


def clustered(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> DataFrame:
    """Every vector with its cluster: row (all columns), cluster, distance, cluster_inertia, inertia,
    centroid_sha256.

    Vectors with another number of components, or with a null, NaN or infinite one, are left out,
    as is a null array. Components become ``floor(scale * x)``. The centroids start as the ``k`` vectors
    whose ids come first by the SHA-256 of ``2:<id>``, fewer if there are fewer vectors; a null id
    hashes as empty text, and rows that share an id stand in the order of their vectors. Each
    round moves a centroid to the floor of the mean of its vectors; one without vectors stays. Of
    equally near centroids the one with the smaller number is taken. Distances are squared and
    exact; a component that would not let them be is an error. Rows repeated as a whole are
    vectors of their own. No vectors give no rows.

    A round reads the table once and sends one sum per task, cluster and dimension, whatever the
    number of vectors; only the ``k`` centroids come to the driver. The table is read once
    for each round and twice after: hand over one that is written, not one that is costly to compute.
    """
    kept = vectors.filter(is_vector(F.col(f"`{vector_column}`"), dimensions)).select(
        whole_row(vectors), F.col(f"`{vector_column}`").alias("vector")
    )
    row_type = kept.schema["row"]
    schema = StructType([row_type, StructField("cluster", IntegerType()), StructField("distance", LongType())])
    figures = (F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("string"))
    centroids = first_centroids(kept, id_column, k, scale)
    if not len(centroids):
        found = kept.select("row", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        names = ("cluster_inertia", "inertia", "centroid_sha256")
        return found.select("*", *(c.alias(n) for c, n in zip(figures, names, strict=True)))

    def summed(now: np.ndarray) -> list:
        parts = kept.select("vector").mapInArrow(_round(now, scale), _PART)
        sums = F.sum("total").alias("total"), F.sum("n").alias("n"), F.sum("inertia").alias("inertia")
        # At most k times the number of dimensions rows.
        return parts.groupBy("cluster", "dimension").agg(*sums).collect()

    for _ in range(rounds):
        centroids = moved(centroids, summed(centroids))
    inertia = [0] * len(centroids)
    for r in summed(centroids):
        inertia[r["cluster"]] += int(r["inertia"])
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    assigned = kept.select("row", "vector").mapInArrow(_assignment(centroids, scale), schema)
    at = F.col("cluster") + 1
    return assigned.select(
        "row",
        "cluster",
        "distance",
        F.element_at(F.array(*[F.lit(x).cast("long") for x in inertia]), at).alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), at).alias("centroid_sha256"),
    )
