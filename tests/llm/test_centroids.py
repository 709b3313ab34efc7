"""Clustering against a plain version in whole numbers."""

import hashlib
import math
from collections import Counter

import pytest

from flatloom.llm import centroids
from flatloom.llm.queries import QUERIES

INF, NAN = float("inf"), float("nan")


def brute(rows, k, rounds, dimensions, scale=256):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dimensions]
    kept = [(i, v) for i, v in kept if all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in kept]
    now = [[math.floor(scale * x) for x in v] for _, v in order[:k]]

    def assigned():
        for i, v in whole:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in now]
            yield i, v, far.index(min(far)), min(far)

    for _ in range(rounds):
        groups = [[v for _, v, c, _ in assigned() if c == n] for n in range(len(now))] if len(now) < 9 else None
        if groups is None:
            groups = [[] for _ in now]
            for _, v, c, _ in assigned():
                groups[c].append(v)
        now = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, now, strict=True)]
    last = list(assigned())
    inertia = Counter()
    for _, _, c, d in last:
        inertia[c] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), digests[c]) for i, _, c, d in last)


FIGURES = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = Counter(map(tuple, QUERIES["op11_centroid_clustering"](spark, sf_dir).collect()))
    assert found == brute(rows, 40, 5, 64)


ODD = [
    (1, [0.5, -0.25]), (2, [0.5, -0.25]), (2, [0.5, -0.25]), (None, [3.0, 1.0]), (None, [-3.0, 1.0]), (3, None), (4, []),
    (5, [1.0]), (6, [1.0, None]), (7, [NAN, 1.0]), (8, [INF, 0.0]), (9, [1.0, 2.0, 3.0]), (-4, [0.001, -0.001]),
    (10, [100.0, 100.0]), (11, [0.0, -0.0]), *[(100 + i, [float(i % 3), float(i % 2)]) for i in range(30)],
]


@pytest.mark.parametrize("k", [1, 4, 60])
def test_odd_rows(spark, k):
    # Other columns have the names that the operator uses inside.
    schema = "vec_id long, embedding array<double>, vector string, row string, cluster int"
    table = spark.createDataFrame([(i, v, "v", "r", 1) for i, v in ODD], schema)
    found = centroids.clustered(table, k=k, rounds=3, dimensions=2)
    assert found.select("row.*").columns == table.columns
    assert Counter(map(tuple, found.select("row.vec_id", *FIGURES).collect())) == brute(ODD, k, 3, 2)


def test_no_rows_and_too_large(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found = centroids.clustered(table)
    assert found.columns == ["row", *FIGURES] and found.collect() == []
    table = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        centroids.clustered(table, dimensions=2, k=1).collect()


def test_tables_give_the_distances():
    import numpy as np

    random = np.random.default_rng(5)
    vectors, points = random.integers(-50, 50, (300, 7)), random.integers(-50, 50, (5, 7))
    cluster, distance = centroids.nearest(vectors, points)
    far = ((vectors[:, None] - points[None]) ** 2).sum(2)
    assert (cluster == far.argmin(1)).all() and (distance == far.min(1)).all()
