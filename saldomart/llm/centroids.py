"""Clustering of integer vectors around centroids, with the products of both kept from round to round.

Every vector is stored with its exact dot product with each centroid. A centroid that moved
changes a product only by the components that differ, so a round multiplies those columns
alone, adds the result to the stored products and takes the nearest centroid anew:
|v - c|^2 = |v|^2 - 2 v.c + |c|^2. All of it is whole numbers; nothing is rounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from saldomart.llm.common import batch
from saldomart.session import new_folder, remove_folder

SCALE = 64
MAX_COMPONENT = 1 << 27  # a squared distance of 64 such components still fits into 63 bits
MAX_CENTROIDS = 4096  # they and their changes go to every task

_STATE = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("v", pa.list_(pa.int32())),
        ("products", pa.list_(pa.int64())),
        ("cluster", pa.int32()),
        ("distance", pa.int64()),
    ]
)
_STATE_DDL = "vec_id long, v array<int>, products array<long>, cluster int, distance long"


def whole_vectors(vectors: DataFrame, dims: int, scale: int = SCALE) -> DataFrame:
    """vec_id and components as floor(scale * x), of the rows that ``cluster_vectors`` keeps."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < MAX_COMPONENT / scale, F.lit(False)))
    sound = (F.size(x) == dims) & finite
    components = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("int"))
    return vectors.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), components.alias("v"))


def updated_products(v: np.ndarray, products: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Products after the centroids moved by ``change`` (centroids x components)."""
    products = products.copy()
    for c in np.flatnonzero(change.any(axis=1)):
        moved = np.flatnonzero(change[c])
        products[:, c] += v[:, moved] @ change[c, moved]
    return products


def nearest(v: np.ndarray, products: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector, the smaller one of equals, and the squared distance."""
    beyond = (centroids * centroids).sum(axis=1) - 2 * products
    cluster = beyond.argmin(axis=1)
    return cluster, (v * v).sum(axis=1) + beyond[np.arange(len(v)), cluster]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    bounds = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.ravel(), kind))


def _assigned(
    state: DataFrame, before: np.ndarray | None, centroids: np.ndarray, path: str
) -> DataFrame:
    """The state after the centroids moved from ``before``, written to ``path``.

    Vectors that have no products yet start from zero centroids.
    """
    change = centroids if before is None else centroids - before

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            v = _matrix(rows.column(1), centroids.shape[1])
            if before is None:
                products = np.zeros((len(v), len(centroids)), np.int64)
            else:
                products = _matrix(rows.column(2), len(centroids))
            products = updated_products(v, products, change)
            cluster, distance = nearest(v, products, centroids)
            yield batch(
                _STATE, rows.column(0), _lists(v, pa.int32()), _lists(products, pa.int64()), cluster, distance
            )

    state.mapInArrow(assign, _STATE_DDL).write.parquet(path)
    return state.sparkSession.read.schema(_STATE_DDL).parquet(path)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each cluster. Summed in the tasks first: a row per centroid arrives."""
    sums = [F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(centroids.shape[1])]
    moved = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(centroids.shape[1])]
    return moved


def starting_centroids(kept: DataFrame, k: int, salt: int) -> list[Row]:
    """The ``k`` vectors with the smallest hash of salt and vec_id; equal ids in order of their components."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    return kept.filter("vec_id IS NOT NULL").orderBy(digest, "v").limit(k).collect()


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, salt: int = 1) -> DataFrame:
    """Assign every vector (vec_id, embedding) to one of ``k`` centroids after ``rounds`` moves.

    Returns per kept vector: vec_id, cluster, squared distance, the sum of distances over its
    cluster and over all, the digest of its final centroid. A row is kept if its embedding
    has ``dims`` components, all of them finite numbers below 2^27 / 64 in size; beyond that
    a distance would not fit into a long. Repeated rows are vectors of their own. A vector
    without vec_id is assigned and counted but never starts a centroid. With fewer vectors
    than ``k`` there are fewer centroids; without a vector that can start one, or with an
    empty table, the result is empty. Other columns are ignored.

    A round reads the stored state once, and once more its vectors and cluster numbers for
    the sums. No vector is shuffled; what is collected and sent out are the centroids.
    """
    if not 0 < k <= MAX_CENTROIDS:
        raise ValueError(f"k must be between 1 and {MAX_CENTROIDS}")
    kept = whole_vectors(vectors, dims)
    start = starting_centroids(kept, k, salt)
    if not start:
        none = [F.lit(None).cast(kind).alias(c) for c, kind in _RESULT[1:]]
        return kept.filter(F.lit(False)).select("vec_id", *none)
    centroids = np.array([row["v"] for row in start], np.int64)
    spark = vectors.sparkSession
    path = new_folder(spark, "centroids")
    state = _assigned(kept, None, centroids, path)
    for _ in range(rounds):
        moved = _means(state, centroids)
        if (moved == centroids).all():
            break
        following = new_folder(spark, "centroids")
        state = _assigned(state, centroids, moved, following)
        remove_folder(spark, path)  # the round before; what is read from now on is written in full
        path, centroids = following, moved
    within = {row["cluster"]: row["s"] for row in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def of_cluster(values: list) -> F.Column:
        return F.array(*[F.lit(x) for x in values])[F.col("cluster")]

    return state.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([within.get(c, 0) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(within.values())).cast("long").alias("inertia"),
        of_cluster(digests).alias("centroid_sha256"),
    )


_RESULT = [
    ("vec_id", "long"),
    ("cluster", "int"),
    ("distance", "long"),
    ("cluster_inertia", "long"),
    ("inertia", "long"),
    ("centroid_sha256", "string"),
]
