"""Centroid clustering of integer vectors by Lloyd rounds whose assignment is an Orchard search.

Each centroid keeps a list of the others by growing distance. A vector starts at some centroid and walks its list: each
centroid not yet visited is measured and marked; when one is closer (or as close with a smaller number), the walk jumps to
that centroid's list and begins anew. It stops at the first entry strictly farther from the current centroid than twice the
vector's distance: by the triangle inequality nothing behind it can be closer, nor as close. All arithmetic is in integers.

Vectors stay where they are: a round reads them once, each task emits sums by centroid and component, and the driver gets
centroids x components sums, which the data's size does not change. No vector is shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from feedlake.llm.rows import map_arrow, quoted
from feedlake.workspace import materialize

#: Vectors searched at once.
BLOCK = 4096


def largest(size: int) -> int:
    """Components beyond this are refused: four times a squared distance must fit in a long."""
    return min(math.isqrt((1 << 61) // max(size, 1)) // 2, 1 << 30)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, apart): each centroid's list of all by growing squared distance, itself first; and the distances."""
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(apart, -1)  # itself first, before centroids at the same place
    order = np.argsort(apart, axis=1, kind="stable")
    np.fill_diagonal(apart, 0)
    return order, apart


def orchard_search(x: np.ndarray, centroids: np.ndarray, order: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance) of every row of x; of equally near ones the smallest number."""
    n, k = len(x), len(centroids)
    current = np.zeros(n, dtype=np.int64)
    nearest = ((x - centroids[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, k), dtype=bool)
    visited[:, 0] = True
    place = np.ones(n, dtype=np.int64)  # in the current centroid's list; place 0 is the centroid itself
    walking = np.arange(n) if k > 1 else np.arange(0)
    while len(walking):
        at = current[walking]
        other = order[at, place[walking]]
        going = apart[at, other] <= 4 * nearest[walking]  # distances at most twice the vector's, squared
        walking, other = walking[going], other[going]
        fresh = ~visited[walking, other]
        rows, seen = walking[fresh], other[fresh]
        visited[rows, seen] = True
        distance = ((x[rows] - centroids[seen]) ** 2).sum(axis=1)
        place[walking] += 1
        closer = (distance < nearest[rows]) | ((distance == nearest[rows]) & (seen < current[rows]))
        jump = rows[closer]
        current[jump], nearest[jump], place[jump] = seen[closer], distance[closer], 1
        walking = walking[place[walking] < k]
    return current, nearest


def integer_vectors(vectors: DataFrame, id_col: str, vector: str, size: int, scale: int = 1024) -> DataFrame:
    """(id, v) of the vectors with exactly `size` components, none null or non-finite; v holds floor(scale * component)."""
    c = F.col(quoted(vector))
    sound = F.forall(c, lambda e: F.coalesce((F.abs(e.cast("double")) < F.lit(float("inf"))) & ~F.isnan(e.cast("double")), F.lit(False)))
    small = F.forall(c, lambda e: F.abs(e.cast("double")) * scale <= largest(size) - 1)
    kept = vectors.where((F.size(c) == size) & sound)
    scaled = F.transform(c, lambda e: F.floor(e.cast("double") * scale).cast("int"))
    checked = F.when(small, scaled).otherwise(F.raise_error(F.lit(f"a component times {scale} is beyond {largest(size)}")).cast("array<int>"))
    return kept.select(F.col(quoted(id_col)).alias("id"), checked.alias("v"))


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of `<salt>:<id>`, in that order (a null id is the empty word; equal ids by vector)."""
    key = F.sha2(F.concat(F.lit(salt + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()  # k rows, whatever the data
    return np.array([r.v for r in rows], dtype=np.int64)


def _blocks(batch: pa.RecordBatch, size: int):
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        yield part, part.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, size)


def _sums(vectors: DataFrame, search: Callable, k: int, size: int) -> DataFrame:
    """(cluster, component, sum, n): sums a task, added up."""
    schema = StructType([StructField("cluster", IntegerType()), StructField("component", IntegerType()), StructField("total", LongType()), StructField("n", LongType())])

    def run(batches):
        totals, counts = np.zeros((k, size), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for _, x in _blocks(batch, size):
                cluster, _ = search(x)
                counts += np.bincount(cluster, minlength=k)
                for c in range(k):
                    totals[c] += x[cluster == c].sum(axis=0)
        held = np.flatnonzero(counts)
        arrays = [np.repeat(held, size).astype(np.int32), np.tile(np.arange(size, dtype=np.int32), len(held)), totals[held].ravel(), np.repeat(counts[held], size)]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=schema.names)

    return map_arrow(vectors, run, schema).groupBy("cluster", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def searcher(centroids: np.ndarray) -> Callable:
    order, apart = neighbour_lists(centroids)
    return lambda x: orchard_search(x, centroids, order, apart)


def lloyd(vectors: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after `rounds` rounds: each non-empty one moves to floor(sum / count) of its vectors, component by component."""
    centroids = centroids.copy()
    k, size = centroids.shape
    for _ in range(rounds):
        moved = centroids.copy()
        for r in _sums(vectors, searcher(centroids), k, size).collect():  # k x size rows, whatever the data
            moved[r.cluster, r.component] = r.total // r.n
        if (moved == centroids).all():
            break  # no later round moves anything
        centroids = moved
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    search, size = searcher(centroids), centroids.shape[1]
    schema = StructType([vectors.schema["id"], StructField("cluster", IntegerType()), StructField("distance", LongType())])

    def run(batches):
        for batch in batches:
            for part, x in _blocks(batch, size):
                cluster, distance = search(x)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=schema.names)

    return map_arrow(vectors, run, schema)


def centroid_clusters(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    size: int = 64,
    salt: str = "3",
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every kept vector.

    Vectors of another size, or with a null or non-finite component, and null vectors give no row. Fewer than k kept vectors
    give as many centroids; none (or an empty table) give no rows. Repeated rows and null ids are vectors of their own,
    equally near centroids go to the smaller number, and columns other than the two named are ignored. A kept component
    whose scaled size is beyond `largest(size)` (with the defaults: over 92,000 before scaling) raises an error, as
    distances would leave the range of a long.
    """
    # ids and integers once in the shared folder: every round reads those files, and so does a task that is run again
    ints = materialize(integer_vectors(vectors, id_col, vector, size), "orchard-vectors")
    start = seeds(ints, k, salt)
    out = [F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    if not len(start):
        none = "id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], none).withColumn("id", F.col("id").cast(ints.schema["id"].dataType)).select(out)
    centroids = lloyd(ints, start, rounds)
    found = materialize(assign(ints, centroids), "orchard-clusters")
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    at = F.col("cluster")
    by_cluster = F.array(*[F.lit(inertia.get(c, 0)).cast("bigint") for c in range(len(centroids))])
    return found.withColumns({
        "cluster_inertia": F.get(by_cluster, at),
        "inertia": F.lit(sum(inertia.values())).cast("bigint"),
        "centroid_sha256": F.get(F.array(*map(F.lit, digest)), at),
    }).select(out)
