"""Clusters of vectors of 64 small integers, exact, by bit planes.

A vector's 64 components are whole numbers in two's complement; plane p holds bit p of each, one component a bit, in one
64-bit word. The last plane is the sign: it weighs -2^p where the others weigh 2^p. So the dot product of two vectors is
the sum over pairs of planes of weight times popcount of their AND, exact, in as many words as the numbers have bits.
A vector keeps as many planes as its largest number needs; a sign plane may be repeated without changing the vector.

Each round reads the stored planes, sends the centroids (``k`` times 64 numbers, whatever the size of the table) with the
job, and brings back sums per centroid, added up in each task first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import stored
from logweir.session import small_frame

COMPONENTS = 64
SCALE = 256
# Numbers are held to this many bits, sign included, so that squared distances fit a long.
BITS = 28
K, ROUNDS = 40, 5
# About so many distances are held at once.
CELLS = 1 << 18
_LARGEST_LONG = (1 << 63) - 1


def pack(numbers: np.ndarray) -> list[bytes]:
    """Planes of each row of 64 integers, 8 bytes a plane, lowest first; as few as hold the row's numbers."""
    needed = np.where(numbers < 0, ~numbers, numbers).max(axis=1, initial=0)
    planes = np.array([int(x).bit_length() + 1 for x in needed], np.int64)
    found: list[bytes] = [b""] * len(numbers)
    for p in np.unique(planes).tolist():
        at = np.flatnonzero(planes == p)
        bits = (numbers[at][:, None, :] >> np.arange(p)[:, None]) & 1
        words = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
        for i, row in zip(at.tolist(), words):
            found[i] = row.tobytes()
    return found


def planes_of(packed: list[bytes]) -> np.ndarray:
    """The planes of all rows, (planes, rows): rows of fewer planes repeat their sign."""
    lengths = np.array([len(x) // 8 for x in packed], np.int64)
    most = int(lengths.max(initial=1))
    found = np.zeros((most, len(packed)), np.uint64)
    for p in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == p)
        words = np.frombuffer(b"".join(packed[i] for i in at.tolist()), "<u8").reshape(-1, p)
        found[:p, at] = words.T
        found[p:, at] = words[:, -1]
    return found


def numbers_of(planes: np.ndarray) -> np.ndarray:
    """The integers again, (rows, 64)."""
    found = np.zeros((planes.shape[1], COMPONENTS), np.int64)
    for p, w in enumerate(weights(len(planes))):
        bits = np.unpackbits(np.ascontiguousarray(planes[p]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        found += bits.astype(np.int64) * w
    return found


def weights(planes: int) -> list[int]:
    return [*(1 << p for p in range(planes - 1)), -(1 << (planes - 1))]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of all rows of planes ``a`` with all of ``b``, (rows of a, rows of b)."""
    found = np.zeros((a.shape[1], b.shape[1]), np.int64)
    for x, v in zip(a, weights(len(a))):
        for y, w in zip(b, weights(len(b))):
            found += np.bitwise_count(x[:, None] & y).astype(np.int64) * (v * w)
    return found


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the first of equally near ones, and the squared distance."""
    own, (n,) = planes_of(pack(centroids)), planes.shape[1:]
    norms = (centroids * centroids).sum(axis=1)
    cluster, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    step = max(1, CELLS // len(centroids))
    for i in range(0, n, step):
        part = planes[:, i:i + step]
        numbers = numbers_of(part)
        all_of = (numbers * numbers).sum(axis=1)[:, None] - 2 * dots(part, own) + norms
        best = all_of.argmin(axis=1)
        cluster[i:i + step], distance[i:i + step] = best, np.take_along_axis(all_of, best[:, None], 1)[:, 0]
    return cluster, distance


def packed_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(key, planes): the vectors of exactly 64 finite components, each as floor(256 * x), held to BITS bits."""
    kind = vectors.schema[key].dataType.simpleString()
    x = F.col(embedding).cast("array<double>")
    fine = (F.size(x) == COMPONENTS) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(key).alias("key"), x.alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
            with np.errstate(over="ignore"):
                numbers = np.clip(np.floor(SCALE * values), -(1 << (BITS - 1)), (1 << (BITS - 1)) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pack(numbers), pa.binary())], names=["key", "planes"])

    return kept.mapInArrow(run, f"key {kind}, planes binary")


def first_centroids(packed: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors (all, if fewer) with the smallest sha256 of ``2:<key>``; of equal ones, the smaller planes."""
    order = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    first = packed.select(order.alias("draw"), "planes").orderBy("draw", "planes").limit(k).collect()
    return numbers_of(planes_of([bytes(r["planes"]) for r in first])) if first else np.zeros((0, COMPONENTS), np.int64)


def moved(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of what is nearest to each; without any, as it was."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), COMPONENTS), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            planes = planes_of(batch.column(0).to_pylist())
            cluster, _ = nearest(planes, centroids)
            order = np.argsort(cluster, kind="stable")
            there, starts = np.unique(cluster[order], return_index=True)
            sums[there] += np.add.reduceat(numbers_of(planes)[order], starts, axis=0)
            counts += np.bincount(cluster, minlength=len(centroids))
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there]), pa.array(list(sums[there]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "sums"])

    partial = packed.select("planes").mapInArrow(run, "cluster long, n long, sums array<long>")
    added = partial.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    after = centroids.copy()
    for r in added.collect():  # k times 64 numbers
        after[r["cluster"], r["at"]] = int(r["total"]) // int(r["n"])
    return after


def clusters(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", k: int = K, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """One row per kept vector: key, cluster, distance, cluster_inertia, inertia, centroid_sha256; and the centroids.

    Vectors that are NULL, are not of 64 components or hold a NULL, a NaN or an infinity are left out. A component
    beyond 2^19 in size counts as 2^19 (BITS), and sums of distances beyond a long as the largest long. A NULL key is
    drawn as ``2:``. Repeated rows count each. Fewer than ``k`` vectors: as many centroids. No vector: no rows and no
    centroids. Of equally near centroids the smaller number holds; one without vectors stays where it is. Other
    columns are not read.
    """
    if k < 1 or rounds < 0:
        raise ValueError("k must be 1 or more, rounds 0 or more")
    spark = vectors.sparkSession
    packed = stored(packed_vectors(vectors, key, embedding), "planes")
    centroids = first_centroids(packed, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(packed, centroids)
    final = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = nearest(planes_of(batch.column(1).to_pylist()), final)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["key", "cluster", "distance"])

    kind = vectors.schema[key].dataType.simpleString()
    found = stored(packed.mapInArrow(run, f"key {kind}, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole = min(sum(sums.values()), _LARGEST_LONG)
    rows = [(c, min(s, _LARGEST_LONG), whole, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(sums.items())]
    about = small_frame(spark, rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(about, "cluster").select("key", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids
