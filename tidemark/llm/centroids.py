"""Centroid clustering: Lloyd rounds over integer vectors, each nearest centroid found by a
progressive search over exact Walsh-Hadamard coefficients.

Vectors never move: a round is one pass over them, and a task sends one row of sums per centroid.
Only the centroids, k vectors, are on the driver. The integer transform keeps every squared
distance (times its length), so partial sums over coarse coefficients are lower bounds, and a
centroid that is strictly worse by them than a whole distance cannot be nearest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace

# Vectors looked at together, times the number of centroids.
PAIRS = 1 << 16
LONG = (1 << 63) - 1
# Sums travel as two decimals, so that no finite component can overflow them.
LIMB = 10**18

ASSIGNED = "vec_id long, cluster int, distance long"
SUMS = "cluster int, n long, high array<string>, low array<string>"
RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
    "centroid_sha256 string"
)


def sequency(width: int) -> np.ndarray:
    """Rows of the Hadamard matrix of a power of two, from no sign change to the most."""
    signs = np.ones((1, 1), np.int64)
    while len(signs) < width:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def transform(rows: np.ndarray) -> np.ndarray:
    """Exact Walsh-Hadamard transform of each row, coarse coefficients first; rows are padded
    with zeros to a power of two."""
    n, dims = rows.shape
    width = 1 << max(0, dims - 1).bit_length()
    out = np.zeros((n, width), rows.dtype)
    out[:, :dims] = rows
    half = 1
    while half < width:
        pairs = out.reshape(n, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([a + b, a - b], axis=2).reshape(n, width)
        half *= 2
    return out[:, sequency(width)]


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, exactly: longs where they fit well, else Python integers."""
    scaled = np.floor(values * float(scale))
    if not values.size or np.abs(scaled).max() < 1 << 40:
        return scaled.astype(np.int64)
    exact = [
        math.floor(x * scale) if abs(x) < 1 << 40 else int(x) * scale for x in values.ravel()
    ]
    return np.array(exact, dtype=object).reshape(values.shape)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each vector's nearest centroid, the smallest of equals, and its squared distance.

    The centroid that leads after the coarsest coefficients gives a whole distance; those whose
    partial sums exceed it strictly are dropped, again after each finer band of coefficients. What
    is left has been summed over all coefficients.
    """
    top = max(int(np.abs(x).max()) if x.size else 0 for x in (vectors, centroids))
    width = 1 << max(0, vectors.shape[1] - 1).bit_length()
    if 2 * width * top >= 1 << 31:  # a sum of squares might not fit a long
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    fine = transform(centroids)
    number = np.zeros(len(vectors), np.int32)
    distance = np.zeros(len(vectors), fine.dtype)
    step = max(1, PAIRS // len(centroids))
    for low in range(0, len(vectors), step):
        v = transform(vectors[low : low + step])
        band = min(4, width)
        part = ((v[:, None, :band] - fine[None, :, :band]) ** 2).sum(2)
        lead = part.argmin(1)
        bound = ((v - fine[lead]) ** 2).sum(1)
        row, cent = np.nonzero(part <= bound[:, None])
        part = part[row, cent]
        while band < width:
            part = part + ((v[row, band : 2 * band] - fine[cent, band : 2 * band]) ** 2).sum(1)
            band *= 2
            stay = part <= bound[row]
            row, cent, part = row[stay], cent[stay], part[stay]
        first = np.searchsorted(row, np.arange(len(v)))
        best = np.minimum.reduceat(part, first)
        hit = np.flatnonzero(part == best[row])
        hit = hit[np.searchsorted(row[hit], np.arange(len(v)))]
        number[low : low + step] = cent[hit]
        distance[low : low + step] = best // width
    return number, distance


def _vectors(batch: pa.RecordBatch, dims: int, scale: int) -> np.ndarray:
    flat = pc.cast(batch.column(1).flatten(), pa.float64())
    return whole(flat.to_numpy(zero_copy_only=False).reshape(-1, dims), scale)


def _assigner(centroids: list[list[int]], dims: int, scale: int) -> Callable:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _matrix(centroids)
        for batch in batches:
            if batch.num_rows:
                number, distance = nearest(_vectors(batch, dims, scale), held)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(number, pa.int32()),
                        pa.array([min(int(x), LONG) for x in distance], pa.int64()),
                    ],
                    names=["vec_id", "cluster", "distance"],
                )

    return assign


def _summer(centroids: list[list[int]], dims: int, scale: int) -> Callable:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _matrix(centroids)
        count = [0] * len(held)
        total = np.zeros((len(held), dims), dtype=object)
        for batch in batches:
            if batch.num_rows:
                vectors = _vectors(batch, dims, scale)
                number, _ = nearest(vectors, held)
                for c in np.unique(number):
                    mine = vectors[number == c]
                    count[c] += len(mine)
                    total[c] += mine.sum(0).astype(object)
        rows = [
            (c, n, *([str(x) for x in part] for part in zip(*(divmod(x, LIMB) for x in total[c]))))
            for c, n in enumerate(count)
            if n
        ]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["cluster", "n", "high", "low"]
        )

    return add_up


def _matrix(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < 1 << 62 for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if small else object)


def kept_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """Vectors of exactly `dims` components, none of them null or not finite."""
    bad = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.where(F.size("embedding") == dims).where(~bad)


def centroid_clusters(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1
) -> DataFrame:
    """Cluster of every vector, with exact integer arithmetic throughout.

    Columns `vec_id`, `cluster`, `distance` (squared), `cluster_inertia`, `inertia` (distances
    summed over the cluster and over all) and `centroid_sha256`, the digest of the final centroid.

    A component x counts as floor(scale * x). Vectors with another length, a null or a component
    that is not finite are not clustered and give no row. The first centroids are the `k` vectors
    with the smallest sha256 of `seed:vec_id`; of equal ids, the smaller vector; all vectors if
    there are fewer; an empty input gives no rows. A null vec_id counts as an empty word there and
    stays null; repeated rows are clustered each for itself. Equal distances go to the smaller
    cluster number, and an empty cluster keeps its centroid. Sums and distances past a long, far
    beyond any embedding, are computed exactly and returned as the largest long.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dims)
    word = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    firsts = (
        kept.withColumn("draw", F.sha2(word, 256)).orderBy("draw", "vec_id", "embedding").limit(k)
    )
    centroids = [
        whole(np.array([r.embedding], np.float64), scale)[0].tolist() for r in firsts.collect()
    ]
    if not centroids:
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        sums = kept.mapInArrow(_summer(centroids, dims, scale), SUMS)
        parts = sums.select("cluster", "n", F.posexplode(F.arrays_zip("high", "low")))
        added = parts.groupBy("cluster", "pos").agg(
            F.sum("n").alias("n"),
            *(F.sum(F.col(f"col.{x}").cast("decimal(38,0)")).alias(x) for x in ("high", "low")),
        )
        for r in added.collect():  # k * dims rows
            centroids[r.cluster][r.pos] = (int(r.high) * LIMB + int(r.low)) // r.n
    ws = Workspace(spark, "centroids")
    assigned = ws.save(kept.mapInArrow(_assigner(centroids, dims, scale), ASSIGNED), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = {r.cluster: int(r.s) for r in sums.collect()}
    named = spark.createDataFrame(
        [
            (c, min(s, LONG), min(sum(inertia.values()), LONG), _digest(centroids[c]))
            for c, s in inertia.items()
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(named), "cluster").select(
        *(x.split()[0] for x in RESULT.split(", "))
    )


def _digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
