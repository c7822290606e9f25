"""Centroid clustering (Lloyd's rounds) in exact integers over subvector dictionaries.

Vectors become integers floor(SCALE * x). Their components are cut into blocks of WIDTH dimensions, and in chunks of CHUNK rows
each block is dictionary-encoded without loss: its distinct subvectors once, and a code per row. The encoded chunks are written
to the shared folder. In each round a task computes the exact squared distance of each distinct subvector of a chunk to each
centroid's block, once, and a row's distance is the sum of its codes' entries. No vector is shuffled: a round sends counts and
component sums of each task, at most k of each, which Spark adds up in decimals; the k centroids come to the driver and go out
with the next round's tasks.

Defined results: vectors that are null, of another length, or hold null or non-finite components take no part. Starts are the
vectors with the smallest hash of the seed and their identifier (null identifiers come last; of equal identifiers the smaller
vector first); equal starts are kept, ties in distance go to the smaller number, so a later equal one stays empty and where it
is. Fewer vectors than k give as many centroids; no vectors give no rows. Repeated rows count each. Further columns are
ignored, whatever their names. A component of 2**27 or more after scaling is an error, as distances would not fit a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, saved

SCALE, WIDTH, CHUNK, MOST = 256, 2, 8192, 2**27


def _components(column: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of dim finite components, and these rows' integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    right = np.asarray(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)) == dim
    flat = column.filter(pa.array(right)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    finite = np.isfinite(flat).all(1)
    right[np.flatnonzero(right)] = finite
    whole = np.floor(SCALE * flat[finite])
    if whole.size and np.abs(whole).max() >= MOST:
        raise ValueError(f"a component is {MOST} or more after scaling")
    return right, whole.astype(np.int64)


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct lines, and which of them each line is. Up to two dimensions are sorted as one number."""
    if x.shape[1] > 2:
        return np.unique(x, axis=0, return_inverse=True)
    one = x[:, 0] if x.shape[1] == 1 else x[:, 0] * (2 * MOST) + x[:, 1]
    _, first, code = np.unique(one, return_index=True, return_inverse=True)
    return x[first], code


def _encoded(ids: list, x: np.ndarray, width: int) -> pa.RecordBatch:
    """One row: identifiers, and for each block its distinct subvectors and the rows' codes."""
    entries, codes, sizes = [], [], []
    for lo in range(0, x.shape[1], width):
        distinct, code = _distinct(x[:, lo : lo + width])
        entries.append(distinct.astype(np.int32).tobytes())
        codes.append(code.astype(np.uint32 if len(distinct) > 65535 else np.uint16).tobytes())
        sizes.append(len(distinct))
    return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([entries], pa.list_(pa.binary())), pa.array([codes], pa.list_(pa.binary())), pa.array([sizes], pa.list_(pa.int32()))], names=["ids", "entries", "codes", "sizes"])


def encode(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dim: int = 64, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """Chunks of vectors with their subvector dictionaries."""

    def run(batches):
        ids, parts, held = [], [], 0
        for b in batches:
            right, x = _components(b.column(1), dim)
            ids += b.column(0).filter(pa.array(right)).to_pylist()
            parts.append(x)
            held += len(x)
            while held >= chunk:
                whole = np.concatenate(parts)
                yield _encoded(ids[:chunk], whole[:chunk], width)
                ids, parts, held = ids[chunk:], [whole[chunk:]], held - chunk
        if held:
            yield _encoded(ids, np.concatenate(parts), width)

    rows = vectors.select(vectors[key].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v"))
    return rows.mapInArrow(lean(run), "ids array<long>, entries array<binary>, codes array<binary>, sizes array<int>")


def _chunks(batches):
    """ids, and (distinct subvectors, codes) of each block, of every chunk."""
    for b in batches:
        for i in range(b.num_rows):
            ids, entries, codes, sizes = (c.slice(i, 1).to_pylist()[0] for c in b.columns)
            blocks = [(np.frombuffer(e, np.int32).reshape(n, -1).astype(np.int64), np.frombuffer(c, np.uint16 if n <= 65535 else np.uint32)) for e, c, n in zip(entries, codes, sizes, strict=True)]
            yield ids, blocks


def _nearest(blocks: list, centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid: per block a table of its distinct subvectors' distances, and
    for each row the sum of its codes' lines."""
    total, lo = np.zeros((n, len(centroids)), np.int64), 0
    for distinct, code in blocks:
        hi = lo + distinct.shape[1]
        total += ((distinct[:, None, :] - centroids[None, :, lo:hi]) ** 2).sum(2)[code]
        lo = hi
    best = total.argmin(1)
    return best, total[np.arange(n), best]


def starts(vectors: DataFrame, k: int, seed: int = 2, key: str = "vec_id", vector: str = "embedding", dim: int = 64) -> np.ndarray:
    """The k vectors that come first by the hash of `seed:key`, as integers."""
    v = vectors[vector].cast("array<double>")
    good = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    first = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), vectors[key].cast("string")), 256).alias("h"), v.alias("v")).where(good)
    rows = first.orderBy(F.col("h").asc_nulls_last(), F.transform("v", lambda x: F.floor(SCALE * x))).limit(k).collect()
    return np.array([[int(np.floor(SCALE * x)) for x in r.v] for r in rows], np.int64).reshape(-1, dim)


def _moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of its vectors' mean; without vectors it stays."""
    k, dim = centroids.shape

    def run(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), object)
        for ids, blocks in _chunks(batches):
            best, _ = _nearest(blocks, centroids, len(ids))
            n += np.bincount(best, minlength=k)
            lo = 0
            for distinct, code in blocks:
                hi = lo + distinct.shape[1]
                part = np.zeros((k, hi - lo), np.int64)
                np.add.at(part, best, distinct[code])
                sums[:, lo:hi] += part
                lo = hi
        there = [c for c in range(k) if n[c]]
        sent = [(c, j, str(v)) for c in there for j, v in enumerate([n[c], *sums[c]])]
        cols = list(zip(*sent, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, (pa.int32(), pa.int32(), pa.string()), strict=True)], names=["c", "j", "s"])

    parts = chunks.mapInArrow(lean(run), "c int, j int, s string").groupBy("c", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    added = {(r.c, r.j): int(r.s) for r in parts.collect()}
    return np.array([[added[c, j + 1] // added[c, 0] for j in range(dim)] if (c, 0) in added else centroids[c] for c in range(k)], np.int64)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, key: str = "vec_id", vector: str = "embedding", dim: int = 64, width: int = WIDTH, chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """Identifier, cluster and squared distance of every vector after the last round, and the centroids."""
    centroids = starts(vectors, k, seed, key, vector, dim)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "id long, cluster int, distance long"), centroids
    chunks = saved(encode(vectors, key, vector, dim, width, chunk))
    for _ in range(rounds):
        centroids = _moved(chunks, centroids)

    def run(batches):
        for ids, blocks in _chunks(batches):
            best, distance = _nearest(blocks, centroids, len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(best, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    return saved(chunks.mapInArrow(lean(run), "id long, cluster int, distance long")), centroids


def described(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assignment with each cluster's and the whole inertia and the hash of the centroid's components; what is broadcast is
    a row per centroid."""
    spark = assigned.sparkSession
    inertia = {r.cluster: int(r.d) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    named = [(c, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in inertia.items()]
    return assigned.join(F.broadcast(spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster")
