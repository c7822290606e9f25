"""What the operators share: tables in the shared folder, Arrow batches, word ids, running sums."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE = 256

_own: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir); only where the session names
    none and runs on this machine alone, as in tests, a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: executors and driver need a folder that they share")
        app = spark.sparkContext.applicationId
        base = _own.setdefault(app, "") or tempfile.mkdtemp(prefix="spark-hourloom-")
        _own[app] = base
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, compression: str = "zstd") -> DataFrame:
    """The rows of df, written to path, in place of what lay there, and read again."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """The rows of df, written to the shared folder and read again: cuts the lineage, survives lost executors."""
    return written(df, scratch(df.sparkSession), compression)


def pylists(batches, *names: str):
    """Rows of the named columns as tuples, a slice of each Arrow batch at a time."""
    for batch in batches:
        at = [batch.schema.get_field_index(n) for n in names]
        for lo in range(0, batch.num_rows, SLICE):
            part = batch.slice(lo, SLICE)
            yield list(zip(*(part.column(i).to_pylist() for i in at), strict=True))


def lean(run):
    """A batch function that hands its memory back when its task ends: Spark's Python workers live on between tasks."""

    def held(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return held


def roomy() -> None:
    """Large arrays of a task are kept for its next ones, not mapped and cleared anew each time; `lean` hands them back."""
    if sys.platform == "linux":
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 25)  # M_MMAP_THRESHOLD, the most that it takes
        libc.mallopt(-1, 1 << 28)  # M_TRIM_THRESHOLD


def record_batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


class WordIds(dict):
    """Word (bytes) to its 64-bit hash. Emptied when it holds `most` words, so that memory stays bounded."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers; each salt gives another order of the same tokens."""
    h = h ^ np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of `edges` (a, b); the label is the smallest node it can reach.

    Each round every group of equally labelled nodes takes the smallest label that any of them has for a neighbour, and then
    each label gives way to the new label of the node of that name. Whole groups move and labels reach twice as far each
    round, so rounds grow with the logarithm of the longest path (paths of 3,000 nodes take about a dozen). A round writes a
    row per group and a row per node, in place of those of the round before the last."""
    spark = edges.sparkSession
    base = scratch(spark)
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), f"{base}/edges")
    labels, turn = both.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), 0
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        moves = labels.join(near, labels.node == near.a).groupBy("label").agg(F.min("near").alias("near"))
        moves = written(moves.select("label", F.least("label", "near").alias("goal")), f"{base}/moves{turn % 2}")
        moved = labels.join(moves, "label").select("node", F.col("goal").alias("new"))
        far = moves.join(moved, moves.goal == moved.node).select("label", "new")
        labels = written(labels.join(far, "label").select("node", F.col("new").alias("label")), f"{base}/labels{turn % 2}")
        if not moves.where("goal < label").limit(1).count():
            return labels
        turn += 1


def extended(batch: pa.RecordBatch, columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    """The batch with further columns; an older column of the same name gives way."""
    keep = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in keep] + [pa.array(v, t) for v, t in columns.values()], names=[*keep, *columns])


def extended_schema(df: DataFrame, ddl: str) -> str:
    """Schema of `extended`: df's columns but those that ddl names, then ddl."""
    new = [x.split()[0] for x in ddl.split(", ")]
    return ", ".join([f"`{n}` {t}" for n, t in df.dtypes if n not in new] + [ddl])


def slices(batches):
    """Arrow batches of at most SLICE rows."""
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE):
            yield batch.slice(lo, SLICE)


def columns(batches, name: str, most: int):
    """Arrow batches, cut before each row with which the named column of strings passes a multiple of `most` bytes."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // most
        ends = [*(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
        for lo, hi in zip([0, *ends], ends, strict=False):
            yield batch.slice(lo, hi - lo)


def masked(batch: pa.RecordBatch, keep: list[bool]) -> pa.RecordBatch:
    """The rows of a batch that are kept, with all columns as they are."""
    return batch.filter(pa.array(keep, pa.bool_()))


def replaced(batch: pa.RecordBatch, columns: dict[str, list]) -> pa.RecordBatch:
    """The batch with new values in some of its columns."""
    for name, new in columns.items():
        at = batch.schema.get_field_index(name)
        batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
    return batch


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
