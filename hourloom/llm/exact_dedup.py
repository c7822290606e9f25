"""Exact duplicates by stateful streaming: keyed state on disk that never expires, full bytes checked on hits.

A stream of documents is grouped by the SHA-256 of its normalised text (A-Z lower-cased, nothing else). State is RocksDB's,
saved with the stream's progress in the shared folder; it has no watermark, so a text is known for as long as the folder
exists, and a later run over new files goes on from it. For each digest it retains the identifier of the row that stays, the
locator of that row's content (file and row in it) and the number of copies. Copies are combined before the shuffle, so a
text that is a third of all rows is one row per task. Spark's state reader gives the state back as a table.

On hits (a digest of several rows) all bytes are compared: smallest and largest text of a digest must be the same. Digests for
which they are not are split by their texts.

Defined results: a null text counts as empty, and empty texts are equal to each other. Of equal texts the largest identifier
stays (null is the smallest); of rows that share that identifier, the one with the largest locator. Equal rows are counted
each. An empty table gives no rows. Further columns are ignored, whatever their names. Texts are compared whole at any length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, scratch

#: Settings of the state: on disk, with a bound on an executor's memory for it, and no disk taken before it is written to.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: A digest with at least this share of the rows is hot; there are at most 1 / HOT of them, and these alone are broadcast.
HOT = 0.001


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _located(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column], whole: bool = False) -> DataFrame:
    """Identifier, content locator and digest of each row, and its normalised text if asked for. docs is read from files."""
    at, t = docs.metadataColumn("_metadata"), normalised(docs[text])
    return docs.select(docs[key].alias("id"), at["file_path"].alias("file"), at["row_index"].alias("row"), digest(t).alias("digest"), *([t.alias("content")] if whole else []))


def observe(stream: DataFrame, root: str, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> bool:
    """Takes what the stream's source newly holds into the state under root; False if that was nothing."""
    spark = stream.sparkSession
    rows = _located(stream, key, text, digest)
    kept = rows.groupBy("digest").agg(F.max(F.struct("id", "file", "row")).alias("keep"), F.count("*").alias("n"))
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)
        q = kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", root).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return any(p["numInputRows"] for p in q.recentProgress)


def state(spark: SparkSession, root: str) -> DataFrame:
    """digest, keep (id, file, row) and n of every text seen, as the state under root holds them."""
    kept = spark.read.format("statestore").load(root)
    return kept.select(F.col("key.digest").alias("digest"), F.col("value.max").alias("keep"), F.col("value.count").alias("n"))


def clashes(docs: DataFrame, groups: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Digests under which different texts lie: the full bytes of every row of a hit are compared, map side first."""
    texts = _located(docs, key, text, digest, whole=True).groupBy("digest").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
    hits = groups.where("n > 1").select("digest")
    return texts.join(hits, "digest").where("lo <> hi").select("digest")


def _answer(rows: DataFrame) -> DataFrame:
    stays = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    return rows.select("id", F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"), stays.alias("kept"), "digest")


def members(docs: DataFrame, groups: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """id, keep_id, group_size, kept and digest of every row of docs, whose files the state has seen. Rows of hot digests meet
    a broadcast of at most 1 / HOT rows, the others are joined by digest."""
    groups = saved(groups)
    total = groups.agg(F.sum("n")).first()[0]
    rows = saved(_located(docs, key, text, digest))
    clash = saved(clashes(docs, groups, key, text, digest))
    if total is None:
        return _answer(rows.join(groups, "digest"))
    hot = F.col("n") >= F.lit(HOT * total)
    few = F.broadcast(groups.where(hot))
    met = rows.join(few, "digest").unionByName(rows.join(few.select("digest"), "digest", "left_anti").join(groups.where(~hot), "digest"))
    if not clash.limit(1).count():
        return _answer(met)
    texts = _located(docs, key, text, digest, whole=True).join(clash, "digest", "left_semi")
    parts = texts.groupBy("digest", "content").agg(F.max(F.struct("id", "file", "row")).alias("keep"), F.count("*").alias("n"))
    return _answer(met.join(clash, "digest", "left_anti")).unionByName(_answer(texts.join(parts, ["digest", "content"])))


def stored(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The Parquet table at path as a stream of its files and as a table. A stream needs a folder or a pattern, so the last
    letter becomes a pattern of one."""
    table = spark.read.parquet(path)
    return spark.readStream.schema(table.schema).parquet(f"{path[:-1]}[{path[-1]}]"), table


def duplicates(spark: SparkSession, path: str, root: str | None = None, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of the table at path: id, keep_id, group_size, kept, digest. With root, state of earlier runs over the
    table's older files is gone on with."""
    stream, docs = stored(spark, path)
    root = root or scratch(spark)
    seen = observe(stream, root, key, text, digest)
    rows = _located(docs, key, text, digest)
    if not seen and not docs.limit(1).count():
        return _answer(rows.withColumns({"keep": F.struct("id", "file", "row"), "n": F.lit(1).cast("long")}))
    return members(docs, state(spark, root), key, text, digest)


def distinct_rows(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """docs, with all their columns, without the copies: rows at the locators that the state retains."""
    at = docs.metadataColumn("_metadata")
    placed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("r"), at["file_path"].alias("file"), at["row_index"].alias("row"))
    return placed.join(groups.select("keep.file", "keep.row"), ["file", "row"], "left_semi").select("r.*")
