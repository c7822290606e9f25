"""Writing: versioned batches, upserts, idempotent appends, splits, manifests and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourloom.config import Columns
from hourloom.operators.clean import dedupe
from hourloom.operators.joins import new_rows
from hourloom.sources.observations import hour_of


def save_batch(df: DataFrame, path: str, version: int, formats: tuple[str, ...] = ("parquet",)) -> dict[str, str]:
    """The batch in each format under version=N; the paths."""
    out = {f: f"{path}/format={f}/version={version}" for f in formats}
    for f, p in out.items():
        df.write.mode("overwrite").option("header", True).format(f).save(p)
    return out


def read_batch(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).format(fmt).load(path)


def manifest(df: DataFrame, version: str | None = None) -> DataFrame:
    """Row count and an order-free content hash, per version."""
    h = F.sum(F.xxhash64(*[F.col(c) for c in sorted(df.columns) if c != version]).cast("decimal(38,0)")).cast("string").alias("content_hash")
    return df.groupBy(*([version] if version else [])).agg(F.count("*").alias("n_rows"), h)


def upsert(existing: DataFrame, incoming: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Both by name; of equal keys the incoming row stays (the last one, by the order column)."""
    both = existing.withColumn("_batch", F.lit(0)).unionByName(incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    return dedupe(both, cols.key, "_batch", *([cols.order] if cols.order in both.columns else [])).drop("_batch")


def align(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """The target's columns in its order; missing ones are typed nulls, others go."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in target.items()])


def rows_to_append(incoming: DataFrame, existing: DataFrame, target: dict[str, str], cols: Columns = Columns()) -> DataFrame:
    """What an idempotent append adds: valid keys, floored hour, last of equal keys, not there yet, target schema."""
    keyed = incoming.withColumn(cols.time, hour_of(F.col(cols.time))).where(F.col(cols.time).isNotNull() & (F.trim(cols.entity) != ""))
    last = dedupe(keyed, cols.key, *([cols.order] if cols.order in keyed.columns else []))
    return align(new_rows(last, existing, cols), target)


def append_features(spark: SparkSession, incoming: DataFrame, path: str, target: dict[str, str], cols: Columns = Columns()) -> int:
    """Appends to the Parquet table at path, partitioned by date; returns the number of rows. A second call adds 0. Of the table
    only the dates between the first and the last incoming row are read, and of these only keys."""
    schema = ", ".join(f"`{c}` {t}" for c, t in target.items()) + ", event_date date"
    spark.createDataFrame([], schema).write.mode("append").partitionBy("event_date").parquet(path)  # there is a table now
    lo, hi = incoming.agg(F.min(F.to_date(hour_of(F.col(cols.time)))), F.max(F.to_date(hour_of(F.col(cols.time))))).first()
    if lo is None:
        return 0
    existing = spark.read.schema(schema).parquet(path).where(F.col("event_date").between(F.lit(lo), F.lit(hi))).select(*cols.key)
    new = rows_to_append(incoming, existing, target, cols).withColumn("event_date", F.to_date(cols.time)).persist()
    try:
        n = new.count()
        if n:
            new.write.mode("append").partitionBy("event_date").parquet(path)
        return n
    finally:
        new.unpersist()


def save_splits(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def save_forecast(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def save_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
