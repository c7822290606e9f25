"""Set operations on rows and schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.config import Columns


def stack(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def missing_hours(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """The hours of each entity's range that it has no row for."""
    e, t = cols.entity, cols.time
    grid = df.groupBy(e).agg(F.min(t).cast("timestamp").alias("lo"), F.max(t).cast("timestamp").alias("hi")).select(e, F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias(t)).withColumn(t, F.col(t).cast("timestamp_ntz"))
    return grid.join(df.select(e, t).distinct(), [e, t], "left_anti")


def common_days(a: DataFrame, b: DataFrame, cols: Columns = Columns()) -> DataFrame:
    return a.select(F.to_date(cols.time).alias("day")).intersect(b.select(F.to_date(cols.time).alias("day")))


def schema_difference(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    return {"missing": [c for c in a.columns if c not in b.columns], "unexpected": [c for c in b.columns if c not in a.columns], "common": [c for c in a.columns if c in b.columns]}


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).count().where("count > 1")
