"""Empirical distribution functions of many columns at once, and the tests that compare them.

Values are counted by column first, so that equal values are one row. Running sums then go by ranges of values: their borders
are quantiles from a sketch per column, so that ranges hold about equally many values whatever the distribution; sums of ranges
are put one after another (RANGES rows per column), and each range is ordered by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of values per column, a power of two.
RANGES = 256


def melted(df: DataFrame, columns: list[str], labels: dict[str, Column]) -> DataFrame:
    """feature, v and, for each label, 1 where its condition holds: a row per row and column that has a value."""
    flags = [F.coalesce(c.cast("int"), F.lit(0)).alias(n) for n, c in labels.items()]
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])
    return df.select(F.explode(cells).alias("_f"), *flags).select("_f.*", *labels).where("v is not null")


def _range_of(v: Column, borders: Column) -> Column:
    """How many of the sorted borders are not above v, by bisection."""
    steps, n = [], RANGES
    while n > 1:
        n //= 2
        steps.append(n)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(F.coalesce(F.get(borders, at + s - 1) <= v, F.lit(False)), at + s).otherwise(at))


def distribution_functions(df: DataFrame, columns: list[str], labels: dict[str, Column]) -> DataFrame:
    """feature, v and, for each label, the share of its values up to v (a column of the label's name) and its number of values
    (`n_` before it): a row per distinct value of each column. Labels are conditions on rows; null values are left out; a label
    without values has nulls."""
    counts = melted(df, columns, labels).groupBy("feature", "v").agg(*[F.sum(n).alias(n) for n in labels]).where(sum((F.col(n) for n in labels), F.lit(0)) > 0)
    quantiles = F.percentile_approx("v", F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)]), F.lit(10 * RANGES))
    borders = counts.groupBy("feature").agg(quantiles.alias("_borders"))  # a row per column
    placed = counts.join(F.broadcast(borders), "feature").withColumn("_g", _range_of(F.col("v"), F.col("_borders"))).drop("_borders")
    sums = placed.groupBy("feature", "_g").agg(*[F.sum(n).alias(f"_s_{n}") for n in labels])  # RANGES rows per column at most
    w = Window.partitionBy("feature")
    before = w.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("feature", "_g", *[x for n in labels for x in (F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_b_{n}"), F.sum(f"_s_{n}").over(w).alias(f"n_{n}"))])
    inside = Window.partitionBy("feature", "_g").orderBy("v")
    met = placed.join(F.broadcast(sums), ["feature", "_g"])
    return met.select("feature", "v", *[F.try_divide(F.col(f"_b_{n}") + F.sum(n).over(inside), F.col(f"n_{n}")).alias(n) for n in labels], *[f"n_{n}" for n in labels])


def ks_probability(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p value of a largest distance d between samples of n and m."""
    x = F.sqrt(n * m / (n + m)) * d
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x))
    return F.when(x <= 0, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * terms)))


def drift(df: DataFrame, columns: list[str], first: Column, second: Column, level: float = 0.05, digits: int = 6) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of every column between two sets of rows: feature, ks, p (asymptotic) and whether p
    is under the level. All columns share one pass; a column without values on either side is left out."""
    f = distribution_functions(df, columns, {"a": first, "b": second})
    worst = f.groupBy("feature").agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("_d"), F.max("n_a").alias("_n"), F.max("n_b").alias("_m")).where("_n > 0 and _m > 0")
    p = ks_probability(F.col("_d"), F.col("_n").cast("double"), F.col("_m").cast("double"))
    return worst.select("feature", F.round("_d", digits).alias("ks"), F.round(p, digits).alias("p"), (p < level).alias("drift"))
