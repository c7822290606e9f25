"""Aggregates: statistics, quality reports, profiles, correlation and time-series analysis."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.config import Columns
from hourloom.operators.blocks import Spans, in_blocks, spare
from hourloom.operators.windows import numbered


def _long(row: DataFrame, names: list[str], stats: list[str], label: str) -> DataFrame:
    """One row of `{name}__{stat}` columns as a row per name."""
    parts = [F.struct(F.lit(n).alias(label), *[F.col(f"{n}__{s}").alias(s) for s in stats]) for n in names]
    return row.select(F.inline(F.array(*parts)))


def statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, min, max, std (0 for one value) of each column that has a value."""
    made = [f.alias(f"{c}__{s}") for c in columns for s, f in (("n", F.count(c)), ("mean", F.round(F.avg(c), 3)), ("min", F.round(F.min(c), 3)), ("max", F.round(F.max(c), 3)), ("std", F.round(F.when(F.count(c) == 1, 0.0).otherwise(F.stddev_samp(c)), 3)))]
    return _long(df.agg(*made), columns, ["n", "mean", "min", "max", "std"], "field").where("n > 0")


def missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing count and share in percent of each column with any."""
    made = [f.alias(f"{c}__{s}") for c in columns for s, f in (("missing", F.count_if(F.col(c).isNull())), ("pct", F.round(100 * F.count_if(F.col(c).isNull()) / F.count("*"), 2)))]
    return _long(df.agg(*made), columns, ["missing", "pct"], "field").where("missing > 0")


def availability(df: DataFrame, columns: list[str]) -> DataFrame:
    return _long(df.agg(*[F.round(100 * F.count(c) / F.count("*"), 2).alias(f"{c}__available_pct") for c in columns]), columns, ["available_pct"], "field")


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return df.groupBy(*key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def duplicate_rows(df: DataFrame, key: list[str], order: str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where("_n > 1").drop("_n")


def quality_report(df: DataFrame, columns: list[str], cols: Columns = Columns()) -> DataFrame:
    """One row: duplicates, missing share, gaps, invalid values, issues, is_clean."""
    from hourloom.operators.clean import invalid_counts
    from hourloom.operators.windows import gaps

    bad = invalid_counts(df, cols)
    cells = sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    parts = [
        duplicates(df, cols.key), df.agg(F.count("*").alias("n_rows"), F.round(100 * cells / (F.count("*") * len(columns)), 2).alias("missing_pct")),
        gaps(df, cols).agg(F.count("*").alias("n_gaps"), F.coalesce(F.sum("missing_hours"), F.lit(0)).alias("missing_hours")), bad.select(sum((F.col(c) for c in bad.columns), F.lit(0)).alias("invalid")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    issues = F.array_compact(F.array(F.when(F.col("duplicates") > 0, "duplicate keys"), F.when(F.col("missing_pct") > 5, "missing values"), F.when(F.col("n_gaps") > 0, "gaps"), F.when(F.col("invalid") > 0, "invalid values")))
    return out.withColumn("issues", F.array_join(issues, "; ")).withColumn("is_clean", F.col("issues") == "")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def entity_profile(df: DataFrame, column: str, by: list[Column | str], digits: int = 4) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(column).alias("n"), F.round(F.avg(column), digits).alias("mean"), F.round(F.percentile(column, F.lit(0.5)), digits).alias("median"), F.round(F.stddev_samp(column), digits).alias("std"), F.min(column).alias("min"), F.max(column).alias("max")
    )


def means(df: DataFrame, columns: list[str], by: list[Column | str], digits: int = 4) -> DataFrame:
    return df.groupBy(*by).agg(*[F.round(F.avg(c), digits).alias(f"mean_{c}") for c in columns])


def cardinality(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values of each column, and their share of all rows. A distinct count per column shuffles the column's
    values once each; approximate keeps a sketch."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    made = [f.alias(f"{c}__{s}") for c in columns for s, f in (("n_distinct", count(F.col(c))), ("pct", F.round(100 * count(F.col(c)) / F.count("*"), 2)))]
    return _long(df.agg(*made), columns, ["n_distinct", "pct"], "field")


def table_profile(df: DataFrame) -> DataFrame:
    kinds = [t for _, t in df.dtypes]
    number = sum(t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal") for t in kinds)
    text, time = sum(t == "string" for t in kinds), sum(t.startswith(("timestamp", "date")) for t in kinds)
    cells = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    rows = df.agg(F.count("*").alias("n_rows"), cells.alias("missing_cells"))
    distinct = df.distinct().agg(F.count("*").alias("n_distinct"))
    return rows.crossJoin(distinct).select("n_rows", F.lit(len(kinds)).cast("long").alias("n_columns"), F.round(100 * (F.col("n_rows") - F.col("n_distinct")) / F.col("n_rows"), 2).alias("duplicate_pct"), "missing_cells", *[F.lit(v).cast("long").alias(k) for k, v in (("numeric", number), ("categorical", text), ("datetime", time))])


def _correlation(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are there; null where one of them does not vary (F.corr divides by zero)."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))


def correlations(df: DataFrame, columns: list[str], by: list[str] | None = None, digits: int = 4, constant: bool = False) -> DataFrame:
    """Pearson correlation of every pair (each ordered once), over rows where both are there; one pass. constant: columns may
    not vary, their correlations are null."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    corr = _correlation if constant else F.corr
    row = df.groupBy(*(by or [])).agg(*[F.round(corr(a, b), digits).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(*(by or []), F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])))


def target_correlations(df: DataFrame, features: list[str], target: str, by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Correlation of each feature with the target; one pass, sort by its size for a ranking."""
    row = df.groupBy(*(by or [])).agg(*[F.round(F.corr(c, target), digits).alias(f"c{i}") for i, c in enumerate(features)])
    return row.select(*(by or []), F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("corr")) for i, c in enumerate(features)])))


def predictability(c: Column) -> Column:
    return F.when(F.abs(c) > 0.7, "High").when(F.abs(c) > 0.4, "Medium").otherwise("Low")


def horizon_autocorrelation(df: DataFrame, horizons: tuple[int, ...] = (1, 3, 6, 12, 24), cols: Columns = Columns()) -> DataFrame:
    from hourloom.operators.windows import leads

    led = leads(df, cols.target, horizons, cols)
    row = led.groupBy(cols.entity).agg(*[F.round(F.corr(cols.target, f"{cols.target}_lead_{h}"), 4).alias(f"c{h}") for h in horizons])
    out = row.select(cols.entity, F.inline(F.array(*[F.struct(F.lit(h).cast("long").alias("horizon"), F.col(f"c{h}").alias("corr")) for h in horizons])))
    return out.withColumn("level", predictability(F.col("corr")))


def leakage(df: DataFrame, features: list[str], pollutants: tuple[str, ...], target: str) -> DataFrame:
    """Features that give the target away: correlation over 0.95, over 0.98 for pollutants of the same hour."""
    out = target_correlations(df, features, target)
    limit = F.when(F.col("feature").isin(*pollutants), 0.98).otherwise(0.95)
    return out.withColumn("leaks", F.coalesce(F.abs("corr") > limit, F.lit(False)))


def decompose(df: DataFrame, column: str, period: int = 7, cols: Columns = Columns()) -> DataFrame:
    """Additive parts of each series: centred moving average (odd period), mean by phase, rest. Averages run in blocks, phases
    come from row numbers by counts of spans, phase means are `period` rows per entity."""
    half = period // 2
    place, size, raw, e, p = spare(df, "_place", "_size", "_raw", "_e", "_p")

    def framed(x: DataFrame, c: Columns) -> DataFrame:
        frame = c.window().rowsBetween(-half, half)
        return x.withColumn("trend", F.when(F.count(column).over(frame) == period, F.avg(column).over(frame)))

    t = in_blocks(numbered(df, place, size, cols), framed, half, half, cols).withColumn(place, (F.col(place) - 1) % period)
    phases = t.groupBy(F.col(cols.entity).alias(e), F.col(place).alias(p)).agg(F.avg(F.col(column) - F.col("trend")).alias(raw))
    phases = phases.select(e, p, (F.col(raw) - F.avg(raw).over(Window.partitionBy(e))).alias("seasonal"))
    met = t.join(phases, F.col(cols.entity).eqNullSafe(F.col(e)) & (F.col(place) == F.col(p)))
    return met.withColumn("residual", F.col(column) - F.col("trend") - F.col("seasonal")).drop(place, size, e, p)


def signal_to_noise(parts: DataFrame, cols: Columns = Columns()) -> DataFrame:
    v = parts.groupBy(cols.entity).agg(F.stddev_samp("trend").alias("t"), F.stddev_samp("seasonal").alias("s"), F.stddev_samp("residual").alias("r"))
    snr = (F.col("t") * F.col("t") + F.col("s") * F.col("s")) / (F.col("r") * F.col("r"))
    return v.select(cols.entity, *[F.round(x, 4).alias(n) for x, n in (("t", "trend_std"), ("s", "seasonal_std"), ("r", "residual_std"))], F.round(snr, 4).alias("snr"), F.round(10 * F.log10(snr), 4).alias("snr_db"))


def rolling_correlation(df: DataFrame, a: str, b: str, rows: int = 168, cols: Columns = Columns()) -> DataFrame:
    """Per entity the mean, deviation and extremes of the correlation over full frames of rows."""

    def framed(x: DataFrame, c: Columns) -> DataFrame:
        frame = c.window().rowsBetween(1 - rows, 0)
        return x.withColumn("_c", F.when(F.count("*").over(frame) == rows, F.corr(a, b).over(frame)))

    c = in_blocks(df.select(*cols.key, a, b), framed, rows - 1, cols=cols)
    return c.groupBy(cols.entity).agg(F.count("_c").alias("n"), F.round(F.avg("_c"), 4).alias("mean"), F.round(F.stddev_samp("_c"), 4).alias("std"), F.round(F.min("_c"), 4).alias("min"), F.round(F.max("_c"), 4).alias("max"))


def stability(df: DataFrame, column: str, parts: int = 4, cols: Columns = Columns()) -> DataFrame:
    """Variation of the means of equal runs of rows; unstable above 0.2."""
    from hourloom.operators.windows import row_splits

    m = row_splits(df, parts, cols).groupBy(cols.entity, "chunk").agg(F.avg(column).alias("m"))
    cv = F.stddev_pop("m") / F.abs(F.avg("m"))
    return m.groupBy(cols.entity).agg(F.round(cv, 4).alias("cv"), (cv > 0.2).alias("unstable"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Of complete rows; one pass. A column that does not vary is correlated with none."""
    rows = correlations(df.na.drop(subset=columns), columns, digits=15, constant=True).collect()
    out = np.eye(len(columns))
    for r in rows:
        i, j = columns.index(r.a), columns.index(r.b)
        out[i, j] = out[j, i] = r["corr"] or 0.0
    return out


def vif(matrix: np.ndarray) -> np.ndarray:
    return np.diag(np.linalg.inv(matrix))


def high_vif(df: DataFrame, columns: list[str], limit: float = 10.0) -> list[str]:
    """Columns dropped one at a time, the largest factor first, until none is over the limit; one pass over the data."""
    m, kept, dropped = correlation_matrix(df, columns), list(range(len(columns))), []
    while len(kept) > 1:
        f = np.diag(np.linalg.pinv(m[np.ix_(kept, kept)]))
        worst = int(f.argmax())
        if f[worst] <= limit:
            break
        dropped.append(columns[kept.pop(worst)])
    return dropped


def top_variance(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    row = df.agg(*[F.var_samp(c).alias(c) for c in columns])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.round(c, 4).alias("variance")) for c in columns]))).orderBy(F.desc("variance"), "feature").limit(k)


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: list[str] | None = None) -> DataFrame:
    y, p = F.col(actual), F.col(predicted)
    e = y - p
    ss = F.var_pop(y) * F.count(y)
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"), F.round(F.avg(F.abs(e)), 4).alias("mae"), F.round(F.avg(e * e), 4).alias("mse"), F.round(1 - F.sum(e * e) / ss, 4).alias("r2"),
        F.round(1 - F.var_pop(e) / F.var_pop(y), 4).alias("explained_variance"), F.round(F.percentile(F.abs(e), F.lit(0.5)), 4).alias("median_abs_error"), F.round(F.max(F.abs(e)), 4).alias("max_error"),
        F.round(F.avg(e), 4).alias("residual_mean"), F.round(F.stddev_pop(e), 4).alias("residual_std"), F.round(F.min(e), 4).alias("residual_min"), F.round(F.max(e), 4).alias("residual_max"),
    )


def degradation(df: DataFrame, order: str, degraded: str, last_n: int = 100, limit: float = 0.2) -> DataFrame:
    last = df.orderBy(F.desc(order)).limit(last_n)
    return last.agg(F.count("*").alias("n"), F.round(F.avg(F.col(degraded).cast("double")), 4).alias("ratio")).withColumn("alert", F.col("ratio") > limit)


def sequence_readiness(df: DataFrame, sequence: int, horizon: int, cols: Columns = Columns()) -> DataFrame:
    n = F.greatest(F.col("n") - sequence - horizon + 1, F.lit(0))
    return df.groupBy(cols.entity).agg(F.count("*").alias("n")).select(cols.entity, n.alias("sequences"), (n > 100).alias("enough"), (n > 5000).alias("plenty"))


def split_report(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    total = df.agg(F.count("*").alias("total"))
    return df.groupBy("split").agg(F.count("*").alias("n"), F.min(cols.time).alias("start"), F.max(cols.time).alias("end")).crossJoin(total).select("split", "n", F.round(100 * F.col("n") / F.col("total"), 2).alias("pct"), "start", "end")


def chronology(df: DataFrame, order: str, cols: Columns = Columns()) -> DataFrame:
    """Per entity, in ingestion order (a whole number): backward steps, repeats and the most usual step in hours. The row
    before comes by carry across spans of the order."""
    at = F.unix_timestamp(F.col(cols.time).cast("timestamp"))
    s = Spans(df.select(cols.entity, F.col(order).cast("long").alias(order), at.alias("_at")), replace(cols, time=order))
    earlier = s.carry(at=(F.max_by(F.struct("_at"), order), "nearest"))["at"]
    s.add("_b", F.coalesce(F.lag(F.struct("_at")).over(s.window()), earlier))
    steps = s.rows.select(cols.entity, ((F.col("_at") - F.col("_b")["_at"]) / 3600).cast("long").alias("_d")).groupBy(cols.entity, "_d").agg(F.count("*").alias("_n"))
    many = lambda when: F.coalesce(F.sum(F.when(when, F.col("_n"))), F.lit(0))
    out = steps.groupBy(cols.entity).agg(many(F.col("_d") < 0).alias("backward"), many(F.col("_d") == 0).alias("repeated"), F.max_by("_d", F.when(F.col("_d").isNotNull(), F.struct("_n", -F.col("_d")))).alias("modal_hours"))
    return out.withColumn("monotone", F.col("backward") == 0)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts of equal-width bins between the smallest and largest value."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return df.select(F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (hi - lo) / bins or 1.0
    b = F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)).cast("long")
    return df.where(F.col(column).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))


def box(df: DataFrame, column: str, by: str) -> DataFrame:
    q = F.percentile(column, F.array(*map(F.lit, (0.25, 0.5, 0.75))))
    return df.groupBy(by).agg(F.min(column).alias("low"), q.alias("q"), F.max(column).alias("high")).select(by, "low", *[F.round(F.col("q")[i], 4).alias(n) for i, n in enumerate(("q1", "median", "q3"))], "high")


def run_summary(runs: DataFrame, by: list[str], status: str = "status", seconds: str = "seconds", digits: int = 4) -> DataFrame:
    """Runs of each group: how many, by status, the share of successes in percent, and the mean duration."""
    is_ = {s: F.count_if(F.col(status) == s) for s in ("succeeded", "failed", "degraded")}
    return runs.groupBy(*by).agg(F.count("*").alias("n"), *[f.alias(s) for s, f in is_.items()], F.round(100 * is_["succeeded"] / F.count("*"), 2).alias("success_pct"), F.round(F.avg(seconds), digits).alias("mean_seconds"))


def column_summary(df: DataFrame, numbers: list[str], texts: list[str], approximate: bool = False, digits: int = 4) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles and max of numbers; count, distinct values, the most frequent
    value (the smallest of equals) and its count of texts. approximate keeps a sketch for the quartiles."""
    quartiles = (lambda c: F.percentile_approx(c, F.array(*map(F.lit, (0.25, 0.5, 0.75))))) if approximate else (lambda c: F.percentile(c, F.array(*map(F.lit, (0.25, 0.5, 0.75)))))
    made = [f.alias(f"{c}__{s}") for c in numbers for s, f in (("n", F.count(c)), ("mean", F.round(F.avg(c), digits)), ("std", F.round(F.stddev_samp(c), digits)), ("low", F.min(c).cast("double")), ("q", quartiles(c)), ("high", F.max(c).cast("double")))]
    of_numbers = _long(df.agg(*made), numbers, ["n", "mean", "std", "low", "q", "high"], "field").select("field", "n", "mean", "std", F.col("low").alias("min"), *[F.round(F.col("q")[i], digits).alias(q) for i, q in enumerate(("q1", "median", "q3"))], F.col("high").alias("max"))
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("_v")) for c in texts]))).where("_v is not null")
    counts = values.groupBy("field", "_v").agg(F.count("*").alias("_n"))
    of_texts = counts.groupBy("field").agg(F.sum("_n").alias("n"), F.count("*").alias("n_unique"), F.min_by("_v", F.struct(-F.col("_n"), "_v")).alias("top"), F.max("_n").alias("freq"))
    return of_numbers.unionByName(of_texts, allowMissingColumns=True)


def mean_contributions(long: DataFrame, top: int = 20, digits: int = 6) -> DataFrame:
    """Features by their mean absolute contribution, the largest first (equal ones by name); `long` has a row per key and
    feature."""
    return long.groupBy("feature").agg(F.round(F.avg(F.abs("contribution")), digits).alias("mean_abs_contribution")).orderBy(F.desc("mean_abs_contribution"), "feature").limit(top)


def ranked(df: DataFrame, size: Column, name: str, top: int = 15) -> DataFrame:
    """The rows of the largest size (nulls last, equal ones by name)."""
    return df.orderBy(F.desc_nulls_last(size), name).limit(top)


def leakage_risk(df: DataFrame, features: list[str], pollutants: tuple[str, ...], target: str) -> DataFrame:
    """How many features give the target away."""
    return leakage(df, features, pollutants, target).agg(F.count_if("leaks").alias("risk_score"))


def split_overlaps(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Whether a split begins before the one in front of it has ended; the window orders one row per split."""
    w = Window.orderBy("start", "split")
    return split_report(df, cols).select("split", "start", "end", F.coalesce(F.col("start") <= F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)).alias("overlaps"))


#: Grades by the least score, the highest first.
GRADES = ((90, "A"), (75, "B"), (60, "C"), (40, "D"), (-1, "F"))


def readiness(components: dict[str, float], weights: dict[str, float]) -> tuple[float, str]:
    """Weighted score of components in 0..1 as 0..100, and its grade."""
    total = sum(weights.values())
    score = round(100 * sum(weights[k] * min(max(components.get(k, 0.0), 0.0), 1.0) for k in weights) / total, 1)
    return score, next(g for limit, g in GRADES if score >= limit)


def readiness_report(df: DataFrame, columns: list[str], weights: dict[str, float], cols: Columns = Columns()) -> DataFrame:
    """One row: shares of values that are there (completeness), of hours that are there (continuity), of keys that are single
    (uniqueness) and of targets that are valid (validity), their weighted score of 100 and its grade."""
    from hourloom.operators.clean import invalid_counts
    from hourloom.operators.windows import gaps

    cells = sum((F.count(c) for c in columns), F.lit(0))
    rows = df.agg(F.count("*").alias("n"), cells.alias("cells")).crossJoin(duplicates(df, cols.key)).crossJoin(gaps(df, cols).agg(F.coalesce(F.sum("missing_hours"), F.lit(0)).alias("holes"))).crossJoin(invalid_counts(df, cols).select("bad_target"))  # one row each
    parts = {"completeness": F.col("cells") / (F.col("n") * len(columns)), "continuity": (F.col("n") - F.col("duplicates")) / (F.col("n") - F.col("duplicates") + F.col("holes")), "uniqueness": 1 - F.col("duplicates") / F.col("n"), "validity": 1 - F.col("bad_target") / F.col("n")}
    out = rows.where("n > 0").select(*[c.alias(k) for k, c in parts.items()])
    score = F.round(100 * sum((w * F.col(k) for k, w in weights.items()), F.lit(0.0)) / sum(weights.values()), 1)
    grade = F.lit(GRADES[-1][1])
    for limit, g in reversed(GRADES[:-1]):
        grade = F.when(F.col("score") >= limit, g).otherwise(grade)
    return out.select(*[F.round(k, 4).alias(k) for k in parts], score.alias("score")).withColumn("grade", grade)
