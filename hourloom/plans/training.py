"""Direct multi-horizon forecasting with Spark ML: candidates, champion by validation error, forecasts, contributions."""

from __future__ import annotations

import math
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.config import Columns
from hourloom.functions import features as fx
from hourloom.operators import reports, windows
from hourloom.plans.dataset import for_horizon

HORIZONS = (24, 48, 72)
TASK_ROWS = 20_000  # of a task while models are fitted: boosted trees are hundreds of jobs, each as slow as its tasks are many


def ridge(train: DataFrame, alpha: float = 10.0) -> LinearRegression:
    """The estimator whose closed form is (X'X + alpha I)^-1 X'y: Spark divides the penalty by n and the label's
    deviation."""
    n, sd = train.agg(F.count("*"), F.stddev_pop("label")).first()
    return LinearRegression(elasticNetParam=0.0, standardization=False, solver="normal", regParam=alpha / max(n, 1) * (sd or 1.0))


def candidates(train: DataFrame, trees: bool = True) -> dict:
    out = {"ridge": ridge(train)}
    if trees:
        out["forest"] = RandomForestRegressor(numTrees=50, maxDepth=8, seed=42)
        out["boosted"] = GBTRegressor(maxIter=100, stepSize=0.1, maxDepth=6, seed=42)
    return out


def champion(df: DataFrame, horizon: int, features: list[str], trees: bool = True) -> tuple[str, PipelineModel, DataFrame]:
    """Name and model of the smallest validation error (the first of equals), and test metrics of that model alone."""
    held = for_horizon(df, horizon, features).persist()
    try:
        data = held.coalesce(math.ceil(max(held.count(), 1) / TASK_ROWS))
        train = data.where("split = 'train'")
        best = None
        for name, estimator in candidates(train, trees).items():
            model = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), estimator]).fit(train)
            rmse = model.transform(data.where("split = 'validation'")).agg(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)))).first()[0]
            if best is None or (rmse is not None and rmse < best[0]):
                best = (rmse if rmse is not None else float("inf"), name, model)
        test = best[2].transform(data.where("split = 'test'")).select(F.col("label").alias("actual"), F.col("prediction").alias("predicted"))
        return best[1], best[2], reports.regression_metrics(test).withColumn("horizon", F.lit(horizon))
    finally:
        held.unpersist()


def forecasts(df: DataFrame, features: list[str], horizons: tuple[int, ...] = HORIZONS, cols: Columns = Columns(), trees: bool = True) -> DataFrame:
    """Direct forecasts of every entity's latest row for each horizon, by the champion of all candidates; no interpolation
    between them. Horizons are fitted side by side, as a boosted tree is many short jobs."""
    latest = windows.latest_rows(df, 1, cols).select(*cols.key, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    fit = inheritable_thread_target(df.sparkSession)(lambda h: champion(df, h, features, trees))
    with ThreadPool(len(horizons)) as pool:
        champions = pool.map(fit, horizons)
    parts = []
    for h, (name, model, _) in zip(horizons, champions, strict=True):
        p = model.transform(latest)
        parts.append(p.select(cols.entity, F.lit(h).cast("long").alias("horizon_hours"), (F.col(cols.time) + F.expr(f"interval {h} hours")).alias(cols.time), F.round("prediction", 2).alias("predicted_aqi"), F.lit(name).alias("model")))
    return reduce(DataFrame.unionByName, parts)


def allowed_horizons(horizon: int) -> list[int]:
    if horizon not in HORIZONS:
        raise ValueError(f"horizon must be one of {HORIZONS}")
    return [h for h in HORIZONS if h <= horizon]


def contributions(model: PipelineModel, df: DataFrame, features: list[str], key: list[str], top: int = 5, digits: int = 4) -> DataFrame:
    """The largest x * coefficient of each row with a label and a direction; top is kept within 1..20."""
    beta = model.stages[-1].coefficients.toArray()
    weights = F.array(*[F.lit(float(b)) for b in beta])
    x = model.stages[0].transform(df).select(*key, F.posexplode(F.zip_with(vector_to_array("features"), weights, lambda a, b: F.when(F.isnan(a * b), 0.0).otherwise(a * b))).alias("i", "contribution"))
    w = Window.partitionBy(*key)
    ranked = x.withColumn("n", F.row_number().over(w.orderBy(F.desc(F.abs("contribution")), "i"))).withColumn("largest", F.max(F.abs("contribution")).over(w))
    names = F.array(*map(F.lit, features))
    return ranked.where(F.col("n") <= min(max(top, 1), 20)).select(*key, F.get(names, F.col("i")).alias("feature"), F.round("contribution", digits).alias("contribution"), fx.impact(F.abs("contribution"), F.col("largest")).alias("impact"), fx.direction(F.col("contribution")).alias("direction"))


def importance(model: PipelineModel, features: list[str], top: int = 20) -> list[tuple[str, float]]:
    last = model.stages[-1]
    v = abs(last.coefficients.toArray()) if hasattr(last, "coefficients") else last.featureImportances.toArray()
    return sorted(zip(features, map(float, v), strict=True), key=lambda x: (-x[1], x[0]))[:top]


def bundle_problems(features: list[str], horizon: int, fitted: list[str]) -> list[str]:
    out = []
    if not features or len({*features}) != len(features):
        out.append("features must be there and unique")
    if horizon not in HORIZONS:
        out.append("unknown horizon")
    if missing := [f for f in features if f not in fitted]:
        out.append(f"not made by the transformer: {missing}")
    return out


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    """df with each feature as a number, 0 where null; a missing feature is an error."""
    if missing := [f for f in features if f not in df.columns]:
        raise ValueError(f"missing features: {missing}")
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})


def predictions(model: PipelineModel, df: DataFrame, features: list[str], version: str, cols: Columns = Columns()) -> DataFrame:
    """Batch prediction through the fitted contract: key, prediction to two digits, the share of features that the row
    holds, and the model's version."""
    there = sum((F.col(f).isNotNull().cast("int") for f in features), F.lit(0)) / max(len(features), 1) if {*features} <= {*df.columns} else F.lit(None)
    x = _assembled(df.withColumn("_there", F.round(there, 4)), features)
    return model.transform(x).select(*cols.key, F.round("prediction", 2).alias("predicted_aqi"), F.col("_there").alias("completeness"), F.lit(version).alias("version"))


def residuals(model: PipelineModel, df: DataFrame, features: list[str], label: str, cols: Columns = Columns()) -> DataFrame:
    """Key, actual, predicted and residual of the rows with a label; reports.regression_metrics takes them as they are. A
    table without the features or the label is an error."""
    if label not in df.columns:
        raise ValueError(f"missing label: {label}")
    x = model.transform(_assembled(df.where(F.col(label).isNotNull()), features))
    return x.select(*cols.key, F.col(label).cast("double").alias("actual"), F.col("prediction").alias("predicted"), (F.col(label) - F.col("prediction")).alias("residual"))


def with_test_errors(made: DataFrame, metrics: DataFrame) -> DataFrame:
    """Forecasts with the root mean squared test error of their horizon (null if it has none); a label, no probability."""
    return made.join(metrics.select(F.col("horizon").alias("horizon_hours"), F.col("rmse").alias("test_rmse")), "horizon_hours", "left")


def next_version(catalogue: DataFrame) -> str:
    row = catalogue.select(F.split("version", r"\.").cast("array<int>").alias("v")).agg(F.max("v").alias("v")).first().v
    return "1.0.0" if row is None else f"{row[0]}.{row[1]}.{row[2] + 1}"


def promote(catalogue: DataFrame, which: Column) -> DataFrame:
    """The chosen row becomes Production, any other Production row Archived."""
    return catalogue.withColumn("stage", F.when(which, "Production").when(F.col("stage") == "Production", "Archived").otherwise(F.col("stage")))


def entity_summary(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Per entity: current value and category, change, and the number of readings of the last 24 hours."""
    now = df.groupBy(cols.entity).agg(F.max_by(cols.target, cols.time).alias("current"), F.max(cols.time).alias("latest"))
    change = windows.trend(df, cols).select(cols.entity, F.col("value").alias("change"))
    history = windows.recent(df, 24, cols).groupBy(cols.entity).agg(F.count("*").alias("n_history"))
    return now.join(change, cols.entity, "left").join(history, cols.entity, "left").withColumn("category", fx.display_category(F.col("current")))


def full_summary(df: DataFrame, made: DataFrame | None = None, wanted: list[str] | None = None, cols: Columns = Columns()) -> DataFrame:
    """Per entity all that a reader of it is shown: latest time, current value, category and message, change since the last valid
    reading with direction and label, dominant pollutant of the latest row, forecasts (an array of horizon, time and value, the
    nearest first) and the history of the last 24 hours, 7 and 30 days (arrays of time and value, at most an hourly row each).

    wanted: entities that are asked for. One without a row or a valid reading has `error` and else nulls; it holds none of the
    others up."""
    e, t, v = cols.entity, cols.time, cols.target
    month = windows.recent(df, 24 * 30, cols)
    last = F.max(t).over(Window.partitionBy(e))  # of 30 days of an entity
    point = F.struct(F.col(t).alias("time"), F.col(v).alias("value"))
    month = month.withColumn("_last", last)
    since = lambda hours: F.array_sort(F.collect_list(F.when(F.col(t) >= F.col("_last") - F.expr(f"interval {hours} hours"), point)))
    there = [p for p in cols.pollutants if p in df.columns]
    shown = fx.dominant_label(fx.dominant(tuple(there))) if there else F.lit("Unknown")
    out = month.groupBy(e).agg(F.max(t).alias("latest"), F.max_by(v, t).alias("current"), F.max_by(shown, t).alias("dominant"), *[since(h).alias(n) for n, h in (("day", 24), ("week", 24 * 7), ("month", 24 * 30))])
    change = windows.trend(df, cols).select(F.col(e).alias("_e"), F.col("value").alias("change"), "direction", "label")
    out = out.join(change, F.col(e).eqNullSafe(F.col("_e")), "left").drop("_e")
    if made is not None:
        item = F.struct(F.col("horizon_hours").alias("horizon"), F.col(t).alias("time"), F.col("predicted_aqi").alias("value"))
        ahead = made.groupBy(F.col(e).alias("_e")).agg(F.array_sort(F.collect_list(item)).alias("forecasts"))
        out = out.join(ahead, F.col(e).eqNullSafe(F.col("_e")), "left").drop("_e")
    else:
        out = out.withColumn("forecasts", F.array())
    if wanted is not None:
        asked = df.sparkSession.createDataFrame([(w,) for w in dict.fromkeys(wanted)], f"`{e}` string")
        out = asked.join(out, e, "left")
    category = fx.display_category(F.col("current"))
    error = F.when(F.col("latest").isNull(), "no rows").when(F.col("current").isNull(), "no valid reading")
    return out.select(e, "latest", "current", category.alias("category"), fx.advice(category).alias("message"), "change", "direction", "label", "dominant", "forecasts", "day", "week", "month", error.alias("error"))
