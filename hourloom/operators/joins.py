"""Joins: exact-time targets, pairings, overlays, as-of lookups and anti-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.config import Columns
from hourloom.operators.blocks import SPAN_HOURS, Spans, last_value
from hourloom.operators.clean import dedupe


def _seconds(c: str) -> Column:
    return F.unix_timestamp(F.col(c).cast("timestamp"))


def targets(df: DataFrame, horizons: tuple[int, ...] = (24, 48, 72), cols: Columns = Columns()) -> DataFrame:
    """target_aqi_t_h: the target exactly h hours later, null if that hour is missing. One join by entity and time, of the
    table with its values moved back by every horizon, so that hours of one entity are many tasks' work. Of repeated keys
    (see dedupe) the largest value counts; a row without entity or time has none."""
    moved = df.select(cols.entity, cols.time, F.col(cols.target).alias("_v"), F.explode(F.array(*map(F.lit, horizons))).alias("_h"))
    moved = moved.select(cols.entity, (F.col(cols.time) - F.expr("make_dt_interval(0, _h)")).alias(cols.time), "_v", "_h")
    later = moved.groupBy(*cols.key).agg(*[F.max(F.when(F.col("_h") == h, F.col("_v"))).alias(f"target_aqi_t_{h}") for h in horizons])
    return df.join(later, cols.key, "left").select(*df.columns, *[f"target_aqi_t_{h}" for h in horizons])


def targets_by_join(df: DataFrame, horizon: int, cols: Columns = Columns()) -> DataFrame:
    """The same by a left join with the shifted table."""
    later = df.select(cols.entity, (F.col(cols.time) - F.expr(f"interval {horizon} hours")).alias(cols.time), F.col(cols.target).alias(f"target_aqi_t_{horizon}"))
    return df.join(later, cols.key, "left")


def pair_hours(weather: DataFrame, air: DataFrame, required: list[str], cols: Columns = Columns()) -> DataFrame:
    """Weather and air rows of the same entity and hour; rows without a required value are skipped."""
    return weather.join(air, cols.key).na.drop(subset=required)


def merge_batch(weather: DataFrame, air: DataFrame, required: list[str], skip_errors: bool = True, cols: Columns = Columns()) -> tuple[DataFrame, DataFrame]:
    """Pairs of the same entity and hour, and the failed ones with their `error`: a pair that lacks its partner or a required
    value fails alone. skip_errors=False makes any failure an error."""
    both = weather.withColumn("_w", F.lit(True)).join(air.withColumn("_a", F.lit(True)), cols.key, "full")
    paired = F.col("_w").isNotNull() & F.col("_a").isNotNull()
    reasons = [F.when(F.col("_w").isNull(), F.lit("weather missing")), F.when(F.col("_a").isNull(), F.lit("air missing")), *[F.when(paired & F.col(c).isNull(), F.lit(f"{c}: missing")) for c in required]]
    out = both.withColumn("error", F.nullif(F.concat_ws("; ", *reasons), F.lit(""))).drop("_w", "_a")
    failed = out.where("error is not null")
    if not skip_errors and (bad := failed.select("error").first()):
        raise ValueError(bad.error)
    return out.where("error is null").drop("error"), failed


def degraded_merge(air: DataFrame, weather: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Every air row; without weather it stays, with the reason."""
    w = weather.withColumn("weather_available", F.lit(True))
    out = air.join(w, cols.key, "left").withColumn("weather_available", F.coalesce("weather_available", F.lit(False)))
    return out.withColumn("degraded_reason", F.when(~F.col("weather_available"), F.lit("weather missing")))


def new_rows(incoming: DataFrame, existing: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Incoming rows whose key (entity trimmed and lower-cased, hour) the table lacks."""
    keys = existing.select(F.lower(F.trim(cols.entity)).alias("_e"), F.col(cols.time).alias("_t")).distinct()
    return incoming.join(keys, (F.lower(F.trim(incoming[cols.entity])) == F.col("_e")) & (incoming[cols.time] == F.col("_t")), "left_anti")


def requested_rows(engineered: DataFrame, requests: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Engineered rows of the requested keys, one each, with the request's order."""
    return requests.join(dedupe(engineered, cols.key), cols.key)


def overlay(stored: DataFrame, live: DataFrame, fields: list[str], defaults: dict[str, float] | None = None, cols: Columns = Columns()) -> DataFrame:
    """Stored rows with live values over them where there are any, then defaults."""
    renamed = live.select(*cols.key, *[F.col(c).alias(f"_live_{c}") for c in fields])
    joined = stored.join(renamed, cols.key, "left")
    keep = [c for c in stored.columns if c not in fields]
    return joined.select(*keep, *[F.coalesce(f"_live_{c}", c, F.lit((defaults or {}).get(c))).alias(c) for c in fields])


def latest_valid(df: DataFrame, fields: dict[str, list[str]], cols: Columns = Columns(), required: tuple[str, ...] = ()) -> DataFrame:
    """Per entity the last non-null value of each field, the first alias that has one. An entity without a value of a required
    field is an error when its row is read."""

    def last(c):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(cols.time)))

    def asked(f: str, c: Column) -> Column:
        lacking = F.raise_error(F.concat(F.lit(f"{f}: no valid value for "), F.coalesce(F.col(cols.entity).cast("string"), F.lit("null"))))
        return F.coalesce(c, lacking.cast(dict(df.dtypes)[next(a for a in fields[f] if a in df.columns)])) if f in required else c

    if missing := [f for f in required if not {*fields[f]} & {*df.columns}]:
        raise ValueError(f"missing fields: {missing}")
    found = df.groupBy(cols.entity).agg(*[F.coalesce(*[last(a) for a in aliases if a in df.columns]).alias(f) for f, aliases in fields.items()], F.max(cols.time).alias("latest"))
    return found.select(cols.entity, *[asked(f, F.col(f)).alias(f) for f in fields], "latest")


def as_of(requests: DataFrame, features: DataFrame, fields: list[str], ttl: str | Column | None = None, valid: bool = False, cols: Columns = Columns(), hours: int = SPAN_HOURS) -> DataFrame:
    """Every request (entity, time and any further columns) with the fields of its entity's latest feature row that is not after
    it, and that row's time (`feature_time`). valid: each field's latest value that is not null, in place of the latest row's.
    ttl, an interval (one for all, or a column of the requests): a row as old as that or older counts as none.

    Requests and features are put in one order and the latest row is carried: inside a span of time by a window, across spans
    by their summaries. So the work grows with both tables, not with pairs, and one entity is many tasks' work."""
    at = F.col(cols.time)
    items = {f: F.when(F.col(f).isNotNull(), F.struct(at.alias("t"), F.col(f).alias("v"))) for f in fields} if valid else {f: F.struct(at.alias("t"), F.col(f).alias("v")) for f in fields}
    left = features.where(at.isNotNull()).select(*cols.key, F.lit(0).alias("_kind"), *[c.alias(f"_f{i}") for i, c in enumerate(items.values())])
    life = F.lit(None).cast("interval day to second") if ttl is None else F.expr(f"interval {ttl}") if isinstance(ttl, str) else ttl
    right = requests.select(*cols.key, F.lit(1).alias("_kind"), F.struct(*requests.columns).alias("_request"), life.alias("_life"))
    s = Spans(left.unionByName(right, allowMissingColumns=True), cols, hours)
    names = [f"_f{i}" for i in range(len(fields))]
    before = s.carry(**{n: (last_value(n, cols), "nearest") for n in names})
    w = Window.partitionBy(s.key, s.span).orderBy(cols.time, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    s.rows = s.rows.withColumns({n: F.coalesce(F.last(n, ignorenulls=True).over(w), before[n]) for n in names})
    fresh = lambda n: F.col("_life").isNull() | (F.col(n)["t"] > at - F.col("_life"))
    got = s.rows.where("_kind = 1").withColumns({n: F.when(fresh(n), F.col(n)) for n in names})
    return got.select("_request.*", *[F.col(n)["v"].alias(f) for n, f in zip(names, fields, strict=True)], F.greatest(*[F.col(n)["t"] for n in names], *([F.lit(None)] if len(names) == 1 else [])).alias("feature_time"))


def latest_features(df: DataFrame, now: Column, ttl_days: int, fields: list[str], cols: Columns = Columns()) -> DataFrame:
    """Per entity the latest row that is not older than the time to live."""
    fresh = df.where((F.col(cols.time) <= now) & (F.col(cols.time) > now - F.make_dt_interval(F.lit(ttl_days))))
    best = fresh.groupBy(cols.entity).agg(F.max_by(F.struct(cols.time, *fields), cols.time).alias("r"))
    return best.select(cols.entity, "r.*")


def day_difference(df: DataFrame, reference: str, cols: Columns = Columns()) -> DataFrame:
    """Daily mean of each entity minus that of the reference, on common days."""
    day = df.groupBy(cols.entity, F.to_date(cols.time).alias("day")).agg(F.avg(cols.target).alias("m"))
    ref = day.where(F.col(cols.entity) == reference).select("day", F.col("m").alias("ref"))
    return day.where(F.col(cols.entity) != reference).join(ref, "day").select(cols.entity, "day", (F.col("m") - F.col("ref")).alias("difference"))


def aligned_days(df: DataFrame, a: str, b: str, cols: Columns = Columns()) -> DataFrame:
    return df.groupBy(F.to_date(cols.time).alias("day")).agg(F.avg(a).alias(f"{a}_mean"), F.avg(b).alias(f"{b}_mean")).na.drop()
