"""Cleaning, validation, filters and keyed de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.config import Columns
from hourloom.operators.blocks import SPAN_HOURS, Spans, last_value
from hourloom.sources.observations import hour_of

#: Tokens that stand for a missing value when serving.
MISSING_TOKENS = ("", "-", "n/a", "na", "null", "none", "nan")


def dedupe(df: DataFrame, key: list[str], *order: str, keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) in the order of the given columns."""
    by = [F.desc(c) if keep == "last" else F.asc(c) for c in order] or [F.lit(1)]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*by))).where("_n = 1").drop("_n")


def canonicalise(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Floored hour, trimmed title-case entity, no blank keys, last row of each key."""
    times = [c for c in ("event_hour", cols.time) if c in df.columns]
    out = df.withColumn(cols.time, hour_of(F.coalesce(*[F.col(c).cast("timestamp_ntz") for c in times]))).withColumn(cols.entity, F.initcap(F.trim(cols.entity)))
    out = out.where(F.col(cols.time).isNotNull() & F.col(cols.entity).isNotNull() & (F.col(cols.entity) != ""))
    return dedupe(out, cols.key, cols.order)


def present(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def drop_stale(df: DataFrame, stale: list[str]) -> DataFrame:
    return df.drop(*stale)


def drop_warm_up(df: DataFrame, targets: list[str]) -> DataFrame:
    """Rows without a null outside the targets."""
    return df.na.drop(subset=[c for c in df.columns if c not in targets])


def usable(df: DataFrame, horizon: int) -> DataFrame:
    return df.where(F.col(f"target_aqi_t_{horizon}").isNotNull())


def leaking(columns: list[str]) -> list[str]:
    """Columns that tell the future or the target's band. dominant_pollutant itself begins with dominant_, so that it
    always goes."""
    out = [c for c in columns if any(x in c.lower() for x in ("future", "lead", "target_shifted"))]
    out += [c for c in columns if c == "aqi_category"]
    if any(c.startswith("dominant_") for c in columns):
        out += [c for c in columns if c == "dominant_pollutant"]
    return list(dict.fromkeys(out))


def drop_leakage(df: DataFrame) -> DataFrame:
    return df.drop(*leaking(df.columns))


def invalid_counts(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """One row: bad timestamps, negative pollutants, targets out of 0..500."""
    c = F.col(cols.target)
    return df.agg(
        F.count_if(F.col(cols.time).isNull()).alias("bad_timestamp"),
        *[F.count_if(F.col(p) < 0).alias(f"negative_{p}") for p in cols.pollutants if p in df.columns],
        F.count_if((c < 0) | (c > 500)).alias("bad_target"),
    )


def null_invalid(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Invalid values become null, the last row of each key stays. Nothing is imputed, whatever the caller's strategy."""
    valid = {p: F.when(F.col(p) >= 0, F.col(p)) for p in cols.pollutants if p in df.columns}
    valid[cols.target] = F.when(F.col(cols.target).between(0, 500), F.col(cols.target))
    return dedupe(df.withColumns(valid), cols.key, cols.order)


def numeric(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def normalise_missing(df: DataFrame, columns: list[str], serving: bool = True) -> DataFrame:
    """Missing tokens become null: at ingest `-` and blanks, when serving the whole list, in any case."""
    tokens = MISSING_TOKENS if serving else ("", "-")
    return df.withColumns({c: F.when(~F.lower(F.trim(c)).isin(*tokens), F.col(c)) for c in columns})


def kelvin_to_celsius(t: Column) -> Column:
    """A temperature over 130 can only be Kelvin."""
    return F.when(t > 130, F.round(t - 273.15, 2)).otherwise(t)


def convert_kelvin(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """All temperatures of a row by the look of one."""
    return df.withColumns({c: F.when(F.col(key) > 130, F.round(F.col(c) - 273.15, 2)).otherwise(F.col(c)) for c in columns})


#: Ranges of the prediction payload; None is open.
RANGES = {
    "latitude": (-90, 90), "longitude": (-180, 180), "temperature": (-90, 60), "humidity": (0, 100), "pressure": (800, 1100), "wind_speed": (0, 120), "wind_direction": (0, 360), "cloudiness": (0, 100),
    "visibility": (-1, None), "pm25": (0, None), "pm10": (0, None), "no2": (0, None), "so2": (0, None), "co": (0, None), "o3": (0, None), "aqi": (0, 500),
}


def errors(df: DataFrame, required: list[str], ranges: dict[str, tuple[float | None, float | None]] = RANGES) -> DataFrame:
    """df with `errors`, the list of broken rules (empty: valid)."""
    rules = [F.when(F.col(c).isNull(), F.lit(f"{c}: missing")) for c in required]
    outside = lambda c, lo, hi: (F.col(c) < lo if lo is not None else F.lit(False)) | (F.col(c) > hi if hi is not None else F.lit(False))
    rules += [F.when(outside(c, lo, hi), F.lit(f"{c}: out of range")) for c, (lo, hi) in ranges.items() if c in df.columns]
    return df.withColumn("errors", F.array_compact(F.array(*rules)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.size("errors") == 0).drop("errors"), df.where(F.size("errors") > 0)


def validated_batch(df: DataFrame, row: str, required: list[str], ranges: dict[str, tuple[float | None, float | None]] = RANGES, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the failing ones with `errors` that name their row (a whole number in column `row`). strict: the first
    failing row is an error with its messages, and so is a batch without rows; else failing rows are set aside."""
    told = errors(df, required, ranges).withColumn("errors", F.transform("errors", lambda e: F.concat(F.lit("row["), F.col(row).cast("string"), F.lit("]."), e)))
    if strict:
        n, first = told.agg(F.count("*"), F.min_by("errors", F.when(F.size("errors") > 0, F.col(row)))).first()
        if not n:
            raise ValueError("the batch is empty")
        if first:
            raise ValueError("; ".join(first))
    return split_valid(told)


def warnings(df: DataFrame, breakdown: str | None = None) -> DataFrame:
    """df with `warnings`, the list of implausible values. breakdown: a map of readings by pollutant that ought not to be
    empty."""
    t, h = F.col("temperature"), F.col("humidity")
    rules = [F.when((t < -90) | (t > 60), F.lit("temperature implausible")), F.when((h == 100) & (t > 45), F.lit("saturated heat")), F.when(F.col("wind_speed") > 120, F.lit("wind implausible")), F.when(F.col("aqi") >= 400, F.lit("aqi extreme"))]
    if breakdown:
        rules.append(F.when(F.col(breakdown).isNull() | (F.size(breakdown) == 0), F.lit("no pollutant breakdown")))
    return df.withColumn("warnings", F.array_compact(F.array(*rules)))


def supported(df: DataFrame, names: list[str], cols: Columns = Columns()) -> DataFrame:
    return df.where(F.lower(F.trim(cols.entity)).isin([n.strip().lower() for n in names]))


def canonical_entity(df: DataFrame, names: list[str], cols: Columns = Columns()) -> DataFrame:
    """The entity by its listed name, whatever its case and outer spaces; a row of an unknown one is an error."""
    key = F.lower(F.trim(cols.entity))
    known = F.create_map(*[x for n in names for x in (F.lit(n.strip().lower()), F.lit(n.strip()))])
    unknown = F.raise_error(F.concat(F.lit("unknown entity: "), F.coalesce(key, F.lit("null")))).cast("string")
    return df.withColumn(cols.entity, F.coalesce(F.element_at(known, key), unknown))


def batch_missing(df: DataFrame, fields: list[str], strategy: str) -> DataFrame:
    """mean: the batch's mean (0 if it has none); zero; drop. Another strategy is an error."""
    if strategy not in ("mean", "zero", "drop"):
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == "drop":
        return df.na.drop(subset=fields)
    if strategy == "zero":
        return df.na.fill(0.0, subset=fields)
    means = df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in fields]).first()
    return df.na.fill({c: means[c] for c in fields})


def forward_fill(df: DataFrame, columns: list[str], cols: Columns = Columns(), hours: int = SPAN_HOURS) -> DataFrame:
    """Each entity's last value so far; what earlier spans of time tell is carried over."""
    s = Spans(df, cols, hours)
    earlier = s.carry(**{c: (last_value(c, cols), "nearest") for c in columns})
    w = s.window().rowsBetween(Window.unboundedPreceding, 0)
    s.rows = s.rows.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(w), earlier[c]) for c in columns})
    return s.done()


def contract(df: DataFrame, features: list[str], metadata: tuple[str, ...] = ("city", "timestamp", "split")) -> tuple[list[str], list[str], float]:
    """Missing and unexpected columns of a learned feature list, and its completeness."""
    allowed = {*features, *metadata}
    unexpected = [c for c in df.columns if c not in allowed and not c.startswith("target_aqi_t_")]
    missing = [c for c in features if c not in df.columns]
    return missing, unexpected, (len(features) - len(missing)) / len(features) if features else 1.0


def enforce_contract(df: DataFrame, features: list[str]) -> DataFrame:
    """The features in order; anything missing, unexpected, doubled or null is an error."""
    if len({*df.columns}) != len(df.columns):
        raise ValueError("doubled columns")
    missing, unexpected, _ = contract(df, features)
    if missing or unexpected:
        raise ValueError(f"missing {missing}, unexpected {unexpected}")
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features]).first().asDict()
    if bad := [c for c, n in nulls.items() if n]:
        raise ValueError(f"null features: {bad}")
    return df.select(*features)


def feature_columns(columns: list[str], metadata: tuple[str, ...] = ("city", "timestamp", "date", "split", "ingest_seq")) -> list[str]:
    return [c for c in columns if c not in metadata and not c.startswith("target_aqi_t_")]


def sample_rows(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """min(n, rows) rows, the same for the same seed."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(n)
