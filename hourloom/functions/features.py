"""Scalar features: calendar, weather, pollution, space and text. All are column expressions."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.config import POLLUTANTS, Columns, FeatureConfig

#: Season of each month, in the order of their codes.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4), "Summer": (5, 6), "Monsoon": (7, 8, 9), "Autumn": (10, 11)}
#: Bands, right-closed, of the target, as a feature and as shown to people.
BANDS = ((50, "Good"), (100, "Moderate"), (150, "Unhealthy_Sensitive"), (200, "Unhealthy"), (300, "Very_Unhealthy"), (501, "Hazardous"))
SHOWN = ((50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"), (200, "Unhealthy"), (300, "Very Unhealthy"), (501, "Hazardous"))
#: Weights of the pollution index.
INDEX_WEIGHTS = {"pm25": 0.35, "pm10": 0.25, "no2": 0.15, "so2": 0.10, "co": 0.10, "o3": 0.05}
EARTH_KM = 6371.0


def _flag(c: Column) -> Column:
    return c.cast("long")


def calendar(t: Column) -> dict[str, Column]:
    d = F.weekday(t)
    return {
        "year": F.year(t), "month": F.month(t), "day": F.day(t), "hour": F.hour(t), "minute": F.minute(t), "day_of_year": F.dayofyear(t), "week_of_year": F.weekofyear(t),
        "day_of_week": d, "quarter": F.quarter(t), "days_in_month": F.day(F.last_day(t)),
        "is_month_start": F.day(t) == 1, "is_month_end": F.to_date(t) == F.last_day(t),
    }


def temporal(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Calendar, cyclic, season, holiday and part-of-day features of the time column."""
    t = F.col(cfg.columns.time)
    c = {k: v.cast("long") for k, v in calendar(t).items()}
    h, d, m, q = F.hour(t), F.weekday(t), F.month(t), F.quarter(t)
    c["day_of_week_name"] = F.date_format(t, "EEEE")
    for name, x, period in (("hour", h, 24), ("dow", d, 7), ("month", m, 12), ("doy", F.dayofyear(t), 365)):
        c[f"{name}_sin"], c[f"{name}_cos"] = F.sin(2 * pi * x / period), F.cos(2 * pi * x / period)
    season, code = F.lit(None), F.lit(None)
    for i, (name, months) in enumerate(SEASONS.items()):
        season, code = F.when(m.isin(*months), name).otherwise(season), F.when(m.isin(*months), i).otherwise(code)
    c |= {"season": season, "season_sin": F.sin(2 * pi * code / 5), "season_cos": F.cos(2 * pi * code / 5)}
    weekend = d >= 5
    holiday = F.lit(False)
    for month, day in cfg.holidays:
        holiday = holiday | ((m == month) & (F.day(t) == day))
    c |= {"is_weekend": _flag(weekend), "is_holiday": _flag(holiday), "is_working_day": _flag(~weekend & ~holiday), "days_since_weekend": F.when(d < 5, F.least(d, 6 - d)).otherwise(0).cast("long")}
    rush_am, rush_pm = h.between(8, 10), h.between(17, 19)
    c |= {"is_morning": _flag(h.between(5, 11)), "is_afternoon": _flag(h.between(12, 16)), "is_evening": _flag(h.between(17, 20)), "is_night": _flag((h >= 21) | (h <= 4)), "is_morning_rush": _flag(rush_am), "is_evening_rush": _flag(rush_pm), "is_rush_hour": _flag(rush_am | rush_pm)}
    c |= {f"is_q{i}": _flag(q == i) for i in (1, 2, 3, 4)} | {"is_first_half": _flag(m <= 6), "is_second_half": _flag(m > 6)}
    return df.withColumns(c)


def light_time(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    t = F.col(cols.time)
    return df.withColumns({"hour": F.hour(t).cast("long"), "day": F.day(t).cast("long"), "month": F.month(t).cast("long"), "day_of_week": F.weekday(t).cast("long"), "is_weekend": _flag(F.weekday(t) >= 5)})


def dew_point(t: Column, rh: Column) -> Column:
    """Magnus formula; humidity clipped to 1..100."""
    a, b = 17.27, 237.7
    clipped = F.when(rh < 1, 1.0).when(rh > 100, 100.0).otherwise(rh)
    g = a * t / (b + t) + F.ln(clipped / 100)
    return b * g / (a - g)


def heat_index(t: Column, rh: Column) -> Column:
    """Rothfusz polynomial in Fahrenheit, back in Celsius; below 26.7 degrees the temperature itself."""
    f = t * 9 / 5 + 32
    hi = (
        -42.379 + 2.04901523 * f + 10.14333127 * rh - 0.22475541 * f * rh - 0.00683783 * f * f - 0.05481717 * rh * rh + 0.00122874 * f * f * rh + 0.00085282 * f * rh * rh - 0.00000199 * f * f * rh * rh
    )
    return F.when(t >= 26.7, (hi - 32) * 5 / 9).otherwise(t)


def interactions(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    t, h, w, p = (F.col(c) for c in ("temperature", "humidity", "wind_speed", "pm25"))
    return df.withColumns({
        "temp_humidity_interaction": t * h, "wind_pm25_interaction": w * p, "pm25_per_wind": p / (w + 0.1), "pressure_change_1h": F.col("pressure") - F.lag("pressure").over(cols.window()),
        "dew_point": dew_point(t, h), "heat_index": heat_index(t, h),
    })


def band(c: Column) -> Column:
    """Band of the target; null outside (-1, 501]."""
    out = F.lit(None)
    for top, name in reversed(BANDS):
        out = F.when(c <= top, name).otherwise(out)
    return F.when((c > -1) & (c <= 501), out)


def display_category(c: Column) -> Column:
    """Like band, in words, without an upper bound; null is Unavailable."""
    out = F.lit("Hazardous")
    for top, name in reversed(SHOWN[:-1]):
        out = F.when(c <= top, name).otherwise(out)
    return F.when(c.isNull(), "Unavailable").otherwise(out)


#: The message shown with a category.
ADVICE = {
    "Good": "Air quality is good. Normal outdoor activity is acceptable.",
    "Moderate": "Air quality is moderate. Sensitive people should monitor symptoms.",
    "Unhealthy for Sensitive Groups": "Air may affect sensitive groups. Reduce long outdoor exposure.",
    "Unhealthy": "Air quality is unhealthy. Limit outdoor activity where possible.",
    "Very Unhealthy": "Air quality is very unhealthy. Avoid prolonged outdoor exposure.",
    "Hazardous": "Air quality is hazardous. Avoid outdoor exposure as much as possible.",
    "Unavailable": "Current AQI reading is unavailable.",
}


def advice(category: Column) -> Column:
    out = F.lit(None)
    for k, v in ADVICE.items():
        out = F.when(category == k, v).otherwise(out)
    return out


def ratios(df: DataFrame) -> DataFrame:
    pairs = (("pm25", "pm10"), ("no2", "so2"), ("co", "no2"), ("pm25", "o3"))
    return df.withColumns({f"{a}_{b}_ratio": F.col(a) / (F.col(b) + 0.1) for a, b in pairs})


def pollution_index(bounds: dict[str, tuple[float, float]]) -> Column:
    """Weighted mean of the min-max scaled pollutants; a null pollutant makes it null, a zero span counts 0."""
    total, weight = F.lit(0.0), 0.0
    for p, (lo, hi) in bounds.items():
        w = INDEX_WEIGHTS.get(p, 0.1)
        weight += w
        scaled = (F.col(p) - lo) / (hi - lo) if hi > lo else F.when(F.col(p).isNotNull(), 0.0)
        total = total + w * scaled
    return total / weight


def one_hot(df: DataFrame, column: str, categories: list[str], title: bool = False) -> DataFrame:
    """{column}_{category} flags; null and unknown are all 0."""
    c = F.initcap(F.trim(column)) if title else F.col(column)
    return df.withColumns({f"{column}_{k}": F.when(c == k, 1).otherwise(0).cast("long") for k in categories})


def haversine(lat: Column, lon: Column, to_lat: float, to_lon: float) -> Column:
    a, b = F.radians(lat), F.radians(F.lit(to_lat))
    d = F.radians(F.lit(to_lon)) - F.radians(lon)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(d / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(h))


#: Latitude and longitude of the known entities.
COORDINATES = {"karachi": (24.8607, 67.0011), "lahore": (31.5204, 74.3587), "islamabad": (33.6844, 73.0479)}


def coordinates(entity: Column, places: dict[str, tuple[float, float]] | None = None) -> Column:
    """A struct of latitude and longitude of an entity (trimmed, in any case); an unknown one is an error when its row is
    read."""
    key, places = F.lower(F.trim(entity)), places or COORDINATES
    known = F.create_map(*[x for n, (lat, lon) in places.items() for x in (F.lit(n), F.struct(F.lit(float(lat)).alias("latitude"), F.lit(float(lon)).alias("longitude")))])
    unknown = F.raise_error(F.concat(F.lit("no coordinates of: "), F.coalesce(key, F.lit("null")))).cast("struct<latitude:double,longitude:double>")
    return F.coalesce(F.element_at(known, key), unknown)


def dominant(columns: tuple[str, ...] = POLLUTANTS) -> Column:
    """Name of the largest non-null column; ties go to the first, none is unknown."""
    best = F.array_max(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.lit(-i).alias("r"), F.lit(c).alias("n"))) for i, c in enumerate(columns)])))
    return F.coalesce(best["n"], F.lit("unknown"))


#: How pollutants are shown.
LABELS = {"pm25": "PM2.5", "pm10": "PM10", "no2": "NO2", "so2": "SO2", "co": "CO", "o3": "O3"}


def dominant_label(c: Column) -> Column:
    key = F.regexp_replace(F.lower(F.trim(c)), r"[._\- ]", "")
    out = F.lit("Unknown")
    for k, v in LABELS.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def row_checksum(columns: list[str]) -> Column:
    """SHA-256 of the row as JSON with sorted names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def impact(magnitude: Column, largest: Column) -> Column:
    r = F.try_divide(magnitude, largest)
    return F.when(largest <= 0, "Low").when(r >= 0.66, "High").when(r >= 0.33, "Medium").otherwise("Low")


def direction(c: Column) -> Column:
    return F.when(c > 0, "increases").when(c < 0, "decreases").otherwise("neutral")


def display_name(c: Column) -> Column:
    """A feature's name for people: words in title case, pollutants by their symbol."""
    out = F.initcap(F.regexp_replace(c, "_", " "))
    for k, v in LABELS.items():
        out = F.regexp_replace(out, f"(?i)\\b{k}\\b", v)
    return out
