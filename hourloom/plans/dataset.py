"""The feature chain, the state fitted on the training split, and leak-free datasets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.config import Columns, FeatureConfig
from hourloom.functions import features as fx
from hourloom.operators import clean, joins, reports, windows


ROLLED = ("mean", "std", "min", "max", "median", "range")
#: Columns whose collinearity is looked at by default.
VIF_COLUMNS = ("temperature", "feels_like", "humidity", "pressure", "wind_speed", "cloudiness", "pm25", "pm10", "no2", "so2", "co", "o3")

Step = Callable[[DataFrame, FeatureConfig, Columns], DataFrame]


def _there(df: DataFrame, names: tuple[str, ...] | list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def lag_step(df: DataFrame, cfg: FeatureConfig, c: Columns) -> DataFrame:
    return windows.lags(df, {m: ns for m, ns in windows.default_lags(cfg).items() if m in df.columns}, c)


def rolling_step(df: DataFrame, cfg: FeatureConfig, c: Columns, stats: tuple[str, ...] = ROLLED) -> DataFrame:
    stats = tuple(s for s in stats if s != "range" or cfg.ranges) + (("q25", "q75") if cfg.quantiles else ())
    return windows.rolling(df, _there(df, c.measures), cfg.windows, stats, c)


def trend_step(df: DataFrame, cfg: FeatureConfig, c: Columns) -> DataFrame:
    names = _there(df, [c.target, *c.pollutants])
    for f in (windows.differences, windows.percent_changes, windows.rates):
        df = f(df, names, cfg.differences, c)
    return windows.momentum(df, names, 3, c)


def air_quality_step(df: DataFrame, cfg: FeatureConfig, c: Columns) -> DataFrame:
    return fx.ratios(df).withColumn("aqi_category", fx.band(F.col(c.target)))


def spatial_step(df: DataFrame, cfg: FeatureConfig, c: Columns) -> DataFrame:
    """Flags of the fixed entities, the product of the coordinates and, if asked for, the distance to a place."""
    out = fx.one_hot(df, c.entity, list(cfg.cities), title=True)
    if not {"latitude", "longitude"} <= {*df.columns}:
        return out
    lat, lon = clean.numeric("latitude"), clean.numeric("longitude")
    out = out.withColumn("lat_lon_product", lat * lon)
    return out.withColumn(f"distance_to_{cfg.place[0]}_km", fx.haversine(lat, lon, *cfg.place[1:])) if cfg.place else out


#: The steps of the chain, in order. Those of FRAMED look at other rows and run together in blocks.
STEPS: dict[str, Step] = {
    "temporal": lambda df, cfg, c: fx.temporal(df, cfg), "lag": lag_step, "rolling": rolling_step, "trend": trend_step, "interaction": lambda df, cfg, c: fx.interactions(df, c), "air_quality": air_quality_step, "spatial": spatial_step,
}
FRAMED = ("lag", "rolling", "trend", "interaction")


def chain(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), stats: tuple[str, ...] = ROLLED, emas: bool | None = None, steps: dict[str, Step] | None = None, reach: int = 0) -> DataFrame:
    """temporal, lag, rolling, trend, interaction, air quality and spatial features, in that order. Those that look at other
    rows share one pass by entity and time in blocks of rows; exponential averages (emas; None: as cfg says) are folded before it.
    steps: functions that take the place of steps of these names, None leaves a step out; one of FRAMED that looks further back
    than cfg does tells how far by reach."""
    if unknown := {*(steps or {})} - {*STEPS}:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    run = {**STEPS, "rolling": partial(rolling_step, stats=stats), **(steps or {})}
    c = cfg.columns

    def through(out: DataFrame, names: tuple[str, ...], c: Columns) -> DataFrame:
        for n in names:
            out = run[n](out, cfg, c) if run[n] else out
        return out

    far = max(reach, 6, *cfg.windows, *cfg.differences, *(n for ns in windows.default_lags(cfg).values() for n in ns))
    out = through(df, ("temporal",), c)
    if (cfg.emas if emas is None else emas) and run["rolling"]:
        out = windows.ema(out, _there(df, c.measures), cfg.windows, c)
    out = windows.in_blocks(out, lambda x, k: through(x, FRAMED, k), far, cols=c)
    out = through(out, ("air_quality", "spatial"), c)
    return rolled_as_float(out, cfg) if cfg.float32 else out


def rolled_as_float(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Rolling features, exponential averages among them, as 32-bit floats."""
    names = [c for c in df.columns if any(f"_{k}_" in c for k in (*(s for s, _ in windows.ROLLING.values()), "ema"))]
    return df.withColumns({c: F.col(c).cast("float") for c in names})


def fit_bounds(df: DataFrame, columns: tuple[str, ...]) -> dict[str, tuple[float, float]]:
    if not columns:
        return {}
    row = df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"{c}_lo"], row[f"{c}_hi"]) for c in columns if row[f"{c}_lo"] is not None}


def fit_categories(df: DataFrame, column: str, most: int = 50) -> list[str]:
    """Sorted categories; more than `most` is an error."""
    out = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(most + 1).collect()]
    if len(out) > most:
        raise ValueError(f"{column}: over {most} categories")
    return out


def fit_scaler(df: DataFrame, columns: list[str], kind: str = "standard") -> dict[str, tuple[float, float]]:
    """(shift, scale) of each column, from one aggregate; a zero scale becomes 1."""
    makers = {
        "standard": lambda c: (F.avg(c), F.stddev_pop(c)), "minmax": lambda c: (F.min(c), F.max(c) - F.min(c)),
        "robust": lambda c: (F.percentile(c, F.lit(0.5)), F.percentile(c, F.lit(0.75)) - F.percentile(c, F.lit(0.25))),
    }
    row = df.agg(*[x.alias(f"{c}_{i}") for c in columns for i, x in enumerate(makers[kind](c))]).first()
    return {c: (row[f"{c}_0"] or 0.0, row[f"{c}_1"] or 1.0) for c in columns}


def scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - shift) / size for c, (shift, size) in fitted.items() if c in df.columns})


@dataclass
class Preprocessor:
    """Index, imputation, leakage, collinearity, one-hot and scaling, fitted on the training split only."""

    cfg: FeatureConfig = field(default_factory=FeatureConfig)
    impute: str = "median"
    scaling: str = "standard"
    vif_columns: tuple[str, ...] = VIF_COLUMNS
    bounds: dict = field(default_factory=dict)
    fills: dict = field(default_factory=dict)
    dropped: list = field(default_factory=list)
    categories: dict = field(default_factory=dict)
    scaler: dict = field(default_factory=dict)
    features: list = field(default_factory=list)

    def _indexed(self, df: DataFrame) -> DataFrame:
        return df if not self.bounds else df.withColumn("pollution_index", fx.pollution_index(self.bounds))

    def _encoded(self, df: DataFrame) -> DataFrame:
        if self.impute == "forward":  # what an entity's earlier rows tell, before what the training split does
            df = clean.forward_fill(df, [c for c in self.fills if c in df.columns], self.cfg.columns)
        out = clean.drop_leakage(df.na.fill(self.fills)).drop(*self.dropped)
        for c, names in self.categories.items():
            out = fx.one_hot(out, c, names)
        return out.drop(*self.categories)

    def fit(self, train: DataFrame) -> Preprocessor:
        """Fits on the rows of train, which are kept (in memory and on disk) while several passes go over them."""
        self.bounds = fit_bounds(train, tuple(p for p in self.cfg.columns.pollutants if p in train.columns))
        x = self._indexed(train).persist()
        try:
            return self._fitted(x)
        finally:
            x.unpersist()

    def _fitted(self, x: DataFrame) -> Preprocessor:
        numbers = [c for c in clean.feature_columns(x.columns) if dict(x.dtypes)[c] in ("double", "float", "bigint", "int")]
        make = {"median": lambda c: F.percentile(c, F.lit(0.5)), "forward": lambda c: F.percentile(c, F.lit(0.5)), "mean": F.avg, "zero": lambda c: F.lit(0.0)}[self.impute]
        row = x.agg(*[F.coalesce(make(c), F.lit(0.0)).cast("double").alias(c) for c in numbers]).first()
        self.fills = {c: row[c] for c in numbers}
        self.dropped = reports.high_vif(x, vif) if len(vif := [c for c in self.vif_columns if c in x.columns]) > 1 else []
        kept = clean.drop_leakage(x).columns
        self.categories = {c: fit_categories(x, c) for c, t in x.dtypes if t == "string" and c in kept and c not in self.cfg.columns.key and c != "split"}
        encoded = self._encoded(x)
        self.features = [c for c in clean.feature_columns(encoded.columns) if dict(encoded.dtypes)[c] in ("double", "float", "bigint", "int")]
        self.scaler = fit_scaler(encoded, self.features, self.scaling)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return scale(self._encoded(self._indexed(df)), self.scaler)

    def to_dict(self) -> dict:
        """All of the state as plain values, for a manifest."""
        return asdict(self)

    @classmethod
    def from_dict(cls, d: dict) -> Preprocessor:
        tuples = lambda x: tuple(map(tuples, x)) if isinstance(x, (list, tuple)) else x
        cfg = {k: tuples(v) for k, v in d["cfg"].items() if k != "columns"}
        columns = Columns(**{k: tuples(v) for k, v in d["cfg"]["columns"].items()})
        pairs = {k: {c: tuple(v) for c, v in d[k].items()} for k in ("bounds", "scaler")}
        return cls(**(d | pairs | {"cfg": FeatureConfig(**cfg, columns=columns), "vif_columns": tuples(d["vif_columns"])}))


def build(obs: DataFrame, cfg: FeatureConfig = FeatureConfig(), context: bool = True, stats: tuple[str, ...] = ROLLED) -> tuple[DataFrame, Preprocessor]:
    """Canonical rows, targets on the whole timeline, chronological split, features, warm-up drop, state fitted on train.

    context=True lets validation and test rows look back over the border of their split (only past rows are used);
    context=False builds each split alone, so that each loses its warm-up. The features before preprocessing are kept (in
    memory and on disk), as the fit's passes and the result read them; a session's clearCache() lets them go."""
    c = cfg.columns
    rows = windows.chronological_split(joins.targets(clean.canonicalise(obs, c), cfg.horizons, c), cols=c)
    parts = [rows] if context else [rows.where(F.col("split") == s) for s in ("train", "validation", "test")]
    made = reduce(DataFrame.unionByName, [chain(p, cfg, stats) for p in parts])
    longest = [f"{c.target}_lag_{max(cfg.target_lags)}"]
    made = made.na.drop(subset=longest).persist()
    state = Preprocessor(cfg).fit(made.where(F.col("split") == "train"))
    return state.transform(made), state


def for_horizon(df: DataFrame, horizon: int, features: list[str]) -> DataFrame:
    """Rows with this target, the common features in order, zero-filled."""
    return clean.usable(df, horizon).select("city", "timestamp", "split", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features], F.col(f"target_aqi_t_{horizon}").alias("label"))


def hourly_features(context: DataFrame, live: DataFrame, target: dict[str, str] | None = None, cfg: FeatureConfig = FeatureConfig(), stats: tuple[str, ...] = ROLLED) -> DataFrame:
    """Features of the live keys: the entities' latest rows and the live rows through the chain; no pollution index, as
    its bounds belong to training."""
    from hourloom.operators.sets import stack
    from hourloom.sources.sinks import align

    c = cfg.columns
    both = clean.dedupe(stack(windows.latest_rows(context, 168, c).withColumn("_live", F.lit(0)), live.withColumn("_live", F.lit(1))), c.key, "_live")
    made = chain(both, cfg, stats).where("_live = 1").drop("_live", "pollution_index")
    return align(made, target) if target else made
