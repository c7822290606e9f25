"""Window features per entity. Frames count rows, hold the current row and need one non-null value, unless said."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable
from functools import wraps
from inspect import signature

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.config import Columns, FeatureConfig
from hourloom.operators.blocks import SPAN_HOURS, Spans, exclusive_folds, in_blocks, in_hours, spare, with_previous

#: Hours of the spans whose rows an exponential average folds in one go.
EMA_HOURS = 256


def bounded(reach: Callable[..., tuple[int, int]]):
    """Makes an operator of bounded row frames block itself: called on whole entities it runs in blocks with halos of the rows
    that reach(its arguments) tells (before, after); called inside blocks (cols.parts is set) it runs as it is."""

    def wrap(f):
        kinds = signature(f)

        @wraps(f)
        def run(df: DataFrame, *args, **kwargs) -> DataFrame:
            given = kinds.bind(df, *args, **kwargs)
            given.apply_defaults()
            given = given.arguments
            cols = given["cols"]
            if cols.parts:
                return f(**given)
            before, after = reach(**given)
            make = lambda x, c: f(**(given | {"df": x, "cols": c}))
            return in_hours(df, make, before, cols) if given.get("mode") == "time" else in_blocks(df, make, before, after, cols)

        return run

    return wrap


@bounded(lambda wanted, **_: (max((n for ns in wanted.values() for n in ns), default=0), 0))
def lags(df: DataFrame, wanted: dict[str, tuple[int, ...]], cols: Columns = Columns()) -> DataFrame:
    w = cols.window()
    return df.withColumns({f"{c}_lag_{n}": F.lag(c, n).over(w) for c, ns in wanted.items() for n in ns})


def default_lags(cfg: FeatureConfig) -> dict[str, tuple[int, ...]]:
    c = cfg.columns
    return {c.target: cfg.target_lags} | {p: cfg.pollutant_lags for p in c.pollutants} | {x: cfg.weather_lags for x in ("temperature", "humidity", "pressure", "wind_speed") if x in c.weather}


@bounded(lambda ns, **_: (0, max(ns, default=0)))
def leads(df: DataFrame, column: str, ns: tuple[int, ...], cols: Columns = Columns()) -> DataFrame:
    w = cols.window()
    return df.withColumns({f"{column}_lead_{n}": F.lead(column, n).over(w) for n in ns})


#: name of a rolling statistic -> (suffix, aggregate).
ROLLING = {
    "mean": ("rollmean", F.avg),
    "std": ("rollstd", F.stddev_samp),
    "min": ("rollmin", F.min),
    "max": ("rollmax", F.max),
    "median": ("rollmedian", lambda c: F.percentile(c, F.lit(0.5))),
    "q25": ("rollq25", lambda c: F.percentile(c, F.lit(0.25))),
    "q75": ("rollq75", lambda c: F.percentile(c, F.lit(0.75))),
    "range": ("rollrange", lambda c: (F.max(c), F.min(c))),
}
#: Rolling statistics of a sorted frame, and their quantiles. Frames of at least SORTED_FROM rows are kept sorted from row to
#: row; shorter ones cost less to sort anew.
ORDERED, SORTED_FROM = {"median": 0.5, "q25": 0.25, "q75": 0.75}, 24


@bounded(lambda windows, mode, **_: (max(windows, default=1) - 1, 0))
def rolling(df: DataFrame, columns: list[str], windows: tuple[int, ...], stats: tuple[str, ...] = ("mean", "std", "min", "max", "median", "range"), cols: Columns = Columns(), mode: str = "rows", full: bool = False) -> DataFrame:
    """{column}_{stat}_{w}h for every column, window and statistic, in one sort. mode time (in blocks of hours): the last w hours
    instead of w rows. full: null unless the frame holds w values."""
    out, new, kept = df, {}, []
    if mode == "time":
        out = out.withColumn("_s", F.unix_timestamp(F.col(cols.time).cast("timestamp")))
    for w in windows:
        frame = Window.partitionBy(cols.entity, *cols.parts).orderBy("_s").rangeBetween(-(w - 1) * 3600, 0) if mode == "time" else cols.window().rowsBetween(1 - w, 0)
        for c in columns:
            sort = [s for s in stats if s in ORDERED and mode == "rows" and w >= SORTED_FROM]
            kept += [(c, w, sort)] if sort else []
            for s in stats:
                if s in sort:
                    continue
                suffix, agg = ROLLING[s]
                made = agg(c)
                value = made[0].over(frame) - made[1].over(frame) if isinstance(made, tuple) else made.over(frame)
                new[f"{c}_{suffix}_{w}h"] = F.when(F.count(c).over(frame) == w, value) if full else value
    out = (_sorted_frames(out, kept, cols, full) if kept else out).withColumns(new).drop("_s")
    return out.select(*df.columns, *[f"{c}_{ROLLING[s][0]}_{w}h" for w in windows for c in columns for s in stats])


def _sorted_frames(df: DataFrame, wanted: list[tuple[str, int, list[str]]], cols: Columns, full: bool) -> DataFrame:
    """Quantiles of frames that stay sorted: the value that enters a frame is put in its place, the one that leaves is taken out,
    both found by bisection, so that a row costs the same for any length of frame. Spark's aggregates over frames sort each
    frame anew, and a fold over arrays in SQL was measured at five times that; so rows go through Python here, in order, a
    block after another, with nothing held but the frames. NaN counts as missing."""
    names = [f"{c}_{ROLLING[s][0]}_{w}h" for c, w, stats in wanted for s in stats]
    group = [cols.entity, *cols.parts]
    ordered = df.repartition(*group).sortWithinPartitions(*group, cols.time)
    columns = list(dict.fromkeys(c for c, _, _ in wanted))

    def run(batches):
        now, frames = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(batch.schema.get_field_index(g)).to_pylist() for g in group), strict=True))
            values = {c: batch.column(batch.schema.get_field_index(c)).cast(pa.float64()).to_pylist() for c in columns}
            out: list[list] = [[] for _ in names]
            for i, key in enumerate(keys):
                if key != now or not frames:
                    now, frames = key, [(c, deque(), [], w, [ORDERED[s] for s in stats]) for c, w, stats in wanted]
                at = 0
                for c, order, held, w, quantiles in frames:
                    v = values[c][i]
                    v = v if v == v else None
                    order.append(v)
                    if v is not None:
                        insort(held, v)
                    if len(order) > w and (gone := order.popleft()) is not None:
                        del held[bisect_left(held, gone)]
                    n = len(held)
                    for q in quantiles:
                        if n == 0 or full and n < w:
                            out[at].append(None)
                        else:
                            p = (n - 1) * q
                            low = int(p)
                            out[at].append(held[low] if p == low else held[low] + (held[low + 1] - held[low]) * (p - low))
                        at += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(v, pa.float64()) for v in out]], names=[*batch.schema.names, *names])

    return ordered.mapInArrow(run, ", ".join([f"`{n}` {t}" for n, t in df.dtypes] + [f"`{n}` double" for n in names]))


def _step(c: str, n: int, cols: Columns) -> Column:
    return F.lag(c, n).over(cols.window())


@bounded(lambda ns, **_: (max(ns, default=0), 0))
def differences(df: DataFrame, columns: list[str], ns: tuple[int, ...], cols: Columns = Columns()) -> DataFrame:
    return df.withColumns({f"{c}_diff_{n}": F.col(c) - _step(c, n, cols) for c in columns for n in ns})


@bounded(lambda ns, **_: (max(ns, default=0), 0))
def percent_changes(df: DataFrame, columns: list[str], ns: tuple[int, ...], cols: Columns = Columns()) -> DataFrame:
    """Null where it would be infinite."""
    return df.withColumns({f"{c}_pctchange_{n}": F.try_divide(F.col(c), _step(c, n, cols)) - 1 for c in columns for n in ns})


@bounded(lambda ns, **_: (max(ns, default=0), 0))
def rates(df: DataFrame, columns: list[str], ns: tuple[int, ...], cols: Columns = Columns()) -> DataFrame:
    return df.withColumns({f"{c}_roc_{n}": (F.col(c) - _step(c, n, cols)) / n for c in columns for n in ns})


@bounded(lambda n, **_: (2 * n, 0))
def momentum(df: DataFrame, columns: list[str], n: int = 3, cols: Columns = Columns()) -> DataFrame:
    """The n-difference of the n-difference."""
    return df.withColumns({f"{c}_momentum_{n}": F.col(c) - 2 * _step(c, n, cols) + _step(c, 2 * n, cols) for c in columns})


@bounded(lambda **_: (2, 0))
def light_trend(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Change of the target since the last row (0 where unknown), and its mean over three rows."""
    t = cols.target
    return df.withColumns({f"{t}_change_rate": F.coalesce(F.col(t) - _step(t, 1, cols), F.lit(0.0)), f"{t}_rolling_mean_3h": F.avg(t).over(cols.window().rowsBetween(-2, 0))})


class _Averages:
    """Exponential averages of several columns and spans as summaries of runs of rows that can be put together.

    A summary holds the number of rows n and, for each column, the first value x, the nulls before it (lead) and after the last
    value (tail); for each column and span, the map s * x + t that gives the average at the last value. At a non-null row, with
    q = (1 - alpha) ** (rows since the last one), the average becomes (q * average + alpha * x) / (q + alpha). Everything is an
    array, so that the expressions do not grow with the number of columns."""

    def __init__(self, columns: int, spans: tuple[int, ...]):
        self.columns, pairs = columns, [(m, 2.0 / (w + 1)) for m in range(columns) for w in spans]
        self.pairs = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(a).alias("a")) for m, a in pairs])
        self.ones, self.zeros = F.array(*[F.lit(1.0)] * len(pairs)), F.array(*[F.lit(0.0)] * len(pairs))
        self.none = F.array(*[F.lit(0).cast("long")] * columns)

    def _made(self, n, x, lead, tail, s, t) -> Column:
        return F.struct(n.alias("n"), x.alias("x"), lead.alias("lead"), tail.alias("tail"), s.alias("s"), t.alias("t"))

    def nothing(self) -> Column:
        return self._made(F.lit(0).cast("long"), F.array(*[F.lit(None).cast("double")] * self.columns), self.none, self.none, self.ones, self.zeros)

    def row(self, values: Column) -> Column:
        return self._made(F.lit(1).cast("long"), values, self.none, self.none, self.ones, self.zeros)

    def merge(self, a: Column, b: Column) -> Column:
        first = lambda p, k: F.get(a[k], p["m"])
        other = lambda p, k: F.get(b[k], p["m"])
        q = lambda p: F.pow(1 - p["a"], first(p, "tail") + other(p, "lead") + 1)
        pick = lambda p, i, k, both: F.when(first(p, "x").isNull(), F.get(b[k], i)).when(other(p, "x").isNull(), F.get(a[k], i)).otherwise(both)
        s = F.transform(self.pairs, lambda p, i: pick(p, i, "s", F.get(b["s"], i) * F.get(a["s"], i) * q(p) / (q(p) + p["a"])))
        t = F.transform(self.pairs, lambda p, i: pick(p, i, "t", F.get(b["s"], i) * (q(p) * F.get(a["t"], i) + p["a"] * other(p, "x")) / (q(p) + p["a"]) + F.get(b["t"], i)))
        lead = F.transform(a["x"], lambda v, m: F.when(v.isNull(), a["n"] + F.get(b["lead"], m)).otherwise(F.get(a["lead"], m)))
        tail = F.transform(b["x"], lambda v, m: F.when(v.isNull(), F.get(a["tail"], m) + b["n"]).otherwise(F.get(b["tail"], m)))
        return self._made(a["n"] + b["n"], F.zip_with(a["x"], b["x"], lambda v, w: F.coalesce(v, w)), lead, tail, s, t)

    def values(self, a: Column) -> Column:
        """The averages, one after another; null where a column has had no value."""
        return F.transform(self.pairs, lambda p, i: F.get(a["s"], i) * F.get(a["x"], p["m"]) + F.get(a["t"], i))


def ema(df: DataFrame, columns: str | list[str], spans: tuple[int, ...], cols: Columns = Columns(), hours: int = EMA_HOURS) -> DataFrame:
    """{column}_ema_{span}h: recursive average with weight 2 / (span + 1), older weights decaying over nulls as over rows;
    nulls before the first value stay null.

    The rows of a span of `hours` are an array, folded to the span's summary (see _Averages). Summaries of an entity are
    folded in turn, which gives each span what came before it, and a second fold of the array gives the rows' averages. All of
    it is SQL; rows are shuffled once, by entity and span."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    s, work = Spans(df, cols, hours), _Averages(len(columns), spans)
    place, key, span = spare(s.rows, "_place")[0], s.key, s.span
    rows = s.rows.withColumn(place, F.row_number().over(s.window()))
    item = F.struct(place, F.struct(*df.columns).alias("row"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    packed = rows.groupBy(key, span).agg(F.array_sort(F.collect_list(item), lambda a, b: a[place] - b[place]).alias("_rows"))
    parts = packed.select(key, span, F.aggregate("_rows", work.nothing(), lambda acc, r: work.merge(acc, work.row(r["x"]))).alias("_e"))
    met = packed.join(exclusive_folds(parts, key, span, ["_e"], work.nothing(), work.merge), [key, span])

    def step(acc: Column, r: Column) -> Column:
        now = work.merge(acc["now"], work.row(r["x"]))
        return F.aggregate(F.array(now), acc, lambda old, n: F.struct(n.alias("now"), F.array_append(old["out"], work.values(n)).alias("out")))

    start = F.struct(F.col("_e").alias("now"), F.array().cast("array<array<double>>").alias("out"))
    zipped = F.arrays_zip(F.transform("_rows", lambda r: r["row"]).alias("row"), F.aggregate("_rows", start, step, lambda acc: acc["out"]).alias("out"))
    names = [f"{c}_ema_{n}h" for c in columns for n in spans]
    return met.select(F.inline(zipped)).select("row.*", *[F.col("out")[i].alias(n) for i, n in enumerate(names)])


def latest_rows(df: DataFrame, n: int = 168, cols: Columns = Columns()) -> DataFrame:
    w = Window.partitionBy(cols.entity).orderBy(F.desc(cols.time))
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def _hours(a: Column, b: Column) -> Column:
    return ((F.unix_timestamp(a.cast("timestamp")) - F.unix_timestamp(b.cast("timestamp"))) / 3600).cast("long")


def gaps(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """gap_start, gap_end and missing_hours of every hole in an hourly series; the row before comes by carry across spans."""
    s = with_previous(df.select(*cols.key), "_before", cols)
    t, hour = F.col(cols.time), F.expr("interval 1 hour")
    step = _hours(t, F.col("_before"))
    return s.rows.where(step > 1).select(cols.entity, (F.col("_before") + hour).alias("gap_start"), (t - hour).alias("gap_end"), (step - 1).alias("missing_hours"))


def gap_analysis(df: DataFrame, cols: Columns = Columns(), overall: str | None = None) -> DataFrame:
    """Per entity: usual interval (the smallest of equals), largest gap, gaps over one and a half usual intervals, repeated
    times. overall: a further row of that name for the times of all entities in one series, over whose gaps alone the largest
    is taken; the number of its repeats counts keys. Steps are counted by size, so no row is looked at twice."""
    s = with_previous(df.select(*cols.key), "_before", cols)
    steps = s.rows.select(cols.entity, _hours(F.col(cols.time), F.col("_before")).alias("_d")).groupBy(cols.entity, "_d").agg(F.count("*").alias("_n"))
    out = _step_report(steps, cols.entity, F.max("_d"))
    if overall is None:
        return out
    times = df.groupBy(cols.time).agg(F.count("*").alias("_m")).withColumn(cols.entity, F.lit(overall))
    t = with_previous(times, "_before", cols)
    one = t.rows.select(cols.entity, F.explode(F.array(F.struct(_hours(F.col(cols.time), F.col("_before")).alias("_d"), F.lit(1).cast("long").alias("_n")), F.struct(F.lit(0).cast("long").alias("_d"), (F.col("_m") - 1).alias("_n")))).alias("r"))
    one = one.select(cols.entity, "r.*").where("_n > 0").groupBy(cols.entity, "_d").agg(F.sum("_n").alias("_n"))
    repeated = df.groupBy(*cols.key).agg((F.count("*") - 1).alias("_k")).agg(F.coalesce(F.sum("_k"), F.lit(0)).alias("repeated"))
    wide = _step_report(one, cols.entity, F.coalesce(F.max(F.when(F.col("_d") > 1.5 * F.col("modal_hours"), F.col("_d"))), F.lit(0)))
    return out.unionByName(wide.drop("repeated").crossJoin(repeated).select(*out.columns))  # one row each


def _step_report(steps: DataFrame, entity: str, largest: Column) -> DataFrame:
    usual = steps.where("_d is not null").groupBy(entity).agg(F.max_by("_d", F.struct("_n", -F.col("_d"))).alias("modal_hours"))
    many = lambda when: F.coalesce(F.sum(F.when(when, F.col("_n"))), F.lit(0))
    return steps.join(usual, entity).groupBy(entity, "modal_hours").agg(largest.alias("max_gap_hours"), many(F.col("_d") > 1.5 * F.col("modal_hours")).alias("large_gaps"), many(F.col("_d") == 0).alias("repeated"))


def longest_run(df: DataFrame, hours: float | None = 1.0, cols: Columns = Columns()) -> DataFrame:
    """Per entity the most rows in a run without a step over one and a half intervals (hours; None: the entity's own usual
    interval). A run is named by the time at which it began, the last break, which is carried across spans."""
    s = with_previous(df.select(*cols.key), "_before", cols)
    s.add("_d", _hours(F.col(cols.time), F.col("_before")))
    if hours is None:
        usual = s.rows.where("_d is not null").groupBy(F.col(s.key).alias("_k"), "_d").count().groupBy("_k").agg(F.max_by("_d", F.struct("count", -F.col("_d"))).alias("_usual"))
        s.rows = s.rows.join(usual, F.col(s.key) == F.col("_k"), "left").drop("_k")
    limit = F.lit(hours) if hours is not None else F.coalesce("_usual", F.lit(0))
    s.add("_start", F.when(F.col("_d") > 1.5 * limit, F.col(cols.time)))
    earlier = s.carry(start=(F.max("_start"), "nearest"))["start"]
    s.add("_run", F.coalesce(F.max("_start").over(s.window()), earlier))
    return s.rows.groupBy(cols.entity, "_run").count().groupBy(cols.entity).agg(F.max("count").alias("longest_run"))


def _trend_label(d: Column) -> Column:
    """Wording of a change."""
    text = d.cast("string")
    return (
        F.when(d.isNull(), "Insufficient AQI history").when(d > 0, F.concat(F.lit("▲ +"), text, F.lit(" since last reading")))
        .when(d < 0, F.concat(F.lit("▼ "), text, F.lit(" since last reading"))).otherwise("No change since last reading")
    )


def trend(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Per entity the change between its last two valid readings, its direction and a label; without two of them the
    change is null and the direction unknown."""
    w = Window.partitionBy(cols.entity).orderBy(F.col(cols.target).isNull(), F.desc(cols.time))
    r = df.withColumn("_n", F.row_number().over(w)).where("_n <= 2")
    v = r.groupBy(cols.entity).agg(F.max(F.when(F.col("_n") == 1, F.col(cols.target))).alias("now"), F.max(F.when(F.col("_n") == 2, F.col(cols.target))).alias("before"))
    d = F.round(F.col("now") - F.col("before"), 2)
    way = F.when(d.isNull(), "unknown").when(d > 0, "up").when(d < 0, "down").otherwise("flat")
    return v.select(cols.entity, d.alias("value"), way.alias("direction"), _trend_label(d).alias("label"))


def recent(df: DataFrame, hours: int, cols: Columns = Columns()) -> DataFrame:
    """Rows of the last hours before the entity's latest, the start included. The latest times are a row per entity, joined
    back."""
    e, last = spare(df, "_e", "_last")
    latest = df.groupBy(F.col(cols.entity).alias(e)).agg(F.max(cols.time).alias(last))
    return df.join(latest, F.col(cols.entity).eqNullSafe(F.col(e))).where(F.col(cols.time) >= F.col(last) - F.expr(f"interval {hours} hours")).drop(e, last)


def numbered(df: DataFrame, name: str, total: str, cols: Columns = Columns(), hours: int = SPAN_HOURS) -> DataFrame:
    """Each row's number within its entity (from 1) and the entity's number of rows, by counts of spans."""
    s = Spans(df, cols, hours)
    earlier, later = s.carry(n=(F.count("*"), "sum"))["n"], s.carry(later=True, n=(F.count("*"), "sum"))["n"]
    place = F.row_number().over(s.window())
    own = F.count("*").over(Window.partitionBy(s.key, s.span))
    s.rows = s.rows.withColumns({name: earlier + place, total: earlier + own + later})
    return s.done()


def row_splits(df: DataFrame, parts: int, cols: Columns = Columns()) -> DataFrame:
    """chunk: equal runs of rows in time, the last takes the rest."""
    n, m = spare(df, "_n", "_m")
    size = F.greatest(F.floor(F.col(m) / parts), F.lit(1))
    return numbered(df, n, m, cols).withColumn("chunk", F.least(F.floor((F.col(n) - 1) / size), F.lit(parts - 1))).drop(n, m)


def chronological_split(df: DataFrame, train: float = 0.70, validation: float = 0.15, cols: Columns = Columns()) -> DataFrame:
    """split (train, validation, test) by distinct hours, so that an hour of all entities falls in one part.

    Both borders come from one pass: distinct hours by day, and running counts of the days, whose number is the time range."""
    days = df.where(F.col(cols.time).isNotNull()).groupBy(F.to_date(cols.time).alias("_day")).agg(F.sort_array(F.collect_set(cols.time)).alias("_t"))
    upto, n = F.sum(F.size("_t")).over(Window.orderBy("_day")), F.sum(F.size("_t")).over(Window.partitionBy())
    days = days.select("_t", upto.alias("_upto"), n.alias("_n"), *[F.floor(n * share).alias(k) for k, share in (("_a", F.lit(train)), ("_b", F.lit(train + validation)))])
    at = lambda k: F.max(F.get("_t", (F.col(k) - 1 - (F.col("_upto") - F.size("_t"))).cast("int")))
    n, a, b, first, second = days.agg(F.max("_n"), F.max("_a"), F.max("_b"), at("_a"), at("_b")).first()
    if not n or not 0 < a < b < n:
        raise ValueError(f"too few hours to split: {n or 0}")
    t = F.col(cols.time)
    return df.withColumn("split", F.when(t <= F.lit(first), "train").when(t <= F.lit(second), "validation").otherwise("test"))


def hourly_interpolated(df: DataFrame, column: str, cols: Columns = Columns()) -> DataFrame:
    """Hourly means on a full grid of hours, holes filled by the line between their neighbours. Each hour with a value fills
    the hole before it: its neighbour comes by carry, so the grid is never ordered."""
    e, t = cols.entity, cols.time
    hourly = df.groupBy(e, F.date_trunc("hour", t).cast("timestamp").alias(t)).agg(F.avg(column).alias("_v")).where(F.col("_v").isNotNull() & F.col(t).isNotNull())
    s = Spans(hourly, cols, SPAN_HOURS)
    now = F.struct(F.col(t).alias("t"), F.col("_v").alias("v"))
    before = F.coalesce(F.lag(now).over(s.window()), s.carry(now=(F.max_by(now, t), "nearest"))["now"])
    s.add("_b", before)
    hours = F.sequence(F.coalesce(F.col("_b.t") + F.expr("interval 1 hour"), F.col(t)), F.col(t), F.expr("interval 1 hour"))
    full = s.rows.select(e, t, "_v", "_b", F.explode(hours).alias("_h"))
    whole, part = F.unix_timestamp(t) - F.unix_timestamp("_b.t"), F.unix_timestamp("_h") - F.unix_timestamp("_b.t")
    line = F.col("_b.v") + (F.col("_v") - F.col("_b.v")) * part / F.nullif(whole, F.lit(0))
    return full.select(e, F.col("_h").cast("timestamp_ntz").alias(t), F.when(F.col("_h") == F.col(t), F.col("_v")).otherwise(line).alias(column))
