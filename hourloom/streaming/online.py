"""Features of a stream of hourly rows from keyed state: what a new row costs does not depend on how long the history is.

State per entity: the latest values (as many as the longest lag or window reaches), the exponential averages so far, and the
hour of the last row. An entity that is silent for `idle` is forgotten by a timer on event time."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hourloom.config import Columns, FeatureConfig

STATE = "values array<double>, averages array<double>, gap bigint, last bigint"


class Online(StatefulProcessor):
    """Rows (_s: hour as epoch seconds, _o: order, _v: value) of one entity to their lags, rolling means and exponential
    averages. Of equal hours the first by order counts; hours that are not after the last one seen are late and give nothing."""

    def __init__(self, lags: tuple[int, ...], windows: tuple[int, ...], spans: tuple[int, ...], idle_ms: int, names: tuple[str, ...] = ("city", "_s", "ingest_seq", "aqi", "_l", "_m", "_a")):
        self.lags, self.windows, self.idle_ms, self.names = lags, windows, idle_ms, names
        self.alphas = [2.0 / (s + 1) for s in spans]
        self.reach = max([*(n + 1 for n in lags), *windows, 1])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("history", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        hours: dict[int, tuple] = {}
        for r in rows:
            if r._s not in hours or r._o < hours[r._s][0]:
                hours[r._s] = (r._o, r._v)
        values, averages, gap, last = self.state.get() if self.state.exists() else ([], [None] * len(self.alphas), 0, None)
        values, averages, before = list(values), list(averages), last
        for s in sorted(hours):
            if last is not None and s <= last:
                continue
            order, v = hours[s]
            values = [*values, v][-self.reach :]
            averages, gap = self._averaged(averages, gap, v), gap + 1 if v is None else 0
            last = s
            known = lambda w: [x for x in values[-w:] if x is not None]
            means = [sum(x) / len(x) if (x := known(w)) else None for w in self.windows]
            made = (key[0], s, order, v, [values[-1 - n] if n < len(values) else None for n in self.lags], means, list(averages))
            yield Row(**dict(zip(self.names, made, strict=True)))
        if last != before:
            self.state.update((values, averages, gap, last))
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(last * 1000 + self.idle_ms)

    def _averaged(self, averages: list, gap: int, v: float | None) -> list:
        if v is None:
            return averages
        if averages and averages[0] is None:
            return [v] * len(averages)
        out = []
        for y, alpha in zip(averages, self.alphas, strict=True):
            q = (1 - alpha) ** (gap + 1)
            out.append((q * y + alpha * v) / (q + alpha))
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def online_features(keys: DataFrame, cfg: FeatureConfig = FeatureConfig(), idle: int = 24 * 365, late: str = "2 hours") -> DataFrame:
    """A stream of (entity, time, event_time, order, target) rows with the target's lags, rolling means and exponential averages
    over all rows before, named as the batch operators name them. idle: hours of silence after which an entity is forgotten.
    The state needs the RocksDB provider (see jobs.ROCKSDB)."""
    c: Columns = cfg.columns
    kind = dict(keys.dtypes)[c.entity]
    rows = keys.select(c.entity, "event_time", F.unix_timestamp(F.col(c.time).cast("timestamp")).alias("_s"), F.col(c.order).cast("long").alias("_o"), F.col(c.target).cast("double").alias("_v"))
    schema = f"`{c.entity}` {kind}, _s bigint, `{c.order}` bigint, `{c.target}` double, _l array<double>, _m array<double>, _a array<double>"
    made = rows.withWatermark("event_time", late).groupBy(c.entity).transformWithState(Online(cfg.target_lags, cfg.windows, cfg.windows, idle * 3_600_000, (c.entity, "_s", c.order, c.target, "_l", "_m", "_a")), schema, "Append", "EventTime")
    names = [("_l", f"{c.target}_lag_{{}}", cfg.target_lags), ("_m", f"{c.target}_rollmean_{{}}h", cfg.windows), ("_a", f"{c.target}_ema_{{}}h", cfg.windows)]
    return made.select(c.entity, F.timestamp_seconds("_s").cast("timestamp_ntz").alias(c.time), c.order, c.target, *[F.col(a)[i].alias(n.format(k)) for a, n, ks in names for i, k in enumerate(ks)])
