"""One entity's rows as many tasks' work.

`in_blocks` runs windows of bounded row frames in blocks of rows, with copies of the rows around them. `Spans` carries what an
unbounded frame needs (last value, last time, running count) across spans of time: each span gives one summary, an exclusive
scan of an entity's summaries (a row per span, not per row) gives what came before, and rows look only inside their span.
`exclusive_folds` is such a scan for summaries that no window function can put together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hourloom.config import Columns

#: Rows of a block of bounded frames, and hours of the spans in which an entity's rows are numbered or carried across.
BLOCK_ROWS, SPAN_HOURS = 8192, 8192
#: Summaries of an entity that are folded in one row; more of them are folded in two steps.
FAN_IN = 256


def spare(df: DataFrame, *names: str) -> list[str]:
    """Column names like the wanted ones that df does not have."""
    out = []
    for n in names:
        while n in df.columns:
            n += "_"
        out.append(n)
    return out


def _placed(df: DataFrame, key: str, span: str, cols: Columns, hours: int) -> DataFrame:
    """df with its entity as a text that is never null, and its span of time (the first, for rows without a time; of `hours`
    units, where the order is a whole number): keys that plain equality can join, so that a partitioning by them serves again."""
    e, t = F.col(cols.entity), F.col(cols.time)
    s = F.floor(t / hours) if dict(df.dtypes)[cols.time] in ("int", "bigint") else F.floor(F.unix_timestamp(t.cast("timestamp")) / (3600 * hours))
    return df.withColumns({key: F.when(e.isNull(), "n").otherwise(F.concat(F.lit("v"), e.cast("string"))), span: F.coalesce(s, F.lit(-(2**62)))})


def in_blocks(df: DataFrame, make: Callable[[DataFrame, Columns], DataFrame], before: int = 0, after: int = 0, cols: Columns = Columns(), rows: int = BLOCK_ROWS, hours: int = SPAN_HOURS) -> DataFrame:
    """make(df, cols) for windows of bounded row frames, in blocks of `rows` rows. Each block also holds copies of the `before`
    and `after` rows around it, which frames reach; they are dropped again. Rows are numbered within spans of time and by the
    spans' counts, so no task orders a whole entity."""
    key, span, m, base, n, block, own = spare(df, "_key", "_span", "_m", "_base", "_n", "_block", "_own")
    placed = _placed(df, key, span, cols, hours)
    counts = placed.groupBy(key, span).agg(F.count("*").alias(m))
    counts = counts.select(key, span, (F.sum(m).over(Window.partitionBy(key).orderBy(span)) - F.col(m)).alias(base))
    numbered = placed.withColumn(n, F.row_number().over(Window.partitionBy(key, span).orderBy(cols.time))).join(counts, [key, span])
    numbered = numbered.withColumn(n, F.col(n) + F.col(base) - 1).select(*df.columns, n)
    at = lambda x: F.floor(x / rows)
    copies = numbered.withColumn(block, F.explode(F.sequence(at(F.greatest(F.col(n) - after, F.lit(0))), at(F.col(n) + before))))
    copies = copies.withColumn(own, F.col(block) == at(F.col(n))).drop(n)
    return make(copies, replace(cols, parts=(block,))).where(own).drop(own, block)


def in_hours(df: DataFrame, make: Callable[[DataFrame, Columns], DataFrame], before: float = 0, cols: Columns = Columns(), hours: int = SPAN_HOURS) -> DataFrame:
    """make(df, cols) for windows of time frames, in blocks of `hours`, with copies of the rows of the `before` hours in front
    of each. Blocks follow from a row's time, so nothing is counted first; rows without a time are a block of their own."""
    block, own = spare(df, "_block", "_own")
    t = F.unix_timestamp(F.col(cols.time).cast("timestamp"))
    at = lambda x: F.coalesce(F.floor(x / (3600 * hours)), F.lit(-(2**62)))
    copies = df.withColumn(block, F.explode(F.sequence(at(t), at(t + int(3600 * before)))))
    copies = copies.withColumn(own, F.col(block) == at(t))
    return make(copies, replace(cols, parts=(block,))).where(own).drop(own, block)


class Spans:
    """Rows of df by entity and span of time. `carry` adds what earlier (or later) spans tell, `window` orders a span's rows,
    `rows` is the table so far and `done` takes the helping columns off."""

    def __init__(self, df: DataFrame, cols: Columns = Columns(), hours: int = SPAN_HOURS):
        self.cols, self.hours = cols, hours
        self.key, self.span = spare(df, "_key", "_span")
        self._own = [self.key, self.span]
        self.rows = _placed(df, self.key, self.span, cols, hours)

    def window(self) -> WindowSpec:
        return Window.partitionBy(self.key, self.span).orderBy(self.cols.time)

    def carry(self, later: bool = False, **wanted: tuple[Column, str]) -> dict[str, Column]:
        """For each name an aggregate over a span, and how it is put together over the earlier (or later) ones: `nearest`
        known value, or `sum`."""
        names = dict(zip(wanted, spare(self.rows, *[f"_carried_{n}" for n in wanted]), strict=True))
        per = self.rows.groupBy(self.key, self.span).agg(*[a.alias(names[n]) for n, (a, _) in wanted.items()])
        w = Window.partitionBy(self.key).orderBy(self.span)
        w = w.rowsBetween(1, Window.unboundedFollowing) if later else w.rowsBetween(Window.unboundedPreceding, -1)
        nearest = F.first if later else F.last
        over = {n: nearest(names[n], ignorenulls=True).over(w) if how == "nearest" else F.coalesce(F.sum(names[n]).over(w), F.lit(0)) for n, (_, how) in wanted.items()}
        per = per.select(self.key, self.span, *[c.alias(names[n]) for n, c in over.items()])
        self.rows = self.rows.join(per, [self.key, self.span])
        self._own += names.values()
        return {n: F.col(c) for n, c in names.items()}

    def add(self, name: str, value: Column, own: bool = False) -> None:
        """A further column; own ones go with `done`."""
        self.rows = self.rows.withColumn(name, value)
        if own:
            self._own.append(name)

    def done(self) -> DataFrame:
        return self.rows.drop(*self._own)


def last_value(column: str, cols: Columns) -> Column:
    """The value of the latest row of a group that has one."""
    return F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(cols.time)))


def first_value(column: str, cols: Columns) -> Column:
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(cols.time)))


def with_previous(df: DataFrame, name: str, cols: Columns = Columns(), hours: int = SPAN_HOURS) -> Spans:
    """Spans of df with the time of the entity's row before, as `name`."""
    s = Spans(df, cols, hours)
    earlier = s.carry(time=(F.max(cols.time), "nearest"))["time"]
    s.add(name, F.coalesce(F.lag(cols.time).over(s.window()), earlier))
    return s


def exclusive_folds(parts: DataFrame, key: str, at: str, names: list[str], nothing: Column, merge: Callable[[Column, Column], Column]) -> DataFrame:
    """key, at and, under each name, the merged summaries of all the key's earlier parts (`nothing` for the first). A key's
    parts are folded by groups of FAN_IN neighbours (`at` is a whole number), and the groups likewise in one row."""

    empty = F.slice(F.array(nothing), 1, 0)

    def prefixes(items: Column, name: str, start: Column) -> Column:
        step = lambda acc, x: F.struct(merge(acc["now"], x[name]).alias("now"), F.array_append(acc["out"], acc["now"]).alias("out"))
        return F.aggregate(items, F.struct(start.alias("now"), empty.alias("out")), step, lambda acc: acc["out"])

    def whole(name: str) -> Column:
        return F.aggregate("_items", nothing, lambda acc, x: merge(acc, x[name])).alias(name)

    items = F.array_sort(F.collect_list(F.struct(at, *names)))
    groups = parts.groupBy(key, F.floor(F.col(at) / FAN_IN).alias("_group")).agg(items.alias("_items"))
    whole = groups.select(key, "_group", *[whole(n) for n in names])
    top = whole.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_group", *names))).alias("_items"))
    starts = top.select(key, F.inline(F.arrays_zip(F.col("_items")["_group"].alias("_group"), *[prefixes(F.col("_items"), n, nothing).alias(n) for n in names])))
    met = groups.join(starts, [key, "_group"])
    return met.select(key, F.inline(F.arrays_zip(F.col("_items")[at].alias(at), *[prefixes(F.col("_items"), n, F.col(n)).alias(n) for n in names])))
