"""Autocorrelation, partial autocorrelation and stationarity tests of every entity's series.

Each test rests on sums of lagged products, taken in one aggregate over blocks of rows; a row of sums per entity is then worked
out by a small fold in SQL or a small solve, whose size is the number of lags."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.config import Columns
from hourloom.operators.blocks import Spans
from hourloom.operators.windows import lags as lagged
from hourloom.operators.windows import differences, numbered


def _centred(df: DataFrame, column: str, cols: Columns) -> DataFrame:
    """Entity, time and _x, the value less its entity's mean; means are a row per entity."""
    means = df.groupBy(F.col(cols.entity).alias("_c")).agg(F.avg(column).alias("_mean"))
    return df.join(means, F.col(cols.entity).eqNullSafe(F.col("_c"))).select(*cols.key, (F.col(column) - F.col("_mean")).cast("double").alias("_x"))


def _products(df: DataFrame, column: str, most: int, cols: Columns) -> DataFrame:
    """Entity, n and g: the sums of x[t] * x[t - k] for k in 0..most, x being centred."""
    x = lagged(_centred(df, column, cols), {"_x": tuple(range(1, most + 1))}, cols)
    sums = [F.sum(F.col("_x") * F.col(f"_x_lag_{k}" if k else "_x")) for k in range(most + 1)]
    return x.groupBy(cols.entity).agg(F.count("_x").alias("n"), F.array(*sums).alias("g"))


def acf(df: DataFrame, column: str, lags: int, cols: Columns = Columns()) -> DataFrame:
    """Autocorrelation of each entity's series at 0..lags rows, and whether it leaves the 95% band."""
    g = _products(df, column, lags, cols).select(cols.entity, "n", F.posexplode(F.transform("g", lambda v: v / F.col("g")[0])).alias("lag", "r"))
    out = g.select(cols.entity, "n", F.col("lag").cast("long").alias("lag"), F.round("r", 4).alias("acf"))
    return out.select(cols.entity, "lag", "acf", (F.abs("acf") > F.round(1.96 / F.sqrt("n"), 4)).alias("significant"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def levinson(r: Column, lags: int) -> Column:
    """Partial autocorrelations at 0..lags of the autocorrelations r[0..lags], by the Durbin-Levinson recursion as a fold."""

    def step(acc: Column, k: Column) -> Column:
        phi, past = acc["phi"], F.slice(r, 2, k - 1)
        a = F.try_divide(F.get(r, k) - _dot(phi, F.reverse(past)), 1 - _dot(phi, past))
        return F.struct(F.array_append(F.zip_with(phi, F.reverse(phi), lambda p, q: p - a * q), a).alias("phi"), F.array_append(acc["out"], a).alias("out"))

    start = F.struct(F.array().cast("array<double>").alias("phi"), F.array(F.lit(1.0)).alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(lags)), start, step, lambda acc: acc["out"])


def pacf(df: DataFrame, column: str, lags: int = 48, cols: Columns = Columns()) -> DataFrame:
    """Partial autocorrelation of each entity's series at 0..lags rows (less than half its length), from autocovariances
    adjusted for their number of products, and whether it leaves the 95% band."""
    g = _products(df, column, lags, cols)
    r = F.transform("g", lambda v, k: v / (F.col("n") - k) / (F.col("g")[0] / F.col("n")))
    out = g.where("n > 1").select(cols.entity, "n", F.when(F.col("n") > lags, r).otherwise(F.slice(r, 1, F.greatest(F.least(F.col("n").cast("int"), F.lit(lags + 1)), F.lit(1)))).alias("r"))
    out = out.select(cols.entity, "n", F.posexplode(levinson(F.col("r"), lags)).alias("lag", "v")).where(F.col("lag") <= F.greatest(F.floor(F.col("n") / 2) - 1, F.lit(0)))
    return out.select(cols.entity, F.col("lag").cast("long").alias("lag"), F.round("v", 4).alias("pacf"), (F.abs("v") > 1.96 / F.sqrt("n")).alias("significant"))


#: Critical values of the KPSS statistic about a constant, and their probabilities.
_KPSS = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))


def _kpss_p(k: Column) -> Column:
    out = F.when(k <= _KPSS[0][0], F.lit(_KPSS[0][1]))
    for (a, p), (b, q) in zip(_KPSS, _KPSS[1:]):
        out = out.when(k <= b, p + (k - a) * ((q - p) / (b - a)))
    return out.otherwise(_KPSS[-1][1])


def kpss_lags(df: DataFrame, column: str, cols: Columns = Columns()) -> DataFrame:
    """Entity and the number of lags of its Bartlett window, chosen from the data (Hobijn, Franses and Ooms)."""
    longest = df.groupBy(cols.entity).agg(F.count(column).alias("n")).agg(F.max("n")).first()[0] or 0
    g = _products(df, column, max(int(longest ** (2 / 9)), 1), cols).where("n > 0")
    most = F.floor(F.pow("n", F.lit(2 / 9)) + 1e-9)
    terms = F.transform(F.slice("g", 2, F.size("g") - 1), lambda v, i: F.when(i < most, v / (F.col("n") / 2)).otherwise(0.0))
    s0 = F.col("g")[0] / F.col("n") + F.aggregate(terms, F.lit(0.0), lambda a, v: a + v)
    s1 = F.aggregate(F.transform(terms, lambda v, i: (i + 1) * v), F.lit(0.0), lambda a, v: a + v)
    share = F.try_divide(s1, s0)
    return g.select(cols.entity, F.least(F.floor(1.1447 * F.pow(share * share, F.lit(1 / 3)) * F.pow("n", F.lit(1 / 3))), F.col("n") - 1).alias("lags"))


def kpss(df: DataFrame, column: str, lags: int | None, cols: Columns = Columns()) -> DataFrame:
    """KPSS statistic about a constant with a Bartlett window of `lags` (None: chosen from each entity's data), p value
    (0.01 to 0.1) and whether the series passes as stationary at 5%. Partial sums are carried across spans."""
    chosen = kpss_lags(df, column, cols).withColumnRenamed(cols.entity, "_c") if lags is None else None
    most = lags if lags is not None else int(chosen.agg(F.max("lags")).first()[0] or 0)
    g = _products(df, column, most, cols)
    s = Spans(_centred(df, column, cols), cols)
    before = s.carry(sum=(F.sum("_x"), "sum"))["sum"]
    s.add("_s", before + F.sum("_x").over(s.window()))
    squares = s.rows.groupBy(F.col(cols.entity).alias("_e")).agg(F.sum(F.col("_s") * F.col("_s")).alias("_ss"))
    out = g.join(squares, F.col(cols.entity).eqNullSafe(F.col("_e")))
    out = out.join(chosen, F.col(cols.entity).eqNullSafe(F.col("_c"))) if chosen is not None else out.withColumn("lags", F.lit(lags).cast("long"))
    weights = F.transform("g", lambda v, k: F.when(k == 0, v).when(k <= F.col("lags"), 2 * (1 - k / (F.col("lags") + 1)) * v).otherwise(0.0))
    stat = F.try_divide(F.col("_ss"), F.col("n") * F.aggregate(weights, F.lit(0.0), lambda a, v: a + v))
    out = out.select(cols.entity, "lags", stat.alias("_k"))
    return out.select(cols.entity, "lags", F.round("_k", 4).alias("kpss"), F.round(_kpss_p(F.col("_k")), 4).alias("p"), (F.col("_k") < 0.463).alias("stationary"))


#: MacKinnon's response surface for the test with a constant. Critical values are b0 + b1/n + b2/n^2 + b3/n^3;
#: p is the normal distribution at a polynomial of the statistic, one below and one above the border.
_ADF_CRITICAL = {0.01: (-3.43035, -6.5393, -16.786, -79.433), 0.05: (-2.86154, -2.8903, -4.234, -40.040), 0.10: (-2.56677, -1.5384, -2.809, 0.0)}
_ADF_BORDER, _ADF_LOW, _ADF_HIGH = -1.61, (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)


def adf_p_value(t: float) -> float:
    if t > 2.74:
        return 1.0
    if t < -18.83:
        return 0.0
    z = sum(c * t**i for i, c in enumerate(_ADF_LOW if t <= _ADF_BORDER else _ADF_HIGH))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def adf_lag_limit(n: int) -> int:
    """The most lags that are tried for a series of n values."""
    return min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)


class _Moments:
    """Normal equations of the regression of d[t] on x[t - 1], 1 and d[t - 1], ..., d[t - p] over any sample t > q, from the
    sums over the whole series and the values at its ends."""

    def __init__(self, n: int, ends: dict[int, float], c: list[float], p: list[float], s1: float, s2: float):
        self.n, self.x, self.c, self.p, self.s1, self.s2 = n, ends, c, p, s1, s2

    def d(self, u: int) -> float:
        return self.x[u] - self.x[u - 1]

    def products(self, i: int, j: int, q: int) -> float:
        """Sum of d[t - i] * d[t - j], i <= j: the whole sum at distance j - i, less the products that the sample leaves out."""
        k = j - i
        return self.c[k] - sum(self.d(u) * self.d(u - k) for u in [*range(k + 1, q - i + 1), *range(self.n - i, self.n)])

    def equations(self, lags: int, q: int) -> tuple[np.ndarray, np.ndarray, float, int]:
        size = self.n - 1 - q
        first = [self.s1 - sum(self.x[t - 1] for t in range(1, q + 1)), self.s2 - sum(self.x[t - 1] ** 2 for t in range(1, q + 1))]
        cross = [self.p[j] - sum(self.x[t - 1] * self.d(t - j) for t in range(j + 1, q + 1)) for j in range(lags + 1)]
        total = [self.x[self.n - 1 - j] - self.x[q - j] for j in range(lags + 1)]
        g = np.empty((lags + 2, lags + 2))
        g[0, 0], g[0, 1], g[1, 1] = size, first[0], first[1]
        g[0, 2:], g[1, 2:] = total[1:], cross[1:]
        for i in range(1, lags + 1):
            for j in range(i, lags + 1):
                g[i + 1, j + 1] = self.products(i, j, q)
        g = np.triu(g) + np.triu(g, 1).T
        return g, np.array([total[0], cross[0], *[self.products(0, j, q) for j in range(1, lags + 1)]]), self.products(0, 0, q), size

    def chosen(self, most: int) -> int:
        """The number of lags of the smallest Akaike criterion over the sample that all of them share. The regressions are
        nested, so one Cholesky factor gives all their residual sums."""
        g, b, yy, size = self.equations(most, most)
        z = np.linalg.solve(np.linalg.cholesky(g), b)
        left = yy - np.cumsum(z * z)
        return min(range(most + 1), key=lambda p: (size * math.log(max(left[p + 1], 1e-300) / size) + 2 * (p + 2), p))

    def statistic(self, lags: int) -> tuple[float, int]:
        g, b, yy, size = self.equations(lags, lags)
        beta, inverse = np.linalg.solve(g, b), np.linalg.inv(g)
        return beta[1] / math.sqrt((yy - beta @ b) / (size - lags - 2) * inverse[1, 1]), size


def adf(df: DataFrame, column: str, lags: int | None = None, cols: Columns = Columns()) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant: lags (None: those of the smallest Akaike criterion), observations used,
    statistic, p value, 5% critical value and whether the series is stationary at 5%. Null values are left out; a series that
    is too short or constant has nulls.

    One pass gathers the sums of lagged products of every entity and the few values at its ends; normal equations of any number
    of lags and any sample follow from them, so no order is fitted by a pass of its own."""
    rows = _centred(df.where(F.col(column).isNotNull()), column, cols)
    longest = rows.groupBy(cols.entity).count().agg(F.max("count")).first()[0] or 0
    widest = max(adf_lag_limit(longest), 0) if lags is None else lags
    x = lagged(numbered(rows, "_t", "_n", cols), {"_x": tuple(range(1, widest + 2))}, cols)
    d = [F.col(f"_x_lag_{k}" if k else "_x") - F.col(f"_x_lag_{k + 1}") for k in range(widest + 1)]
    ends = F.when((F.col("_t") <= widest + 2) | (F.col("_t") > F.col("_n") - widest - 2), F.struct((F.col("_t") - 1).alias("t"), F.col("_x").alias("x")))
    sums = x.groupBy(cols.entity).agg(
        F.count("*").alias("n"), F.collect_list(ends).alias("ends"), F.array(*[F.sum(d[0] * v) for v in d]).alias("c"), F.array(*[F.sum(F.col("_x_lag_1") * v) for v in d]).alias("p"),
        F.sum("_x_lag_1").alias("s1"), F.sum(F.col("_x_lag_1") * F.col("_x_lag_1")).alias("s2"),
    )

    def solve(it):
        import pandas as pd

        for pdf in it:
            out = []
            for r in pdf.to_dict("records"):
                n = r["n"]
                most = adf_lag_limit(n) if lags is None else lags
                if most < 0 or n < 2 * most + 4:  # too short
                    out.append((None,) * 6)
                    continue
                try:
                    m = _Moments(n, {e["t"]: e["x"] for e in r["ends"]}, list(r["c"]), list(r["p"]), r["s1"], r["s2"])
                    p = m.chosen(most) if lags is None else lags
                    t, size = m.statistic(p)
                    critical = sum(b / size**i for i, b in enumerate(_ADF_CRITICAL[0.05]))
                    out.append((p, size, round(t, 4), round(adf_p_value(t), 4), round(critical, 4), adf_p_value(t) < 0.05))
                except (np.linalg.LinAlgError, ZeroDivisionError, ValueError):  # constant, or lags that explain it whole
                    out.append((None,) * 6)
            made = pd.DataFrame(out, columns=["lags", "n_used", "adf", "p", "critical", "stationary"]).astype({"lags": "Int64", "n_used": "Int64", "stationary": "boolean"})
            yield pd.concat([pdf[[cols.entity]].reset_index(drop=True), made], axis=1)

    return sums.mapInPandas(solve, f"`{cols.entity}` {dict(df.dtypes)[cols.entity]}, lags long, n_used long, adf double, p double, critical double, stationary boolean")


def stationarity(df: DataFrame, column: str, cols: Columns = Columns()) -> DataFrame:
    """Both tests on the series and on its first differences, lags chosen from the data: entity, series, test, statistic, p,
    lags, stationary."""
    step = differences(df.where(F.col(column).isNotNull()).select(*cols.key, column), [column], (1,), cols)
    made = []
    for name, table, c in (("raw", df, column), ("differenced", step, f"{column}_diff_1")):
        for test, out in (("ADF", adf(table, c, None, cols)), ("KPSS", kpss(table.where(F.col(c).isNotNull()), c, None, cols))):
            made.append(out.select(cols.entity, F.lit(name).alias("series"), F.lit(test).alias("test"), F.col(test.lower()).alias("statistic"), "p", "lags", "stationary"))
    return made[0].unionByName(made[1]).unionByName(made[2]).unionByName(made[3])
