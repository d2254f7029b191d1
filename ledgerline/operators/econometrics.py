"""Regressions and causality tests from moments: Spark reduces the rows, the k x k algebra is on the driver."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.tails import chi2_sf, f_sf, mackinnon_critical, mackinnon_p, t_two_sided
from ledgerline.operators.series import Series
from ledgerline.operators.windows import diff, lags


@dataclass(frozen=True)
class Fit:
    """Least-squares fit with a constant; arrays start with the constant."""

    terms: tuple[str, ...]
    coef: np.ndarray
    std_err: np.ndarray
    ssr: float
    total: float
    nobs: int
    df_resid: int

    @property
    def t(self) -> np.ndarray:
        return self.coef / self.std_err

    @property
    def r2(self) -> float:
        return 1.0 - self.ssr / self.total

    @property
    def adj_r2(self) -> float:
        return 1.0 - (1.0 - self.r2) * (self.nobs - 1) / self.df_resid

    @property
    def aic(self) -> float:
        loglik = -self.nobs / 2 * (math.log(2 * math.pi) + math.log(self.ssr / self.nobs) + 1)
        return -2 * loglik + 2 * len(self.coef)

    def frame(self, spark) -> DataFrame:
        rows = [
            (name, float(b), float(se), float(t), t_two_sided(float(t), self.df_resid))
            for name, b, se, t in zip(self.terms, self.coef, self.std_err, self.t)
        ]
        out = spark.createDataFrame(rows, "term string, coef double, std_err double, t double, p_value double")
        return out.withColumns(
            {"nobs": F.lit(self.nobs), "r2": F.lit(float(self.r2)), "adj_r2": F.lit(float(self.adj_r2))}
        )


def _moment_columns(cols: Sequence[str]) -> list[Column]:
    """Count, means and centred second moments; covar_pop merges partial results without cancellation."""
    value = {c: F.col(c).cast("double") for c in cols}
    return [
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(value[c]) for c in cols]).alias("m"),
        F.array(*[F.covar_pop(value[a], value[b]) for i, a in enumerate(cols) for b in cols[i:]]).alias("s"),
    ]


def _symmetric(upper: Sequence[float], k: int) -> np.ndarray:
    full = np.zeros((k, k))
    full[np.triu_indices(k)] = upper
    return full + np.triu(full, 1).T


@dataclass(frozen=True)
class Moments:
    cols: tuple[str, ...]
    n: int
    mean: np.ndarray
    cross: np.ndarray  # centred sums of products

    def fit(self, y: str, xs: Sequence[str]) -> Fit:
        iy, ix = self.cols.index(y), [self.cols.index(x) for x in xs]
        sxx, sxy = self.cross[np.ix_(ix, ix)], self.cross[ix, iy]
        inverse = np.linalg.inv(sxx) if ix else np.zeros((0, 0))
        beta = inverse @ sxy
        ssr = float(self.cross[iy, iy] - beta @ sxy)
        df_resid = self.n - len(xs) - 1
        variance = ssr / df_resid if df_resid > 0 else float("nan")
        mean_x = self.mean[ix]
        constant = self.mean[iy] - mean_x @ beta
        se = np.sqrt(variance * np.diag(inverse))
        se_constant = math.sqrt(variance * (1.0 / self.n + mean_x @ inverse @ mean_x))
        return Fit(
            ("const", *xs),
            np.concatenate([[constant], beta]),
            np.concatenate([[se_constant], se]),
            ssr,
            float(self.cross[iy, iy]),
            self.n,
            df_resid,
        )


def moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """One aggregation over the complete rows."""
    cols = list(cols)
    row = df.dropna(subset=cols).agg(*_moment_columns(cols)).first()
    if not row["n"]:
        raise ValueError(f"no complete rows in {cols}")
    return Moments(
        tuple(cols), row["n"], np.array(row["m"]), _symmetric(row["s"], len(cols)) * row["n"]
    )


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """(term, coef, std_err, t, p_value, nobs, r2, adj_r2) of y on the columns and a constant."""
    return moments(df, [y, *xs]).fit(y, xs).frame(df.sparkSession)


def panel_fe(df: DataFrame, entity: str, y: str, xs: Sequence[str]) -> DataFrame:
    """Fixed-effects regression, equal to one dummy per entity; the constant is the first entity's effect.

    Per-entity moments are summed, which gives the within-entity moments without demeaning the rows, without
    dummies, and with partial aggregation for an entity of any size.
    """
    cols = [y, *xs]
    k = len(cols)
    held = df.dropna(subset=[entity, *cols])
    per = held.groupBy(entity).agg(*_moment_columns(cols))
    pairs = k * (k + 1) // 2
    row = per.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("entities"),
        F.array(*[F.sum(F.col("s")[i] * F.col("n")) for i in range(pairs)]).alias("s"),
        F.min_by(F.struct("n", "m"), entity).alias("first"),
    ).first()
    if not row["n"]:
        raise ValueError(f"no complete rows in {cols}")
    total = held.agg(F.var_pop(F.col(y).cast("double"))).first()[0] * row["n"]
    n, groups = row["n"], row["entities"]
    within = Moments(tuple(cols), n, np.zeros(k), _symmetric(row["s"], k)).fit(y, xs)
    df_resid = n - len(xs) - groups
    scale = (within.df_resid / df_resid) ** 0.5
    beta, se = within.coef[1:], within.std_err[1:] * scale
    inverse = np.linalg.inv(_symmetric(row["s"], k)[1:, 1:])
    variance = within.ssr / df_resid
    mean = np.array(row["first"]["m"])
    constant = mean[0] - mean[1:] @ beta
    se_constant = math.sqrt(variance * (1.0 / row["first"]["n"] + mean[1:] @ inverse @ mean[1:]))
    return Fit(
        ("const", *xs),
        np.concatenate([[constant], beta]),
        np.concatenate([[se_constant], se]),
        within.ssr,
        total,
        n,
        df_resid,
    ).frame(df.sparkSession)


def lagged_panel(df: DataFrame, entity: str, year: str, y: str, x: str) -> DataFrame:
    """y on its own first lag and two lags of x, with entity effects. Yearly grain bounds each entity."""
    s = Series.of(entity, year)
    panel = lags(df.select(entity, year, y, x), s, {y: [1], x: [1, 2]})
    return panel_fe(panel, entity, y, [f"{y}_lag1", f"{x}_lag1", f"{x}_lag2"])


def adf_test(df: DataFrame, order: str, col: str, alpha: float = 0.05, segment: Column | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant; the lag count minimises AIC on a common sample."""
    s = Series.of((), order, segment)
    base = df.select(order, F.col(col).cast("double").alias("v")).dropna()
    n = base.count()
    most = min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25))
    if most < 0:
        raise ValueError(f"{col}: {n} values are too few for a unit-root test")
    stepped = diff(lags(base, s, {"v": [1]}), s, {"v": "d"})
    ready = lags(stepped, s, {"d": list(range(1, most + 1))}) if most else stepped
    lagged = [f"d_lag{i}" for i in range(1, most + 1)]
    common = moments(ready, ["d", "v_lag1", *lagged])
    fits = [common.fit("d", ["v_lag1", *lagged[:p]]) for p in range(most + 1)]
    used = min(range(most + 1), key=lambda p: fits[p].aic)
    final = moments(ready, ["d", "v_lag1", *lagged[:used]]).fit("d", ["v_lag1", *lagged[:used]])
    stat = float(final.t[1])
    p = mackinnon_p(stat)
    critical = mackinnon_critical(final.nobs)
    return df.sparkSession.createDataFrame(
        [(col, stat, p, used, final.nobs, critical["1%"], critical["5%"], critical["10%"], p < alpha)],
        "series string, adf_stat double, p_value double, lags int, nobs bigint, "
        "critical_1 double, critical_5 double, critical_10 double, is_stationary boolean",
    )


def granger(df: DataFrame, order: str, y: str, x: str, max_lag: int = 3, alpha: float = 0.05,
            segment: Column | None = None) -> DataFrame:
    """Does x help predict y beyond y's own past? F and chi2 tests per lag count."""
    s = Series.of((), order, segment)
    data = df.select(order, y, x).dropna()
    steps = list(range(1, max_lag + 1))
    ready = lags(data, s, {y: steps, x: steps})
    rows = []
    for p in steps:
        own = [f"{y}_lag{i}" for i in range(1, p + 1)]
        other = [f"{x}_lag{i}" for i in range(1, p + 1)]
        m = moments(ready, [y, *own, *other])
        restricted, full = m.fit(y, own), m.fit(y, own + other)
        gain = (restricted.ssr - full.ssr) / full.ssr
        f, chi2 = gain / p * full.df_resid, gain * m.n
        f_p = f_sf(f, p, full.df_resid)
        rows.append((p, m.n, f, f_p, chi2, chi2_sf(chi2, p), f_p < alpha))
    return df.sparkSession.createDataFrame(
        rows,
        "lag int, nobs bigint, f_stat double, f_p_value double, chi2 double, chi2_p_value double, "
        "is_significant boolean",
    )


_TESTS = "lag int, nobs bigint, f_stat double, f_p_value double, chi2 double, chi2_p_value double, is_significant boolean"


def granger_by(
    df: DataFrame, entity: str, order: str, y: str, x: str, max_lag: int = 3, alpha: float = 0.05, segment: Column | str | None = None
) -> DataFrame:
    """`granger` for every entity at once: (entity, lag, nobs, f_stat, f_p_value, chi2, chi2_p_value, is_significant).

    The moments of all lag counts are summed by entity in one aggregation, combined in the map tasks, and each entity's k x k
    fits are solved on its own row of moments, wherever that is. A lag count whose fit is singular, exact or left without
    degrees of freedom has NULL statistics. Rows without entity, y or x are left out; raw-grain series need `segment`.
    """
    s = Series.of("entity", "order", segment)
    data = df.select(*([] if segment is None else [c for c in df.columns if c not in ("entity", "order", "y", "x")]),
                     F.col(entity).alias("entity"), F.col(order).alias("order"), F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x"))
    steps = list(range(1, max_lag + 1))
    ready = lags(data.dropna(subset=["entity", "y", "x"]), s, {"y": steps, "x": steps})
    columns, sets = [], {}
    for p in steps:
        sets[p] = ["y", *[f"y_lag{i}" for i in range(1, p + 1)], *[f"x_lag{i}" for i in range(1, p + 1)]]
        held = {c: F.when(F.col(f"y_lag{p}").isNotNull(), F.col(c)) for c in sets[p]}
        pairs = [(a, b) for i, a in enumerate(sets[p]) for b in sets[p][i:]]
        columns += [F.count(held["y"]).alias(f"n{p}"), F.array(*[F.covar_pop(held[a], held[b]) for a, b in pairs]).alias(f"s{p}")]

    def tests(n: int, upper: Sequence[float], p: int) -> tuple:
        none = (p, n, None, None, None, None, None)
        if n - 2 * p - 1 <= 0:
            return none
        m = Moments(tuple(sets[p]), n, np.zeros(len(sets[p])), _symmetric(upper, len(sets[p])) * n)
        try:
            small, full = m.fit("y", sets[p][1 : p + 1]), m.fit("y", sets[p][1:])
        except np.linalg.LinAlgError:
            return none
        if not full.ssr > 1e-12 * full.total:
            return none
        gain = (small.ssr - full.ssr) / full.ssr
        f, chi2 = gain / p * full.df_resid, gain * n
        f_p = f_sf(f, p, full.df_resid)
        return p, n, f, f_p, chi2, chi2_sf(chi2, p), f_p < alpha

    def solve(batches):
        for rows in batches:
            out = [(e, *tests(int(r[f"n{p}"]), r[f"s{p}"], p)) for e, (_, r) in zip(rows["entity"], rows.iterrows()) for p in steps]
            yield pd.DataFrame(out, columns=["entity", *[f.split()[0] for f in _TESTS.split(", ")]])

    kind = dict(data.dtypes)["entity"]
    found = ready.groupBy("entity").agg(*columns).mapInPandas(solve, f"entity {kind}, {_TESTS}")
    return found.withColumnRenamed("entity", entity)


def causality(df: DataFrame, order: str, y: str, x: str, max_lag: int = 3) -> dict[str, DataFrame]:
    """Unit-root tests on levels and differences, then the causality test on levels only if both are stationary."""
    s = Series.of((), order)
    changes = diff(df, s, {y: f"__{y}", x: f"__{x}"}).select(
        order, F.col(f"__{y}").alias(y), F.col(f"__{x}").alias(x)
    )
    level = adf_test(df, order, y).unionByName(adf_test(df, order, x))
    change = adf_test(changes, order, y).unionByName(adf_test(changes, order, x))
    both = all(r["is_stationary"] for r in level.collect())
    used = df if both else changes
    basis = F.lit("level" if both else "difference")
    return {
        "adf_level": level,
        "adf_difference": change,
        "granger": granger(used, order, y, x, max_lag).withColumn("basis", basis),
    }
