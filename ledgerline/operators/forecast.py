"""Price forecasts: direct multi-horizon regressions, autoregressive and moving-average baselines, comparison.

Series here have daily grain (one row per key and day), so the calendar bounds each of them; the regressions
run over all series together.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.operators.aggregates import forecast_metrics
from ledgerline.operators.joins import next_business_days
from ledgerline.operators.series import Series, join_on
from ledgerline.operators.windows import diff, lags, last_n_rows, latest_row, ma_forecast, sequences, series_split


def _scaled_by_train(df: DataFrame, s: Series, cols: Sequence[str], ratio: float) -> DataFrame:
    """Min-max scale per series with the range of its training rows only; adds `<c>_s`, `<c>_lo`, `<c>_hi`."""
    marked = series_split(df, s, ratio)
    ranges = marked.filter("is_train").groupBy(*s.keys).agg(
        *[F.min(F.col(c).cast("double")).alias(f"{c}_lo") for c in cols],
        *[F.max(F.col(c).cast("double")).alias(f"{c}_hi") for c in cols],
    )
    span = {c: F.col(f"{c}_hi") - F.col(f"{c}_lo") for c in cols}
    return join_on(marked.drop("is_train"), ranges, s.keys).withColumns(
        {f"{c}_s": F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}_lo"), span[c]), F.lit(0.0)) for c in cols}
    )


def joint_moments(df: DataFrame, vector: str, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, centred cross products) of an array column, in one pass: each task sums its own rows and
    Spark adds the partial sums."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size + 1, size + 1))
        for b in batches:
            rows = np.stack(b[vector].to_numpy()) if len(b) else np.zeros((0, size))
            full = np.hstack([np.ones((len(rows), 1)), rows])
            total += full.T @ full
        yield pd.DataFrame({"i": upper[0], "j": upper[1], "g": total[upper]})

    upper = tuple(x.astype("int32") for x in np.triu_indices(size + 1))
    parts = df.select(vector).mapInPandas(part, "i int, j int, g double")
    sums = parts.groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()  # one row per matrix cell
    gram = np.zeros((size + 1, size + 1))
    gram[sums["i"], sums["j"]] = gram[sums["j"], sums["i"]] = sums["g"]
    n = int(gram[0, 0])
    mean = gram[0, 1:] / n
    return n, mean, gram[1:, 1:] - n * np.outer(mean, mean)


def _ridge(n: int, mean: np.ndarray, cross: np.ndarray, x: list[int], y: list[int], strength: float) -> np.ndarray:
    """Coefficients (rows: constant, then x) of each target; the penalty acts on standardised features."""
    sxx = cross[np.ix_(x, x)] / n
    scale = np.diag(sxx).copy()
    scale[scale <= 0] = 1.0  # a constant feature gets weight 0
    beta = np.linalg.solve(sxx + strength * np.diag(scale), cross[np.ix_(x, y)] / n)
    return np.vstack([mean[y] - mean[x] @ beta, beta])


def train_forecaster(
    df: DataFrame,
    s: Series,
    target: str,
    models: Mapping[str, Sequence[str]],
    horizon: int = fixed.FORECAST_HORIZON,
    window: int = fixed.FORECAST_WINDOW,
    history: int | None = None,
    ratio: float = fixed.TRAIN_SHARE,
    ridge: float = 1e-4,
) -> dict[str, DataFrame]:
    """Linear models of the next `horizon` values on the last `window` rows of each feature, over all series.

    Whole series are used unless `history` keeps the last rows only. All models and horizons share one training pass: their normal equations are blocks of the same joint
    moments. Returns `metrics` (key, model, horizon, n, rmse, mae, mape), `pooled` (over horizons), `best`
    (lower pooled RMSE per series) and `predictions` (base, key, horizon label, predicted, model).
    """
    features = list(dict.fromkeys([target, *[f for fs in models.values() for f in fs]]))
    order = s.order[0]
    recent = df.select(*s.keys, *s.order, *features)
    recent = recent if history is None else last_n_rows(recent, s.keys, s.order, history)
    scaled = _scaled_by_train(recent, s, features, ratio).persist()
    bounds = scaled.select(*s.keys, f"{target}_lo", f"{target}_hi").distinct()
    cols = [f"{f}_s" for f in features]
    width = window * len(features)

    sets = series_split(sequences(scaled, s, cols, f"{target}_s", window, horizon), s, ratio)
    train = sets.filter("is_train").select(F.concat(F.flatten("x"), "y").alias("v"))
    n, mean, cross = joint_moments(train, "v", width + horizon)
    weights = np.zeros((width + 1, len(models) * horizon))
    for m, fs in enumerate(models.values()):
        used = {features.index(f) for f in fs}
        x = [i for i in range(width) if i % len(features) in used]
        beta = _ridge(n, mean, cross, x, list(range(width, width + horizon)), ridge)
        weights[[0, *[i + 1 for i in x]], m * horizon : (m + 1) * horizon] = beta

    @F.pandas_udf("array<double>")
    def predict(x: pd.Series) -> pd.Series:
        if x.empty:
            return pd.Series([], dtype=object)
        return pd.Series(list(weights[0] + np.stack(x.to_numpy()) @ weights[1:]))

    back = lambda v: v * (F.col(f"{target}_hi") - F.col(f"{target}_lo")) + F.col(f"{target}_lo")
    slots = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("model"),
                    F.lit(f"T+{h + 1}").alias("horizon"),
                    F.lit(h).alias("h"),
                    F.lit(m * horizon + h).alias("at"),
                )
                for m, name in enumerate(models)
                for h in range(horizon)
            ]
        )
    ).alias("slot")
    test = sets.filter("NOT is_train").withColumn("p", predict(F.flatten("x")))
    results = (
        join_on(test, bounds, s.keys)
        .select("*", slots)
        .select(
            *s.keys,
            "slot.model",
            "slot.horizon",
            back(F.get("y", F.col("slot.h"))).alias("actual"),
            back(F.get("p", F.col("slot.at"))).alias("predicted"),
        )
    )
    last = latest_row(sequences(scaled, s, cols, f"{target}_s", window, 0), s.keys, s.order)
    predictions = (
        join_on(last.withColumn("p", predict(F.flatten("x"))), bounds, s.keys)
        .select("*", slots)
        .select(
            F.col(order).alias("base"),
            *s.keys,
            "slot.horizon",
            back(F.get("p", F.col("slot.at"))).alias("predicted"),
            "slot.model",
        )
    )
    metrics = forecast_metrics(results, [*s.keys, "model", "horizon"], "actual", "predicted")
    pooled = forecast_metrics(results, [*s.keys, "model"], "actual", "predicted")
    best = pooled.groupBy(*s.keys).agg(
        F.min_by("model", F.struct("rmse", "model")).alias("model"), F.min("rmse").alias("rmse")
    )
    return {"metrics": metrics, "pooled": pooled, "best": best, "predictions": predictions}


def ar_fit(df: DataFrame, s: Series, col: str, p: int = fixed.AR_ORDER) -> DataFrame:
    """Per series: coefficients of d_t on its p lags (no constant) and the last p differences and value.

    The rows reduce to p x p sums by grouped aggregation; only those sums are solved, in Arrow batches.
    """
    base = df.select(*s.keys, *s.order, F.col(col).cast("double").alias("v"))
    stepped = lags(diff(base, s, {"v": "d"}), s, {"d": list(range(1, p + 1))})
    x = [f"d_lag{i}" for i in range(1, p + 1)]
    whole = F.lit(True)
    for c in x:
        whole = whole & F.col(c).isNotNull()
    product = lambda a, b: F.sum(F.when(whole, F.col(a) * F.col(b)))
    at = F.struct(*s.order)
    sums = stepped.groupBy(*s.keys).agg(
        F.array(*[product(a, b) for a in x for b in x]).alias("xx"),
        F.array(*[product(a, "d") for a in x]).alias("xy"),
        F.max_by(F.array("d", *x[:-1]), at).alias("last_d"),
        F.max_by("v", at).alias("last_v"),
        F.avg("v").alias("mean_v"),
    )

    @F.pandas_udf("array<double>")
    def solve(xx: pd.Series, xy: pd.Series) -> pd.Series:
        def one(a, b):
            try:
                a = np.asarray(a, dtype=float).reshape(p, p)
                b = np.asarray(b, dtype=float)
                if not (np.isfinite(a).all() and np.isfinite(b).all()):
                    return None
                return np.linalg.solve(a, b)
            except (np.linalg.LinAlgError, ValueError):
                return None

        return pd.Series([one(a, b) for a, b in zip(xx, xy)])

    return sums.select(*s.keys, solve("xx", "xy").alias("phi"), "last_d", "last_v", "mean_v")


def ar_forecast(fitted: DataFrame, s: Series, steps: str) -> DataFrame:
    """(keys, step, predicted) for steps 1..`steps` (a column); a series without a fit predicts its mean.

    Each step is the lag vector times the coefficients, folded over the steps inside Spark.
    """
    start = F.struct(
        F.col("last_d").alias("d"),
        F.col("last_v").alias("v"),
        F.array().cast("array<double>").alias("out"),
    )

    def step(state, _):
        move = F.aggregate(
            F.zip_with(state["d"], F.col("phi"), lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v
        )
        value = state["v"] + move
        shifted = F.slice(F.concat(F.array(move), state["d"]), 1, F.size(state["d"]))
        return F.struct(
            shifted.alias("d"), value.alias("v"), F.concat(state["out"], F.array(value)).alias("out")
        )

    run = F.sequence(F.lit(1), F.col(steps).cast("int"))
    path = F.aggregate(run, start, step, lambda state: state["out"])
    mean = F.transform(run, lambda _: F.col("mean_v"))
    usable = F.col("phi").isNotNull() & (F.size(F.filter("last_d", lambda d: d.isNull())) == 0)
    return (
        fitted.filter(F.col(steps) > 0)
        .select(*s.keys, F.posexplode(F.when(usable, path).otherwise(mean)).alias("i", "predicted"))
        .select(*s.keys, (F.col("i") + 1).cast("bigint").alias("step"), "predicted")
    )


def ar_diff_baseline(
    df: DataFrame, s: Series, col: str, p: int = fixed.AR_ORDER, ratio: float = fixed.TRAIN_SHARE
) -> DataFrame:
    """(keys, order, step, actual, predicted): autoregression on differences, fitted on the training rows by
    conditional least squares and run forward over all test rows."""
    marked = series_split(df.select(*s.keys, *s.order, F.col(col).cast("double").alias("v")), s, ratio)
    train, test = marked.filter("is_train"), marked.filter("NOT is_train")
    numbered = test.withColumn("step", F.row_number().over(s.window).cast("bigint"))
    lengths = test.groupBy(*s.keys).agg(F.count(F.lit(1)).alias("steps"))
    path = ar_forecast(ar_fit(train, s, "v", p).join(lengths, list(s.keys)), s, "steps")
    # A series without training rows has the mean of its rows.
    mean = F.avg("v").over(W.partitionBy(*s.keys))
    return join_on(numbered.withColumn("mean_v", mean), path, [*s.keys, "step"], "left").select(
        *s.keys, *s.order, "step", F.col("v").alias("actual"), F.coalesce("predicted", "mean_v").alias("predicted")
    )


def ma_baseline(df: DataFrame, s: Series, col: str, n: int = 5) -> DataFrame:
    """(keys, n, rmse, mae, mape) of the moving-average forecast over the whole series."""
    return forecast_metrics(ma_forecast(df, s, col, n, "__ma"), list(s.keys), col, "__ma")


def baselines(df: DataFrame, s: Series, col: str, n: int = 5) -> DataFrame:
    """(keys, model, n, rmse, mae, mape) of both baselines."""
    ma = ma_baseline(df, s, col, n).withColumn("model", F.lit("moving_average"))
    ar = forecast_metrics(ar_diff_baseline(df, s, col), list(s.keys), "actual", "predicted")
    return ma.unionByName(ar.withColumn("model", F.lit("ar_difference")))


def compare_models(results: DataFrame, keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    """One row per series with `<model>_rmse` and `<model>_mae`, and the model of lowest RMSE."""
    pick = lambda m, c: F.max(F.when(F.col("model") == m, F.col(c)))
    return results.groupBy(*keys).agg(
        *[pick(m, c).alias(f"{m}_{c}") for m in models for c in ("rmse", "mae")],
        F.min_by("model", F.struct("rmse", "model")).alias("best_model"),
    )


def forecast_dates(last: DataFrame, date: str, n: int = fixed.FORECAST_HORIZON) -> DataFrame:
    """Each row repeated for the n weekdays after its date, with `horizon` and `forecast_date`."""
    kept = last.columns
    return last.select(
        *kept, F.posexplode(next_business_days(F.to_date(date), n)).alias("__i", "forecast_date")
    ).select(*kept, F.concat(F.lit("T+"), F.col("__i") + 1).alias("horizon"), "forecast_date")


def forecast_compare(
    predictions: DataFrame, last: DataFrame, keys: Sequence[str], close: str, models: Sequence[str], unit: float = 1.0
) -> DataFrame:
    """One row per (keys, horizon): for each model the price, its difference and percent change from the last close."""
    joined = predictions.join(last.select(*keys, (F.col(close) * unit).alias("last_close")), list(keys))
    price = lambda m: F.max(F.when(F.col("model") == m, F.col("predicted") * unit))
    wide = joined.groupBy(*keys, "horizon", "last_close").agg(*[price(m).alias(m) for m in models])
    new = {}
    for m in models:
        gap = F.col(m) - F.col("last_close")
        new |= {f"{m}_diff": gap, f"{m}_pct": F.try_divide(gap, F.col("last_close")) * 100}
    return wide.withColumns(new)
