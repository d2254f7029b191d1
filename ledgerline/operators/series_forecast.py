"""One forecaster for each series: normal equations summed by series, walk-forward evaluation, comparison, gate."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import fixed
from ledgerline.operators.aggregates import forecast_metrics
from ledgerline.operators.forecast import _scaled_by_train
from ledgerline.operators.series import Series, join_on
from ledgerline.operators.windows import last_n_rows, latest_row, sequences
from ledgerline.storage import stored

# Moments that a task holds before it passes them on.
_HELD_BYTES = 64 << 20


@dataclass(frozen=True)
class SeriesModel:
    """A linear model of the next values on the last `window` values of each feature."""

    features: tuple[str, ...]
    window: int = fixed.FORECAST_WINDOW


def _blocks(sets: DataFrame, s: Series, ratio: float, folds: int) -> DataFrame:
    """Adds `block`: 0 for the first floor(n * ratio) rows of a series, then 1 to `folds` for equal parts of the others."""
    whole = W.partitionBy(*s.keys)
    n, at = F.count(F.lit(1)).over(whole), F.row_number().over(s.window)
    placed = sets.withColumn("_n", n).withColumn("_at", at).withColumn("_train", F.floor(F.col("_n") * F.lit(ratio)))
    held_out = F.floor((F.col("_at") - F.col("_train") - 1) * folds / (F.col("_n") - F.col("_train"))) + 1
    block = F.when(F.col("_at") <= F.col("_train"), 0).otherwise(held_out)
    return placed.withColumn("block", block.cast("int")).drop("_n", "_at", "_train")


def _moments(sets: DataFrame, keys: Sequence[str], folds: int) -> DataFrame:
    """(keys, block, moments): sums of products of (1, x, y) over the rows of a block that train some fold. A task adds up its
    own rows; a series comes out of its windows in one task, so there are few rows a block."""
    source = sets.filter(F.col("block") < folds).select(*keys, "block", F.concat(F.flatten("x"), "y").alias("v"))
    fields = [source.schema[c] for c in (*keys, "block")]
    schema = T.StructType([*fields, T.StructField("moments", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}

        def frame() -> pd.DataFrame:
            made = pd.DataFrame([(*k, m.ravel()) for k, m in held.items()], columns=[f.name for f in schema])
            return made.astype({"block": "int32"})

        for batch in batches:
            for at, rows in batch.groupby([*keys, "block"], dropna=False, sort=False):
                at = tuple(None if x is not None and x != x else x for x in at)
                v = np.stack(rows["v"].to_numpy())
                v = np.hstack([np.ones((len(v), 1)), v])
                held[at] = held.get(at, 0) + v.T @ v
                if len(held) * v.shape[1] ** 2 * 8 > _HELD_BYTES:
                    yield frame()
                    held = {}
        if held:
            yield frame()

    return source.mapInPandas(run, schema)


def _coefficients(gram: np.ndarray, x: list[int], y: list[int], ridge: float) -> np.ndarray | None:
    """Constant and slopes of each target from the moments; the penalty acts on standardised features, and a constant feature
    gets weight 0. None with fewer rows than unknowns."""
    n = gram[0, 0]
    if n < len(x) + 1:
        return None
    mean = gram[0] / n
    cross = gram / n - np.outer(mean, mean)
    sxx = cross[np.ix_(x, x)]
    scale = np.diag(sxx).copy()
    flat = scale <= 1e-14
    scale[flat] = 1.0
    fixed_up = sxx + np.diag(np.where(flat, 1.0, ridge * scale))
    beta = np.linalg.lstsq(fixed_up, cross[np.ix_(x, y)], rcond=None)[0]
    beta[flat] = 0.0
    return np.vstack([mean[y] - mean[x] @ beta, beta])


def forecast_series(
    df: DataFrame,
    s: Series,
    target: str,
    models: Mapping[str, SeriesModel],
    horizon: int = fixed.FORECAST_HORIZON,
    ratio: float = fixed.TRAIN_SHARE,
    folds: int = 1,
    ridge: float = 1e-4,
    history: int | None = None,
) -> dict[str, DataFrame]:
    """Every model fitted for every series on its own, evaluated walking forward, and its forecast after the last row.

    Features are scaled by the range of the series' training rows. The rows after them are cut into `folds` parts; part k is
    forecast by a fit on all rows before it. The fits of all folds come from sums of products by block, which add up. With one
    fold this is a plain split in time. All models are judged on the same rows, those that have the longest window.

    Returns `results` (keys, order, model, horizon, actual, predicted), `metrics` (keys, model, horizon, n, rmse, mae, mape),
    `pooled` (over horizons), `best` (keys, model, rmse: the lowest pooled RMSE) and `predictions` (base, keys, horizon,
    predicted, model), fitted as the last part was. Too short a series has the mean of its training targets as a forecast where
    it has some, else it is left out. Series are of daily grain: what one holds is bounded by the calendar.
    """
    if not models or horizon < 1 or folds < 1 or not 0 < ratio < 1:
        raise ValueError("forecasts need models, a horizon, folds and a ratio between 0 and 1")
    features = list(dict.fromkeys([target, *[f for m in models.values() for f in m.features]]))
    window, keys, order = max(m.window for m in models.values()), list(s.keys), list(s.order)
    recent = df.select(*keys, *order, *features)
    recent = recent if history is None else last_n_rows(recent, keys, order, history)
    scaled = stored(_scaled_by_train(recent, s, features, ratio))
    cols = [f"{f}_s" for f in features]
    width = window * len(features)
    sets = stored(_blocks(sequences(scaled, s, cols, f"{target}_s", window, horizon), s, ratio, folds))

    used = {}
    for name, m in models.items():
        mine = {features.index(f) for f in m.features}
        used[name] = [1 + i for i in range(width) if i % len(features) in mine and i // len(features) >= window - m.window]
    targets = list(range(width + 1, width + 1 + horizon))
    size = width + 1 + horizon
    key_fields = [scaled.schema[k] for k in keys]

    def solved(rows: pd.DataFrame) -> pd.DataFrame:
        grams = {b: sum(np.asarray(m).reshape(size, size) for m in of["moments"]) for b, of in rows.groupby("block")}
        at = tuple(rows[k].iloc[0] for k in keys)
        total, out = np.zeros((size, size)), []
        for fold in range(folds):
            total = total + grams.get(fold, 0)
            for name, x in used.items():
                beta = _coefficients(total, x, targets, ridge)
                full = np.zeros((width + 1, horizon))
                if beta is not None:
                    full[[0, *x]] = beta
                elif total[0, 0]:
                    full[0] = total[0, targets] / total[0, 0]
                else:
                    continue
                out.append((*at, fold, name, full.ravel()))
        return pd.DataFrame(out, columns=[*keys, "fold", "model", "weights"])

    weight_schema = T.StructType(
        [*key_fields, T.StructField("fold", T.IntegerType()), T.StructField("model", T.StringType()), T.StructField("weights", T.ArrayType(T.DoubleType()))]
    )
    weights = _moments(sets, keys, folds).groupBy(*keys).applyInPandas(solved, weight_schema)
    bounds = scaled.select(*keys, F.col(f"{target}_lo").alias("lo"), F.col(f"{target}_hi").alias("hi")).distinct()
    weights = join_on(weights, bounds, keys, "inner") if keys else weights

    last = latest_row(sequences(scaled, s, cols, f"{target}_s", window, 0), keys, order)
    last = last.select(*keys, *order, "x", F.lit(None).cast("array<double>").alias("y"), F.lit(folds).alias("block"), F.lit(True).alias("last"))
    asked = sets.filter("block > 0").select(*keys, *order, "x", "y", "block", F.lit(False).alias("last")).unionByName(last)
    out_fields = [*key_fields, *[scaled.schema[c] for c in order]]
    out_schema = T.StructType(
        [
            *out_fields,
            T.StructField("last", T.BooleanType()),
            T.StructField("model", T.StringType()),
            T.StructField("horizon", T.StringType()),
            T.StructField("actual", T.DoubleType()),
            T.StructField("predicted", T.DoubleType()),
        ]
    )

    def predicted(rows: pd.DataFrame, fits: pd.DataFrame) -> pd.DataFrame:
        out = []
        for fit in fits.itertuples(index=False):
            mine = rows[rows["block"] == fit.fold + 1]
            if not len(mine):
                continue
            x = np.stack([np.concatenate(v) for v in mine["x"]])
            full = np.asarray(fit.weights).reshape(width + 1, horizon)
            found = (full[0] + x @ full[1:]) * (fit.hi - fit.lo) + fit.lo
            known = np.stack([np.full(horizon, np.nan) if v is None else np.asarray(v, float) for v in mine["y"]]) * (fit.hi - fit.lo) + fit.lo
            for h in range(horizon):
                part = mine[[*keys, *order, "last"]].copy()
                part["model"], part["horizon"] = fit.model, f"T+{h + 1}"
                part["actual"], part["predicted"] = known[:, h], found[:, h]
                out.append(part)
        return pd.concat(out) if out else pd.DataFrame(columns=[f.name for f in out_schema])

    found = asked.groupBy(*keys).cogroup(weights.groupBy(*keys)).applyInPandas(predicted, out_schema)
    found = stored(found.withColumn("actual", F.when(~F.isnan("actual"), F.col("actual"))))
    results = found.filter("not last").drop("last")
    metrics = forecast_metrics(results, [*keys, "model", "horizon"], "actual", "predicted")
    pooled = forecast_metrics(results, [*keys, "model"], "actual", "predicted")
    predictions = found.filter("last").select(F.col(order[0]).alias("base"), *keys, "horizon", "predicted", "model")
    return {"results": results, "metrics": metrics, "pooled": pooled, "best": best_model(pooled, keys), "predictions": predictions}


def best_model(pooled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, model, rmse): the model of the lowest RMSE of each series."""
    least = F.min_by("model", F.struct("rmse", "model")).alias("model")
    return pooled.groupBy(*keys).agg(least, F.min("rmse").alias("rmse"))


def forecast_gate(results: DataFrame, keys: Sequence[str], models: Sequence[str], baselines: Sequence[str]) -> DataFrame:
    """(keys, metric, model, value, threshold, passed): whether the best model of each series, by RMSE, is below the lowest RMSE
    and the lowest MAPE of the baselines. results: (keys, model, rmse, mape). A missing value does not pass."""
    mine = results.filter(F.col("model").isin(list(models)))
    theirs = results.filter(F.col("model").isin(list(baselines)))
    best = mine.groupBy(*keys).agg(F.min_by(F.struct("model", "rmse", "mape"), F.struct("rmse", "model")).alias("m"))
    limits = theirs.groupBy(*keys).agg(F.min("rmse").alias("rmse"), F.min("mape").alias("mape"))
    both = join_on(best, limits, list(keys), "left")
    rows = [F.struct(F.lit(c).alias("metric"), F.col(f"m.{c}").alias("value"), F.col(c).alias("threshold")) for c in ("rmse", "mape")]
    each = both.select(*keys, F.col("m.model").alias("model"), F.explode(F.array(*rows)).alias("r"))
    passed = F.coalesce(F.col("value") < F.col("threshold"), F.lit(False)).alias("passed")
    return each.select(*keys, "r.metric", "model", "r.value", "r.threshold").select("*", passed)
