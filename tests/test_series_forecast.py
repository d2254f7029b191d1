"""Per-series forecasts against least squares series by series."""

import math

import numpy as np
import pytest
from conftest import as_set, close

from ledgerline.operators.series import Series
from ledgerline.operators.series_forecast import SeriesModel, forecast_gate, forecast_series

DAILY = Series.of("k", "t")
MODELS = {"one": SeriesModel(("v",), 4), "two": SeriesModel(("v", "w"), 2)}


def frame(spark, series):
    rows = [(k, i, float(v), float(w)) for k, (a, b) in series.items() for i, (v, w) in enumerate(zip(a, b, strict=True))]
    return spark.createDataFrame(rows, "k string, t int, v double, w double").repartition(3)


def by_hand(v, w, horizon, folds, window, model):
    """(fold rows, actual, predicted) for every row after the training rows."""
    features = [v] if model.features == ("v",) else [v, w]
    at = range(window - 1, len(v) - horizon)
    x = np.array([[1.0, *[f[i - j] for j in range(model.window) for f in features]] for i in at])
    y = np.array([v[i + 1 : i + 1 + horizon] for i in at])
    n = len(x)
    cut = math.floor(n * 0.8)
    blocks = np.array([0 if i < cut else (i - cut) * folds // (n - cut) + 1 for i in range(n)])
    out = []
    for fold in range(folds):
        beta = np.linalg.lstsq(x[blocks <= fold], y[blocks <= fold], rcond=None)[0]
        out += [(a, p) for a, p in zip(y[blocks == fold + 1], x[blocks == fold + 1] @ beta, strict=True)]
    last = np.array([1.0, *[f[len(v) - 1 - j] for j in range(model.window) for f in features]])
    return out, last @ beta


@pytest.mark.parametrize("folds", [1, 3])
def test_each_series_has_its_own_least_squares(spark, folds):
    rng = np.random.default_rng(3)
    series = {k: (np.cumsum(rng.normal(size=n)) + 50, rng.normal(size=n) * 9) for k, n in (("a", 120), ("b", 90), ("c", 61))}
    out = forecast_series(frame(spark, series), DAILY, "v", MODELS, horizon=3, folds=folds, ridge=0.0)
    metrics = {(r["k"], r["model"], r["horizon"]): r for r in out["metrics"].collect()}
    ahead = {(r["k"], r["model"], r["horizon"]): r for r in out["predictions"].collect()}
    best = {r["k"]: r["model"] for r in out["best"].collect()}
    for k, (v, w) in series.items():
        pooled = {}
        for name, model in MODELS.items():
            rows, future = by_hand(v, w, 3, folds, 4, model)
            e = np.array([a - p for a, p in rows])
            for h in range(3):
                got = metrics[k, name, f"T+{h + 1}"]
                assert got["n"] == len(rows) and close(got["rmse"], math.sqrt(np.mean(e[:, h] ** 2)), 1e-7)
                assert close(got["mae"], np.mean(abs(e[:, h])), 1e-7)
                assert close(ahead[k, name, f"T+{h + 1}"]["predicted"], future[h], 1e-7) and ahead[k, name, f"T+{h + 1}"]["base"] == len(v) - 1
            pooled[name] = np.mean(e**2)
        assert best[k] == min(pooled, key=pooled.get)


def test_short_and_constant_series(spark):
    rng = np.random.default_rng(5)
    series = {"flat": ([7.0] * 60, [1.0] * 60), "short": (rng.normal(size=9), rng.normal(size=9)), "one": ([1.0], [2.0]), "long": (rng.normal(size=80), np.zeros(80))}
    out = forecast_series(frame(spark, series), DAILY, "v", MODELS, horizon=2)
    flat = out["metrics"].filter("k = 'flat'").collect()
    assert len(flat) == 4 and all(r["rmse"] < 1e-9 for r in flat)
    assert as_set(out["predictions"], "k") == {("flat",), ("short",), ("long",)}  # one row makes no window
    assert all(math.isfinite(r["predicted"]) for r in out["predictions"].collect())
    v = series["short"][0]  # four windows, three to train on: the mean of their targets
    means = [np.mean([v[i + h] for i in (3, 4, 5)]) for h in (1, 2)]
    got = {r["horizon"]: r["predicted"] for r in out["predictions"].filter("k = 'short' and model = 'one'").collect()}
    assert close(got["T+1"], means[0]) and close(got["T+2"], means[1])


def test_no_rows_and_bad_arguments(spark):
    df = frame(spark, {"a": (np.arange(60.0), np.arange(60.0))})
    assert forecast_series(df.limit(0), DAILY, "v", MODELS)["metrics"].count() == 0
    for bad in ({"horizon": 0}, {"folds": 0}, {"ratio": 1.0}):
        with pytest.raises(ValueError):
            forecast_series(df, DAILY, "v", MODELS, **bad)


def test_gate(spark):
    rows = [("a", "m1", 1.0, 5.0), ("a", "m2", 2.0, 1.0), ("a", "b1", 1.5, 4.0), ("a", "b2", 3.0, 6.0), ("b", "m1", 1.0, 1.0)]
    got = forecast_gate(spark.createDataFrame(rows, "k string, model string, rmse double, mape double"), ["k"], ["m1", "m2"], ["b1", "b2"])
    assert as_set(got) == {
        ("a", "rmse", "m1", 1.0, 1.5, True), ("a", "mape", "m1", 5.0, 4.0, False), ("b", "rmse", "m1", 1.0, None, False), ("b", "mape", "m1", 1.0, None, False),
    }
