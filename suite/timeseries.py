"""Windows over ordered series, similarity, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.scalars import key_to_date
from ledgerline.operators import forecast as FC
from ledgerline.operators import series_forecast as SF
from ledgerline.operators import similarity as SIM
from ledgerline.operators import windows as WN
from ledgerline.operators.aggregates import forecast_metrics
from ledgerline.operators.joins import pair_rows
from ledgerline.operators.series import Series, numbered
from ledgerline.plans import facts
from suite.registry import query
from suite.views import BARS, BY_TICKER, PANEL, PRIORITIES, bars, panel, rounded, table

W = "WINDOW w AS (PARTITION BY ticker ORDER BY date_key)"

# Raw ticks: an event type holds a fifth of all rows, so its series is cut by hour.
TICKS = Series.of("event_type", ("ts", "event_id"), "date_trunc('hour', ts)", 4096)


@query(
    "tick_changes",
    """SELECT event_id, round(coalesce(value / nullif(lag(value) OVER w, 0) - 1, 0), 6) AS value_pct FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
)
def tick_changes(spark, sf):
    """Change from tick to tick in segmented series: no task holds a whole event type."""
    return rounded(WN.pct_change(table(spark, sf, "events"), TICKS, "value").select("event_id", "value_pct"))


@query(
    "tick_moving_average",
    """SELECT event_id, CASE WHEN count(*) OVER f = 20 THEN round(avg(value) OVER f, 6) END AS ma,
    lag(value, 3) OVER w AS value_lag3, row_number() OVER w AS n FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id),
    f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
)
def tick_moving_average(spark, sf):
    ticks = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    df, s = numbered(ticks, TICKS, "n")
    df = WN.moving_avg(df, s, "value", 20, "ma")
    return rounded(WN.lags(df, s, {"value": [3]}).select("event_id", "ma", "value_lag3", "n"))


@query(
    "pct_change_daily",
    f"""WITH {BARS} SELECT ticker, date_key, round(coalesce(close_price / lag(close_price) OVER w - 1, 0), 6) AS close_price_pct
    FROM bars {W}""",
)
def pct_change_daily(spark, sf):
    out = WN.pct_change(bars(spark, sf), BY_TICKER, "close_price")
    return rounded(out.select("ticker", "date_key", "close_price_pct"))


@query(
    "pct_change_over_gaps",
    f"""WITH {PANEL}, x AS (SELECT *, last_value(npl_ratio IGNORE NULLS) OVER (PARTITION BY entity ORDER BY year
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM panel)
    SELECT entity, year, round(coalesce(coalesce(npl_ratio, prior) / prior - 1, 0), 6) AS npl_ratio_pct FROM x""",
)
def pct_change_over_gaps(spark, sf):
    """Missing years are padded with the last known value."""
    out = WN.pct_change(panel(spark, sf), Series.of("entity", "year"), "npl_ratio")
    return rounded(out.select("entity", "year", "npl_ratio_pct"))


@query(
    "lagged_ratios",
    f"""WITH {PANEL} SELECT entity, year, round(lag(npl_ratio) OVER w, 6) AS npl_ratio_lag1,
    round(lag(llp_ratio) OVER w, 6) AS llp_ratio_lag1, round(lag(llp_ratio, 2) OVER w, 6) AS llp_ratio_lag2
    FROM panel WINDOW w AS (PARTITION BY entity ORDER BY year)""",
)
def lagged_ratios(spark, sf):
    out = WN.lags(panel(spark, sf), Series.of("entity", "year"), {"npl_ratio": [1], "llp_ratio": [1, 2]})
    return rounded(out.select("entity", "year", "npl_ratio_lag1", "llp_ratio_lag1", "llp_ratio_lag2"))


@query(
    "first_difference",
    f"WITH {BARS} SELECT ticker, date_key, round(close_price - lag(close_price) OVER w, 4) AS close_price_diff FROM bars {W}",
)
def first_difference(spark, sf):
    out = WN.diff(bars(spark, sf), BY_TICKER, "close_price")
    return rounded(out.select("ticker", "date_key", "close_price_diff"), 4)


@query(
    "forward_fill_two",
    f"""WITH {PANEL} SELECT entity, year, round(coalesce(npl_ratio, lag(npl_ratio) OVER w, lag(npl_ratio, 2) OVER w), 6) AS npl_ratio
    FROM panel WINDOW w AS (PARTITION BY entity ORDER BY year)""",
)
def forward_fill_two(spark, sf):
    out = WN.ffill(panel(spark, sf), Series.of("entity", "year"), ["npl_ratio"], 2)
    return rounded(out.select("entity", "year", "npl_ratio"))


@query(
    "moving_averages",
    f"""WITH {BARS} SELECT ticker, date_key, CASE WHEN count(*) OVER a = 20 THEN round(avg(close_price) OVER a, 4) END AS ma20,
    CASE WHEN count(*) OVER b = 60 THEN round(avg(close_price) OVER b, 4) END AS ma60,
    CASE WHEN count(*) OVER c = 5 THEN round(avg(close_price) OVER c, 4) END AS forecast FROM bars
    WINDOW a AS (PARTITION BY ticker ORDER BY date_key ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    b AS (PARTITION BY ticker ORDER BY date_key ROWS BETWEEN 59 PRECEDING AND CURRENT ROW),
    c AS (PARTITION BY ticker ORDER BY date_key ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
)
def moving_averages(spark, sf):
    df = WN.moving_avg(bars(spark, sf), BY_TICKER, "close_price", 20, "ma20")
    df = WN.moving_avg(df, BY_TICKER, "close_price", 60, "ma60")
    df = WN.ma_forecast(df, BY_TICKER, "close_price", 5, "forecast")
    return rounded(df.select("ticker", "date_key", "ma20", "ma60", "forecast"), 4)


PAIRS_SQL = f"""{BARS}, common AS (SELECT * FROM bars WHERE date_key IN (SELECT date_key FROM bars GROUP BY 1 HAVING count(*) = 5)),
    p AS (SELECT a.ticker AS a, b.ticker AS b, a.date_key, a.close_price AS x, b.close_price AS y
      FROM common a JOIN common b ON a.date_key = b.date_key AND a.ticker < b.ticker)"""


@query(
    "rolling_correlation",
    f"""WITH {PAIRS_SQL} SELECT a, b, date_key, CASE WHEN count(*) OVER f = 60 THEN round(corr(x, y) OVER f, 6) END AS rolling_corr
    FROM p WINDOW f AS (PARTITION BY a, b ORDER BY date_key ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""",
)
def rolling_correlation(spark, sf):
    return rounded(SIM.pair_rolling_corr(bars(spark, sf), "ticker", "date_key", "close_price", PRIORITIES, 60))


@query(
    "mean_rolling_correlation",
    f"""WITH {PAIRS_SQL}, r AS (SELECT a, b, CASE WHEN count(*) OVER f = 250 THEN corr(x, y) OVER f END AS r
    FROM p WINDOW f AS (PARTITION BY a, b ORDER BY date_key ROWS BETWEEN 249 PRECEDING AND CURRENT ROW))
    SELECT a, b, round(avg(r), 6) AS mean_corr FROM r GROUP BY 1, 2""",
)
def mean_rolling_correlation(spark, sf):
    return rounded(SIM.mean_rolling_corr(bars(spark, sf), "ticker", "date_key", "close_price", PRIORITIES, 250))


@query(
    "pair_correlation",
    f"""WITH {BARS} SELECT a.ticker AS a, b.ticker AS b, round(corr(a.close_price, b.close_price), 6) AS corr
    FROM bars a JOIN bars b ON a.date_key = b.date_key AND a.ticker < b.ticker GROUP BY 1, 2""",
)
def pair_correlation(spark, sf):
    return rounded(SIM.pair_corr(bars(spark, sf), "ticker", "date_key", "close_price", PRIORITIES))


@query(
    "series_pairs",
    f"""WITH {BARS} SELECT a.date_key, a.ticker AS a, b.ticker AS b, a.close_price AS x, b.close_price AS y
    FROM bars a JOIN bars b ON a.date_key = b.date_key AND a.ticker < b.ticker""",
)
def series_pairs(spark, sf):
    return pair_rows(bars(spark, sf), "ticker", "date_key", "close_price", PRIORITIES)


# Diagonal by diagonal; a cell outside the matrix is NULL, which least() passes over.
WARPED = f"""WITH RECURSIVE {BARS}, named AS (SELECT * FROM bars WHERE ticker IN {tuple(PRIORITIES)} AND close_price IS NOT NULL),
common AS (SELECT date_key FROM named GROUP BY 1 HAVING count(DISTINCT ticker) = (SELECT count(DISTINCT ticker) FROM named)),
z AS (SELECT ticker, date_key, (close_price - avg(close_price) OVER w) / stddev_samp(close_price) OVER w AS z
  FROM named SEMI JOIN common USING (date_key) WINDOW w AS (PARTITION BY ticker)),
s AS (SELECT ticker, list(z ORDER BY date_key) AS v, count(*) AS n FROM z GROUP BY 1),
walk(a, b, x, y, n, d, last, past) AS (
  SELECT p.ticker, q.ticker, p.v, q.v, p.n, 2, list_transform(range(1, p.n + 1), lambda i: CASE WHEN i = 1 THEN abs(p.v[1] - q.v[1]) END), CAST([] AS DOUBLE[])
  FROM s p JOIN s q ON p.ticker < q.ticker
  UNION ALL
  SELECT a, b, x, y, n, d + 1, list_transform(range(1, n + 1), lambda i: CASE WHEN d + 1 - i BETWEEN 1 AND n
    THEN abs(x[i] - y[d + 1 - i]) + least(last[i], CASE WHEN i > 1 THEN last[i - 1] END, CASE WHEN i > 1 THEN past[i - 1] END) END), last
  FROM walk WHERE d < 2 * n),
ends AS (SELECT a, b, round(last[n], 6) AS distance FROM walk WHERE d = 2 * n)
SELECT a, b, distance FROM ends UNION ALL SELECT b, a, distance FROM ends UNION ALL SELECT ticker, ticker, 0.0 FROM s"""


@query("warped_distance", WARPED)
def warped_distance(spark, sf):
    return rounded(SIM.dtw_matrix(bars(spark, sf), "ticker", "date_key", "close_price", PRIORITIES))


@query(
    "latest_bar",
    f"WITH {BARS} SELECT ticker, date_key, close_price FROM bars QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date_key DESC) = 1",
)
def latest_bar(spark, sf):
    return WN.latest_row(bars(spark, sf), ["ticker"], "date_key").select("ticker", "date_key", "close_price")


@query(
    "latest_known_values",
    f"""WITH {PANEL} SELECT entity, max(year) AS year, round(arg_max(npl_ratio, year) FILTER (npl_ratio IS NOT NULL), 6) AS npl_ratio,
    round(arg_max(roa, year) FILTER (roa IS NOT NULL), 6) AS roa FROM panel GROUP BY 1""",
)
def latest_known_values(spark, sf):
    """Last non-null value per column, possibly from different years."""
    out = WN.latest_non_null(panel(spark, sf), ["entity"], "year", ["year", "npl_ratio", "roa"])
    return rounded(out)


@query(
    "last_rows_per_series",
    f"""WITH {BARS} SELECT ticker, date_key, close_price FROM bars
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date_key DESC) <= 750""",
)
def last_rows_per_series(spark, sf):
    return WN.last_n_rows(bars(spark, sf), ["ticker"], "date_key", 750).select("ticker", "date_key", "close_price")


@query(
    "ordered_time_split",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, rn <= floor(n * 0.8::DOUBLE) AS is_train FROM r""",
)
def ordered_time_split(spark, sf):
    """First 80 % of all rows by date and key, cut by counting instead of sorting."""
    return WN.time_split(table(spark, sf, "orders"), "o_orderdate", ["o_orderkey"]).select("o_orderkey", "is_train")


@query(
    "series_time_split",
    f"""WITH {BARS}, r AS (SELECT ticker, date_key, row_number() OVER w AS rn, count(*) OVER (PARTITION BY ticker) AS n FROM bars {W})
    SELECT ticker, date_key, rn <= floor(n * 0.8::DOUBLE) AS is_train FROM r""",
)
def series_time_split(spark, sf):
    return WN.series_split(bars(spark, sf), BY_TICKER).select("ticker", "date_key", "is_train")


@query(
    "sliding_windows",
    f"""WITH {BARS}, s AS (SELECT ticker, date_key, count(*) OVER f AS n, round(sum(close_price) OVER f, 2) AS x_sum,
      lead(close_price, 5) OVER w AS y5, round(close_price + lead(close_price) OVER w, 2) AS seam FROM bars
      WINDOW w AS (PARTITION BY ticker ORDER BY date_key),
      f AS (PARTITION BY ticker ORDER BY date_key ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
    SELECT ticker, date_key, x_sum, y5, seam FROM s WHERE n = 20 AND y5 IS NOT NULL""",
)
def sliding_windows(spark, sf):
    """20 past vectors and 5 next closes per row; summed here to compare."""
    seq = WN.sequences(bars(spark, sf), BY_TICKER, ["close_price", "open_price"], "close_price", 20, 5)
    total = F.aggregate("x", F.lit(0.0), lambda t, v: t + v[0])
    return rounded(
        seq.select(
            "ticker",
            "date_key",
            total.alias("x_sum"),
            F.col("y")[4].alias("y5"),
            (F.element_at("x", -1)[0] + F.col("y")[0]).alias("seam"),
        ),
        2,
    )


@query(
    "latest_change",
    f"""WITH {BARS} SELECT ticker, date_key, close_price AS latest, lag(close_price) OVER w AS previous,
    round(close_price / lag(close_price) OVER w - 1, 6) AS change_pct FROM bars {W}
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date_key DESC) = 1""",
)
def latest_change(spark, sf):
    return rounded(WN.latest_change(bars(spark, sf), BY_TICKER, "close_price"))


@query(
    "fallback_imputation",
    f"""WITH {PANEL} SELECT entity, year, round(coalesce(npl_ratio, lag(npl_ratio) OVER w, avg(npl_ratio) OVER f), 6) AS npl_ratio_filled
    FROM panel WINDOW w AS (PARTITION BY entity ORDER BY year),
    f AS (PARTITION BY entity ORDER BY year ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
)
def fallback_imputation(spark, sf):
    out = WN.fallback_impute(panel(spark, sf), Series.of("entity", "year"), "npl_ratio")
    return rounded(out.select("entity", "year", "npl_ratio_filled"))


@query(
    "volatility_warning",
    f"""WITH {BARS} SELECT ticker, date_key, coalesce(CASE WHEN count(*) OVER f = 20 THEN stddev_samp(close_price) OVER f END > 150000, false)
    AS high_volatility FROM bars WINDOW f AS (PARTITION BY ticker ORDER BY date_key ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
)
def volatility_warning(spark, sf):
    out = WN.volatility_flag(bars(spark, sf), BY_TICKER, "close_price", 20, 150000.0)
    return out.select("ticker", "date_key", "high_volatility")


METRIC_SQL = """count(e) AS n, round(sqrt(avg(e * e)), 3) AS rmse, round(avg(abs(e)), 3) AS mae,
    round(avg(abs(e / (a + 1e-8::DOUBLE))) * 100, 4) AS mape"""


@query(
    "moving_average_baseline",
    f"""WITH {BARS}, m AS (SELECT ticker, close_price AS a, close_price - CASE WHEN count(*) OVER c = 5 THEN avg(close_price) OVER c END AS e
      FROM bars WINDOW c AS (PARTITION BY ticker ORDER BY date_key ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
    SELECT ticker, {METRIC_SQL} FROM m GROUP BY 1""",
)
def moving_average_baseline(spark, sf):
    return rounded(FC.ma_baseline(bars(spark, sf), BY_TICKER, "close_price"), 3, mape=4)


@query(
    "forecast_errors",
    f"""WITH {BARS}, m AS (SELECT ticker, close_price AS a, close_price - open_price AS e FROM bars)
    SELECT ticker, {METRIC_SQL} FROM m GROUP BY 1""",
)
def forecast_errors(spark, sf):
    """Open price as the forecast of the close."""
    return rounded(forecast_metrics(bars(spark, sf), ["ticker"], "close_price", "open_price"), 3, mape=4)


@query("autoregressive_baseline")
def autoregressive_baseline(spark, sf):
    return FC.ar_diff_baseline(bars(spark, sf), BY_TICKER, "close_price")


@query("baseline_comparison")
def baseline_comparison(spark, sf):
    results = FC.baselines(bars(spark, sf), BY_TICKER, "close_price")
    return FC.compare_models(results, ["ticker"], ["moving_average", "ar_difference"])


def forecaster(spark, sf):
    features = facts.stock_features(bars(spark, sf), "ticker")
    return FC.train_forecaster(
        features,
        BY_TICKER,
        "close_price",
        {
            "univariate": ["close_price"],
            "multivariate": [
                "close_price",
                "open_price",
                "high_price",
                "low_price",
                "trading_volume",
                "price_change_pct",
                "volume_change_pct",
            ],
        },
    )


@query("price_forecast")
def price_forecast(spark, sf):
    """Next five closes of every series by both models."""
    return forecaster(spark, sf)["predictions"]


@query("forecast_table")
def forecast_table(spark, sf):
    """Forecasts next to the last close: difference and percent per model, with their dates."""
    daily = bars(spark, sf)
    last = WN.latest_row(daily, ["ticker"], "date_key")
    wide = FC.forecast_compare(
        forecaster(spark, sf)["predictions"], last, ["ticker"], "close_price", ["univariate", "multivariate"]
    )
    dated = FC.forecast_dates(last.select("ticker", key_to_date("date_key").alias("last_date")), "last_date")
    return wide.join(dated, ["ticker", "horizon"])


@query(
    "forecast_dates",
    f"""WITH {BARS}, l AS (SELECT ticker, strptime(CAST(max(date_key) AS VARCHAR), '%Y%m%d')::DATE AS last_date FROM bars GROUP BY 1),
    d AS (SELECT ticker, last_date, CAST(last_date + CAST(i AS INTEGER) AS DATE) AS forecast_date FROM l, range(1, 20) r(i)),
    k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY forecast_date) AS rn FROM d WHERE isodow(forecast_date) < 6)
    SELECT ticker, last_date, 'T+' || rn AS horizon, forecast_date FROM k WHERE rn <= 5""",
)
def forecast_dates(spark, sf):
    last = bars(spark, sf).groupBy("ticker").agg(key_to_date(F.max("date_key")).alias("last_date"))
    return FC.forecast_dates(last, "last_date")




# Two regressors a model, so that SQL can solve the normal equations by hand.
SMALL_MODELS = {"univariate": SF.SeriesModel(("close_price",), 2), "multivariate": SF.SeriesModel(("close_price", "trading_volume"), 1)}
FITTED = f"""{BARS}, r AS (SELECT *, row_number() OVER w AS at, lag(close_price) OVER w AS lag1 FROM bars {W}),
    sz AS (SELECT ticker, count(*) AS n FROM bars GROUP BY 1),
    sets AS (SELECT r.ticker, r.at - 1 AS m, floor((n - 6) * 0.8) AS t, r.close_price AS x, r.lag1, r.trading_volume AS vol, q.h, y.close_price AS y
      FROM r JOIN sz USING (ticker) CROSS JOIN range(1, 6) q(h) JOIN r y ON y.ticker = r.ticker AND y.at = r.at + q.h
      WHERE r.at >= 2 AND r.at <= n - 5),
    regs AS (SELECT ticker, m, t, h, x, y, 'univariate' AS model, lag1 AS z FROM sets
      UNION ALL SELECT ticker, m, t, h, x, y, 'multivariate', vol FROM sets),
    c AS (SELECT ticker, h, model, avg(y) AS my, avg(x) AS mx, avg(z) AS mz, covar_pop(x, x) AS sxx, covar_pop(z, z) AS szz,
      covar_pop(x, z) AS sxz, covar_pop(x, y) AS sxy, covar_pop(z, y) AS szy FROM regs WHERE m <= t GROUP BY ALL),
    b AS (SELECT *, (sxy * szz - szy * sxz) / (sxx * szz - sxz * sxz) AS bx, (szy * sxx - sxy * sxz) / (sxx * szz - sxz * sxz) AS bz FROM c),
    res AS (SELECT ticker, model, 'T+' || h AS horizon, y AS a, y - (my + bx * (x - mx) + bz * (z - mz)) AS e
      FROM regs JOIN b USING (ticker, h, model) WHERE m > t)"""
COMPARED = f"""{FITTED}, tr AS (SELECT r.ticker, r.at AS pos, r.close_price AS v, floor(n * 0.8) AS t FROM r JOIN sz USING (ticker)),
    d AS (SELECT *, v - lag(v) OVER (PARTITION BY ticker ORDER BY pos) AS d FROM tr WHERE pos <= t),
    l AS (SELECT *, lag(d) OVER (PARTITION BY ticker ORDER BY pos) AS dl FROM d),
    phi AS (SELECT ticker, sum(d * dl) / sum(dl * dl) AS phi, arg_max(d, pos) AS ld, arg_max(v, pos) AS lv FROM l GROUP BY 1),
    every AS (SELECT ticker, model, a, e FROM res
      UNION ALL SELECT ticker, 'ar_difference', v, v - (lv + ld * phi * (1 - pow(phi, pos - t)) / (1 - phi)) FROM tr JOIN phi USING (ticker) WHERE pos > t
      UNION ALL SELECT ticker, 'moving_average', close_price, close_price - CASE WHEN count(*) OVER c = 5 THEN avg(close_price) OVER c END
        FROM bars WINDOW c AS (PARTITION BY ticker ORDER BY date_key ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
    pooled AS (SELECT ticker, model, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, avg(abs(e / (a + 1e-8::DOUBLE))) * 100 AS mape FROM every GROUP BY 1, 2)"""


def _small_forecasts(spark, sf):
    return SF.forecast_series(bars(spark, sf), BY_TICKER, "close_price", SMALL_MODELS, ridge=0.0)


def _with_baselines(spark, sf):
    """Pooled errors of both fitted models and both baselines."""
    daily = bars(spark, sf)
    ma = FC.ma_baseline(daily, BY_TICKER, "close_price").withColumn("model", F.lit("moving_average"))
    ar = forecast_metrics(FC.ar_diff_baseline(daily, BY_TICKER, "close_price", 1), ["ticker"], "actual", "predicted")
    pooled = _small_forecasts(spark, sf)["pooled"]
    return pooled.unionByName(ma).unionByName(ar.withColumn("model", F.lit("ar_difference")))


@query("forecast_metrics_by_horizon", f"WITH {FITTED} SELECT ticker, model, horizon, {METRIC_SQL} FROM res GROUP BY 1, 2, 3")
def forecast_metrics_by_horizon(spark, sf):
    """Errors of each series' own models on the rows after the training rows, by horizon."""
    return rounded(_small_forecasts(spark, sf)["metrics"], 3, mape=4)


@query(
    "best_forecast_model",
    f"""WITH {FITTED}, p AS (SELECT ticker, model, sqrt(avg(e * e)) AS rmse FROM res GROUP BY 1, 2)
    SELECT ticker, arg_min(model, rmse) AS model, round(min(rmse), 3) AS rmse FROM p GROUP BY 1""",
)
def best_forecast_model(spark, sf):
    return rounded(_small_forecasts(spark, sf)["best"], 3)


COMPARED_MODELS = ["univariate", "multivariate", "ar_difference", "moving_average"]


@query(
    "model_comparison",
    f"WITH {COMPARED} SELECT ticker, "
    + ", ".join(f"round(max({c}) FILTER (model = '{m}'), 3) AS {m}_{c}" for m in COMPARED_MODELS for c in ("rmse", "mae"))
    + ", arg_min(model, rmse) AS best_model FROM pooled GROUP BY 1",
)
def model_comparison(spark, sf):
    """The two fitted models of each series next to the autoregressive and the moving-average baseline."""
    return rounded(FC.compare_models(_with_baselines(spark, sf), ["ticker"], COMPARED_MODELS), 3)


@query(
    "forecast_gate",
    f"""WITH {COMPARED}, best AS (SELECT ticker, arg_min(model, rmse) AS model, min(rmse) AS rmse, arg_min(mape, rmse) AS mape FROM pooled
      WHERE model IN ('univariate', 'multivariate') GROUP BY 1),
    lim AS (SELECT ticker, min(rmse) AS rmse, min(mape) AS mape FROM pooled WHERE model IN ('ar_difference', 'moving_average') GROUP BY 1)
    SELECT ticker, 'rmse' AS metric, model, round(best.rmse, 3) AS value, round(lim.rmse, 3) AS threshold, best.rmse < lim.rmse AS passed
    FROM best JOIN lim USING (ticker)
    UNION ALL SELECT ticker, 'mape', model, round(best.mape, 3), round(lim.mape, 3), best.mape < lim.mape FROM best JOIN lim USING (ticker)""",
)
def forecast_gate(spark, sf):
    """Whether the best model of each series beats both baselines."""
    gate = SF.forecast_gate(_with_baselines(spark, sf), ["ticker"], ["univariate", "multivariate"], ["ar_difference", "moving_average"])
    return rounded(gate, 3)


@query("price_forecast_by_series")
def price_forecast_by_series(spark, sf):
    """The next five closes of every series by its own models of 20 days, judged over four parts of the last fifth."""
    features = facts.stock_features(bars(spark, sf), "ticker")
    every = ("close_price", "open_price", "high_price", "low_price", "trading_volume", "price_change_pct", "volume_change_pct")
    models = {"univariate": SF.SeriesModel(("close_price",)), "multivariate": SF.SeriesModel(every)}
    out = SF.forecast_series(features, BY_TICKER, "close_price", models, folds=4)
    errors = out["metrics"].select("ticker", "model", "horizon", "n", "rmse", "mae", "mape")
    return out["predictions"].join(errors, ["ticker", "model", "horizon"])
