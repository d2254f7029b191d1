"""Clustering, risk, econometrics, similarity and forecasts against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import tails
from ledgerline.operators import clusters, econometrics, forecast, risk, similarity
from ledgerline.operators.series import Series
from ledgerline.plans import reports
from tests.conftest import as_set, close

RNG = np.random.default_rng(11)


def test_tails():
    # Reference values from published tables.
    assert close(tails.normal_cdf(1.959963985), 0.975, 1e-9)
    assert close(tails.chi2_sf(3.841458821, 1), 0.05, 1e-8) and close(tails.chi2_sf(18.30703805, 10), 0.05, 1e-8)
    assert close(tails.f_sf(4.964602744, 1, 10), 0.05, 1e-8) and close(tails.f_sf(2.978237016, 10, 10), 0.05, 1e-8)
    assert close(tails.t_two_sided(2.228138852, 10), 0.05, 1e-8) and close(tails.t_two_sided(0.0, 5), 1.0)
    assert close(tails.gamma_sf(0.0, 3), 1.0) and close(tails.beta_cdf(0.5, 2, 2), 0.5)


@pytest.mark.parametrize("stat, p", [(-0.4572, 0.9001), (-0.6569, 0.8576), (-2.3376, 0.1601), (-5.7962, 0.0000)])
def test_unit_root_p_values(stat, p):
    assert abs(tails.mackinnon_p(stat) - p) < 1e-4


def least_squares(y, x):
    x = np.column_stack([np.ones(len(y)), x])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    ssr = float(((y - x @ beta) ** 2).sum())
    dof = len(y) - x.shape[1]
    se = np.sqrt(ssr / dof * np.diag(np.linalg.inv(x.T @ x)))
    return beta, se, ssr, dof


def test_ols_matches_least_squares(spark):
    x = RNG.normal(size=(200, 3)) * [1, 50, 0.01] + [0, 1000, 5]
    y = 3 + x @ [2.0, -0.1, 30.0] + RNG.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([y, x]), columns=["y", "a", "b", "c"])).repartition(5)
    got = econometrics.ols(df, "y", ["a", "b", "c"]).collect()
    beta, se, ssr, dof = least_squares(y, x)
    assert [r["term"] for r in got] == ["const", "a", "b", "c"]
    for r, b, s in zip(got, beta, se):
        assert close(r["coef"], b, 1e-6) and close(r["std_err"], s, 1e-6)
        assert close(r["p_value"], tails.t_two_sided(b / s, dof), 1e-5)
    assert close(got[0]["r2"], 1 - ssr / ((y - y.mean()) ** 2).sum(), 1e-9)


def test_panel_equals_dummies(spark):
    rows = []
    for e in range(6):
        for t in range(4 + e):
            a, b = RNG.normal() + e, RNG.normal()
            rows.append((e, 2 * a - b + 5 * e + RNG.normal() * 0.1, a, b))
    data = pd.DataFrame(rows, columns=["e", "y", "a", "b"])
    got = {r["term"]: r for r in econometrics.panel_fe(spark.createDataFrame(data), "e", "y", ["a", "b"]).collect()}
    dummies = pd.get_dummies(data["e"], drop_first=True).astype(float).to_numpy()
    beta, se, ssr, dof = least_squares(data["y"].to_numpy(), np.column_stack([data[["a", "b"]], dummies]))
    for i, term in enumerate(["const", "a", "b"]):
        assert close(got[term]["coef"], beta[i], 1e-8) and close(got[term]["std_err"], se[i], 1e-8)
    y = data["y"]
    r2 = 1 - ssr / ((y - y.mean()) ** 2).sum()
    assert close(got["a"]["r2"], r2) and close(got["a"]["adj_r2"], 1 - (1 - r2) * (len(y) - 1) / dof)


def brute_adf(v):
    n = len(v)
    d = np.diff(v)
    most = min(n // 2 - 2, math.ceil(12 * (n / 100) ** 0.25))

    def fit(p, skip):
        y = d[skip:]
        cols = [v[skip:-1]] + [d[skip - i : len(d) - i] for i in range(1, p + 1)]
        beta, se, ssr, dof = least_squares(y, np.column_stack(cols))
        m = len(y)
        return beta[1] / se[1], m * (math.log(2 * math.pi) + math.log(ssr / m) + 1) + 2 * (p + 2), m

    best = min(range(most + 1), key=lambda p: fit(p, most)[1])
    stat, _, m = fit(best, best)
    return stat, best, m


@pytest.mark.parametrize("n, kind", [(21, "walk"), (60, "walk"), (60, "noise")])
def test_unit_root_test(spark, n, kind):
    steps = RNG.normal(size=n)
    v = np.cumsum(steps) if kind == "walk" else steps
    df = spark.createDataFrame([(int(i), float(x)) for i, x in enumerate(v)], "t int, v double").repartition(3)
    got = econometrics.adf_test(df, "t", "v").first()
    stat, lag, m = brute_adf(v)
    assert (got["lags"], got["nobs"]) == (lag, m) and close(got["adf_stat"], stat, 1e-6)
    assert close(got["p_value"], tails.mackinnon_p(stat), 1e-6)


def test_granger(spark):
    x = RNG.normal(size=80)
    y = np.concatenate([[0.0], 0.8 * x[:-1]]) + RNG.normal(size=80) * 0.5
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, x))], "t int, y double, x double")
    for r in econometrics.granger(df, "t", "y", "x", 3).collect():
        p = r["lag"]
        back = lambda s: np.column_stack([s[p - i : len(s) - i] for i in range(1, p + 1)])
        _, _, small, _ = least_squares(y[p:], back(y))
        _, _, full, dof = least_squares(y[p:], np.column_stack([back(y), back(x)]))
        assert close(r["f_stat"], (small - full) / full / p * dof, 1e-6)
        assert close(r["chi2"], (small - full) / full * (len(y) - p), 1e-6)
        assert r["is_significant"] and r["nobs"] == 80 - p


def test_granger_by_entity_equals_one_by_one(spark):
    rng = np.random.default_rng(4)
    rows = [(e, t, float(rng.normal()), float(rng.normal())) for e in "ab" for t in range(50)]
    rows += [("short", t, float(t), float(t * t)) for t in range(3)] + [("flat", t, float(rng.normal()), 1.0) for t in range(30)]
    rows += [("a", 60, None, 1.0), (None, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "e string, t int, y double, x double").repartition(3)
    got = {(r["e"], r["lag"]): r for r in econometrics.granger_by(df, "e", "t", "y", "x", 2).collect()}
    assert len(got) == 8
    for e in "ab":
        for want in econometrics.granger(df.filter(F.col("e") == e), "t", "y", "x", 2).collect():
            r = got[e, want["lag"]]
            assert r["nobs"] == want["nobs"] and r["is_significant"] == want["is_significant"]
            assert all(close(r[c], want[c], 1e-7) for c in ("f_stat", "f_p_value", "chi2", "chi2_p_value"))
    assert all(got[e, p]["f_stat"] is None and got[e, p]["is_significant"] is None for e in ("short", "flat") for p in (1, 2))


def brute_dtw(a, b, band=None):
    table = np.full((len(a) + 1, len(b) + 1), np.inf)
    table[0, 0] = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            if band is not None and abs(i - j) > band:
                continue
            table[i, j] = abs(a[i - 1] - b[j - 1]) + min(table[i - 1, j], table[i, j - 1], table[i - 1, j - 1])
    return table[-1, -1]


@pytest.mark.parametrize("n, m", [(1, 1), (1, 5), (7, 3), (30, 41), (25, 25)])
def test_dtw_distance(n, m):
    a, b = RNG.normal(size=n), RNG.normal(size=m)
    assert close(similarity.dtw_distance(a, b), brute_dtw(a, b))
    assert close(similarity.dtw_distance(a, b, band=n + m), brute_dtw(a, b))
    assert similarity.dtw_distance(a, b, band=0) >= brute_dtw(a, b) - 1e-12
    assert close(similarity.dtw_distance(a, b), similarity.dtw_distance(b, a))


@pytest.mark.parametrize("tile, band", [(4096, None), (7, None), (7, 0), (7, 8), (11, 3), (40, 2)])
def test_dtw_matrix(spark, tile, band):
    rows = [(k, t, float(RNG.normal())) for k in "abc" for t in range(40) if not (k == "b" and t % 9 == 0)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(4)
    got = {(r["a"], r["b"]): r["distance"] for r in similarity.dtw_matrix(df, "k", "t", "v", ["a", "b", "c"], band, tile).collect()}
    wide = pd.DataFrame(rows, columns=["k", "t", "v"]).pivot(index="t", columns="k", values="v").dropna()
    z = (wide - wide.mean()) / wide.std()
    assert len(got) == 9
    for (p, q), d in got.items():
        assert close(d, 0.0 if p == q else brute_dtw(z[p].to_numpy(), z[q].to_numpy(), band), 1e-9)


def test_dtw_matrix_of_no_common_dates(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 1.0)], "k string, t int, v double")
    assert similarity.dtw_matrix(df, "k", "t", "v", ["a", "b"]).count() == 0


def test_auc_of_no_rows(spark):
    assert risk.auc(spark.createDataFrame([], "y int, p double"), "y", "p").first()["auc"] == 0.0


def test_one_row_series_has_its_mean_as_baseline(spark):
    rows = [("a", t, float(t % 7)) for t in range(60)] + [("b", 0, 1.0)]
    got = forecast.ar_diff_baseline(spark.createDataFrame(rows, "k string, t int, v double"), Series.of("k", "t"), "v")
    assert [tuple(r) for r in got.filter("k = 'b'").select("actual", "predicted").collect()] == [(1.0, 1.0)]


def test_constant_series_have_no_correlation(spark):
    df = spark.createDataFrame([(k, t, 1.0 if k == "a" else float(t)) for k in "ab" for t in range(9)], "k string, t int, v double")
    assert similarity.pair_corr(df, "k", "t", "v", ["a", "b"]).first()["corr"] is None
    assert as_set(similarity.pair_rolling_corr(df, "k", "t", "v", ["a", "b"], 3), "rolling_corr") == {(None,)}


def test_silhouette_and_davies_bouldin(spark):
    points = RNG.normal(size=(60, 3)) + np.repeat([[0, 0, 0], [4, 0, 0], [0, 6, 0]], 20, axis=0)
    label = np.repeat([0, 1, 2], 20)
    label[59] = 3  # a cluster of one
    df = spark.createDataFrame([(i, int(c), *map(float, p)) for i, (c, p) in enumerate(zip(label, points))], "i int, c int, x double, y double, z double")
    dist = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    scores = []
    for i in range(60):
        own = (label == label[i]) & (np.arange(60) != i)
        if not own.any():
            scores.append(0.0)
            continue
        a, b = dist[i, own].mean(), min(dist[i, label == c].mean() for c in set(label) - {label[i]})
        scores.append((b - a) / max(a, b))
    for block in (7, 1000):
        assert close(clusters.silhouette(df, "i", "c", ["x", "y", "z"], block).first()[0], np.mean(scores), 1e-9)
    keep = label < 3
    centre = np.array([points[(label == c)].mean(0) for c in range(3)])
    spread = np.array([np.sqrt(((points[label == c] - centre[c]) ** 2).sum(1)).mean() for c in range(3)])
    worst = [max((spread[i] + spread[j]) / np.linalg.norm(centre[i] - centre[j]) for j in range(3) if j != i) for i in range(3)]
    got = clusters.davies_bouldin(df.filter("c < 3"), "c", ["x", "y", "z"]).first()[0]
    assert keep.sum() == 59 and close(got, np.mean(worst), 1e-9)


def test_silhouette_of_near_copies_in_few_strips(spark):
    rng = np.random.default_rng(4)
    points = np.repeat(rng.normal(size=(20, 2)) + 1e4, 15, axis=0) + rng.normal(size=(300, 2)) * 1e-6
    label = np.arange(300) % 3
    dist = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    scores = []
    for i in range(300):
        own = (label == label[i]) & (np.arange(300) != i)
        a, b = dist[i, own].mean(), min(dist[i, label == c].mean() for c in {0, 1, 2} - {label[i]})
        scores.append((b - a) / max(a, b))
    df = spark.createDataFrame([(i, int(c), *map(float, p)) for i, (c, p) in enumerate(zip(label, points))], "i int, c int, x double, y double")
    out = clusters.silhouette(df, "i", "c", ["x", "y"], 5)
    assert close(out.first()[0], np.mean(scores), 1e-9)
    # Small blocks do not send every row sixty times.
    assert "sequence(0, 7" in out._jdf.queryExecution().analyzed().toString()


def test_pca(spark):
    x = RNG.normal(size=(50, 4)) @ RNG.normal(size=(4, 4))
    z = (x - x.mean(0)) / x.std(0)
    df = spark.createDataFrame(pd.DataFrame(z, columns=list("abcd")))
    scored, table = clusters.pca_project(df, list("abcd"), 0.8)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    order = values.argsort()[::-1]
    share = values[order] / values.sum()
    rows = table.orderBy("component").collect()
    assert all(close(r["variance_ratio"], s, 1e-8) for r, s in zip(rows, share))
    keep = int(np.argmax(np.cumsum(share) >= 0.8)) + 1
    assert sum(r["selected"] for r in rows) == keep and f"pc{keep}" in scored.columns and f"pc{keep + 1}" not in scored.columns
    v = vectors[:, order[0]]
    v = v * np.sign(v[np.abs(v).argmax()])
    got = np.array([r["pc1"] for r in scored.collect()])
    assert np.allclose(got, z @ v, atol=1e-8)


def test_cluster_ids_are_stable(spark):
    rows = [(i, 0.0 + i % 3 * 0.1, 0.0) for i in range(9)] + [(i, 10.0 + i * 0.01, 5.0) for i in range(9, 13)] + [(20, -30.0, 2.0)]
    df = spark.createDataFrame(rows, "i int, x double, y double")
    for seed in (1, 2):
        out = clusters.assign_clusters(df, ["x", "y"], 3, n_init=4, seed=seed)
        assert {r["cluster_id"]: r["count"] for r in out.groupBy("cluster_id").count().collect()} == {0: 9, 1: 4, 2: 1}


def test_kmeans_search_finds_the_groups(spark):
    rng = np.random.default_rng(8)
    centres = np.array([[0, 0], [9, 0], [0, 9], [9, 9]], float)
    points = np.vstack([c + rng.normal(size=(60, 2)) * 0.5 for c in centres])
    df = spark.createDataFrame(pd.DataFrame(points, columns=["x", "y"])).repartition(5)
    fits = clusters.fit_kmeans(df, ["x", "y"], range(2, 7), 3)
    assert clusters.best_k(fits) == 4 and sorted(fits[4].sizes) == [60] * 4
    for k, fit in fits.items():
        gaps = ((points[:, None, :] - fit.centres) ** 2).sum(axis=2)
        label = gaps.argmin(axis=1)
        assert close(fit.inertia, gaps.min(axis=1).sum(), 1e-9) and sum(fit.sizes) == 240
        scores = []
        for i in range(len(points)):
            away = ((points - points[i]) ** 2).sum(axis=1)
            own = away[label == label[i]].sum() / max((label == label[i]).sum() - 1, 1)
            other = min(away[label == j].mean() for j in set(label) - {label[i]})
            scores.append((other - own) / max(own, other) if (label == label[i]).sum() > 1 else 0.0)
        assert close(fit.silhouette_sq, np.mean(scores), 1e-9)
    chosen = [r["k"] for r in clusters.kmeans_search(df, ["x", "y"], range(2, 7), 2).filter("is_chosen").collect()]
    sizes = clusters.assign_clusters(df, ["x", "y"], range(2, 7), 2).groupBy("cluster_id").count().collect()
    assert chosen == [4] and sorted(r["count"] for r in sizes) == [60] * 4


def test_kmeans_of_few_or_bad_rows(spark):
    same = spark.createDataFrame([(1.0,)] * 5, "x double")
    fit = clusters.fit_kmeans(same, ["x"], [3], 2)[3]
    assert fit.inertia == 0 and sorted(fit.sizes) == [0, 0, 5] and fit.silhouette_sq == 0
    assert {r["cluster_id"] for r in clusters.assign_clusters(same, ["x"], 3).collect()} == {0}
    with pytest.raises(ValueError):
        clusters.fit_kmeans(same.limit(0), ["x"], [2])
    with pytest.raises(Exception, match="finite"):
        clusters.fit_kmeans(spark.createDataFrame([(1.0,), (None,)], "x double"), ["x"], [2])


def test_cluster_entities_runs_both_ways(spark):
    rows = [(e, y, f"B{e}", float(e % 3 * 10 + RNG.normal()), float(RNG.normal()), None if y == 2021 and e == 1 else float(e)) for e in range(12) for y in (2020, 2021)]
    df = spark.createDataFrame(rows, "e int, y int, code string, a double, b double, c double")
    for first in (True, False):
        out = clusters.cluster_entities(df, "e", "y", ["a", "b", "c"], code="code", excluded=["B0"], scale_first=first, names={0: "big", 1: "mid", 2: "small"}, n_init=2)
        assert out.count() == 11 and out.filter("cluster_name IS NULL OR y <> 2021").count() == 0


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_binary_metrics(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.2), round(rng.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, p double")
    got = risk.binary_metrics(df, "y", "p", 0.3).first()
    tp = sum(y == 1 and p >= 0.3 for y, p in rows)
    assert got["tp"] == tp and close(got["recall"], tp / sum(y for y, _ in rows)) and close(got["auc"], brute_auc(rows))
    points = risk.roc_points(df, "y", "p").orderBy(F.desc("threshold")).collect()
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(points, points[1:]))
    assert close(area, got["auc"]) and points[0]["fpr"] == 0 and points[-1]["tpr"] == 1


def test_one_class_has_auc_zero(spark):
    df = spark.createDataFrame([(1, 0.4), (1, 0.6)], "y int, p double")
    assert risk.auc(df, "y", "p").first()[0] == 0.0
    assert risk.confusion(df, "y", "p", 0.9).first()["precision"] == 0.0


def test_threshold_tuning(spark):
    rng = random.Random(9)
    rows = [(int(i % 9 == 0), rng.random() * (0.6 if i % 9 == 0 else 0.3)) for i in range(300)]
    df = spark.createDataFrame(rows, "y int, p double")
    recall = lambda t: sum(y and p >= t for y, p in rows) / sum(y for y, _ in rows)
    good = [t for t in np.linspace(0.01, 0.5, 100) if recall(t) >= 0.85]
    got = risk.tune_threshold(df, "y", "p").first()
    assert close(got["threshold"], max(good)) and close(got["recall"], recall(max(good)))
    assert risk.tune_threshold(df, "y", "p", min_recall=1.1).first()["threshold"] == 0.5


def test_balanced_weight(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2, "y double")
    assert as_set(risk.balanced_weight(df, "y")) == {(0.0, 8 / 12), (1.0, 2.0)}


def test_risk_evaluation(spark):
    rng = random.Random(1)
    rows = [(2000 + i // 30, i, float(rng.random()), float(rng.random())) for i in range(600)]
    df = spark.createDataFrame(rows, "year int, id int, a double, b double").withColumn(
        "y", (F.col("a") + 0.2 * F.col("b") > 0.8).cast("double")
    )
    out = reports.risk_evaluation(df, ["a", "b"], "year", ["id"], "y", trees=10, depth=5)
    metrics = {r["model"]: r for r in out["metrics"].collect()}
    assert metrics["random_forest"]["auc"] > 0.95 and metrics["logistic"]["auc"] > 0.95
    assert metrics["random_forest"]["tp"] + metrics["random_forest"]["fn"] + metrics["random_forest"]["fp"] + metrics["random_forest"]["tn"] == 120
    assert {r["metric"]: r["passed"] for r in out["gates"].collect()}["auc"]


def test_large_training_sets_are_dealt_and_sorted(spark, monkeypatch):
    df = spark.range(0, 1000, 1, 1).select((F.col("id") * 7 % 100).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("y"))
    assert risk._dealt(df, ["a"]) is df
    monkeypatch.setattr(risk, "TRAIN_ROWS", 100)
    dealt = risk._dealt(df, ["a"])
    parts = [[r["a"] for r in p] for p in dealt.rdd.glom().collect()]
    assert len(parts) == 10 and max(map(len, parts)) < 200 and all(p == sorted(p) for p in parts)
    assert sorted(v for p in parts for v in p) == sorted(r["a"] for r in df.collect())
    model = risk.fit_risk_forest(df, ["a"], "y", trees=3, depth=3)
    assert model.getCacheNodeIds() and model.getNumTrees == 3


def test_gates_fit_no_baseline(spark, monkeypatch):
    def asked(*args):
        raise AssertionError("the gates do not ask for the logistic model")

    monkeypatch.setattr(reports, "fit_logistic", asked)
    rows = [(2000 + i // 30, i, i % 17 / 17, float(i % 17 > 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "year int, id int, a double, y double")
    out = reports.risk_evaluation(df, ["a"], "year", ["id"], "y", trees=3, depth=3, baseline=False)
    assert out["logistic"] is None and {r["metric"] for r in out["gates"].collect()} == {"auc", "recall"}
    assert [r["model"] for r in out["metrics"].collect()] == ["random_forest"]


def test_points_of_a_search_are_dealt_by_rows(spark, monkeypatch):
    df = spark.range(0, 1000, 1, 1).select(F.col("id").cast("double").alias("x"))
    assert clusters._dealt(df) is df
    monkeypatch.setattr(clusters, "SCAN_ROWS", 100)
    dealt = clusters._dealt(df)
    assert dealt.rdd.getNumPartitions() == 10 and sorted(r["x"] for r in dealt.collect()) == [float(i) for i in range(1000)]
    assert sum(clusters.fit_kmeans(df, ["x"], [2], 2)[2].sizes) == 1000


DAILY = Series.of("k", "t")


def test_ar_baseline_matches_least_squares(spark):
    series = {"a": np.cumsum(RNG.normal(size=120)), "b": np.cumsum(RNG.normal(size=60))}
    rows = [(k, i, float(x)) for k, v in series.items() for i, x in enumerate(v)]
    rows += [("short", i, float(i * i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(3)
    got = forecast.ar_diff_baseline(df, DAILY, "v", 5).collect()
    for k, v in series.items():
        cut = int(len(v) * 0.8)
        d = np.diff(v[:cut])
        x = np.column_stack([d[5 - i : len(d) - i] for i in range(1, 6)])
        phi = np.linalg.lstsq(x, d[5:], rcond=None)[0]
        state, level, path = list(d[::-1][:5]), v[cut - 1], []
        for _ in range(len(v) - cut):
            move = float(np.dot(phi, state))
            level += move
            state = [move, *state[:4]]
            path.append(level)
        mine = [r["predicted"] for r in sorted((r for r in got if r["k"] == k), key=lambda r: r["t"])]
        assert np.allclose(mine, path, rtol=1e-6, atol=1e-6)
    short = [r["predicted"] for r in got if r["k"] == "short"]
    assert short == [np.mean([0, 1, 4, 9])]  # too few rows to fit: the training mean


def test_moving_average_baseline(spark):
    v = [1.0, 2.0, 3.0, 4.0, 5.0, 9.0, 1.0]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(v)], "k string, t int, v double")
    got = forecast.ma_baseline(df, DAILY, "v", 5).first()
    errors = [9 - 3.0, 1 - 4.6]
    assert got["n"] == 2 and close(got["rmse"], math.sqrt(np.mean(np.square(errors)))) and close(got["mae"], np.mean(np.abs(errors)))


def test_forecaster_learns_a_linear_rule(spark):
    rows = []
    for k in ("a", "b"):
        v = [100.0, 101.0]
        for i in range(260):
            v.append(1.6 * v[-1] - 0.64 * v[-2] + 4.0 + math.sin(i) * (1 if k == "a" else 2))
        rows += [(k, i, x, math.sin(i)) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "k string, t int, v double, w double")
    out = forecast.train_forecaster(df, DAILY, "v", {"one": ["v"], "two": ["v", "w"]}, horizon=3, window=6, history=200, ridge=1e-9)
    pooled = {(r["k"], r["model"]): r for r in out["pooled"].collect()}
    n_test = (200 - 6 - 3 + 1) - int((200 - 6 - 3 + 1) * 0.8)
    assert pooled["a", "one"]["n"] == 3 * n_test
    assert all(r["rmse"] < 0.05 for r in pooled.values())
    assert as_set(out["predictions"], "k", "horizon", "model", "base") == {
        (k, f"T+{h}", m, 261) for k in ("a", "b") for h in (1, 2, 3) for m in ("one", "two")
    }
    assert out["best"].count() == 2 and out["metrics"].count() == 12


def test_business_days(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-01-03",)], "d string")
    got = {(r["d"], r["horizon"]): str(r["forecast_date"]) for r in forecast.forecast_dates(df, "d").collect()}
    assert got["2024-01-05", "T+1"] == "2024-01-08" and got["2024-01-05", "T+5"] == "2024-01-12"
    assert got["2024-01-03", "T+3"] == "2024-01-08"
