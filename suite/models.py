"""Clustering, classification, regression and causality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import clusters as CL
from ledgerline.operators import econometrics as EC
from ledgerline.operators import risk as RK
from ledgerline.operators.ordered import union_of
from ledgerline.operators.scaling import zscore
from ledgerline.operators.windows import time_split
from ledgerline.plans import reports
from ledgerline.storage import checkpointed, stored
from suite.registry import query
from suite.timeseries import forecaster
from suite.views import (
    EMBEDDING_COLUMNS,
    FEATURES,
    NATIONS,
    PANEL,
    SCORED,
    bars,
    customer_features,
    nation_panel,
    panel,
    rounded,
    scored,
    table,
    vectors,
)


def _standardised(spark, sf):
    scaled = zscore(customer_features(spark, sf), FEATURES)
    return scaled.select("entity", *[F.col(f"{c}_z").alias(c) for c in FEATURES])


@query("pca_scores")
def pca_scores(spark, sf):
    return CL.pca_project(_standardised(spark, sf), FEATURES)[0]


@query("pca_variance")
def pca_variance(spark, sf):
    scaled = zscore(vectors(spark, sf), EMBEDDING_COLUMNS, suffix="")
    return CL.pca_project(scaled, EMBEDDING_COLUMNS)[1]


@query("cluster_search")
def cluster_search(spark, sf):
    return CL.kmeans_search(_standardised(spark, sf), FEATURES)


@query(
    "cluster_search_checks",
    """SELECT CAST(k AS INTEGER) AS k, (SELECT count(DISTINCT o_custkey) FROM orders) AS n, true AS inertia_holds, true AS sizes_hold,
    true AS chosen_is_best FROM range(2, 11) t(k)""",
)
def cluster_search_checks(spark, sf):
    """The search against its own rows: every row has a cluster, the sums of squares follow from the rows' means, and the chosen k
    is the one with the best silhouette."""
    rows = checkpointed(_standardised(spark, sf))
    fits = CL.fit_kmeans(rows, FEATURES, range(2, 11), 4)
    pick, best = CL.best_k(fits), max(f.silhouette_sq for f in fits.values())
    out = []
    for k, fit in fits.items():
        held = CL.nearest_centre(rows, FEATURES, fit).groupBy("cluster_id").agg(
            F.count(F.lit(1)).alias("n"), sum((F.var_pop(c) for c in FEATURES), F.lit(0.0)).alias("spread")
        )
        sizes = F.array(*[F.lit(int(n)).cast("bigint") for n in sorted(fit.sizes[fit.sizes > 0])])
        summed = held.agg(
            F.lit(k).alias("k"),
            F.sum("n").alias("n"),
            (F.abs(F.sum(F.col("n") * F.col("spread")) / F.lit(fit.inertia) - 1) < 1e-3).alias("inertia_holds"),
            (F.sort_array(F.collect_list("n")) == sizes).alias("sizes_hold"),
            F.lit((k == pick) <= (fit.silhouette_sq == best)).alias("chosen_is_best"),
        )
        out.append(summed)
    return union_of(out)


DIST = "sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"


@query(
    "silhouette_of_labels",
    f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({DIST}) AS s, count(*) AS n
      FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
    p AS (SELECT vec_id, max(CASE WHEN own = other THEN s / n END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b
      FROM d GROUP BY 1)
    SELECT round(avg((b - a) / greatest(a, b)), 8) AS silhouette FROM p""",
)
def silhouette_of_labels(spark, sf):
    """Exact Euclidean silhouette of the labelled vectors."""
    return rounded(CL.silhouette(vectors(spark, sf), "vec_id", "label", EMBEDDING_COLUMNS, 250), 8)


@query(
    "davies_bouldin_of_labels",
    f"""WITH e AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2),
    s AS (SELECT label, avg(d) AS s FROM (SELECT vec_id, e.label, sqrt(sum((x - m) * (x - m))) AS d FROM e JOIN c USING (label, i)
      GROUP BY 1, 2) GROUP BY 1),
    g AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label
      GROUP BY 1, 2)
    SELECT round(avg(r), 8) AS davies_bouldin FROM (SELECT la, max((x.s + y.s) / d) AS r FROM g JOIN s x ON la = x.label
      JOIN s y ON lb = y.label GROUP BY 1)""",
)
def davies_bouldin_of_labels(spark, sf):
    return rounded(CL.davies_bouldin(vectors(spark, sf), "label", EMBEDDING_COLUMNS), 8)


@query("entity_clusters")
def entity_clusters(spark, sf):
    """Latest ratios per nation, standardised, reduced and clustered, with names."""
    return CL.cluster_entities(
        nation_panel(spark, sf).drop("bank_type"),
        "bank_key",
        "date_key",
        ["npl_ratio", "llp_ratio", "roa", "nim"],
        code="bank_code",
        excluded=["NATION_0", "NATION_7"],
        names={0: "large group", 1: "middle group", 2: "small group"},
    )


@query(
    "cluster_overview",
    f"""WITH {NATIONS}, l AS (SELECT *, row_number() OVER (PARTITION BY bank_key ORDER BY date_key DESC) AS rn FROM nations)
    SELECT c.c_custkey, c.c_mktsegment, round(npl_ratio, 6) AS npl_ratio, round(roa, 6) AS roa FROM customer c
    LEFT JOIN l ON bank_key = c_nationkey AND rn = 1""",
)
def cluster_overview(spark, sf):
    members = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("bigint").alias("bank_key"))
    out = reports.cluster_overview(members, nation_panel(spark, sf), "bank_key", "date_key", ["npl_ratio", "roa"])
    return rounded(out.drop("bank_key"))


@query(
    "cluster_sizes",
    """SELECT label, count(*) AS n, round(count(*) / (SELECT count(*) FROM embeddings), 6) AS share FROM embeddings GROUP BY 1""",
)
def cluster_sizes(spark, sf):
    return rounded(CL.cluster_sizes(table(spark, sf, "embeddings"), "label"))


@query(
    "balanced_weights",
    """WITH n AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
    SELECT doc_id, round((SELECT sum(n) FROM n) / ((SELECT count(*) FROM n) * n), 6) AS weight FROM labels JOIN n USING (quality)""",
)
def balanced_weights(spark, sf):
    return rounded(RK.balanced_weight(table(spark, sf, "labels"), "quality").select("doc_id", "weight"))


RISK_FEATURES = ["llp_ratio", "n_orders", "largest", "smallest", "total"]


def _risk_rows(spark, sf):
    """Yearly customer rows, high risk when the finished share is above one half."""
    return (
        panel(spark, sf)
        .na.fill(0.0, ["npl_ratio", "llp_ratio"])
        .withColumn("risk_label", (F.col("npl_ratio") >= 0.5).cast("double"))
        .withColumn("n_orders", F.col("n_orders").cast("double"))
    )


def _evaluated(spark, sf, baseline=True):
    return reports.risk_evaluation(
        _risk_rows(spark, sf), RISK_FEATURES, "year", ["entity"], "risk_label", baseline=baseline
    )


@query("risk_model_metrics")
def risk_model_metrics(spark, sf):
    """Forest and logistic baseline on the last fifth of the rows by year."""
    return _evaluated(spark, sf)["metrics"]


@query("risk_gates")
def risk_gates(spark, sf):
    return _evaluated(spark, sf, baseline=False)["gates"]


def _forest(spark, sf):
    rows = checkpointed(_risk_rows(spark, sf))
    train = time_split(rows, "year", ["entity"]).filter("is_train")
    return RK.fit_risk_forest(train, RISK_FEATURES, "risk_label")


@query("feature_importance")
def feature_importance(spark, sf):
    return RK.feature_importance(spark, _forest(spark, sf), RISK_FEATURES)


@query("risk_predictions")
def risk_predictions(spark, sf):
    """Label, probability and actual ratio of every yearly row."""
    rows = _risk_rows(spark, sf).drop("risk_label")
    return RK.score_risk(_forest(spark, sf), rows, RISK_FEATURES, 0.4, "npl_ratio", ["entity", "year"], "forest")


@query("flagged_trend")
def flagged_trend(spark, sf):
    rows = _risk_rows(spark, sf).drop("risk_label")
    scores = RK.score_risk(_forest(spark, sf), rows, RISK_FEATURES, 0.6, "npl_ratio", ["entity", "year"], "forest")
    return reports.flagged_trend(stored(scores), "entity", "risk_label")


AUC_SQL = """(SELECT sum(CASE WHEN p.prob > n.prob THEN 1.0 WHEN p.prob = n.prob THEN 0.5 ELSE 0 END) / count(*)
      FROM scored p, scored n WHERE p.label = 1 AND n.label = 0)"""


@query(
    "binary_metrics",
    f"""WITH {SCORED}, c AS (SELECT count(*) FILTER (label = 1 AND prob >= 0.4) AS tp, count(*) FILTER (label = 0 AND prob >= 0.4) AS fp,
      count(*) FILTER (label = 1 AND prob < 0.4) AS fn, count(*) FILTER (label = 0 AND prob < 0.4) AS tn FROM scored)
    SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
    round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
    round(CAST({AUC_SQL} AS DOUBLE), 6) AS auc FROM c""",
)
def binary_metrics(spark, sf):
    return rounded(RK.binary_metrics(scored(spark, sf), "label", "prob", 0.4))


@query(
    "auc_of_large_table",
    """WITH s AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_extendedprice AS p FROM lineitem),
    r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM s),
    c AS (SELECT sum(r) FILTER (y = 1) AS w, count(*) FILTER (y = 1) AS np, count(*) FILTER (y = 0) AS nn FROM r)
    SELECT round((w - np * (np + 1) / 2) / (np * nn), 6) AS auc FROM c""",
)
def auc_of_large_table(spark, sf):
    """Rank AUC of price for returned items: exact, with the order cut into value segments."""
    rows = table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(RK.auc(rows, "y", "l_extendedprice"))


@query(
    "roc_points",
    f"""WITH {SCORED}, t AS (SELECT DISTINCT prob AS threshold FROM scored)
    SELECT round(threshold, 6) AS threshold, round(count(*) FILTER (label = 0 AND prob >= threshold) / max(nn), 6) AS fpr,
    round(count(*) FILTER (label = 1 AND prob >= threshold) / max(np), 6) AS tpr FROM t, scored,
    (SELECT count(*) FILTER (label = 1) AS np, count(*) FILTER (label = 0) AS nn FROM scored) GROUP BY t.threshold
    UNION ALL SELECT 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE""",
)
def roc_points(spark, sf):
    return rounded(RK.roc_points(scored(spark, sf), "label", "prob"))


@query(
    "tuned_threshold",
    f"""WITH {SCORED}, g AS (SELECT 0.01::DOUBLE + i * (0.49::DOUBLE / 99) AS t FROM range(100) r(i)),
    c AS (SELECT t, count(*) FILTER (label = 1 AND prob >= t) / count(*) FILTER (label = 1) AS recall FROM g, scored GROUP BY 1)
    SELECT round(t, 6) AS threshold, round(recall, 6) AS recall FROM c WHERE recall >= 0.85 ORDER BY t DESC LIMIT 1""",
)
def tuned_threshold(spark, sf):
    return rounded(RK.tune_threshold(scored(spark, sf), "label", "prob"))


@query(
    "acceptance_gates",
    f"""WITH {SCORED}, r AS (SELECT count(*) FILTER (label = 1 AND prob >= 0.4) / count(*) FILTER (label = 1) AS recall,
      CAST({AUC_SQL} AS DOUBLE) AS auc FROM scored)
    SELECT 'auc' AS metric, round(auc, 6) AS value, 0.8::DOUBLE AS threshold, auc > 0.8 AS passed FROM r
    UNION ALL SELECT 'recall', round(recall, 6), 0.85, recall >= 0.85 FROM r""",
)
def acceptance_gates(spark, sf):
    return rounded(RK.acceptance(RK.binary_metrics(scored(spark, sf), "label", "prob", 0.4), RK.RISK_GATES))


@query(
    "ols_regression",
    """WITH m AS (SELECT count(*) AS n, avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
      covar_pop(l_quantity, l_quantity) AS s11, covar_pop(l_discount, l_discount) AS s22,
      covar_pop(l_quantity, l_discount) AS s12, covar_pop(l_quantity, l_extendedprice) AS s1y,
      covar_pop(l_discount, l_extendedprice) AS s2y, var_pop(l_extendedprice) AS syy FROM lineitem),
    b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m),
    r AS (SELECT *, 1 - (syy - b1 * s1y - b2 * s2y) / syy AS r2 FROM b)
    SELECT term, round(coef, 4) AS coef, n AS nobs, round(r2, 6) AS r2 FROM (
      SELECT 'const' AS term, my - b1 * m1 - b2 * m2 AS coef, n, r2 FROM r
      UNION ALL SELECT 'l_quantity', b1, n, r2 FROM r UNION ALL SELECT 'l_discount', b2, n, r2 FROM r)""",
)
def ols_regression(spark, sf):
    fit = EC.ols(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"])
    return rounded(fit.select("term", "coef", F.col("nobs").cast("bigint").alias("nobs"), "r2"), 6, coef=4)


@query(
    "panel_fixed_effects",
    f"""WITH {PANEL}, k AS (SELECT entity, npl_ratio AS y, llp_ratio AS x FROM panel WHERE npl_ratio IS NOT NULL AND llp_ratio IS NOT NULL),
    d AS (SELECT y - avg(y) OVER w AS y, x - avg(x) OVER w AS x FROM k WINDOW w AS (PARTITION BY entity)),
    b AS (SELECT sum(x * y) / sum(x * x) AS b, sum(y * y) - sum(x * y) * sum(x * y) / sum(x * x) AS ssr, sum(x * x) AS sxx FROM d),
    t AS (SELECT var_pop(y) * count(*) AS sst, count(*) AS n, count(DISTINCT entity) AS g FROM k)
    SELECT 'llp_ratio' AS term, round(b, 6) AS coef, round(sqrt(ssr / (n - 1 - g) / sxx), 6) AS std_err, n AS nobs,
    round(1 - ssr / sst, 6) AS r2, round(1 - ssr / sst * (n - 1) / (n - 1 - g), 6) AS adj_r2 FROM b, t""",
)
def panel_fixed_effects(spark, sf):
    """One regressor with an effect per customer, from per-entity moments."""
    fit = EC.panel_fe(panel(spark, sf), "entity", "npl_ratio", ["llp_ratio"]).filter("term <> 'const'")
    return rounded(fit.select("term", "coef", "std_err", F.col("nobs").cast("bigint").alias("nobs"), "r2", "adj_r2"))


@query("lagged_panel_regression")
def lagged_panel_regression(spark, sf):
    return EC.lagged_panel(nation_panel(spark, sf), "bank_key", "year", "npl_ratio", "llp_ratio")


def _partial_sql(term: str, p: str, q: str) -> str:
    """Coefficient of one of three regressors: y on what the other two leave of it."""
    on_p = lambda c: f"(SELECT sum({p} * {c}) / sum({p} * {p}) FROM d)"
    q1 = f"({q} - {on_p(q)} * {p})"
    left = f"{term} - {on_p(term)} * {p} - (SELECT sum({q1} * {term}) / sum({q1} * {q1}) FROM d) * {q1}"
    return f"SELECT '{term}' AS term, round(sum(y * e) / sum(e * e), 6) AS coef, count(*) AS nobs FROM (SELECT y, {left} AS e FROM d)"


LAG_TERMS = ["npl_ratio_lag1", "llp_ratio_lag1", "llp_ratio_lag2"]


@query(
    "lagged_panel_coefficients",
    f"""WITH {NATIONS}, l AS (SELECT bank_key, npl_ratio AS y, lag(npl_ratio) OVER w AS npl_ratio_lag1,
      lag(llp_ratio) OVER w AS llp_ratio_lag1, lag(llp_ratio, 2) OVER w AS llp_ratio_lag2
      FROM nations WINDOW w AS (PARTITION BY bank_key ORDER BY year)),
    k AS (SELECT * FROM l WHERE y IS NOT NULL AND npl_ratio_lag1 IS NOT NULL AND llp_ratio_lag1 IS NOT NULL
      AND llp_ratio_lag2 IS NOT NULL),
    d AS (SELECT {", ".join(f"{c} - avg({c}) OVER w AS {c}" for c in ["y", *LAG_TERMS])} FROM k WINDOW w AS (PARTITION BY bank_key)) """
    + " UNION ALL ".join(_partial_sql(t, *[o for o in LAG_TERMS if o != t]) for t in LAG_TERMS),
)
def lagged_panel_coefficients(spark, sf):
    fit = EC.lagged_panel(nation_panel(spark, sf), "bank_key", "year", "npl_ratio", "llp_ratio")
    return rounded(fit.filter("term <> 'const'").select("term", "coef", F.col("nobs").cast("bigint").alias("nobs")))


def _monthly(spark, sf):
    """System-wide monthly means."""
    orders = table(spark, sf, "orders")
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("month")
    share = lambda s, n: F.avg((F.col("o_orderstatus") == s).cast("double")).alias(n)
    return orders.groupBy(month).agg(share("F", "npl_ratio"), share("O", "llp_ratio"))


@query("unit_root_test")
def unit_root_test(spark, sf):
    monthly = _monthly(spark, sf)
    return EC.adf_test(monthly, "month", "npl_ratio").unionByName(EC.adf_test(monthly, "month", "llp_ratio"))


@query("granger_causality")
def granger_causality(spark, sf):
    return EC.granger(_monthly(spark, sf), "month", "npl_ratio", "llp_ratio")


@query(
    "granger_by_nation",
    """WITH m AS (SELECT c_nationkey AS nation, year(o_orderdate) * 100 + month(o_orderdate) AS month, avg(CAST(o_totalprice AS DOUBLE)) AS y,
      CAST(count(*) AS DOUBLE) AS x FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    l AS (SELECT nation, y, lag(y) OVER w AS y1, lag(x) OVER w AS x1 FROM m WINDOW w AS (PARTITION BY nation ORDER BY month)),
    s AS (SELECT nation, count(y1) AS n, covar_pop(y, y) FILTER (y1 IS NOT NULL) AS yy, covar_pop(y, y1) AS yp, covar_pop(y1, y1) AS pp,
      covar_pop(y, x1) AS yx, covar_pop(x1, x1) AS xx, covar_pop(x1, y1) AS xp FROM l GROUP BY 1),
    g AS (SELECT nation, n, yy - yp * yp / pp AS ssr, (yx - yp * xp / pp) * (yx - yp * xp / pp) / nullif(xx - xp * xp / pp, 0) AS gain FROM s)
    SELECT CAST(nation AS BIGINT) AS nation, n AS nobs, round(CASE WHEN n > 3 THEN gain / (ssr - gain) * (n - 3) END, 6) AS f_stat,
    round(CASE WHEN n > 3 THEN gain / (ssr - gain) * n END, 6) AS chi2 FROM g""",
)
def granger_by_nation(spark, sf):
    """Do order counts foretell mean order values? One lag, every nation in one job."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month")
    monthly = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").cast("bigint").alias("nation"), month)
    found = EC.granger_by(monthly.agg(F.avg(F.col("o_totalprice").cast("double")).alias("y"), F.count(F.lit(1)).alias("x")), "nation", "month", "y", "x", 1)
    return rounded(found.select("nation", "nobs", "f_stat", "chi2"))


@query("causality_analysis")
def causality_analysis(spark, sf):
    """Unit-root tests decide between levels and differences for the causality test."""
    return EC.causality(_monthly(spark, sf), "month", "npl_ratio", "llp_ratio")["granger"]


@query("executive_summary")
def executive_summary(spark, sf):
    predictions = forecaster(spark, sf)["predictions"]
    rows = _risk_rows(spark, sf).drop("risk_label")
    forest = _forest(spark, sf)
    risk = RK.score_risk(forest, rows, RISK_FEATURES, 0.5, "npl_ratio", ["entity", "year"], "forest")
    return reports.summary_report(
        bars(spark, sf),
        predictions,
        entity_clusters(spark, sf),
        risk,
        RK.feature_importance(spark, forest, RISK_FEATURES),
        key="ticker",
        entity="entity",
    )


