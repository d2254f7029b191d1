"""Report frames behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions.scalars import key_to_date, threshold_label
from ledgerline.operators.aggregates import monthly_flow
from ledgerline.operators.clusters import cluster_entities
from ledgerline.operators.filters import last_n_periods, recent, rows_of_flagged, top_k
from ledgerline.operators.joins import join_latest
from ledgerline.operators.reshape import union_all
from ledgerline.operators.risk import (
    acceptance,
    binary_metrics,
    fit_logistic,
    fit_risk_forest,
    score,
    tune_threshold,
)
from ledgerline.operators.windows import latest_row, time_split
from ledgerline.storage import checkpointed, stored


def price_history(fact: DataFrame, key: str, value, n: int = 60) -> DataFrame:
    """Last n days of one series, oldest first."""
    return recent(fact.filter(F.col(key) == F.lit(value)), "date_key", n)


def money_flow(fact: DataFrame, key: str, months: int = 24, unit: float = 1e9) -> DataFrame:
    """Monthly traded value per key and share of the month, over the last months."""
    dated = fact.withColumns({"full_date": key_to_date("date_key"), "__m": F.floor(F.col("date_key") / 100)})
    return monthly_flow(last_n_periods(dated, "__m", months), "full_date", key, "trading_value", unit)


def cluster_overview(clusters: DataFrame, fact: DataFrame, entity: str, order: str, cols: Sequence[str]) -> DataFrame:
    """Cluster members with their latest figures."""
    return join_latest(clusters, fact.select(entity, order, *cols), entity, order).drop(order)


def flagged_trend(predictions: DataFrame, entity: str, label: str) -> DataFrame:
    """Whole history of every entity that was flagged at least once."""
    return rows_of_flagged(predictions, entity, F.col(label) == 1)


def risk_evaluation(
    df: DataFrame,
    features: Sequence[str],
    order: str,
    ties: Sequence[str],
    label: str,
    trees: int = 200,
    depth: int = 10,
    baseline: bool = True,
) -> dict:
    """Time split, forest, tuned threshold, metrics, gates and the logistic baseline on the same split.

    The threshold is tuned on the last fifth of the training rows, not on the test rows. Without `baseline` there is no logistic
    model (None) and no row of it; the gates ask the forest alone.
    """
    # Stored once: the splits, class counts and both models read these rows many times.
    rows = checkpointed(df.dropna(subset=[*features, label]))
    marked = time_split(rows, order, ties, fixed.TRAIN_SHARE)
    train = marked.filter("is_train").drop("is_train")
    test = marked.filter("NOT is_train").drop("is_train")
    inner = time_split(train, order, ties, fixed.TRAIN_SHARE)
    probe = fit_risk_forest(inner.filter("is_train"), features, label, trees, depth)
    # Scores are stored: a row passes all trees once, however often its score is read.
    scored = lambda model, rows: stored(score(model, rows, features).select(label, "risk_probability"))
    tuned = tune_threshold(scored(probe, inner.filter("NOT is_train")), label, "risk_probability").first()
    forest = fit_risk_forest(train, features, label, trees, depth)
    logistic = fit_logistic(train, features, label) if baseline else None
    named = lambda model, name, t: binary_metrics(
        scored(model, test), label, "risk_probability", t
    ).withColumns({"model": F.lit(name), "threshold": F.lit(float(t))})
    of_forest = metrics = named(forest, "random_forest", tuned["threshold"])
    if baseline:
        metrics = metrics.unionByName(named(logistic, "logistic", 0.5))
    return {
        "forest": forest,
        "logistic": logistic,
        "threshold": float(tuned["threshold"]),
        "metrics": metrics,
        "gates": acceptance(
            of_forest,
            {"auc": (">", fixed.AUC_GATE), "recall": (">=", fixed.RECALL_GATE)},
        ),
    }


def risk_labels(df: DataFrame, ratio: str = "npl_ratio", threshold: float = fixed.RISK_THRESHOLD) -> DataFrame:
    return df.withColumn("risk_label", threshold_label(ratio, threshold))


def bank_clusters(fact: DataFrame, dim: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """Cluster assignment of the banks by their latest ratios."""
    joined = fact.join(dim.filter("is_current").select("bank_key", "bank_code", "bank_name", "bank_type"), "bank_key")
    return cluster_entities(
        joined,
        "bank_key",
        "date_key",
        fixed.CAMELS_FEATURES,
        code="bank_code",
        excluded=fixed.EXCLUDED_BANKS,
        names=names,
    )


def summary_report(
    prices: DataFrame,
    predictions: DataFrame,
    clusters: DataFrame,
    risk: DataFrame,
    importance: DataFrame,
    key: str = "stock_key",
    entity: str = "bank_key",
) -> DataFrame:
    """(section, item, value): last close and forecasts per series, cluster sizes, flagged count, top feature."""

    def lines(df: DataFrame, section: str, item: Column, value: Column) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), item.cast("string").alias("item"), value.cast("string").alias("value")
        )

    last = latest_row(prices, [key], "date_key")
    ends = predictions.filter(F.col("horizon").isin("T+1", f"T+{fixed.FORECAST_HORIZON}"))
    sizes = clusters.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    flagged = risk.filter("risk_label = 1").agg(F.count_distinct(entity).alias("n"))
    label = F.concat_ws(" ", F.col(key).cast("string"), "model", "horizon")
    return union_all(
        [
            lines(last, "last_close", F.col(key), F.round("close_price", 2)),
            lines(ends, "forecast", label, F.round("predicted", 2)),
            lines(sizes, "cluster_size", F.col("cluster_id"), F.col("n")),
            lines(flagged, "flagged_entities", F.lit("count"), F.col("n")),
            lines(top_k(importance, "importance", 1, ["feature"]), "top_feature", F.col("feature"), F.round("importance", 4)),
        ]
    )
