"""Binary risk classification and its evaluation."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.operators.clusters import assemble
from ledgerline.operators.ordered import constants, running_totals
from ledgerline.operators.reshape import rows_of
from ledgerline.storage import checkpointed


def balanced_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight n / (classes * rows of the class); one count per class is read when the plan is built."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counts)
    weight = F.lit(None).cast("double")
    for r in counts:
        weight = F.when(F.col(label).eqNullSafe(F.lit(r[label])), F.lit(total / (len(counts) * r["n"]))).otherwise(weight)
    return df.withColumn(out, weight)


TRAIN_ROWS = 100_000


def _dealt(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Large training sets in partitions of some 100,000 rows, sorted: neighbours pass the same nodes of each tree, whose statistics
    then stay in the processor's cache. The bags of a partition (a number a tree and row) fit an executor's storage."""
    parts = math.ceil(rows.count() / TRAIN_ROWS)
    if parts <= 1:
        return rows
    parts = max(parts, rows.sparkSession.sparkContext.defaultParallelism)
    return checkpointed(rows.repartition(parts).sortWithinPartitions(*features))


def fit_risk_forest(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 200,
    depth: int = 10,
    min_leaf: int = 2,
    seed: int = 42,
):
    """Random forest with balanced class weights.

    Every row's node in every tree is kept between levels instead of walked to from the root; the trees are the same.
    """
    weighted = balanced_weight(train.dropna(subset=[*features, label]), label).select(*features, label, "weight")
    ready = assemble(_dealt(weighted, features), features)
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt",
        cacheNodeIds=True,
        checkpointInterval=-1,
        seed=seed,
    )
    return forest.fit(ready.select("features", label, "weight"))


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, c: float = 1.0, max_iter: int = 1000):
    """Weighted logistic regression with an L2 penalty of strength 1/c on raw coefficients."""
    ready = assemble(balanced_weight(train.dropna(subset=[*features, label]), label), features)
    n = ready.count()
    model = LogisticRegression(
        featuresCol="features",
        labelCol=label,
        weightCol="weight",
        maxIter=max_iter,
        regParam=1.0 / (c * n),
        standardization=False,
    )
    return model.fit(ready.select("features", label, "weight"))


def feature_importance(spark, model, features: Sequence[str]) -> DataFrame:
    values = model.featureImportances.toArray()
    rows = sorted(zip(features, map(float, values)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(
        [(i + 1, f, v) for i, (f, v) in enumerate(rows)], "rank int, feature string, importance double"
    )


def score(model, df: DataFrame, features: Sequence[str], out: str = "risk_probability") -> DataFrame:
    """Probability of class 1 for every row with complete features."""
    scored = model.transform(assemble(df.dropna(subset=list(features)), features))
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def score_risk(
    model, df: DataFrame, features: Sequence[str], threshold: float, actual: str, keep: Sequence[str], name: str
) -> DataFrame:
    """Prediction table: identifying columns, label at the threshold, probability and the actual value."""
    return score(model, df, features).select(
        *keep,
        (F.col("risk_probability") >= threshold).cast("bigint").alias("risk_label"),
        "risk_probability",
        F.col(actual).alias("actual_npl_ratio"),
        F.lit(name).alias("model_name"),
    )


def _by_score(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Positives and negatives per distinct score: ties collapse before anything is ordered."""
    p = F.col(prob).cast("double")
    return (
        df.select(p.alias("score"), F.col(label).alias("y"))
        .filter("score IS NOT NULL AND y IS NOT NULL")
        .groupBy("score")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    )


def auc(df: DataFrame, label: str, prob: str) -> DataFrame:
    """(auc): exact rank AUC, ties counted half; 0 when only one class is present."""
    ordered = running_totals(_by_score(df, label, prob), "score", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2.0))
    return ordered.agg(
        F.coalesce(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")), F.lit(0.0)).alias("auc")
    )


def roc_points(df: DataFrame, label: str, prob: str) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, plus the origin at an infinite threshold."""
    ordered = running_totals(_by_score(df, label, prob), "score", ["pos", "neg"])
    total = constants(_by_score(df, label, prob).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    left = lambda c: (total[c] - F.col(f"cum_{c}") + F.col(c)).cast("double")
    points = ordered.select(
        F.col("score").alias("threshold"),
        F.try_divide(left("neg"), total["neg"]).alias("fpr"),
        F.try_divide(left("pos"), total["pos"]).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def confusion(df: DataFrame, label: str, prob: str, threshold: float) -> DataFrame:
    """(tp, fp, fn, tn, precision, recall, f1, accuracy) at a threshold; undefined ratios are 0."""
    y, hit = F.col(label) == 1, F.col(prob) >= threshold
    counts = df.agg(
        F.count_if(y & hit).alias("tp"),
        F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"),
        F.count_if(~y & ~hit).alias("tn"),
    )
    part = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "precision": part(tp, tp + fp),
            "recall": part(tp, tp + fn),
            "f1": part(2 * tp, 2 * tp + fp + fn),
            "accuracy": part(tp + tn, tp + fp + fn + tn),
        }
    )


def binary_metrics(df: DataFrame, label: str, prob: str, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, derived ratios and exact AUC in one row."""
    return confusion(df, label, prob, threshold).withColumn("auc", auc(df, label, prob).scalar())


def threshold_grid(lo: float = 0.01, hi: float = 0.50, n: int = 100) -> list[float]:
    return [float(t) for t in np.linspace(lo, hi, n)]


def tune_threshold(
    df: DataFrame,
    label: str,
    prob: str,
    grid: Sequence[float] | None = None,
    min_recall: float = fixed.RECALL_GATE,
    default: float = 0.5,
) -> DataFrame:
    """(threshold, recall): the largest grid value whose recall is high enough, else the default."""
    grid = sorted(grid or threshold_grid())
    points = F.array(*[F.lit(g) for g in grid])
    # How many grid values a positive clears; the recall curve is the running count of these few groups.
    cleared = F.size(F.filter(points, lambda g: g <= F.col(prob)))
    counts = df.filter(F.col(label) == 1).select(cleared.alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    listed = counts.agg(F.collect_list(F.struct("k", "n")).alias("all"), F.sum("n").alias("p"))

    def recall(i: Column) -> Column:
        above = F.filter(F.col("all"), lambda x: x["k"] > i)
        return F.try_divide(F.aggregate(above, F.lit(0).cast("bigint"), lambda t, x: t + x["n"]), F.col("p"))

    curve = F.transform(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(g).alias("t")) for i, g in enumerate(grid)]),
        lambda x: F.struct(x["t"].alias("threshold"), recall(x["i"]).alias("recall")),
    )
    good = F.array_max(F.filter(curve, lambda x: x["recall"] >= min_recall))
    at_default = df.agg(
        F.try_divide(F.count_if((F.col(label) == 1) & (F.col(prob) >= default)), F.count_if(F.col(label) == 1))
    ).scalar()
    return listed.select(good.alias("g")).select(
        F.coalesce(F.col("g.threshold"), F.lit(default)).alias("threshold"),
        F.coalesce(F.col("g.recall"), at_default, F.lit(0.0)).alias("recall"),
    )


def acceptance(metrics: DataFrame, rules: Mapping[str, tuple[str, float]]) -> DataFrame:
    """(metric, value, threshold, passed) for a one-row metrics frame; rules give (operator, threshold)."""

    def gate(name: str, op: str, limit: float) -> Column:
        v = F.col(name).cast("double")
        passed = {">": v > limit, ">=": v >= limit, "<": v < limit, "<=": v <= limit}[op]
        return F.struct(
            F.lit(name).alias("metric"),
            v.alias("value"),
            F.lit(float(limit)).alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    return rows_of(metrics, F.array(*[gate(n, op, t) for n, (op, t) in rules.items()]))


RISK_GATES = {"auc": (">", fixed.AUC_GATE), "recall": (">=", fixed.RECALL_GATE)}
