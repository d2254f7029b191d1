"""Grouped summaries and column descriptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.moments import correlation
from ledgerline.functions.scalars import month_label
from ledgerline.operators.ordered import constants, exact_percentiles
from ledgerline.operators.reshape import melt, rows_of
from ledgerline.operators.scaling import minmax
from ledgerline.operators.series import join_on


def group_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def peer_compare(
    df: DataFrame, entity: str, kind: str, year: str, metric: str, which=None
) -> DataFrame:
    """(year, entity, series, value): an entity's yearly mean next to its type's and the system's.

    With `which` one entity is compared over every year any of the three series has (outer join). Without it
    all entities are compared over their own years. The input is read and shuffled once: type and system
    means are rolled up from the per-entity sums.
    """
    base = df.groupBy(year, kind, entity).agg(
        F.sum(F.col(metric).cast("double")).alias("s"), F.count(metric).alias("n")
    )
    mean = F.try_divide(F.sum("s"), F.sum("n"))
    system = base.groupBy(year).agg(mean.alias("system"))
    types = base.groupBy(year, kind).agg(mean.alias("type"))
    own = base.select(entity, kind, year, F.try_divide(F.col("s"), F.col("n")).alias("own"))
    series = ["own", "type", "system"]
    if which is None:
        wide = own.join(types, [year, kind], "left").join(system, year, "left")
        return melt(wide, [year, entity], series, "series", "value")
    mine = own.filter(F.col(entity) == F.lit(which))
    its_kind = mine.agg(F.max(kind)).scalar()
    wide = (
        mine.select(year, "own")
        .join(system, year, "full_outer")
        .join(types.filter(F.col(kind) == its_kind).drop(kind), year, "full_outer")
        .withColumn(entity, F.lit(which))
    )
    return melt(wide, [year, entity], series, "series", "value")


def monthly_flow(df: DataFrame, date: str, key: str, value: str, unit: float = 1.0) -> DataFrame:
    """Sum per (month, key) and its share of the month's total.

    The window runs on the sums, so a month holds one row per key however many rows it had.
    """
    flow = df.groupBy(month_label(date).alias("month"), key).agg((F.sum(value) / unit).alias("flow"))
    total = F.sum("flow").over(W.partitionBy("month"))
    return flow.withColumn("share", F.try_divide(F.col("flow"), total))


def cluster_profile(
    df: DataFrame, cluster: str, cols: Sequence[str], normalize: bool = False
) -> DataFrame:
    """(cluster, metric, value): mean per cluster, optionally of columns rescaled to [0, 1]."""
    if normalize:
        df = minmax(df.select(cluster, *cols), cols, suffix="", constant=0.5)
    return melt(group_mean(df, [cluster], cols), [cluster], cols, "metric", "value")


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Counts of a x b, zero where a pair is absent."""
    return df.groupBy(a).pivot(b, list(values) if values else None).count().na.fill(0)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def coverage(df: DataFrame, key: str, date: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(date).alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )


def count_if(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def group_median(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    medians = exact_percentiles(df, cols, [0.5], keys)
    return medians.select(*keys, *[F.col(c)[0].alias(c) for c in cols])


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q1, median, q3, max, skew) with exact quartiles and sample skew."""
    n = lambda c: F.count(c).cast("double")
    corrected = lambda c: F.when(
        F.count(c) > 2, F.coalesce(F.skewness(c), F.lit(0.0)) * F.sqrt(n(c) * (n(c) - 1)) / (n(c) - 2)
    )
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
                corrected(c).alias("skew"),
            ).alias(c)
            for c in cols
        ]
    )
    quartiles = constants(exact_percentiles(df, cols, [0.25, 0.5, 0.75]))
    picked = F.array(
        *[
            F.struct(
                f"{c}.*",
                quartiles[c][0].alias("q1"),
                quartiles[c][1].alias("median"),
                quartiles[c][2].alias("q3"),
            )
            for c in cols
        ]
    )
    return rows_of(stats, picked).select(
        "column", "count", "mean", "std", "min", "q1", "median", "q3", "max", "skew"
    )


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, dtype, missing_count, missing_pct, min, max); min and max for numbers only. One pass."""
    cols = list(cols or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def described(c: str) -> str:
        number = f"cast(`{c}` as double)" if isinstance(kinds[c], T.NumericType) else "cast(null as double)"
        return (
            f"named_struct('column', '{c}', 'dtype', '{kinds[c].simpleString()}', "
            f"'missing_count', count_if(`{c}` is null), "
            f"'missing_pct', try_divide(cast(count_if(`{c}` is null) as double), count(1)), "
            f"'min', min({number}), 'max', max({number}))"
        )

    listed = F.expr(f"array({', '.join(described(c) for c in cols)})")
    return rows_of(df.agg(listed.alias("rows")), F.col("rows"))


def missing_ranking(df: DataFrame, k: int = 20) -> DataFrame:
    """The k columns with most missing values."""
    return (
        profile(df)
        .filter("missing_count > 0")
        .orderBy(F.desc("missing_pct"), "column")
        .limit(k)
        .select("column", "missing_count", "missing_pct")
    )


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """(column, q1, q3, iqr, low, high, n_outliers, outlier_pct) by quartile fences."""
    q = constants(exact_percentiles(df, cols, [0.25, 0.75]))

    def summary(c: str) -> Column:
        q1, q3 = q[c][0], q[c][1]
        reach = (q3 - q1) * k
        outside = F.count_if((F.col(c) < q1 - reach) | (F.col(c) > q3 + reach))
        return F.struct(
            F.lit(c).alias("column"),
            q1.alias("q1"),
            q3.alias("q3"),
            (q3 - q1).alias("iqr"),
            (q1 - reach).alias("low"),
            (q3 + reach).alias("high"),
            outside.alias("n_outliers"),
            (F.try_divide(outside.cast("double"), F.count(F.lit(1))) * 100).alias("outlier_pct"),
        )

    return rows_of(df.agg(F.array(*[summary(c) for c in cols]).alias("rows")), F.col("rows"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every column pair, each over the rows where both are present. One aggregation."""
    cols = list(cols)
    pair = lambda a, b: F.struct(
        F.lit(a).alias("a"), F.lit(b).alias("b"), correlation(a, b).alias("corr")
    )
    upper = [pair(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    half = rows_of(df.agg(F.array(*upper).alias("rows")), F.col("rows"))
    mirrored = half.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    return half.unionByName(mirrored)


def trend_line(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slope and intercept of the least-squares line; NULL below two points."""
    both = F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1))
    return df.groupBy(*keys).agg(
        both.alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )


def histogram(df: DataFrame, col: str, bins: int = 50, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, bin, low, high, n): equal-width bins over the whole range, the last one closed, empty ones kept."""
    v = F.col(col).cast("double")
    edge = constants(df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")))
    width = (edge["hi"] - edge["lo"]) / bins
    at = F.least(F.coalesce(F.floor(F.try_divide(v - edge["lo"], width)), F.lit(0)), F.lit(bins - 1))
    counts = (
        df.filter(v.isNotNull())
        .select(*keys, at.cast("int").alias("bin"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Fold each group's bin counts into one array, so empty bins come out without a join.
    whole = counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    every = whole.select(*keys, "m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.select(
        *keys,
        "bin",
        (edge["lo"] + width * F.col("bin")).alias("low"),
        (edge["lo"] + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).cast("bigint").alias("n"),
    )


def box_stats(df: DataFrame, keys: Sequence[str], col: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest values inside the fences) and outlier count per key."""
    q = exact_percentiles(df, [col], [0.25, 0.5, 0.75], keys).select(
        *keys, *[F.col(col)[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    reach = (F.col("q3") - F.col("q1")) * k
    inside = F.col(col).between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        join_on(df.select(*keys, col).filter(F.col(col).isNotNull()), q, list(keys), "inner")
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(col))).alias("whisker_low"),
            F.max(F.when(inside, F.col(col))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def forecast_metrics(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE and MAPE over the rows holding both values."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = a - p
    return df.groupBy(*keys).agg(
        F.count(e).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(F.try_divide(e, a + F.lit(1e-8)))) * 100).alias("mape"),
    )
