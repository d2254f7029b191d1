"""Standardising and rescaling columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.series import join_on


def _with_stats(df: DataFrame, stats: dict[str, str], keys: Sequence[str]):
    """The frame plus the SQL text of each statistic: a number, or a column joined on the keys."""
    summary = df.groupBy(*keys).agg(*[F.expr(e).alias(f"__{n}") for n, e in stats.items()])
    if keys:
        return join_on(df, summary, keys), {n: f"`__{n}`" for n in stats}, [f"__{n}" for n in stats]
    row = summary.first()
    text = {n: "null" if row[f"__{n}"] is None else repr(float(row[f"__{n}"])) for n in stats}
    return df, {n: f"cast('{v}' as double)" if v != "null" else "cast(null as double)" for n, v in text.items()}, []


def zscore(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), ddof: int = 0, suffix: str = "_z"
) -> DataFrame:
    """(x - mean) / std with sample (ddof=1) or population (ddof=0) std; a constant column gives 0."""
    spread = "stddev_samp" if ddof else "stddev_pop"
    stats = {f"m_{c}": f"avg(`{c}`)" for c in cols} | {f"s_{c}": f"{spread}(`{c}`)" for c in cols}
    out, stat, extra = _with_stats(df, stats, keys)

    def z(c: str) -> Column:
        centred, scale = f"(`{c}` - {stat[f'm_{c}']})", stat[f"s_{c}"]
        return F.expr(f"if(coalesce({scale}, 0) = 0, {centred} * 0.0d, try_divide({centred}, {scale}))")

    return out.withColumns({c + suffix: z(c) for c in cols}).drop(*extra)


def minmax(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = (),
    suffix: str = "_scaled",
    constant: float = 0.0,
    keep_range: bool = False,
) -> DataFrame:
    """Rescale to [0, 1]; a constant column gives `constant`. `keep_range` keeps `<c>_min` / `<c>_max`."""
    stats = {f"lo_{c}": f"min(cast(`{c}` as double))" for c in cols}
    stats |= {f"hi_{c}": f"max(cast(`{c}` as double))" for c in cols}
    out, stat, extra = _with_stats(df, stats, keys)

    def scaled(c: str) -> Column:
        lo, hi = stat[f"lo_{c}"], stat[f"hi_{c}"]
        flat = f"if(`{c}` is not null, cast({float(constant)!r} as double), null)"
        return F.expr(f"if({hi} = {lo}, {flat}, try_divide(`{c}` - {lo}, {hi} - {lo}))")

    new = {c + suffix: scaled(c) for c in cols}
    if keep_range:
        new |= {f"{c}_min": F.expr(stat[f"lo_{c}"]) for c in cols}
        new |= {f"{c}_max": F.expr(stat[f"hi_{c}"]) for c in cols}
    return out.withColumns(new).drop(*extra)


def minmax_inverse(df: DataFrame, scaled: str, lo: str, hi: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(scaled) * (F.col(hi) - F.col(lo)) + F.col(lo))


def scale_by(df: DataFrame, cols: Sequence[str], factor: float) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(factor) for c in cols})


def normalize_percent(df: DataFrame, cols: Sequence[str], limit: float = 1.5) -> DataFrame:
    """Divide a whole column by 100 when its largest absolute value is above the limit."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    peak = df.agg(*[F.expr(f"max(abs(`{c}`))").alias(c) for c in cols]).first()
    return df.withColumns({c: F.expr(f"`{c}` / 100.0d") for c in cols if (peak[c] or 0) > limit})
