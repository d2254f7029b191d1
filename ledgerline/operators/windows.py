"""Row-to-row operators on ordered series."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.moments import correlation
from ledgerline.operators.ordered import kth_value
from ledgerline.operators.series import Series, carried, framed, join_on, position


def _names(cols: Mapping[str, str] | Sequence[str] | str, suffix: str) -> dict[str, str]:
    if isinstance(cols, str):
        cols = [cols]
    return dict(cols) if isinstance(cols, Mapping) else {c: f"{c}_{suffix}" for c in cols}


def _latest_first(order: str | Sequence[str]) -> list[Column]:
    order = [order] if isinstance(order, str) else order
    return [F.col(o).desc() for o in order]


def pct_change(df: DataFrame, s: Series, cols, fill: float | None = 0.0) -> DataFrame:
    """Change against the last non-null value before the row; the first row and NULLs take `fill`."""
    names = _names(cols, "pct")
    past = {c: f"__p_{c}" for c in names}

    def change(c: str) -> Column:
        prior, now = F.col(past[c]).cast("double"), F.col(c).cast("double")
        # A NULL current value is padded with the last known one, so it changes by nothing.
        moved = F.try_divide(F.coalesce(now, prior), prior) - 1
        return moved if fill is None else F.coalesce(moved, F.lit(float(fill)))

    out = carried(df, s, past)
    return out.withColumns({o: change(c) for c, o in names.items()}).drop(*past.values())


def lags(df: DataFrame, s: Series, steps: Mapping[str, Sequence[int]]) -> DataFrame:
    """Add `<col>_lag<k>` for each requested k."""
    reach = max(k for ks in steps.values() for k in ks)
    return framed(
        df, s, reach, 0, lambda w: {f"{c}_lag{k}": F.lag(c, k).over(w) for c, ks in steps.items() for k in ks}
    )


def leads(df: DataFrame, s: Series, steps: Mapping[str, Sequence[int]]) -> DataFrame:
    reach = max(k for ks in steps.values() for k in ks)
    return framed(
        df, s, 0, reach, lambda w: {f"{c}_lead{k}": F.lead(c, k).over(w) for c, ks in steps.items() for k in ks}
    )


def diff(df: DataFrame, s: Series, cols) -> DataFrame:
    names = _names(cols, "diff")
    return framed(df, s, 1, 0, lambda w: {o: F.col(c) - F.lag(c).over(w) for c, o in names.items()})


def ffill(df: DataFrame, s: Series, cols: Sequence[str], limit: int = 1) -> DataFrame:
    """Fill at most `limit` consecutive NULLs from the last value."""
    return framed(
        df, s, limit, 0, lambda w: {c: F.last(c, ignorenulls=True).over(w.rowsBetween(-limit, 0)) for c in cols}
    )


def _full(w: WindowSpec, lo: int, hi: int, value: Callable[[WindowSpec], Column], *cols: str) -> Column:
    """The framed value, NULL unless the frame holds its full number of complete rows."""
    complete = F.lit(1)
    for c in cols:
        complete = F.when(F.col(c).isNotNull(), complete)
    frame = w.rowsBetween(lo, hi)
    return F.when(F.count(complete).over(frame) == hi - lo + 1, value(frame))


def moving_avg(df: DataFrame, s: Series, col: str, n: int, out: str | None = None) -> DataFrame:
    out = out or f"{col}_ma{n}"
    return framed(df, s, n - 1, 0, lambda w: {out: _full(w, 1 - n, 0, lambda f: F.avg(col).over(f), col)})


def ma_forecast(df: DataFrame, s: Series, col: str, n: int = 5, out: str | None = None) -> DataFrame:
    """Mean of the n rows before the row: the one-step moving-average forecast."""
    out = out or f"{col}_ma{n}_forecast"
    return framed(df, s, n, 0, lambda w: {out: _full(w, -n, -1, lambda f: F.avg(col).over(f), col)})


def rolling_std(df: DataFrame, s: Series, col: str, n: int, out: str | None = None) -> DataFrame:
    out = out or f"{col}_std{n}"
    return framed(df, s, n - 1, 0, lambda w: {out: _full(w, 1 - n, 0, lambda f: F.stddev_samp(col).over(f), col)})


def rolling_corr(df: DataFrame, s: Series, x: str, y: str, n: int, out: str = "rolling_corr") -> DataFrame:
    """Pearson correlation of x and y over the last n rows; NULL until n rows or when a side is constant."""
    return framed(
        df, s, n - 1, 0, lambda w: {out: _full(w, 1 - n, 0, lambda f: correlation(x, y, f), x, y)}
    )


def volatility_flag(df: DataFrame, s: Series, col: str, n: int, limit: float) -> DataFrame:
    """True when the rolling standard deviation exceeds the limit."""
    wide = rolling_std(df, s, col, n, "__std")
    return wide.withColumn("high_volatility", F.coalesce(F.col("__std") > F.lit(limit), F.lit(False))).drop("__std")


def fallback_impute(df: DataFrame, s: Series, col: str, n: int = 5, out: str | None = None) -> DataFrame:
    """Missing value: the previous row's value, else the mean of what the n rows before hold."""
    out = out or f"{col}_filled"
    return framed(
        df,
        s,
        n,
        0,
        lambda w: {out: F.coalesce(F.col(col), F.lag(col).over(w), F.avg(col).over(w.rowsBetween(-n, -1)))},
    )


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by `order`; each map task keeps one row per key before the shuffle."""
    return _ranked(df, keys, [F.col(o) if isinstance(o, str) else o for o in order], 1)


def latest_row(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    return _ranked(df, keys, _latest_first(order), 1)


def last_n_rows(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], n: int, spread: int = 32) -> DataFrame:
    """The last n rows per key. Beyond the n that Spark prunes inside map tasks, a key's rows are first ranked in `spread`
    parts, so no task gathers a hot key."""
    latest = _latest_first(order)
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        by = [order] if isinstance(order, str) else list(order)
        part = F.pmod(F.xxhash64(*by), F.lit(spread))
        df = _ranked(df.withColumn("__part", part), [*keys, "__part"], latest, n).drop("__part")
    return _ranked(df, keys, latest, n)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    # row_number() <= n prunes to n rows per key inside every map task, so a hot key is never gathered.
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def latest_non_null(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], cols: Sequence[str] | None = None
) -> DataFrame:
    """Per key and per column the last non-null value, which may come from different rows."""
    order = [order] if isinstance(order, str) else list(order)
    cols = [c for c in (cols or df.columns) if c not in keys]
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)  # a struct would need a sorted aggregate
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols])


def latest_change(df: DataFrame, s: Series, col: str) -> DataFrame:
    """Latest row of each series with its change against the row before."""
    two = last_n_rows(df, s.keys, s.order, 2)
    w = s.window
    with_prior = two.withColumns({"previous": F.lag(col).over(w), "__rank": F.row_number().over(
        W.partitionBy(*s.keys).orderBy(*_latest_first(s.order)))})
    change = F.try_divide(F.col(col).cast("double"), F.col("previous").cast("double")) - 1
    return (
        with_prior.filter("__rank = 1")
        .select(*s.keys, *s.order, F.col(col).alias("latest"), "previous", change.alias("change_pct"))
    )


def time_split(df: DataFrame, order: str, ties: Sequence[str], ratio: float = 0.8) -> DataFrame:
    """Mark the first floor(n * ratio) rows by (order, *ties) as training rows.

    The cut row is found by counting, so the result is a plain comparison with constants: no sort, no
    numbering, and a time value holding a large share of the rows is split by the tie columns. NULLs come first.
    """
    need = int(df.count() * ratio)
    train = F.lit(False)
    if need:
        rows, equal, branches = df, F.lit(True), []
        for c in (order, *ties):
            value, before, upto = kth_value(rows, c, need)
            less = F.lit(False) if value is None else F.col(c).isNull() | (F.col(c) < F.lit(value))
            same = F.col(c).isNull() if value is None else F.col(c).eqNullSafe(F.lit(value))
            branches.append(equal & less)
            equal = equal & same
            rows, need = rows.filter(same), need - before
            if upto - before == need:
                branches.append(equal)
                break
        else:
            raise ValueError(f"columns {[order, *ties]} do not order the rows uniquely")
        for b in branches:
            train = train | b
    return df.withColumn("is_train", train)


def series_split(df: DataFrame, s: Series, ratio: float = 0.8) -> DataFrame:
    """Mark the first floor(n * ratio) rows of every series as training rows."""
    numbered = position(df, s, "__pos")
    if not s.keys:
        return numbered.withColumn("is_train", F.col("__pos") <= int(df.count() * ratio)).drop("__pos")
    sizes = df.groupBy(*s.keys).agg(F.floor(F.count(F.lit(1)) * F.lit(ratio)).alias("__train"))
    joined = join_on(numbered, sizes, s.keys)
    return joined.withColumn("is_train", F.col("__pos") <= F.col("__train")).drop("__pos", "__train")


def sequences(
    df: DataFrame,
    s: Series,
    features: Sequence[str],
    target: str,
    window: int,
    horizon: int,
) -> DataFrame:
    """Each row with its last `window` feature vectors (`x`) and the next `horizon` targets (`y`)."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        past = w.rowsBetween(1 - window, 0)
        vector = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
        return {
            "x": F.collect_list(vector).over(past),
            "y": F.array(*[F.lead(F.col(target).cast("double"), h).over(w) for h in range(1, horizon + 1)]),
            "__whole": F.lead(F.lit(1), horizon).over(w),
        }

    out = framed(df, s, window - 1, horizon, columns)
    whole = (F.size("x") == window) & F.col("__whole").isNotNull()
    return out.filter(whole).select(*s.keys, *s.order, "x", "y")
