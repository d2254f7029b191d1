"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def exclude(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is not listed; NULL is kept."""
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(*values))


def range_trim(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Keep rows inside every (low, high) bound, ends included; NULL fails."""
    keep = F.lit(True)
    for c, (lo, hi) in bounds.items():
        keep = keep & F.col(c).isNotNull()
        keep = keep if lo is None else keep & (F.col(c) >= lo)
        keep = keep if hi is None else keep & (F.col(c) <= hi)
    return df.filter(keep)


def latest_slice(df: DataFrame, order: str) -> DataFrame:
    """Rows holding the largest value of `order`; the scalar reaches the scan as a filter."""
    return df.filter(F.col(order) == df.agg(F.max(order)).scalar())


def last_n_periods(df: DataFrame, col: str, n: int) -> DataFrame:
    """Rows in the last n distinct periods."""
    periods = df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(F.desc(col)).limit(n)
    return df.filter(F.col(col) >= periods.agg(F.min(col)).scalar())


def since_min_of(df: DataFrame, other: DataFrame, col: str) -> DataFrame:
    """Rows on or after the smallest value another frame holds."""
    return df.filter(F.col(col) >= other.agg(F.min(col)).scalar())


def rows_of_flagged(df: DataFrame, key: str, flagged: Column) -> DataFrame:
    """All rows of every key that has at least one flagged row."""
    return df.join(df.filter(flagged).select(key).distinct(), key, "left_semi")


def recent(df: DataFrame, order: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n latest rows, oldest first."""
    top = df.orderBy(F.desc(order), *[F.desc(t) for t in ties]).limit(n)
    return top.orderBy(order, *ties)


def top_k(df: DataFrame, col: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(col), *ties).limit(k)


def between_dates(df: DataFrame, lo: int, hi: int, key: str = "date_key", year: str = "year") -> DataFrame:
    """Date-key range; also bounds the derived year so partitions are pruned."""
    inside = F.col(key).between(lo, hi)
    return df.filter(inside & F.col(year).between(lo // 10000, hi // 10000) if year in df.columns else inside)
