"""Fact and dimension joins. Spark picks broadcast or sort-merge by measured size; skew is split by AQE."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import seconds_of_day
from ledgerline.operators.windows import latest_row


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    return fact.join(dim, on, how)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{what}: duplicate keys {[tuple(r[k] for k in keys) for r in twice]}")


def lookup_join(df: DataFrame, dim: DataFrame, on: Sequence[str], strict: bool = True) -> DataFrame:
    """Many-to-one left join; raises on a duplicate dimension key and, if strict, on an unmapped key."""
    on = [on] if isinstance(on, str) else list(on)
    require_unique(dim, on, "lookup")
    if strict:
        missing = df.select(*on).distinct().join(dim, on, "left_anti").orderBy(*on).limit(20).collect()
        if missing:
            raise ValueError(f"unmapped keys: {[tuple(r) for r in missing]}")
    return df.join(dim, on, "left")


def fk_violations(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Distinct fact keys without a dimension row; distinct comes first so a hot key shuffles once per task."""
    right = dim.select(F.col(dim_key or key).alias(key)).distinct()
    return fact.select(key).filter(F.col(key).isNotNull()).distinct().join(right, key, "left_anti")


def join_latest(left: DataFrame, right: DataFrame, key: str, order: str | Sequence[str]) -> DataFrame:
    """Left join to the latest right row per key."""
    return left.join(latest_row(right, [key], order), key, "left")


def align_outer(frames: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, on, "full_outer"), frames)


def align_common(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Rows on the dates where every series has a value."""
    held = df.filter(F.col(value).isNotNull())
    total = held.agg(F.count_distinct(key)).scalar()
    whole = held.groupBy(order).agg(F.count_distinct(key).alias("n")).filter(F.col("n") == total)
    return held.join(whole.select(order), order, "left_semi")


def pair_rows(
    df: DataFrame, key: str, order: str, value: str, names: Sequence[str], pairs: Sequence[tuple] | None = None
) -> DataFrame:
    """One row per date and named pair (a, b) with both values, from one wide row per date.

    `names` is the list of series to compare; without `pairs` every unordered pair of them is used.
    """
    names = list(names)
    pairs = pairs or [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    at = {n: i for i, n in enumerate(names)}
    wide = (
        df.filter(F.col(key).isin(*names))
        .groupBy(order)
        .agg(F.array(*[F.max(F.when(F.col(key) == n, F.col(value))) for n in names]).alias("__v"))
    )
    both = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("a"),
                    F.lit(b).alias("b"),
                    F.col("__v")[at[a]].cast("double").alias("x"),
                    F.col("__v")[at[b]].cast("double").alias("y"),
                )
                for a, b in pairs
            ]
        )
    )
    return wide.select(order, both.alias("p")).select(order, "p.*").filter("x IS NOT NULL AND y IS NOT NULL")


def scd2_asof_join(
    fact: DataFrame, dim: DataFrame, key: str, date: str, valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """Left join each fact to the dimension version valid on its date (both ends included)."""
    versions = dim.withColumnRenamed(key, "__key")
    held = (
        (F.col(key) == F.col("__key"))
        & (F.col(date) >= F.col(valid_from))
        & (F.col(date) <= F.col(valid_to))
    )
    return fact.join(versions, held, "left").drop("__key")


def session_of(ts: Column | str, sessions: Sequence[tuple[int, str, str, str]]) -> Column:
    """Key of the session whose [start, end] holds the time of day, else NULL; sessions are a fixed list."""
    at = seconds_of_day(ts)
    seconds = lambda text: sum(int(p) * m for p, m in zip(text.split(":"), (3600, 60, 1)))
    key = F.lit(None).cast("bigint")
    for session_key, _, start, end in reversed(list(sessions)):
        key = F.when(at.between(seconds(start), seconds(end)), F.lit(session_key).cast("bigint")).otherwise(key)
    return key


def map_codes(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace codes of one system by another's; codes not listed stay."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(col, F.coalesce(F.try_element_at(table, F.col(col)), F.col(col)))


def next_business_days(last: Column | str, n: int) -> Column:
    """Array of the n weekdays after a date."""
    start = F.col(last) if isinstance(last, str) else last
    ahead = F.sequence(F.date_add(start, 1), F.date_add(start, 7 * (n // 5 + 1) + 2), F.expr("interval 1 day"))
    return F.slice(F.filter(ahead, lambda d: F.weekday(d) < 5), 1, n)


def as_date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)
