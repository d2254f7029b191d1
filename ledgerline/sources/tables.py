"""Reading source tables and bringing them to a table layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions.scalars import time_seconds, to_whole
from ledgerline.operators.reshape import union_all, union_distinct
from ledgerline.spec import TableSpec


def read_table(spark: SparkSession, spec: TableSpec, path: str, fmt: str = "csv") -> DataFrame:
    """Read a table and bring it to its layout by column name; CSV is read as text and cast, never inferred."""
    if fmt == "csv":
        raw = spark.read.option("header", True).option("escape", '"').csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    return coerce_types(conform(raw, spec), spec)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep the layout's columns in order; those missing are NULL."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(None).alias(c) for c in spec.columns])


def coerce_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast to the layout's types; what does not parse becomes NULL, then defaults fill."""

    kinds = dict(df.dtypes)

    def cast(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "time":
            value = c.cast("int") if kinds[name] == "int" else time_seconds(c)
        elif kind == "bigint":
            value = to_whole(c)
        elif kind == "boolean" and kinds[name] == "string":
            value = F.trim(c).try_cast("boolean")
        else:
            value = c.try_cast(kind)
        if name in spec.defaults:
            value = F.coalesce(value, F.lit(spec.defaults[name]).cast(spec.storage_type(name)))
        return value.alias(name)

    return df.select(*[cast(n, k) for n, k in spec.columns.items()])


def rename_aliases(df: DataFrame, aliases: Mapping[str, str], required: Sequence[str] = ()) -> DataFrame:
    """Trim headers, map alternative headers to one name, and insist on the required ones."""
    names = [aliases.get(c.strip(), c.strip()) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several source columns map to {twice}")
    missing = sorted(set(required) - set(names))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.toDF(*names)


def union_tagged(frames: Mapping, key: str) -> DataFrame:
    """Union of one frame per entity, each tagged with its key."""
    return union_all([df.withColumn(key, F.lit(k)) for k, df in frames.items()])


def append_segments(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Overlapping extracts of one series: where they share a key, the earlier frame wins."""
    return union_distinct(frames, keys)


def literal_dim(spark: SparkSession, rows: Sequence[tuple], columns: Mapping[str, str]) -> DataFrame:
    """Small fixed dimension; time columns are given as 'HH:MM:SS'."""
    text = spark.createDataFrame(list(rows), ", ".join(
        f"`{c}` {'string' if k == 'time' else k}" for c, k in columns.items()))
    return text.withColumns({c: time_seconds(c) for c, k in columns.items() if k == "time"})


def stock_dim(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, fixed.STOCKS, fixed.DIM_STOCK)


def session_dim(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, fixed.SESSIONS, fixed.DIM_TRADING_SESSION)


def calendar(
    spark: SparkSession,
    start: Column | str = fixed.CALENDAR_START,
    end: Column | str = fixed.CALENDAR_END,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """One row per day; weekdays trade, except days in `holidays` (column full_date)."""
    bounds = [F.lit(b).cast("date") if isinstance(b, str) else b for b in (start, end)]
    return calendar_of(spark.range(1).select(*[b.alias(n) for b, n in zip(bounds, ("lo", "hi"))]), holidays)


def calendar_of(bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar over the (lo, hi) dates of a one-row frame."""
    d = F.col("full_date")
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    trades = F.weekday(d) < 5
    if holidays is not None:
        closed = holidays.select(F.to_date("full_date").alias("full_date")).distinct()
        days = days.join(closed.withColumn("__closed", F.lit(True)), "full_date", "left")
        trades = trades & F.col("__closed").isNull()
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint").alias("date_key"),
        "full_date",
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.month(d).cast("bigint").alias("month"),
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        trades.alias("is_trading_day"),
    )


def annual(df: DataFrame, quarter: str = "quarter") -> DataFrame:
    """Annual rows carry quarter code 5."""
    return df.filter(F.col(quarter) == 5)


def quarterly(df: DataFrame, quarter: str = "quarter") -> DataFrame:
    return df.filter(F.col(quarter).isin(1, 2, 3, 4))
