"""Changing the shape of a frame: long to wide, wide to long, transposition, unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed import STATEMENT_META
from ledgerline.operators.windows import dedupe_first


def rows_of(df: DataFrame, structs: Column) -> DataFrame:
    """Turn an array of structs into rows."""
    return df.select(F.explode(structs).alias("__r")).select("__r.*")


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str) -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), name, value
    )


def pivot_wide(
    df: DataFrame, index: str | Sequence[str], key: str, value: str, values: Sequence | None = None
) -> DataFrame:
    """One row per index, one column per key value."""
    index = [index] if isinstance(index, str) else list(index)
    return df.groupBy(*index).pivot(key, list(values) if values else None).agg(F.first(value, ignorenulls=True))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union keeping, per key, the row of the earliest frame."""
    tagged = union_all([f.withColumn("__src", F.lit(i)) for i, f in enumerate(frames)])
    rest = [c for c in tagged.columns if c not in keys and c != "__src"]
    return dedupe_first(tagged, keys, ["__src", *rest]).drop("__src")


def period_columns(df: DataFrame, meta: Sequence[str] = STATEMENT_META) -> list[str]:
    return [c for c in df.columns if c not in meta]


def transpose_report(
    df: DataFrame, item: str = "item", meta: Sequence[str] = STATEMENT_META, items: Sequence[str] | None = None
) -> DataFrame:
    """Statement with items as rows and periods as columns, turned into one row per period.

    Period columns are whatever is not metadata; item columns keep the order given in `items`.
    """
    periods = period_columns(df, meta)
    cells = F.explode(
        F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"`{p}`").cast("double").alias("value")) for p in periods])
    )
    wide = df.select(item, cells.alias("c")).select(item, "c.*").groupBy("period")
    return wide.pivot(item, list(items) if items else None).agg(F.first("value", ignorenulls=True)).orderBy("period")


def item_dictionary(reports: Mapping[str, DataFrame]) -> DataFrame:
    """(report_type, item_id, item_vi, item_en) over all statements, one row per (report_type, item)."""
    parts = []
    for report, df in reports.items():
        have = [c for c in ("item_id", "item", "item_en") if c in df.columns]
        parts.append(df.select(F.lit(report).alias("report_type"), *have))
    every = union_distinct(parts, ["report_type", "item"])
    order = [c for c in ("report_type", "item_id", "item", "item_en") if c in every.columns]
    return every.select(*order).withColumnRenamed("item", "item_vi")


def drop_cols(df: DataFrame, cols: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """Drop technical columns where present and put `first` in front."""
    kept = [c for c in df.columns if c not in cols and c not in first]
    return df.select(*first, *kept)
