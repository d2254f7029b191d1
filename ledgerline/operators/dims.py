"""Slowly changing dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions.scalars import clean_code, clean_name, to_whole
from ledgerline.operators.windows import dedupe_first
from ledgerline.sources.tables import rename_aliases


def build_dim(
    df: DataFrame, aliases: Mapping[str, str], key: str, code: str, names: Sequence[str], codes: Sequence[str]
) -> DataFrame:
    """Clean dimension list: required columns, whole-number key, tidy codes and names, one row per code."""
    wanted = [key, code, *[c for c in (*names, *codes) if c != code]]
    df = rename_aliases(df, aliases, wanted).select(*wanted).dropna()
    df = df.withColumns(
        {key: to_whole(key)} | {c: clean_name(c) for c in names} | {c: clean_code(c) for c in (code, *codes)}
    )
    return dedupe_first(df.dropna(), [code], [key, *names, *codes])


def bank_dim(df: DataFrame) -> DataFrame:
    dim = build_dim(df, fixed.BANK_LIST_HEADERS, "bank_key", "bank_code", ["bank_name"], ["bank_type"])
    return dim.select("bank_key", "bank_code", "bank_name", "bank_type").withColumn(
        "charter_capital", F.lit(None).cast("double")
    )


def scd2_open(df: DataFrame, start: str = fixed.FIRST_VALID_FROM) -> DataFrame:
    """First load: every row is current from the default start."""
    return df.withColumns(
        {
            "valid_from": F.lit(start).cast("date"),
            "valid_to": F.lit(fixed.OPEN_END).cast("date"),
            "is_current": F.lit(True),
        }
    )


def scd2_apply(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    today: dt.date,
    tracked_if_present: Sequence[str] = (),
    first_from: str = fixed.FIRST_VALID_FROM,
    stamp: Mapping | None = None,
) -> DataFrame:
    """Apply an incoming snapshot to a versioned dimension.

    New keys open at `first_from`. A changed key closes its version at today - 1 and opens one today, or
    replaces it when that version itself started today. Unchanged and missing keys stay. `tracked` columns
    compare null-safe; `tracked_if_present` only count when the incoming value is not NULL. `stamp` holds audit
    values put on every row written or closed (`_created_at` only on new versions).
    """
    stamp = stamp or {}
    attributes = [c for c in incoming.columns if c != key]
    rest = [c for c in current.columns if c not in (key, *attributes, "valid_from", "valid_to", "is_current")]
    layout = current.columns
    history = current.filter(~F.col("is_current"))
    active = current.filter("is_current").select(F.struct(*layout).alias("old"), F.col(key).alias(key))
    new = incoming.select(F.struct(*incoming.columns).alias("new"), F.col(key).alias(key))
    day, end = F.lit(today).cast("date"), F.lit(fixed.OPEN_END).cast("date")

    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
    for c in tracked_if_present:
        changed = changed | (
            F.col(f"new.{c}").isNotNull() & ~F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
        )

    types = {f.name: f.dataType for f in current.schema.fields}

    def version(start) -> Column:
        fields = {c: F.col(f"new.{c}") for c in attributes}
        fields |= {key: F.col(key), "valid_from": start, "valid_to": end, "is_current": F.lit(True)}
        fields |= {c: F.lit(stamp.get(c)) for c in rest}
        return F.struct(*[fields[c].cast(types[c]).alias(c) for c in layout])

    def closed() -> Column:
        fields = {c: F.col(f"old.{c}") for c in layout}
        fields |= {"valid_to": F.date_sub(day, 1), "is_current": F.lit(False)}
        fields |= {c: F.lit(v) for c, v in stamp.items() if c in rest and not c.startswith("_created")}
        return F.struct(*[fields[c].cast(types[c]).alias(c) for c in layout])

    kept = F.struct(*[F.col(f"old.{c}").cast(types[c]).alias(c) for c in layout])
    first = F.lit(first_from).cast("date")
    versions = (
        F.when(F.col("new").isNull(), F.array(kept))
        .when(F.col("old").isNull(), F.array(version(first)))
        .when(~changed, F.array(kept))
        .when(F.col("old.valid_from") >= day, F.array(version(F.col("old.valid_from"))))
        .otherwise(F.array(closed(), version(day)))
    )
    # One join; a changed key fans out into its closed and its new version.
    merged = active.join(new, key, "full_outer").select(F.explode(versions).alias("v")).select("v.*")
    return history.unionByName(merged)
