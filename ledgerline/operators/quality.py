"""Data-quality checks reported as rows, and quarantine of bad rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.joins import fk_violations
from ledgerline.operators.reshape import rows_of, union_all


@dataclass(frozen=True)
class TableRules:
    """Checks of one table: NOT NULL columns, unique keys, foreign keys, and named failing conditions."""

    table: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    foreign: dict[str, str] = field(default_factory=dict)  # column -> dimension table with the same key
    failing: dict[str, Column] = field(default_factory=dict)
    audit: str | None = "audit_key"


def _row(rule: Column, table: str, violations: Column) -> Column:
    return F.struct(
        rule.alias("rule"), F.lit(table).alias("table"), violations.cast("bigint").alias("violations")
    )


def run_checks(tables: Mapping[str, DataFrame], rules: Sequence[TableRules]) -> DataFrame:
    """(rule, table, violations), one row per check. Column checks of a table share one pass over it."""
    reports = []
    for r in rules:
        df = tables[r.table]
        tests = {f"not_null:{c}": F.col(c).isNull() for c in r.not_null}
        if r.audit and r.audit in df.columns:
            tests[f"audit:{r.audit}"] = F.col(r.audit).isNull()
        tests |= {f"check:{n}": F.coalesce(test, F.lit(False)) for n, test in r.failing.items()}
        if tests:
            found = [_row(F.lit(n), r.table, F.count_if(t)) for n, t in tests.items()]
            reports.append(rows_of(df.agg(F.array(*found).alias("rows")), F.col("rows")))
        if r.audit and r.audit not in df.columns:
            absent = F.array(_row(F.lit(f"audit:{r.audit}"), r.table, F.lit(1)))
            reports.append(rows_of(df.sparkSession.range(1), absent))
        if r.unique:
            copies = df.groupBy(*r.unique).agg(F.count(F.lit(1)).alias("n"))
            extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
            name = F.lit("unique:" + ",".join(r.unique))
            reports.append(copies.agg(F.array(_row(name, r.table, extra)).alias("rows")))
            reports[-1] = rows_of(reports[-1], F.col("rows"))
        for c, dim in r.foreign.items():
            missing = fk_violations(df, tables[dim], c)
            found = missing.agg(F.array(_row(F.lit(f"foreign:{c}"), r.table, F.count(F.lit(1)))).alias("rows"))
            reports.append(rows_of(found, F.col("rows")))
    return union_all(reports)


def total_violations(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"))


def quarantine(
    df: DataFrame, reject: Mapping[str, Column], flag: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good rows with a `dq_flags` array, rejected rows with a `dq_reasons` array)."""
    named = lambda tests: F.array_compact(
        F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items()])
    ) if tests else F.array().cast("array<string>")
    marked = df.withColumns({"dq_reasons": named(reject), "dq_flags": named(flag or {})})
    bad = F.size("dq_reasons") > 0
    return marked.filter(~bad).drop("dq_reasons"), marked.filter(bad).drop("dq_flags")
