"""Writing warehouse tables: reload, append by run, keyed upsert, reports, audit."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.operators.joins import require_unique
from ledgerline.operators.reshape import union_all
from ledgerline.sources.versions import StoredTable
from ledgerline.spec import RunContext, TableSpec


def write_overwrite(df: DataFrame, spec: TableSpec, path: str) -> None:
    StoredTable(df.sparkSession, spec, path).overwrite(df)


def write_append(df: DataFrame, spec: TableSpec, path: str, run: RunContext) -> None:
    """Append under the run's own partition; repeating a run replaces its rows instead of doubling them."""
    StoredTable(df.sparkSession, spec, path).append(df, run)


def read_stored(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The live version of a table that write_overwrite, write_append or merge_table stored."""
    return StoredTable(spark, spec, path).read()


def merge_upsert(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    preserve: Sequence[str] = ("_created_at",),
    check: bool = True,
) -> DataFrame:
    """Target rows updated by staging on the keys (all but keys and `preserve`), new staging rows inserted."""
    keys = list(keys)
    if check:
        require_unique(staging, keys, "staging")
    staged = staging.select(
        *keys, F.struct(*[c for c in staging.columns if c not in keys]).alias("__s"), F.lit(True).alias("__in")
    )
    kept = target.select(
        *keys, F.struct(*[c for c in target.columns if c not in keys]).alias("__t"), F.lit(True).alias("__had")
    )
    merged = kept.join(staged, keys, "full_outer")

    def value(c: str):
        if c in keys:
            return F.col(c)
        if c not in staging.columns:
            return F.col(f"__t.{c}").alias(c)
        fresh = F.col("__in") if c not in preserve else F.col("__in") & F.col("__had").isNull()
        return F.when(fresh, F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")).alias(c)

    return merged.select(*[value(c) for c in target.columns])


def merge_table(spark: SparkSession, spec: TableSpec, path: str, staging: DataFrame) -> None:
    """Upsert into a stored table, reading and rewriting only the partitions the staging rows touch."""
    StoredTable(spark, spec, path).merge(staging)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Small report as JSON lines or CSV with a header."""
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)


def table_status(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, row_count, size_bytes) by row count; sizes come from the file metadata of stored tables."""
    parts = []
    for name, df in tables.items():
        files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size")
        parts.append(
            files.count().agg(
                F.lit(name).alias("table"),
                F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum("file_size"), F.lit(0)).alias("size_bytes"),
            )
        )
    return union_all(parts).orderBy(F.desc("row_count"), "table")


def _audit_row(spark: SparkSession, run: RunContext, script: str, rows: int | None, status: str) -> DataFrame:
    values = (run.audit_key, run.run_id, run.created_at, script, run.source_file, rows, status)
    ddl = ", ".join(f"`{c}` {k}" for c, k in fixed.DIM_AUDIT.items())
    return spark.createDataFrame([values], ddl)


def audited(
    df: DataFrame, run: RunContext, audit_path: str, script: str, write: Callable[[DataFrame], DataFrame]
) -> int:
    """Run a write between RUNNING and SUCCESS/FAILED audit rows.

    `write` stores the frame and returns what it stored; a stored Parquet table is counted from its footers, so
    the load is neither computed twice nor observed on the way (an Observation on the session would keep forest
    models from being shipped to tasks).
    """
    spark = df.sparkSession
    log = lambda n, status: (
        _audit_row(spark, run, script, n, status).write.mode("append").parquet(audit_path)
    )
    log(None, "RUNNING")
    try:
        rows = write(df).count()
    except Exception:
        log(None, "FAILED")
        raise
    log(rows, "SUCCESS")
    return rows
