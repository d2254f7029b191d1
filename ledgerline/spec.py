"""Table layouts and the per-run audit context."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed


@dataclass(frozen=True)
class TableSpec:
    """Name, ordered columns, merge keys and on-disk layout of one warehouse table."""

    name: str
    columns: dict[str, str]
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c}` {self.storage_type(c)}" for c in self.columns)

    def storage_type(self, column: str) -> str:
        kind = self.columns[column]
        return "int" if kind == "time" else kind


@dataclass(frozen=True)
class RunContext:
    """One load run; the same values are stamped on every row it writes."""

    audit_key: int
    created_at: dt.datetime
    source_file: str
    run_id: str = ""

    @classmethod
    def now(cls, source_file: str, run_id: str = "") -> "RunContext":
        at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        key = int(at.strftime("%Y%m%d%H%M%S"))
        return cls(key, at, source_file, run_id or f"run-{key}")


def with_audit(df: DataFrame, run: RunContext) -> DataFrame:
    """Stamp the four lineage columns."""
    at = F.lit(run.created_at).cast("timestamp")
    return df.withColumns(
        {
            "audit_key": F.lit(run.audit_key).cast("bigint"),
            "_created_at": at,
            "_updated_at": at,
            "_source_file": F.lit(run.source_file),
        }
    )


def _audited(columns: dict[str, str]) -> dict[str, str]:
    return {**columns, **fixed.AUDIT_COLUMNS}


WAREHOUSE = {
    spec.name: spec
    for spec in (
        TableSpec("dim_date", _audited(fixed.DIM_DATE), ("date_key",)),
        TableSpec("dim_stock", _audited(fixed.DIM_STOCK), ("stock_key",)),
        TableSpec(
            "dim_bank",
            _audited(fixed.DIM_BANK),
            ("bank_code", "valid_from"),
            defaults={"valid_to": fixed.OPEN_END},
        ),
        TableSpec("dim_trading_session", _audited(fixed.DIM_TRADING_SESSION), ("session_key",)),
        TableSpec("dim_audit", fixed.DIM_AUDIT),
        TableSpec(
            "fact_stock_daily_metrics",
            _audited(fixed.FACT_STOCK_DAILY_METRICS),
            ("date_key", "stock_key"),
            ("year",),
            ("stock_key", "date_key"),
        ),
        TableSpec(
            "fact_bank_performance",
            _audited(fixed.FACT_BANK_PERFORMANCE),
            ("date_key", "bank_key"),
            ("year",),
            ("bank_key", "date_key"),
        ),
        TableSpec("bank_cluster_assignments", fixed.BANK_CLUSTER_ASSIGNMENTS, ("bank_key",)),
        TableSpec("bank_risk_predictions", fixed.BANK_RISK_PREDICTIONS, ("bank_key", "date_key")),
        TableSpec(
            "fact_model_predictions",
            fixed.FACT_MODEL_PREDICTIONS,
            ("base_date_key", "stock_key", "horizon", "model_name"),
        ),
    )
}
