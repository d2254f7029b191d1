"""The registered queries of this subpackage: the driver's tables, production parameters, whole results."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark, sf: str, name: str):
    return spark.read.parquet(f"{sf}/{name}.parquet")


from ledgerline.llm import queries  # noqa: E402, F401
