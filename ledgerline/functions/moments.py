"""Aggregate expressions that stay defined on degenerate input."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def correlation(x: str, y: str, over: WindowSpec | None = None) -> Column:
    """Pearson correlation over the rows holding both values; NULL when a side is constant.

    The built-in `corr` fails on a constant side under ANSI mode.
    """
    a = F.when(F.col(y).isNotNull(), F.col(x)).cast("double")
    b = F.when(F.col(x).isNotNull(), F.col(y)).cast("double")
    parts = [F.covar_pop(a, b), F.stddev_pop(a), F.stddev_pop(b)]
    if over is not None:
        parts = [p.over(over) for p in parts]
    joint, sx, sy = parts
    return F.try_divide(joint, sx * sy)
