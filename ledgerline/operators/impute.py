"""Two-stage median imputation of panel ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.aggregates import group_median
from ledgerline.operators.ordered import constants
from ledgerline.operators.series import join_on
from ledgerline.storage import stored


def impute_median(
    df: DataFrame,
    entity: str,
    year: str,
    cols: Sequence[str],
    cutoff: int = 2006,
    flag: str = "is_imputed",
) -> DataFrame:
    """Fill NULLs with medians and flag the rows touched.

    Stage 1 fills rows before `cutoff` with the entity's median over the later years, else with the global
    median over the later years, else with the whole column's. Stage 2 fills what is left with medians that
    already include the stage-1 fills: the entity's over all years, else the global one. A column without any
    value raises when the result is computed.
    """
    cols = list(cols)
    df = stored(df.withColumn(flag, F.expr(" or ".join(f"`{c}` is null" for c in cols))))  # read for each level of the medians

    later = df.filter(F.col(year) >= cutoff)
    late = {f"__late_{c}": F.when(F.col(year) >= cutoff, F.col(c)) for c in cols}
    overall = constants(group_median(df.withColumns(late), [], [*cols, *late]))
    fallback = {c: F.coalesce(overall[f"__late_{c}"], overall[c]) for c in cols}
    early = F.col(year) < cutoff

    def filled(frame: DataFrame, source: DataFrame, names: Sequence[str], fill) -> DataFrame:
        own = group_median(source, [entity], names).withColumnsRenamed({c: f"__m_{c}" for c in names})
        joined = join_on(frame, own, [entity])
        return joined.withColumns({c: F.coalesce(F.col(c), fill(c)) for c in names}).drop(
            *[f"__m_{c}" for c in names]
        )

    # Stage 2 reads the stage-1 result several times, so it is stored once.
    first = stored(
        filled(df, later, cols, lambda c: F.when(early, F.coalesce(F.col(f"__m_{c}"), fallback[c])))
    )
    left = first.agg(*[F.expr(f"count_if(`{c}` is null)").alias(c) for c in cols]).first()
    open_cols = [c for c in cols if left[c]]
    if not open_cols:
        return first
    overall_now = constants(group_median(first, [], open_cols))
    no_value = lambda c: F.raise_error(F.lit(f"no median for {c}")).cast("double")
    return filled(
        first,
        first,
        open_cols,
        lambda c: F.coalesce(F.col(f"__m_{c}"), overall_now[c], fallback[c], no_value(c)),
    )


def fill_global_median(df: DataFrame, col: str, year: str, cutoff: int = 2006) -> DataFrame:
    """Fill one column with its global median over the years from `cutoff` on."""
    later = df.filter(F.col(year) >= cutoff)
    median = constants(group_median(later, [], [col]))[col]
    return df.withColumn(col, F.coalesce(F.col(col), median))
