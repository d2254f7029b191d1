"""Ordered series and windows over them that stay bounded for any series length.

A window partitioned by the series key alone puts a whole series in one task. That is fine for daily or
yearly grain, where the calendar bounds a series (about 9,100 days in 25 years). For raw-grain series
(ticks, order lines) give `segment`, a non-decreasing function of the order columns such as the hour of
the timestamp: the series is then numbered segment by segment and cut into chunks of `chunk_rows` rows,
each with the few neighbouring rows its frames reach into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_NULL_KEY = "series keys and segment must not be NULL"
_SEG, _POS, _OFFSET, _CHUNK, _OWN = "__seg", "__pos", "__offset", "__chunk", "__own"


@dataclass(frozen=True)
class Series:
    """Key columns, a total order inside a key, and for raw grain a segment expression."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    segment: Column | str | None = None  # a column or a SQL expression
    chunk_rows: int = 1_000_000
    position: str | None = None  # column already holding the row number, see `numbered`

    @classmethod
    def of(
        cls,
        keys: str | Sequence[str],
        order: str | Sequence[str],
        segment: Column | str | None = None,
        chunk_rows: int = 1_000_000,
    ) -> "Series":
        as_tuple = lambda x: (x,) if isinstance(x, str) else tuple(x)
        return cls(as_tuple(keys), as_tuple(order), segment, chunk_rows)

    @property
    def segment_column(self) -> Column:
        return F.expr(self.segment) if isinstance(self.segment, str) else self.segment

    @property
    def window(self) -> WindowSpec:
        return W.partitionBy(*self.keys).orderBy(*self.order)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join that keeps the left key columns."""
    if not keys:
        raise ValueError("join_on needs at least one key")
    names = [f"__r_{i}" for i in range(len(keys))]
    right = right.withColumnsRenamed(dict(zip(keys, names)))
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return left.join(right, condition, how).drop(*names)


def position(df: DataFrame, s: Series, out: str = _POS) -> DataFrame:
    """1-based row number inside each series, exact and without gathering a series in one task."""
    if s.position:
        return df if out == s.position else df.withColumn(out, F.col(s.position))
    if s.segment is None:
        return df.withColumn(out, F.row_number().over(s.window).cast("bigint"))
    df = df.withColumn(_SEG, s.segment_column)
    part = [*s.keys, _SEG]
    before = W.partitionBy(*s.keys).orderBy(_SEG).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_OFFSET))
    )
    local = F.row_number().over(W.partitionBy(*part).orderBy(*s.order))
    # Plain equality on (keys, segment): the join and the window share one shuffle.
    start = F.coalesce(F.col(_OFFSET), F.raise_error(F.lit(_NULL_KEY)).cast("bigint"))
    return (
        df.join(offsets, part, "left").withColumn(out, (start + local).cast("bigint")).drop(_SEG, _OFFSET)
    )


def numbered(df: DataFrame, s: Series, out: str = "row_no") -> tuple[DataFrame, Series]:
    """Number the rows once and return the series that reuses the number: each further frame is one shuffle."""
    return position(df, s, out), replace(s, position=out)


def framed(
    df: DataFrame,
    s: Series,
    before: int,
    after: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Add window columns whose frames reach at most `before` rows back and `after` rows ahead."""
    if s.segment is None:
        return df.withColumns(columns(s.window))
    size = max(s.chunk_rows, before + after + 1)
    with_position = position(df, s)
    own = F.floor((F.col(_POS) - 1) / size).cast("bigint")
    at = (F.col(_POS) - 1) % size
    copies = F.array_compact(
        F.array(own, F.when(at >= size - before, own + 1), F.when((at < after) & (own > 0), own - 1))
    )
    spread = with_position.withColumns({_OWN: own, _CHUNK: F.explode(copies)})
    w = W.partitionBy(*s.keys, _CHUNK).orderBy(_POS)
    return (
        spread.withColumns(columns(w))
        .filter(F.col(_CHUNK) == F.col(_OWN))
        .drop(_POS, _OWN, _CHUNK)
    )


def carried(df: DataFrame, s: Series, columns: dict[str, str]) -> DataFrame:
    """Last non-null value strictly before each row, however far back; `columns` maps input to output."""
    if s.segment is None:
        past = s.window.rowsBetween(W.unboundedPreceding, -1)
        return df.withColumns({o: F.last(c, ignorenulls=True).over(past) for c, o in columns.items()})
    df = df.withColumn(_SEG, s.segment_column)
    part = [*s.keys, _SEG]
    at = F.struct(*s.order)
    ends = df.groupBy(*part).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"__e_{c}") for c in columns]
    )
    earlier = W.partitionBy(*s.keys).orderBy(_SEG).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(
        *part, *[F.last(f"__e_{c}", ignorenulls=True).over(earlier).alias(f"__c_{c}") for c in columns]
    )
    ends = ends.withColumn("__seen", F.lit(True))
    inside = W.partitionBy(*part).orderBy(*s.order).rowsBetween(W.unboundedPreceding, -1)
    known = F.coalesce(F.col("__seen"), F.raise_error(F.lit(_NULL_KEY)).cast("boolean"))
    return (
        df.join(ends, part, "left")
        .filter(known)
        .withColumns(
            {
                o: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"__c_{c}"))
                for c, o in columns.items()
            }
        )
        .drop(_SEG, "__seen", *[f"__c_{c}" for c in columns])
    )
