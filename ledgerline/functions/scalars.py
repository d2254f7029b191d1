"""Column expressions; all stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_numeric(c: Column | str, to: str = "double") -> Column:
    """Text to number: commas and outer blanks go, empty/nan/None and bad text give NULL."""
    if isinstance(c, str):  # one parsed expression; wide tables clean dozens of columns
        text = f"trim(replace(cast(`{c}` as string), ',', ''))"
        return F.expr(f"try_cast(if(lower({text}) in ('', 'nan', 'none'), null, {text}) as {to})")
    text = F.trim(F.replace(c.cast("string"), F.lit(","), F.lit("")))
    return F.when(~F.lower(text).isin("", "nan", "none"), text).try_cast(to)


def clean_code(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c).cast("string")))


def clean_name(c: Column | str) -> Column:
    return F.trim(_col(c).cast("string"))


def to_whole(c: Column | str) -> Column:
    """Text or number to bigint; '12.0' is 12, a fraction or bad text is NULL."""
    value = _col(c)
    real = value.try_cast("double")
    return F.coalesce(
        value.cast("string").try_cast("bigint"),
        F.when(real == F.floor(real), real.try_cast("bigint")),
    )


def date_key(c: Column | str) -> Column:
    """Date to the integer YYYYMMDD."""
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def year_end_key(c: Column | str) -> Column:
    return (_col(c).cast("bigint") * 10000 + 1231).cast("bigint")


def key_to_date(c: Column | str) -> Column:
    return F.to_date(_col(c).cast("string"), "yyyyMMdd")


def key_to_year(c: Column | str) -> Column:
    return F.floor(_col(c) / 10000).cast("bigint")


def month_label(c: Column | str) -> Column:
    return F.date_format(F.to_date(_col(c)), "yyyy-MM")


def period_label(year: Column | str, quarter: Column | str) -> Column:
    """'YYYY' for annual rows (quarter code 5), else 'YYYY-Qn'."""
    y, q = _col(year).cast("string"), _col(quarter)
    return F.when(q == 5, y).otherwise(F.concat_ws("-Q", y, q.cast("string")))


def time_seconds(c: Column | str) -> Column:
    """'HH:MM:SS' text to int seconds since midnight; anything else is NULL."""
    text = F.trim(_col(c).cast("string"))
    ok = text.rlike(r"^([01]?\d|2[0-3]):[0-5]\d:[0-5]\d$")
    part = F.split(F.when(ok, text), ":")
    return (
        F.get(part, F.lit(0)).try_cast("int") * 3600
        + F.get(part, F.lit(1)).try_cast("int") * 60
        + F.get(part, F.lit(2)).try_cast("int")
    )


def seconds_of_day(ts: Column | str) -> Column:
    t = _col(ts)
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("int")


def ratio_or(given: Column | str, num: Column | str, den: Column | str) -> Column:
    """The given ratio, else num/den (NULL on a zero denominator)."""
    return F.coalesce(_col(given), F.try_divide(_col(num), _col(den)))


def net_flow(buy: Column | str, sell: Column | str, net: Column | str | None = None) -> Column:
    diff = _col(buy) - _col(sell)
    return diff if net is None else F.coalesce(_col(net), diff)


def active_buy_ratio(buy: Column | str, sell: Column | str) -> Column:
    return F.try_divide(_col(buy).cast("double"), (_col(buy) + _col(sell)).cast("double"))


def threshold_label(c: Column | str, threshold: float) -> Column:
    """1 when at or above the threshold, else 0; NULL counts as 0."""
    return F.coalesce((_col(c) >= F.lit(threshold)).cast("int"), F.lit(0))


def finite_or_zero(c: Column | str) -> Column:
    v = _col(c).cast("double")
    bad = v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(v)


def map_label(c: Column | str, labels: Mapping) -> Column:
    """Look a code up in a fixed mapping; unknown codes give NULL."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.try_element_at(table, _col(c))


def percent_text(c: Column | str, digits: int = 2, signed: bool = False) -> Column:
    return F.format_string(f"%{'+' if signed else ''}.{digits}f%%", _col(c).cast("double"))
