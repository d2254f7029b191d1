"""Fact tables: cleaning of the four daily sources, the daily metrics fact and the yearly bank fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions.scalars import clean_code, clean_numeric, date_key, net_flow, to_whole, year_end_key
from ledgerline.operators.aggregates import profile
from ledgerline.operators.dims import bank_dim
from ledgerline.operators.filters import require_not_null
from ledgerline.operators.impute import impute_median
from ledgerline.operators.joins import lookup_join
from ledgerline.operators.scaling import normalize_percent
from ledgerline.operators.series import Series
from ledgerline.operators.windows import dedupe_first, ffill, pct_change
from ledgerline.sources.tables import rename_aliases
from ledgerline.spec import RunContext, with_audit
from ledgerline.storage import checkpointed


@dataclass(frozen=True)
class FactRules:
    """How one daily source becomes a fact: headers, column types, and what to do with gaps."""

    aliases: Mapping[str, str]
    required: tuple[str, ...]
    whole: tuple[str, ...] = ()
    real: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    fill: tuple[str, ...] = ()
    net: dict[str, tuple[str, str]] = field(default_factory=dict)  # net column -> (buy, sell)

    @property
    def values(self) -> tuple[str, ...]:
        return (*self.real, *self.whole)


PRICE_RULES = FactRules(
    fixed.PRICE_HEADERS,
    ("date", "open_price", "high_price", "low_price", "close_price", "trading_volume"),
    whole=("trading_volume",),
    real=("open_price", "high_price", "low_price", "close_price"),
    not_null=("close_price",),
)
FOREIGN_RULES = FactRules(
    fixed.FOREIGN_HEADERS,
    ("date", "foreign_buy_volume", "foreign_sell_volume", "foreign_ownership_ratio"),
    whole=("foreign_buy_volume", "foreign_sell_volume", "foreign_net_volume"),
    real=("foreign_net_value", "foreign_ownership_ratio"),
    fill=(
        "foreign_buy_volume",
        "foreign_sell_volume",
        "foreign_net_volume",
        "foreign_net_value",
        "foreign_ownership_ratio",
    ),
    net={"foreign_net_volume": ("foreign_buy_volume", "foreign_sell_volume")},
)
PROPRIETARY_RULES = FactRules(
    fixed.PROPRIETARY_HEADERS,
    ("date", "prop_buy_volume", "prop_sell_volume"),
    whole=("prop_buy_volume", "prop_sell_volume", "prop_net_volume"),
    real=("prop_net_value",),
    fill=("prop_buy_volume", "prop_sell_volume", "prop_net_volume", "prop_net_value"),
    net={"prop_net_volume": ("prop_buy_volume", "prop_sell_volume")},
)
ORDER_STATS_RULES = FactRules(
    fixed.ORDER_STATS_HEADERS,
    ("date", "total_buy_orders", "total_buy_volume", "total_sell_orders", "total_sell_volume", "matched_volume"),
    whole=("total_buy_orders", "total_buy_volume", "total_sell_orders", "total_sell_volume", "matched_volume"),
    not_null=(
        "date",
        "total_buy_orders",
        "total_buy_volume",
        "total_sell_orders",
        "total_sell_volume",
        "matched_volume",
    ),
)


def clean_fact(
    df: DataFrame,
    rules: FactRules,
    key: str = "stock_key",
    run: RunContext | None = None,
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Headers, types, gaps, date key, one row per (date, key), optional audit columns.

    Rows without a date that parses, or without a value that the rules require (after typing), are rejected.

    `order` decides which duplicate survives; without it the value columns do.
    """
    df = rename_aliases(df, rules.aliases, rules.required)
    have = set(df.columns)
    typed = {c: clean_numeric(c) if c in have else F.lit(None).cast("double") for c in rules.real}
    typed |= {c: to_whole(c) if c in have else F.lit(None).cast("bigint") for c in rules.whole}
    df = df.withColumns(typed)
    # A net column is derived only where the source lacks it altogether.
    df = df.withColumns({n: net_flow(b, s) for n, (b, s) in rules.net.items() if n not in have})
    df = df.withColumn("date_key", date_key(F.col("date").try_cast("date")))
    # Rejected only now: text that is no number, and a date that does not parse, are as missing as a gap.
    df = require_not_null(df, [*rules.not_null, "date_key"])
    df = dedupe_first(df, ["date_key", key], [*order, *rules.values])
    if rules.fill:
        # One row per day by now, so the calendar bounds each key's window.
        df = ffill(df, Series.of(key, "date_key"), rules.fill, 1)
    df = df.select("date_key", key, *rules.values)
    return with_audit(df, run) if run else df


def ohlcv_metrics(df: DataFrame) -> DataFrame:
    """Change, amplitude and traded value of daily bars."""
    o, h, lo, c = (F.col(f"{p}_price") for p in ("open", "high", "low", "close"))
    return df.withColumns(
        {
            "price_change": c - o,
            "price_amplitude": F.try_divide(h - lo, o),
            "trading_value": c * F.col("trading_volume"),
        }
    )


DAILY_COLUMNS = list(fixed.FACT_STOCK_DAILY_METRICS)


def daily_metrics(
    prices: DataFrame, key: str = "stock_key", run: RunContext | None = None, order: Sequence[str | Column] = ()
) -> DataFrame:
    """Daily bars to the metrics fact: one row per (date, key) with the five derived measures.

    After the dedupe a key has one row per day, so its window is bounded by the calendar.
    """
    bars = [c for c in DAILY_COLUMNS[2:7]]
    whole = ("date_key", "trading_volume")
    df = prices.select(
        key, *[(to_whole(c) if c in whole else F.col(c).try_cast("double")).alias(c) for c in ("date_key", *bars)]
    )
    df = dedupe_first(df, ["date_key", key], [*order, *bars])
    df = pct_change(
        df,
        Series.of(key, "date_key"),
        {"close_price": "price_change_pct", "trading_volume": "volume_change_pct"},
    )
    df = ohlcv_metrics(df).select(*[key if c == "stock_key" else c for c in DAILY_COLUMNS])
    return with_audit(df, run) if run else df


def stock_features(fact: DataFrame, key: str = "stock_key") -> DataFrame:
    """Model features of daily bars: both changes with 0 for undefined, complete rows only."""
    bars = DAILY_COLUMNS[2:7]
    df = pct_change(
        fact.select("date_key", key, *bars),
        Series.of(key, "date_key"),
        {"close_price": "price_change_pct", "trading_volume": "volume_change_pct"},
    )
    return df.dropna()


def bars_from_ticks(
    ticks: DataFrame, key: str, ts: str, price: str, volume: Column | str, sequence: Sequence[str]
) -> DataFrame:
    """Daily open/high/low/close/volume per key; map-side combined, so a hot key shuffles one row per day."""
    at = F.col(sequence[0]) if len(sequence) == 1 else F.struct(*sequence)  # a struct would need a sorted aggregate
    amount = F.sum(volume) if isinstance(volume, str) else volume
    return ticks.groupBy(F.col(key), date_key(ts).alias("date_key")).agg(
        F.min_by(price, at).alias("open_price"),
        F.max(price).alias("high_price"),
        F.min(price).alias("low_price"),
        F.max_by(price, at).alias("close_price"),
        amount.cast("bigint").alias("trading_volume"),
    )


def camels_ratios(df: DataFrame) -> DataFrame:
    """Ratios of the yearly statements: given values win, else they are derived; lta, ltd, gta always are."""
    df = df.withColumn("net_interest_income", F.expr("interest_income - interest_expense"))
    given = {
        "eta": "total_equity, total_assets",
        "etd": "total_equity, total_deposits",
        "roa": "profit_after_tax, total_assets",
        "roe": "profit_after_tax, total_equity",
        "nim": "net_interest_income, total_assets",
        "cir": "non_interest_expense, abs(net_interest_income) + abs(non_interest_income)",
        "npl_ratio": "npl_amount, total_loans",
        "llp_ratio": "loan_loss_provision, total_loans",
    }
    derived = {
        "lta": "total_loans, total_assets",
        "ltd": "total_loans, total_deposits",
        "gta": "total_loans, total_assets",
    }
    return df.withColumns(
        {c: F.expr(f"coalesce({c}, try_divide({parts}))") for c, parts in given.items()}
        | {c: F.expr(f"try_divide({parts})") for c, parts in derived.items()}
    )


def standardize_banks(raw: DataFrame) -> DataFrame:
    """Canonical names, clean codes and numbers, fractions instead of percents, date key and ratios."""
    df = rename_aliases(raw, fixed.BANK_HEADERS, ["bank_code", "year"])
    text = {"bank_code", "bank_type"}
    wanted = set(fixed.BANK_HEADERS.values()) - text
    df = df.withColumns(
        {c: F.lit(None).cast("double") for c in sorted(wanted - set(df.columns))}
    )
    numbers = [c for c in df.columns if c not in text and c != "year"]
    df = df.withColumns(
        {c: clean_code(c) for c in text if c in df.columns}
        | {"year": to_whole("year")}
        | {c: clean_numeric(c) for c in numbers}
    )
    df = normalize_percent(df, fixed.PERCENT_COLUMNS, fixed.PERCENT_LIMIT)
    return camels_ratios(df).withColumn("date_key", year_end_key("year"))


def bank_performance(
    raw: DataFrame, banks: DataFrame, run: RunContext | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fact, bank dimension, column profile) from yearly statements and the bank list."""
    dim = bank_dim(banks)
    # Stored once: the key check, the medians and the fact all read it.
    df = checkpointed(standardize_banks(raw))
    df = lookup_join(df, dim.select("bank_key", "bank_code"), ["bank_code"])
    df = impute_median(df, "bank_code", "year", fixed.IMPUTED_RATIOS, fixed.IMPUTE_CUTOFF_YEAR)
    columns = [c for c in fixed.FACT_BANK_PERFORMANCE if c in df.columns]
    shaped = df.select(*columns)
    types = fixed.FACT_BANK_PERFORMANCE
    fact = dedupe_first(shaped, ["date_key", "bank_key"], columns[2:]).select(
        *[F.expr(f"try_cast(`{c}` as {types[c]})").alias(c) for c in columns]
    )
    return (with_audit(fact, run) if run else fact), dim, profile(shaped)
