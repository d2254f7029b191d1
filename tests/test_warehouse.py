"""Versioned dimensions, imputation, quality checks, the yearly fact, reshaping."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.operators import aggregates, dims, joins, quality, reshape
from ledgerline.operators.impute import impute_median
from ledgerline.plans import facts
from ledgerline.sources import tables
from tests.conftest import as_set, close

DIM = "code string, name string, type string, capital double"
OPEN = dt.date(9999, 12, 31)
START = dt.date(2002, 1, 1)


def apply(current, incoming, day):
    return dims.scd2_apply(current, incoming, "code", ["name", "type"], day, ["capital"])


def test_scd2_history(spark):
    first = dims.scd2_open(spark.createDataFrame([("A", "a", "x", 1.0), ("B", "b", "x", None), ("C", "c", "x", 3.0)], DIM))
    day1, day2 = dt.date(2020, 5, 1), dt.date(2021, 5, 1)
    # A renamed, B unchanged, C's missing capital is no change, D new.
    second = apply(first, spark.createDataFrame([("A", "a2", "x", 1.0), ("B", "b", "x", None), ("C", "c", "x", None), ("D", "d", "y", 1.0)], DIM), day1)
    cols = ("code", "name", "capital", "valid_from", "valid_to", "is_current")
    assert as_set(second, *cols) == {
        ("A", "a", 1.0, START, dt.date(2020, 4, 30), False),
        ("A", "a2", 1.0, day1, OPEN, True),
        ("B", "b", None, START, OPEN, True),
        ("C", "c", 3.0, START, OPEN, True),
        ("D", "d", 1.0, START, OPEN, True),
    }
    # Missing from the source: kept. Capital set: a change.
    third = apply(second, spark.createDataFrame([("B", "b", "x", 9.0)], DIM), day2)
    assert as_set(third.filter("code = 'B'"), *cols) == {
        ("B", "b", None, START, dt.date(2021, 4, 30), False),
        ("B", "b", 9.0, day2, OPEN, True),
    }
    assert third.filter("code <> 'B'").count() == 4
    # Again on the same day: the day's version is replaced, not closed before it began.
    fourth = apply(third, spark.createDataFrame([("B", "bb", "x", 9.0)], DIM), day2)
    assert as_set(fourth.filter("code = 'B' and is_current"), "name", "valid_from") == {("bb", day2)}
    assert fourth.filter("valid_to < valid_from").count() == 0
    assert as_set(apply(fourth, spark.createDataFrame([("B", "bb", "x", 9.0)], DIM), day2)) == as_set(fourth)


def test_scd2_intervals_never_overlap(spark):
    rng = random.Random(4)
    state = dims.scd2_open(spark.createDataFrame([(f"K{i}", "n0", "t", 0.0) for i in range(8)], DIM))
    for step in range(3):
        rows = [(f"K{i}", f"n{rng.randint(0, 2)}", "t", rng.choice([None, 1.0, 2.0])) for i in range(10)]
        state = apply(state, spark.createDataFrame(rows, DIM), dt.date(2020 + step, 1, 1))
    rows = sorted(state.collect(), key=lambda r: (r["code"], r["valid_from"]))
    for a, b in zip(rows, rows[1:]):
        assert a["code"] != b["code"] or a["valid_to"] < b["valid_from"]
    current = [r["code"] for r in rows if r["is_current"]]
    assert len(current) == len(set(current)) == 10


def test_point_in_time_join(spark):
    dim = spark.createDataFrame([("A", 1, dt.date(2020, 1, 1), dt.date(2020, 12, 31)), ("A", 2, dt.date(2021, 1, 1), OPEN)], "k string, v int, valid_from date, valid_to date")
    fact = spark.createDataFrame([("A", dt.date(2020, 12, 31)), ("A", dt.date(2021, 1, 1)), ("A", dt.date(2019, 1, 1)), ("Z", dt.date(2021, 1, 1))], "k string, d date")
    assert as_set(joins.scd2_asof_join(fact, dim, "k", "d"), "k", "d", "v") == {
        ("A", dt.date(2020, 12, 31), 1), ("A", dt.date(2021, 1, 1), 2), ("A", dt.date(2019, 1, 1), None), ("Z", dt.date(2021, 1, 1), None),
    }


def brute_impute(data, cols, cutoff):
    data = data.copy()
    data["is_imputed"] = data[cols].isna().any(axis=1)
    for c in cols:
        later = data[data.year >= cutoff]
        own, overall = later.groupby("e")[c].median(), later[c].median()
        overall = data[c].median() if pd.isna(overall) else overall
        early = data[c].isna() & (data.year < cutoff)
        data.loc[early, c] = data.loc[early, "e"].map(own).fillna(overall)
        gaps = data[c].isna()
        everything = data[c].median()
        fill = data.groupby("e")[c].median().reindex(data.loc[gaps, "e"]).to_numpy()
        fill = np.where(np.isnan(fill), overall if pd.isna(everything) else everything, fill)
        data.loc[gaps, c] = fill
    return data


@pytest.mark.parametrize("cutoff", [2003, 2006, 2050])
def test_imputation_matches_brute_force(spark, cutoff):
    rng = random.Random(2)
    rows = []
    for e in "abcdef":
        for year in range(2000, 2010):
            hole = lambda: None if rng.random() < 0.45 or e == "f" or (e == "e" and year > 2004) else rng.random()
            rows.append((e, year, hole(), hole()))
    data = pd.DataFrame(rows, columns=["e", "year", "r", "q"])
    want = brute_impute(data.astype({"r": float, "q": float}), ["r", "q"], cutoff)
    df = spark.createDataFrame(rows, "e string, year int, r double, q double").repartition(4)
    got = {(r["e"], r["year"]): r for r in impute_median(df, "e", "year", ["r", "q"], cutoff).collect()}
    assert len(got) == len(rows)
    for w in want.itertuples():
        g = got[w.e, w.year]
        assert close(g["r"], w.r) and close(g["q"], w.q) and g["is_imputed"] == w.is_imputed


def test_imputation_of_an_empty_column_fails(spark):
    df = spark.createDataFrame([("a", 2001, None)], "e string, year int, r double")
    with pytest.raises(Exception, match="no median"):
        impute_median(df, "e", "year", ["r"]).collect()


def test_bank_performance(spark):
    raw = [
        (" aaa", "2005", "jscb", "1,000", "400", "500", "100", "3.5", "10", "4", None, "2"),
        ("AAA ", "2010", "jscb", "2000", "0", "500", "100", "2.5", "10", "4", "5", "2"),
        ("bbb", "2010", "socb", "2000", "800", "1000", "200", " nan ", "10", "4", "5", "2"),
        ("bbb", "2010", "socb", "2000", "800", "1000", "200", " nan ", "10", "4", "5", "2"),
    ]
    names = ["Bank Code", "Year", "Classification", "Total Assets", "Total Deposits", "Total Loans", "Total Shareholder's Equity",
             "Non-performing Loans Ratio", "Interest Incomes", "Interest Expenses", "Non-Interest Income", "Non-Interest Expenses"]
    df = spark.createDataFrame(raw, ", ".join(f"`{n}` string" for n in names))
    df = df.withColumns({"Profits After Tax": F.lit("20"), "Loan Loss Provisions": F.lit("5")})
    banks = spark.createDataFrame([("1", "Bank A", "aaa", "jscb"), ("2.0", " Bank B", "BBB", "socb"), ("3", "Twin", "bbb", "x"), ("4", None, "c", "x")],
                                  "`No.` string, `Bank ` string, `Bank Code` string, `Type of ownership` string")
    fact, dim, profile = facts.bank_performance(df, banks)
    assert as_set(dim, "bank_key", "bank_code", "bank_type", "bank_name") == {(1, "AAA", "JSCB", "Bank A"), (2, "BBB", "SOCB", "Bank B")}
    rows = {(r["bank_key"], r["date_key"]): r for r in fact.collect()}
    assert set(rows) == {(1, 20051231), (1, 20101231), (2, 20101231)}
    early, later, other = rows[1, 20051231], rows[1, 20101231], rows[2, 20101231]
    assert close(early["npl_ratio"], 0.035) and close(early["eta"], 0.1) and close(early["nim"], 0.006)
    assert close(later["cir"], 2 / 11) and close(early["cir"], 2 / 11) and early["is_imputed"]  # own median of later years
    assert close(early["ltd"], 1.25) and close(later["ltd"], 1.25)  # a zero denominator is a gap, filled in stage 2
    assert close(other["npl_ratio"], 0.03) and other["is_imputed"]  # stage 2: median of 0.035 and 0.025
    assert fact.columns == [c for c in fixed.FACT_BANK_PERFORMANCE]
    assert dict(profile.select("column", "missing_count").collect())["total_assets"] == 0
    with pytest.raises(ValueError, match="unmapped"):
        facts.bank_performance(df, banks.filter("`No.` <> '1'"))


def test_lookup_join(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(ValueError, match="duplicate"):
        joins.lookup_join(left, spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"), ["k"])
    loose = joins.lookup_join(left, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], strict=False)
    assert as_set(loose) == {(1, "a"), (2, None)}


def test_quality_report(spark):
    fact = spark.createDataFrame([(1, 10, 5.0), (1, 10, -1.0), (2, None, None), (9, 10, 3.0)], "k int, d int, close double").withColumn("audit_key", F.lit(1))
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    rules = [
        quality.TableRules("fact", ("k", "d", "close"), ("d", "k"), {"k": "dim"}, {"close_positive": F.col("close") <= 0}),
        quality.TableRules("dim", unique=("k",)),
    ]
    report = quality.run_checks({"fact": fact, "dim": dim}, rules)
    assert as_set(report) == {
        ("not_null:k", "fact", 0), ("not_null:d", "fact", 1), ("not_null:close", "fact", 1), ("audit:audit_key", "fact", 0),
        ("check:close_positive", "fact", 1), ("unique:d,k", "fact", 1), ("foreign:k", "fact", 1),
        ("audit:audit_key", "dim", 1), ("unique:k", "dim", 0),
    }
    assert quality.total_violations(report).first()[0] == 6
    good, bad = quality.quarantine(fact, {"no_close": F.col("close").isNull(), "low": F.col("close") <= 0}, {"big": F.col("close") > 4})
    assert as_set(bad.select("k", F.concat_ws(",", "dq_reasons"))) == {(2, "no_close"), (1, "low")}
    assert as_set(good.select("k", F.concat_ws(",", "dq_flags"))) == {(1, "big"), (9, "")}


def test_transpose_and_dictionary(spark):
    wide = spark.createDataFrame([("Cash", "cash", "c1", 1.0, None, 3.0), ("Debt.x", "debt", "d1", 4.0, 5.0, 6.0)],
                                 "item string, item_en string, item_id string, `2024` double, `2023-Q1` double, `2025` double")
    got = reshape.transpose_report(wide)
    assert got.columns == ["period", "Cash", "Debt.x"]
    assert [tuple(r) for r in got.collect()] == [("2023-Q1", None, 5.0), ("2024", 1.0, 4.0), ("2025", 3.0, 6.0)]
    book = reshape.item_dictionary({"b": wide, "i": wide.drop("item_en").unionAll(wide.drop("item_en"))})
    assert book.columns == ["report_type", "item_id", "item_vi", "item_en"]
    assert as_set(book) == {("b", "c1", "Cash", "cash"), ("b", "d1", "Debt.x", "debt"), ("i", "c1", "Cash", None), ("i", "d1", "Debt.x", None)}


def test_describe_matches_pandas(spark):
    v = [1.0, 2.0, 2.0, 9.0, None, 4.0]
    got = aggregates.describe_exact(spark.createDataFrame([(x,) for x in v], "v double"), ["v"]).first()
    s = pd.Series(v)
    for name, want in zip(("count", "mean", "std", "min", "q1", "median", "q3", "max"), s.describe()):
        assert close(float(got[name]), want)
    assert close(got["skew"], s.skew())
    flat = aggregates.describe_exact(spark.createDataFrame([(1.0,)] * 4, "v double"), ["v"]).first()
    assert flat["skew"] == 0.0 and flat["std"] == 0.0


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 5, 10, 10)], "v double")
    assert [r["n"] for r in aggregates.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 1, 0, 2]
    flat = aggregates.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", 4)
    assert sum(r["n"] for r in flat.collect()) == 3


def test_degenerate_statistics(spark):
    df = spark.createDataFrame([(1.0, 1.0, None), (1.0, 2.0, None)], "a double, b double, c double")
    assert as_set(aggregates.corr_matrix(df, ["a", "b", "c"]), "corr") <= {(None,), (1.0,), (0.9999999999999998,)}
    assert aggregates.trend_line(df, "a", "b").first()["slope"] is None
    out = aggregates.iqr_outliers(df, ["b"]).first()
    assert (out["q1"], out["n_outliers"], out["outlier_pct"]) == (1.25, 0, 0.0)


def test_union_and_append_keep_the_first(spark):
    a, b = spark.createDataFrame([(1, "x")], "t int, v string"), spark.createDataFrame([(1, "y"), (2, "y")], "t int, v string")
    assert as_set(tables.append_segments([a, b], ["t"])) == {(1, "x"), (2, "y")}
    assert as_set(tables.append_segments([b, a], ["t"])) == {(1, "y"), (2, "y")}


def test_row_wise_operators_on_a_stream(spark, tmp_path):
    from ledgerline.operators import filters
    from ledgerline.streaming import STATELESS

    assert facts.ohlcv_metrics in STATELESS and filters.range_trim in STATELESS
    cols = "open_price double, high_price double, low_price double, close_price double, trading_volume bigint"
    spark.createDataFrame([(10.0, 12.0, 9.0, 11.0, 5), (10.0, 12.0, 9.0, None, 5)], cols).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(cols).parquet(str(tmp_path / "in"))
    shaped = facts.ohlcv_metrics(filters.require_not_null(stream, ["close_price"]))
    query = shaped.writeStream.format("memory").queryName("bars").start()
    query.processAllAvailable()
    query.stop()
    assert as_set(spark.table("bars"), "price_change", "trading_value") == {(1.0, 55.0)}
