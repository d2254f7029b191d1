"""Scalars, sources and fact cleaning on the awkward rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import scalars as S
from ledgerline.operators import filters, joins, scaling
from ledgerline.plans import facts
from ledgerline.sources import sinks, tables
from ledgerline.spec import WAREHOUSE, RunContext, TableSpec, with_audit
from tests.conftest import as_set, close

RUN = RunContext(20240102030405, dt.datetime(2024, 1, 2, 3, 4, 5), "src.csv", "r1")


def one(spark, column, value, ddl="string"):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(column("v")).first()[0]


@pytest.mark.parametrize(
    "text, want",
    [("1,234.5", 1234.5), (" nan ", None), ("", None), ("None", None), ("abc", None), ("-7", -7.0), (None, None), ("1e3", 1000.0)],
)
def test_clean_numeric(spark, text, want):
    assert one(spark, S.clean_numeric, text) == want


@pytest.mark.parametrize("text, want", [("12", 12), ("12.0", 12), ("12.5", None), ("x", None), ("9007199254740993", 9007199254740993)])
def test_to_whole(spark, text, want):
    assert one(spark, S.to_whole, text) == want


@pytest.mark.parametrize("text, want", [("09:15:00", 33300), ("24:00:00", None), ("9:05", None), ("00:00:00", 0)])
def test_time_seconds(spark, text, want):
    assert one(spark, S.time_seconds, text) == want


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 29),)], "d date")
    row = df.select(
        S.date_key("d"), S.year_end_key(F.year("d")), S.key_to_date(S.date_key("d")), S.key_to_year(S.date_key("d"))
    ).first()
    assert tuple(row) == (20200229, 20201231, dt.date(2020, 2, 29), 2020)


def test_ratios_and_labels(spark):
    df = spark.createDataFrame([(None, 1.0, 0.0), (0.4, 1.0, 2.0), (None, 1.0, 4.0)], "r double, a double, b double")
    assert [r[0] for r in df.select(S.ratio_or("r", "a", "b")).collect()] == [None, 0.4, 0.25]
    labels = spark.createDataFrame([(None,), (0.03,), (0.0299,)], "r double").select(S.threshold_label("r", 0.03))
    assert [r[0] for r in labels.collect()] == [0, 1, 0]
    odd = spark.createDataFrame([(float("nan"),), (float("-inf"),), (None,), (2.0,)], "v double").select(S.finite_or_zero("v"))
    assert [r[0] for r in odd.collect()] == [0.0, 0.0, 0.0, 2.0]


def test_period_label(spark):
    df = spark.createDataFrame([(2024, 5), (2024, 1)], "y int, q int")
    assert [r[0] for r in df.select(S.period_label("y", "q")).collect()] == ["2024", "2024-Q1"]


def test_calendar_size_and_holidays(spark):
    days = tables.calendar(spark)
    assert days.count() == 9131
    assert as_set(days.filter("date_key = 20240229"), "quarter", "is_trading_day") == {(1, True)}
    off = spark.createDataFrame([("2024-02-29",)], "full_date string")
    closed = tables.calendar(spark, "2024-02-28", "2024-03-02", off)
    assert [r["is_trading_day"] for r in closed.orderBy("date_key").collect()] == [True, False, True, False]


def test_small_dimensions(spark):
    assert tables.stock_dim(spark).count() == 4
    assert as_set(tables.session_dim(spark), "session_name", "start_time", "end_time") >= {("ATO", 32400, 33299)}


def test_session_bounds(spark):
    times = ["08:59:59", "09:14:59", "09:15:00", "11:30:00", "13:00:00", "14:45:00", "14:45:01"]
    df = spark.createDataFrame([(f"2024-01-01 {t}",) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = [r[0] for r in df.select(joins.session_of("t", fixed.SESSIONS)).collect()]
    assert got == [None, 1, 2, None, 3, 4, None]


def test_read_conform_coerce(spark, tmp_path):
    (tmp_path / "t.csv").write_text("valid_from,bank_code,bank_key,is_current,extra\n2020-01-01,AB,1.0,false,x\nbad,CD,y,maybe,x\n")
    dim = tables.read_table(spark, WAREHOUSE["dim_bank"], str(tmp_path / "t.csv"))
    assert dim.columns == list(WAREHOUSE["dim_bank"].columns)
    rows = {r["bank_code"]: r for r in dim.collect()}
    assert rows["AB"]["bank_key"] == 1 and rows["AB"]["is_current"] is False
    assert rows["AB"]["valid_to"] == dt.date(9999, 12, 31)
    assert rows["CD"]["bank_key"] is None and rows["CD"]["valid_from"] is None and rows["CD"]["is_current"] is None


def test_header_aliases(spark):
    df = spark.createDataFrame([(1, 2)], [" Ngày ", "Close"])
    assert tables.rename_aliases(df, fixed.PRICE_HEADERS, ["date", "close_price"]).columns == ["date", "close_price"]
    with pytest.raises(ValueError, match="missing"):
        tables.rename_aliases(df, fixed.PRICE_HEADERS, ["open_price"])
    with pytest.raises(ValueError, match="several"):
        tables.rename_aliases(spark.createDataFrame([(1, 2)], ["Date", "time"]), fixed.PRICE_HEADERS)


def test_normalize_percent(spark):
    df = spark.createDataFrame([(3.5, 1.2, None), (-150.0, 0.1, None)], "a double, b double, c double")
    assert as_set(scaling.normalize_percent(df, ["a", "b", "c", "absent"])) == {(0.035, 1.2, None), (-1.5, 0.1, None)}


def test_minmax_and_zscore_of_a_constant(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, None)], "i int, v double")
    assert as_set(scaling.zscore(df, ["v"]), "i", "v_z") == {(1, 0.0), (2, 0.0), (3, None)}
    assert as_set(scaling.minmax(df, ["v"], constant=0.5), "i", "v_scaled") == {(1, 0.5), (2, 0.5), (3, None)}


def test_zscore_ddof(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    assert [r["v_z"] for r in scaling.zscore(df, ["v"]).collect()] == [-1.0, 1.0]
    assert close(scaling.zscore(df, ["v"], ddof=1).first()["v_z"], -(0.5**0.5))


def test_price_cleaning(spark):
    rows = [
        ("2024-01-02", "1,000.5", "3", "1", "2", "10"),
        ("2024-01-02", "9", "9", "9", "9", "99"),
        ("2024-01-03", "x", "3", "1", "2", "12.0"),
        ("2024-01-04", "1", "3", "1", None, "5"),
    ]
    raw = spark.createDataFrame(rows, ["Date", " Open", "High ", "Low", "Close", "Volume"]).withColumn("stock_key", F.lit(1))
    got = facts.clean_fact(raw, facts.PRICE_RULES, order=["close_price"], run=RUN)
    assert as_set(got, "date_key", "open_price", "trading_volume", "audit_key") == {
        (20240102, 1000.5, 10, RUN.audit_key),
        (20240103, None, 12, RUN.audit_key),
    }


def test_flow_cleaning_fills_one_day(spark):
    rows = [("2024-01-01", None, "5"), ("2024-01-02", "7", "5"), ("2024-01-03", None, "5"), ("2024-01-04", None, "5")]
    raw = spark.createDataFrame(rows, ["Date", "Prop Buy Volume", "Prop Sell Volume"]).withColumn("stock_key", F.lit(1))
    got = facts.clean_fact(raw, facts.PROPRIETARY_RULES).orderBy("date_key").collect()
    assert [r["prop_buy_volume"] for r in got] == [None, 7, 7, None]
    assert [r["prop_net_volume"] for r in got] == [None, 2, 2, None]


def test_order_stats_reject_nulls(spark):
    cols = ["Date", "Total Buy Orders", "Total Buy Volume", "Total Sell Orders", "Total Sell Volume", "Matched Volume"]
    raw = spark.createDataFrame(
        [("2024-01-01", "1", "2", "3", "4", "5"), ("2024-01-02", "1", None, "3", "4", "5")], cols
    ).withColumn("stock_key", F.lit(1))
    assert as_set(facts.clean_fact(raw, facts.ORDER_STATS_RULES), "date_key") == {(20240101,)}


def test_price_cleaning_rejects_what_does_not_parse(spark):
    rows = [(d, "1", "1", "1", c, "1") for d, c in (("2024-01-02", "nan"), ("2024-01-03", "abc"), ("2024-01-04", "5"), ("bad", "6"), ("worse", "7"))]
    raw = spark.createDataFrame(rows, ["Date", "Open", "High", "Low", "Close", "Volume"]).withColumn("stock_key", F.lit(1))
    assert as_set(facts.clean_fact(raw, facts.PRICE_RULES), "date_key", "close_price") == {(20240104, 5.0)}


def test_daily_metrics_by_hand(spark):
    rows = [(20240102, 1, 10.0, 12.0, 9.0, 11.0, 0), (20240103, 1, 0.0, 12.0, 9.0, 22.0, 50), (20240102, 1, 10.0, 12.0, 9.0, 11.0, 0)]
    cols = "date_key bigint, stock_key bigint, open_price double, high_price double, low_price double, close_price double, trading_volume bigint"
    got = facts.daily_metrics(spark.createDataFrame(rows, cols)).orderBy("date_key").collect()
    first, second = got
    assert (first["price_change"], first["price_change_pct"], first["trading_value"]) == (1.0, 0.0, 0.0)
    assert close(first["price_amplitude"], 0.3) and close(second["price_change_pct"], 1.0)
    assert second["price_amplitude"] is None and second["volume_change_pct"] == 0.0


def test_filters(spark):
    df = spark.createDataFrame([(i, i % 4, float(i)) for i in range(12)], "i int, p int, v double")
    assert as_set(filters.last_n_periods(df, "p", 2).select("p").distinct()) == {(2,), (3,)}
    assert as_set(filters.latest_slice(df, "p"), "i") == {(3,), (7,), (11,)}
    assert [r["i"] for r in filters.recent(df, "i", 3).collect()] == [9, 10, 11]
    assert as_set(filters.rows_of_flagged(df, "p", F.col("v") == 5.0), "i") == {(1,), (5,), (9,)}


def test_partitioned_table_and_merge(spark, tmp_path):
    spec = TableSpec("t", {"date_key": "bigint", "k": "string", "v": "double", "_created_at": "date"}, ("date_key", "k"), ("year",), ("k",))
    path = str(tmp_path / "t")
    day = dt.date(2024, 1, 1)
    ddl = "date_key bigint, k string, v double, _created_at date"
    sinks.write_overwrite(spark.createDataFrame([(20230101, "a", 1.0, day), (20240101, "a", 2.0, day)], ddl), spec, path)
    untouched = {f for f in sinks.read_stored(spark, spec, path).inputFiles() if "year=2023" in f}
    later = dt.date(2024, 2, 1)
    staging = spark.createDataFrame([(20240101, "a", 5.0, later), (20250101, "b", 7.0, later)], ddl)
    for _ in range(2):  # repeating a load changes nothing
        sinks.merge_table(spark, spec, path, staging)
        back = sinks.read_stored(spark, spec, path)
        assert as_set(back, "date_key", "k", "v", "_created_at") == {
            (20230101, "a", 1.0, day),
            (20240101, "a", 5.0, day),
            (20250101, "b", 7.0, later),
        }
    assert untouched == {f for f in back.inputFiles() if "year=2023" in f}
    with pytest.raises(ValueError, match="duplicate"):
        sinks.merge_upsert(back, staging.unionAll(staging), ["date_key", "k"])


def test_partition_filter_prunes(spark, tmp_path, capsys):
    spec = TableSpec("t", {"date_key": "bigint"}, ("date_key",), ("year",), ("date_key",))
    path = str(tmp_path / "p")
    sinks.write_overwrite(spark.range(2020, 2025).select((F.col("id") * 10000 + 101).alias("date_key")), spec, path)
    ranged = filters.between_dates(sinks.read_stored(spark, spec, path), 20210101, 20221231)
    assert ranged.count() == 2
    ranged.explain()
    assert "PartitionFilters: [isnotnull(year" in capsys.readouterr().out


def test_audit_log(spark, tmp_path):
    df = with_audit(spark.range(5), RUN)

    def store(d):
        d.write.parquet(str(tmp_path / "d"))
        return spark.read.parquet(str(tmp_path / "d"))

    assert sinks.audited(df, RUN, str(tmp_path / "a"), "load", store) == 5

    def broken(d):
        raise RuntimeError("disk")

    with pytest.raises(RuntimeError):
        sinks.audited(df, RUN, str(tmp_path / "a"), "load", broken)
    log = spark.read.parquet(str(tmp_path / "a"))
    assert sorted((r["status"], r["rows_processed"] or 0) for r in log.collect()) == [
        ("FAILED", 0), ("RUNNING", 0), ("RUNNING", 0), ("SUCCESS", 5),
    ]


def test_append_by_run_is_repeatable(spark, tmp_path):
    spec = TableSpec("r", {"id": "bigint"})
    for _ in range(2):
        sinks.write_append(spark.range(3), spec, str(tmp_path / "r"), RUN)
    assert sinks.read_stored(spark, spec, str(tmp_path / "r")).count() == 3
