"""Segmented windows and distributed order statistics against the plain, one-task forms."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators import ordered, series, windows
from ledgerline.operators.series import Series
from tests.conftest import as_set, close

ROWS = 700


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most rows, a third of the values is missing, order values are unevenly spread."""
    rng = random.Random(7)
    rows = []
    for i in range(ROWS):
        key = "hot" if i % 5 else f"k{i % 3}"
        at = int(rng.random() ** 3 * 10_000) * 1000 + i
        rows.append((key, at, None if rng.random() < 0.33 else round(rng.uniform(1, 9), 3), float(i % 17 + 1)))
    return spark.createDataFrame(rows, "k string, at bigint, v double, x double").repartition(5).persist()


PLAIN = Series.of("k", "at")


@pytest.mark.parametrize("chunk", [25, 64, 10_000])
def test_segments_match_plain_windows(hot, chunk):
    cut = Series.of("k", "at", "floor(at / 500000)", chunk)
    ops = [
        lambda s: series.position(hot, s, "n").select("k", "at", "n"),
        lambda s: windows.lags(hot, s, {"v": [1, 3]}).select("k", "at", "v_lag1", "v_lag3"),
        lambda s: windows.leads(hot, s, {"x": [2]}).select("k", "at", "x_lead2"),
        lambda s: windows.diff(hot, s, "x").select("k", "at", "x_diff"),
        lambda s: windows.ffill(hot, s, ["v"], 2).select("k", "at", "v"),
        lambda s: windows.pct_change(hot, s, "v").select("k", "at", F.round("v_pct", 9)),
        lambda s: windows.moving_avg(hot, s, "x", 20, "m").select("k", "at", F.round("m", 9)),
        lambda s: windows.ma_forecast(hot, s, "x", 5, "m").select("k", "at", F.round("m", 9)),
        lambda s: windows.rolling_corr(hot, s, "x", "at", 10, "c").select("k", "at", F.round("c", 7)),
        lambda s: windows.series_split(hot, s, 0.8).select("k", "at", "is_train"),
        lambda s: windows.sequences(hot, s, ["x"], "x", 6, 3).select(
            "k", "at", F.flatten("x").cast("string"), F.col("y").cast("string")
        ),
    ]
    for op in ops:
        assert as_set(op(cut)) == as_set(op(PLAIN))


def test_numbering_once_serves_every_frame(hot):
    cut = Series.of("k", "at", "floor(at / 500000)", 40)
    df, s = series.numbered(hot, cut)
    both = windows.lags(windows.moving_avg(df, s, "x", 9, "m"), s, {"v": [2]}).select("k", "at", "row_no", "m", "v_lag2")
    plain = windows.lags(windows.moving_avg(series.position(hot, PLAIN, "row_no"), PLAIN, "x", 9, "m"), PLAIN, {"v": [2]})
    assert as_set(both) == as_set(plain, "k", "at", "row_no", "m", "v_lag2")


def test_sequences_count(hot):
    sizes = {r["k"]: r["count"] for r in hot.groupBy("k").count().collect()}
    got = windows.sequences(hot, PLAIN, ["x"], "x", 20, 5).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {k: n - 24 for k, n in sizes.items() if n >= 25}


def test_null_series_key_is_refused_not_dropped(spark):
    df = spark.createDataFrame([(None, 1, 1.0), ("a", 2, 2.0)], "k string, at bigint, v double")
    with pytest.raises(Exception, match="must not be NULL"):
        series.position(df, Series.of("k", "at", "at")).collect()


def test_pct_change_matches_pandas(spark):
    values = [None, 2.0, None, 3.0, 0.0, 5.0, None, 10.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, at int, v double")
    got = [r["v_pct"] for r in windows.pct_change(df, PLAIN, "v").orderBy("at").collect()]
    # A division by zero is undefined here and takes the fill value.
    want = pd.Series(values).ffill().pct_change().replace([float("inf")], 0).fillna(0.0).tolist()
    assert all(close(a, b) for a, b in zip(got, want))


def test_ffill_limit(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([None, 1, None, None, 2, None])], "k string, at int, v int")
    got = [r["v"] for r in windows.ffill(df, PLAIN, ["v"], 1).orderBy("at").collect()]
    assert got == [None, 1, 1, None, 2, 2]


def test_latest_row_and_latest_non_null_differ(spark):
    df = spark.createDataFrame([("a", 1, 5.0, 1.0), ("a", 2, None, 2.0)], "k string, at int, v double, w double")
    assert as_set(windows.latest_row(df, ["k"], "at")) == {("a", 2, None, 2.0)}
    assert as_set(windows.latest_non_null(df, ["k"], "at", ["v", "w"])) == {("a", 5.0, 2.0)}


def test_dedupe_prunes_before_the_shuffle(hot, capsys):
    windows.dedupe_first(hot, ["k"], ["at"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.5, 0.8, 1.0])
def test_time_split_with_one_dominant_date(spark, ratio):
    rows = [(20200101 if i % 3 else 20200101 + i % 7, i // 2, i) for i in range(301)]
    df = spark.createDataFrame(rows, "day int, a int, b int")
    split = windows.time_split(df, "day", ["a", "b"], ratio)
    order = [r["b"] for r in df.orderBy("day", "a", "b").collect()]
    got = {r["b"] for r in split.filter("is_train").collect()}
    assert got == set(order[: int(301 * ratio)])


def test_time_split_needs_a_total_order(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1)], "day int, a int")
    with pytest.raises(ValueError, match="uniquely"):
        windows.time_split(df, "day", ["a"], 0.5)


def test_kth_value(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"))
    values = sorted(r["v"] for r in df.collect())
    for k in (1, 2, 333, 800, 999, 1000):
        value, before, upto = ordered.kth_value(df, "v", k)
        assert value == values[k - 1]
        assert before == sum(v < value for v in values) and upto == sum(v <= value for v in values)
    assert ordered.kth_value(df, "v", 0) is None and ordered.kth_value(df, "v", 1001) is None
    text = df.select(F.when(F.col("v") > 9, F.col("v").cast("string")).alias("t"))
    ranked = sorted((r["t"] for r in text.collect()), key=lambda t: (t is not None, t or ""))
    assert [ordered.kth_value(text, "t", k)[0] for k in (1, 10, 500, 1000)] == [ranked[k - 1] for k in (1, 10, 500, 1000)]


def test_splits_keep_null_rows(spark):
    rows = [(None if i % 5 == 0 else i, f"k{i:03d}") for i in range(20)]
    df = spark.createDataFrame(rows, "day int, name string")
    split = windows.time_split(df, "day", ["name"], 0.5)
    got = {r["name"] for r in split.filter("is_train").collect()}
    assert got == {n for _, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[:10]}
    assert split.filter("is_train IS NULL").count() == 0
    keyed = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(10)], "k string, at int")
    parts = windows.series_split(keyed, Series.of("k", "at"), 0.6)
    assert parts.count() == 10 and parts.filter("is_train").count() == 6


def test_last_rows_of_a_hot_key(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"))
    got = windows.last_n_rows(df, ["k"], "at", 1500)
    assert {r["at"] for r in got.collect()} == set(range(2000, 5000))


@pytest.mark.parametrize("parts", [2, 65_535])
def test_percentiles_match_direct(spark, monkeypatch, parts):
    monkeypatch.setattr(ordered, "_PARTS", parts)  # with 2, many levels are needed
    rng = random.Random(3)
    rows = [("hot" if i % 4 else None, rng.gauss(0, 1), rng.choice([1.0, 2.0, None, 50.0]), i // 3) for i in range(900)]
    rows += [("one", 7.5, None, None), ("none", None, None, None)]
    df = spark.createDataFrame(rows, "k string, a double, b double, c long")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for keys in ((), ("k",)):
        wanted = F.array(*[F.lit(p) for p in probs])
        direct = df.groupBy(*keys).agg(*[F.percentile(c, wanted).alias(c) for c in ("a", "b", "c")]).collect()
        radix = ordered.exact_percentiles(df, ["a", "b", "c"], probs, keys).collect()
        order = lambda rows: sorted(rows, key=lambda r: str(r[0]))
        assert len(direct) == len(radix)
        for d, b in zip(order(direct), order(radix)):
            for c in ("a", "b", "c"):
                assert (d[c] is None) == (b[c] is None)
                assert d[c] is None or all(close(x, y) for x, y in zip(d[c], b[c]))


def test_percentiles_of_odd_numbers(spark):
    inf, tiny = float("inf"), 5e-324
    values = [-inf, -1e308, -1e308, -1.0, -tiny, -0.0, 0.0, tiny, 2 * tiny, 3 * tiny, 1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0 + 3 * 2**-52, 1.7e308, inf, inf]
    df = spark.createDataFrame([(v,) for v in values] * 3, "v double").repartition(5)
    probs = [i / (len(values) * 3 - 1) for i in range(len(values) * 3)]
    got = ordered.exact_percentiles(df, ["v"], probs).first()["v"]
    want = sorted(values * 3)
    for p, a, b in zip(probs, got, want):
        rank = p * (len(want) - 1)
        if rank == int(rank) and abs(b) != inf:
            assert a == b
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "v double")
    assert ordered.exact_percentiles(nan, ["v"], [0.0, 0.5]).first()["v"] == [1.0, 2.0]


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert ordered.exact_percentiles(df, ["v"], [0.5], ["k"]).count() == 0
    assert ordered.exact_percentiles(df, ["v"], [0.5, 0.9]).first()["v"] == [None, None]


def test_percentiles_of_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0), ("b", 4.0)], "k string, v double")
    got = ordered.exact_percentiles(df, ["v"], [0.5, 0.75], ["k"])
    assert {r["k"]: r["v"] for r in got.collect()} == {"a": [1.0, 1.0], "b": [2.0, 3.0]}


def test_running_totals(spark):
    df = spark.range(500).select(
        (F.col("id") * F.col("id") / 7.0).alias("score"), (F.col("id") % 3).alias("n")
    )
    plain = df.withColumn("cum_n", F.sum("n").over(W.orderBy("score").rowsBetween(W.unboundedPreceding, 0)))
    for most in (ordered.SEGMENT_ROWS, 16):
        assert as_set(ordered.running_totals(df, "score", ["n"], most), "score", "cum_n") == as_set(plain, "score", "cum_n")
    assert ordered.running_totals(df.limit(0), "score", ["n"]).count() == 0


def test_order_statistics_cut_close_values(spark):
    """Values a hair apart, in one partition: no ordered piece holds more rows than stated."""
    near = [1.0 + i * 2.0**-50 for i in range(900)] + [3.0 * (1 + i * 2.0**-20) for i in range(700)]
    far = [-(2.0**i) for i in range(-40, 40)] + [0.0, -1e300, 1e300, 5e-324, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(near + far)], "score double, n long").coalesce(1)
    seg = ordered.value_segments(df, "score", "seg", 40)
    sizes = seg.groupBy("seg").count().collect()
    assert max(r["count"] for r in sizes) <= 40 and sum(r["count"] for r in sizes) == len(near + far)
    key = lambda v: (v is not None, v != v, 0 if v is None or v != v else v)
    rows = sorted(((r["score"], r["seg"]) for r in seg.collect()), key=lambda r: key(r[0]))
    assert all(a[1] <= b[1] for a, b in zip(rows, rows[1:]))
    total, want = 0, {}
    for v, n in sorted(((v, i % 7) for i, v in enumerate(near + far)), key=lambda r: key(r[0])):
        total += n
        want[str(v)] = total
    got = {str(r["score"]): r["cum_n"] for r in ordered.running_totals(df, "score", ["n"], 40).collect()}
    assert got == want
    for k in (1, 2, 83, 84, 500, 1500, len(rows)):
        value, before, upto = ordered.kth_value(df, "score", k, 40)
        assert str(value) == str(rows[k - 1][0]) and (before, upto) == (k - 1, k)


def test_results_do_not_depend_on_partitioning(hot):
    s = Series.of("k", "at", "floor(at / 500000)", 30)
    one = windows.pct_change(hot.coalesce(1), s, "v")
    many = windows.pct_change(hot.repartition(13), s, "v")
    assert as_set(one) == as_set(many)
