"""Grouped summaries, distributions and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.scalars import month_label
from ledgerline.operators import aggregates as A
from ledgerline.operators import reshape as R
from ledgerline.operators.filters import range_trim
from ledgerline.operators.scaling import minmax, minmax_inverse, zscore
from suite.registry import query
from suite.views import BARS, NATIONS, PANEL, PRIORITIES, bars, nation_panel, panel, rounded, table


@query(
    "yearly_means",
    f"WITH {NATIONS} SELECT year, round(avg(npl_ratio), 6) AS npl_ratio, round(avg(roa), 6) AS roa FROM nations GROUP BY 1",
)
def yearly_means(spark, sf):
    return rounded(A.group_mean(nation_panel(spark, sf), ["year"], ["npl_ratio", "roa"]))


@query(
    "means_by_year_and_type",
    f"""WITH {NATIONS} SELECT year, bank_type, round(avg(npl_ratio), 6) AS npl_ratio, round(avg(nim), 3) AS nim
    FROM nations GROUP BY 1, 2""",
)
def means_by_year_and_type(spark, sf):
    return rounded(A.group_mean(nation_panel(spark, sf), ["year", "bank_type"], ["npl_ratio", "nim"]), 6, nim=3)


@query(
    "entity_scorecard",
    f"""WITH {PANEL} SELECT entity, round(avg(npl_ratio), 6) AS npl_ratio, round(avg(llp_ratio), 6) AS llp_ratio,
    round(avg(roa), 6) AS roa FROM panel GROUP BY 1""",
)
def entity_scorecard(spark, sf):
    return rounded(A.group_mean(panel(spark, sf), ["entity"], ["npl_ratio", "llp_ratio", "roa"]))


PEER = f"""WITH {NATIONS}, ty AS (SELECT year, bank_type, avg(npl_ratio) AS v FROM nations GROUP BY 1, 2),
    sy AS (SELECT year, avg(npl_ratio) AS v FROM nations GROUP BY 1)"""


@query(
    "peer_comparison",
    PEER
    + """ SELECT year, bank_code, 'own' AS series, round(npl_ratio, 6) AS value FROM nations
    UNION ALL SELECT n.year, bank_code, 'type', round(v, 6) FROM nations n JOIN ty USING (year, bank_type)
    UNION ALL SELECT n.year, bank_code, 'system', round(v, 6) FROM nations n JOIN sy USING (year)""",
)
def peer_comparison(spark, sf):
    return rounded(A.peer_compare(nation_panel(spark, sf), "bank_code", "bank_type", "year", "npl_ratio"))


@query(
    "peer_comparison_of_one",
    PEER
    + """ SELECT year, 'NATION_3' AS bank_code, 'own' AS series,
      round((SELECT npl_ratio FROM nations n WHERE n.year = sy.year AND bank_code = 'NATION_3'), 6) AS value FROM sy
    UNION ALL SELECT year, 'NATION_3', 'system', round(v, 6) FROM sy
    UNION ALL SELECT year, 'NATION_3', 'type', round((SELECT v FROM ty WHERE ty.year = sy.year AND bank_type =
      (SELECT max(bank_type) FROM nations WHERE bank_code = 'NATION_3')), 6) FROM sy""",
)
def peer_comparison_of_one(spark, sf):
    return rounded(A.peer_compare(nation_panel(spark, sf), "bank_code", "bank_type", "year", "npl_ratio", "NATION_3"))


@query(
    "monthly_flow_by_flag",
    """WITH f AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag, sum(l_extendedprice) / 1e6 AS flow
      FROM lineitem GROUP BY 1, 2)
    SELECT month, l_returnflag, round(flow, 6) AS flow, round(flow / sum(flow) OVER (PARTITION BY month), 6) AS share
    FROM f""",
)
def monthly_flow_by_flag(spark, sf):
    """Three keys hold all rows: sums are combined map-side before the shuffle."""
    flow = A.monthly_flow(table(spark, sf, "lineitem"), "l_shipdate", "l_returnflag", "l_extendedprice", 1e6)
    return rounded(flow)


PROFILE_CTE = f"""WITH {NATIONS}, x AS (SELECT bank_type, npl_ratio, roa FROM nations),
    b AS (SELECT min(npl_ratio) AS lo1, max(npl_ratio) AS hi1, min(roa) AS lo2, max(roa) AS hi2 FROM x)"""


@query(
    "cluster_profile",
    f"""WITH {NATIONS} SELECT bank_type, 'npl_ratio' AS metric, round(avg(npl_ratio), 6) AS value FROM nations GROUP BY 1
    UNION ALL SELECT bank_type, 'roa', round(avg(roa), 6) FROM nations GROUP BY 1""",
)
def cluster_profile(spark, sf):
    return rounded(A.cluster_profile(nation_panel(spark, sf), "bank_type", ["npl_ratio", "roa"]))


@query(
    "radar_profile",
    PROFILE_CTE
    + """ SELECT bank_type, 'npl_ratio' AS metric, round(avg((npl_ratio - lo1) / (hi1 - lo1)), 6) AS value FROM x, b GROUP BY 1
    UNION ALL SELECT bank_type, 'roa', round(avg((roa - lo2) / (hi2 - lo2)), 6) FROM x, b GROUP BY 1
    UNION ALL SELECT bank_type, 'flat', 0.5 FROM x GROUP BY 1""",
)
def radar_profile(spark, sf):
    """Columns rescaled to [0, 1] first; a constant column shows as 0.5."""
    df = nation_panel(spark, sf).withColumn("flat", F.lit(7.0))
    return rounded(A.cluster_profile(df, "bank_type", ["npl_ratio", "roa", "flat"], normalize=True))


@query(
    "crosstab_type_status",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
    count(*) FILTER (o_orderstatus = 'P') AS "P", count(*) FILTER (o_orderstatus = 'X') AS "X" FROM orders GROUP BY 1""",
)
def crosstab_type_status(spark, sf):
    return A.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P", "X"])


@query("class_distribution", "SELECT quality, count(*) AS n FROM labels GROUP BY 1")
def class_distribution(spark, sf):
    return A.value_counts(table(spark, sf, "labels"), "quality")


@query(
    "series_coverage",
    f"WITH {BARS} SELECT ticker, count(*) AS n_rows, min(date_key) AS first_date, max(date_key) AS last_date FROM bars GROUP BY 1",
)
def series_coverage(spark, sf):
    return A.coverage(bars(spark, sf), "ticker", "date_key")


@query(
    "conditional_counts",
    """SELECT count(*) FILTER (l_discount = 0) AS no_discount, count(*) FILTER (l_quantity <= 10) AS small,
    count(*) FILTER (l_extendedprice IS NULL) AS missing FROM lineitem""",
)
def conditional_counts(spark, sf):
    tests = {
        "no_discount": F.col("l_discount") == 0,
        "small": F.col("l_quantity") <= 10,
        "missing": F.col("l_extendedprice").isNull(),
    }
    return A.count_if(table(spark, sf, "lineitem"), tests)


def _describe_sql(source: str, cols: dict[str, int]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), {d}) AS mean, round(stddev_samp({c}), {d}) AS std,
        round(CAST(min({c}) AS DOUBLE), {d}) AS min, round(quantile_cont({c}, 0.25), {d}) AS q1, round(median({c}), {d}) AS median,
        round(quantile_cont({c}, 0.75), {d}) AS q3, round(CAST(max({c}) AS DOUBLE), {d}) AS max, round(skewness({c}), {d}) AS skew
        FROM {source}"""
        for c, d in cols.items()
    )


@query("describe_panel", f"WITH {PANEL} " + _describe_sql("panel", {"npl_ratio": 5, "roa": 5, "n_orders": 5}))
def describe_panel(spark, sf):
    return rounded(A.describe_exact(panel(spark, sf), ["npl_ratio", "roa", "n_orders"]), 5)


@query("describe_lineitem", _describe_sql("lineitem", {"l_quantity": 4, "l_discount": 4, "l_extendedprice": 3}).replace(", 3)", ", 3)"))
def describe_lineitem(spark, sf):
    out = A.describe_exact(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_extendedprice"])
    money = F.col("column") == "l_extendedprice"
    kinds = dict(out.dtypes)
    return out.select(
        *[
            F.when(money, F.round(c, 3)).otherwise(F.round(c, 4)).alias(c) if k == "double" else F.col(c)
            for c, k in kinds.items()
        ]
    )


@query(
    "column_profile",
    f"WITH {PANEL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{k}' AS dtype, count(*) - count({c}) AS missing_count,
        round((count(*) - count({c})) / count(*), 6) AS missing_pct, round(CAST(min({c}) AS DOUBLE), 2) AS min,
        round(CAST(max({c}) AS DOUBLE), 2) AS max FROM panel"""
        for c, k in (("entity", "bigint"), ("year", "bigint"), ("finished", "double"), ("npl_ratio", "double"))
    ),
)
def column_profile(spark, sf):
    return rounded(A.profile(panel(spark, sf), ["entity", "year", "finished", "npl_ratio"]), 2, missing_pct=6)


@query(
    "missing_ranking",
    f"""WITH {PANEL}, m AS (SELECT unnest(['finished', 'opened', 'pending', 'npl_ratio', 'llp_ratio', 'roa']) AS "column",
      unnest([count(*) - count(finished), count(*) - count(opened), count(*) - count(pending), count(*) - count(npl_ratio),
      count(*) - count(llp_ratio), count(*) - count(roa)]) AS missing_count, count(*) AS n FROM panel)
    SELECT "column", missing_count, round(missing_count / n, 6) AS missing_pct FROM m WHERE missing_count > 0
    ORDER BY 3 DESC, 1 LIMIT 5""",
)
def missing_ranking(spark, sf):
    return rounded(A.missing_ranking(panel(spark, sf), 5))


@query(
    "group_medians",
    """SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 3) AS l_extendedprice,
    round(median(l_quantity), 3) AS l_quantity FROM lineitem GROUP BY 1, 2""",
)
def group_medians(spark, sf):
    return rounded(
        A.group_median(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_extendedprice", "l_quantity"]), 3
    )


@query(
    "iqr_outliers",
    "WITH e AS (SELECT value, event_id * 1.0::DOUBLE AS event_id FROM events) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr,
        round(q1 - (q3 - q1) * 1.5::DOUBLE, 4) AS low, round(q3 + (q3 - q1) * 1.5::DOUBLE, 4) AS high,
        count(*) FILTER ({c} < q1 - (q3 - q1) * 1.5::DOUBLE OR {c} > q3 + (q3 - q1) * 1.5::DOUBLE) AS n_outliers,
        round(count(*) FILTER ({c} < q1 - (q3 - q1) * 1.5::DOUBLE OR {c} > q3 + (q3 - q1) * 1.5::DOUBLE) / count(*) * 100, 4)
          AS outlier_pct
        FROM e, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM e) GROUP BY q1, q3"""
        for c in ("value", "event_id")
    ),
)
def iqr_outliers(spark, sf):
    return rounded(A.iqr_outliers(table(spark, sf, "events"), ["value", "event_id"]), 4)


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in CORR_COLS for b in CORR_COLS
    ),
)
def correlation_matrix(spark, sf):
    return rounded(A.corr_matrix(table(spark, sf, "lineitem"), CORR_COLS))


@query(
    "correlation_with_gaps",
    f"WITH {PANEL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM panel"
        for a in ("npl_ratio", "llp_ratio", "roa")
        for b in ("npl_ratio", "llp_ratio", "roa")
    ),
)
def correlation_with_gaps(spark, sf):
    """Each pair over the rows where both are present."""
    return rounded(A.corr_matrix(panel(spark, sf), ["npl_ratio", "llp_ratio", "roa"]))


@query(
    "trend_lines",
    f"""WITH {NATIONS}, t AS (SELECT * FROM nations WHERE npl_ratio BETWEEN 0.1 AND 0.6)
    SELECT bank_type, CAST(regr_count(roa, npl_ratio) AS BIGINT) AS n, round(regr_slope(roa, npl_ratio), 6) AS slope,
    round(regr_intercept(roa, npl_ratio), 6) AS intercept FROM t GROUP BY 1
    UNION ALL SELECT 'all', CAST(regr_count(roa, npl_ratio) AS BIGINT), round(regr_slope(roa, npl_ratio), 6), round(regr_intercept(roa, npl_ratio), 6) FROM t""",
)
def trend_lines(spark, sf):
    df = range_trim(nation_panel(spark, sf), {"npl_ratio": (0.1, 0.6)})
    total = A.trend_line(df, "npl_ratio", "roa").withColumn("bank_type", F.lit("all"))
    return rounded(A.trend_line(df, "npl_ratio", "roa", ["bank_type"]).unionByName(total))


@query(
    "histogram_of_values",
    """WITH b AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events),
    c AS (SELECT least(CAST(floor((value - lo) / w) AS INTEGER), 29) AS bin, count(*) AS n FROM events, b GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + w * i, 6) AS low, round(lo + w * (i + 1), 6) AS high, coalesce(n, 0) AS n
    FROM range(30) r(i) CROSS JOIN b LEFT JOIN c ON bin = i""",
)
def histogram_of_values(spark, sf):
    return rounded(A.histogram(table(spark, sf, "events"), "value", 30))


@query(
    "histogram_by_key",
    """WITH b AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 50 AS w FROM lineitem),
    c AS (SELECT l_returnflag, least(CAST(floor((l_extendedprice - lo) / w) AS INTEGER), 49) AS bin, count(*) AS n
      FROM lineitem, b GROUP BY 1, 2)
    SELECT l_returnflag, bin, round(lo + w * bin, 4) AS low, round(lo + w * (bin + 1), 4) AS high, n FROM c, b""",
)
def histogram_by_key(spark, sf):
    h = A.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 50, ["l_returnflag"])
    return rounded(h.filter("n > 0"), 4)


@query(
    "box_plot_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3
      FROM events GROUP BY 1)
    SELECT event_type, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
    min(value) FILTER (value BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE) AS whisker_low,
    max(value) FILTER (value BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE) AS whisker_high,
    count(*) FILTER (NOT value BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE) AS n_outliers
    FROM events JOIN q USING (event_type) GROUP BY event_type, q1, median, q3""",
)
def box_plot_stats(spark, sf):
    return rounded(A.box_stats(table(spark, sf, "events"), ["event_type"], "value"), 4)


@query(
    "distinct_and_range",
    """SELECT count(DISTINCT o_custkey) AS customers, min(year(o_orderdate)) AS first_year,
    max(year(o_orderdate)) AS last_year FROM orders""",
)
def distinct_and_range(spark, sf):
    year = F.year("o_orderdate").cast("bigint")
    return table(spark, sf, "orders").agg(
        F.count_distinct("o_custkey").alias("customers"), F.min(year).alias("first_year"), F.max(year).alias("last_year")
    )


@query(
    "zscore_population",
    """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal_z
    FROM customer""",
)
def zscore_population(spark, sf):
    return rounded(zscore(table(spark, sf, "customer"), ["c_acctbal"]).select("c_custkey", "c_acctbal_z"))


@query(
    "zscore_by_key",
    f"""WITH {BARS} SELECT ticker, date_key, round((close_price - avg(close_price) OVER w) / stddev_samp(close_price) OVER w, 6)
    AS close_price_z FROM bars WINDOW w AS (PARTITION BY ticker)""",
)
def zscore_by_key(spark, sf):
    z = zscore(bars(spark, sf), ["close_price"], ["ticker"], ddof=1)
    return rounded(z.select("ticker", "date_key", "close_price_z"))


@query(
    "minmax_and_back",
    f"""WITH {BARS} SELECT ticker, date_key, round((close_price - min(close_price) OVER w) /
    (max(close_price) OVER w - min(close_price) OVER w), 6) AS scaled, round(close_price, 2) AS restored
    FROM bars WINDOW w AS (PARTITION BY ticker)""",
)
def minmax_and_back(spark, sf):
    scaled = minmax(bars(spark, sf), ["close_price"], ["ticker"], keep_range=True)
    back = minmax_inverse(scaled, "close_price_scaled", "close_price_min", "close_price_max", "restored")
    return rounded(back.select("ticker", "date_key", F.col("close_price_scaled").alias("scaled"), "restored"), 6, restored=2)


STATEMENT_YEARS = list(range(1995, 2002))


def _wide_statement(spark, sf):
    """Items as rows, one column per year, with statement metadata."""
    lines = table(spark, sf, "lineitem")
    item = F.concat_ws("-", "l_returnflag", "l_linestatus")
    wide = (
        lines.withColumn("period", F.year("l_shipdate").cast("string"))
        .groupBy(item.alias("item"))
        .pivot("period", [str(y) for y in STATEMENT_YEARS])
        .agg(F.sum("l_quantity"))
    )
    return wide.withColumns({"item_en": F.lower("item"), "item_id": F.concat(F.lit("id_"), "item"), "unit": F.lit("pcs")})


ITEMS = ["A-F", "A-O", "N-F", "N-O", "R-F", "R-O"]


@query(
    "transposed_statement",
    "SELECT CAST(year(l_shipdate) AS VARCHAR) AS period, "
    + ", ".join(
        f"sum(l_quantity) FILTER (l_returnflag || '-' || l_linestatus = '{i}') AS \"{i}\"" for i in ITEMS
    )
    + " FROM lineitem GROUP BY 1",
)
def transposed_statement(spark, sf):
    return R.transpose_report(_wide_statement(spark, sf), items=ITEMS)


@query(
    "item_dictionary",
    """SELECT r.report_type, 'id_' || item AS item_id, item AS item_vi, lower(item) AS item_en
    FROM (SELECT DISTINCT l_returnflag || '-' || l_linestatus AS item FROM lineitem), (VALUES ('annual'), ('quarterly')) r(report_type)""",
)
def item_dictionary(spark, sf):
    wide = _wide_statement(spark, sf)
    return R.item_dictionary({"annual": wide, "quarterly": R.union_all([wide, wide])})


@query(
    "pivot_prices",
    f"WITH {BARS} SELECT date_key, "
    + ", ".join(f"max(close_price) FILTER (ticker = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM bars GROUP BY 1",
)
def pivot_prices(spark, sf):
    return R.pivot_wide(bars(spark, sf), "date_key", "ticker", "close_price", PRIORITIES)


@query(
    "melted_bars",
    f"""WITH {BARS} SELECT ticker, date_key, 'open_price' AS field, open_price AS price FROM bars
    UNION ALL SELECT ticker, date_key, 'close_price', close_price FROM bars""",
)
def melted_bars(spark, sf):
    return R.melt(bars(spark, sf), ["ticker", "date_key"], ["open_price", "close_price"], "field", "price")


@query(
    "union_by_name",
    """SELECT 'orders' AS source, CAST(o_orderdate AS DATE) AS day, count(*) AS n, NULL AS flag FROM orders GROUP BY 1, 2
    UNION ALL SELECT 'lineitem', CAST(l_shipdate AS DATE), count(*), l_returnflag FROM lineitem GROUP BY 1, 2, 4""",
)
def union_by_name(spark, sf):
    n = F.count(F.lit(1)).alias("n")
    orders = table(spark, sf, "orders").groupBy(F.lit("orders").alias("source"), F.to_date("o_orderdate").alias("day")).agg(n)
    lines = table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("day"), F.lit("lineitem").alias("source")
    ).agg(n)
    return R.union_all([orders, lines])


@query(
    "union_distinct",
    "SELECT DISTINCT o_custkey AS party FROM orders UNION SELECT s_suppkey FROM supplier",
)
def union_distinct(spark, sf):
    buyers = table(spark, sf, "orders").select(F.col("o_custkey").alias("party"))
    sellers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party"))
    return R.union_distinct([buyers, sellers], ["party"])


@query(
    "ordered_report",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2
    ORDER BY 1 DESC, 3 DESC, 2""",
)
def ordered_report(spark, sf):
    counts = table(spark, sf, "orders").groupBy(month_label("o_orderdate").alias("month"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.orderBy(F.desc("month"), F.desc("n"), "o_orderpriority")
