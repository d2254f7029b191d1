"""Joins, versioned dimensions, imputation, quality checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import dims, joins, quality
from ledgerline.operators.impute import fill_global_median, impute_median
from ledgerline.operators.windows import dedupe_first
from ledgerline.plans import facts, reports
from suite.registry import query
from suite.views import (
    BARS,
    METRICS,
    NATIONS,
    PANEL,
    bars,
    nation_panel,
    panel,
    rounded,
    snapshot,
    table,
)


@query(
    "fact_dim_join",
    """SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def fact_dim_join(spark, sf):
    dim = joins.join_dim(
        table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, sf, "region"), "r_regionkey"
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    wide = joins.join_dim(joins.join_dim(table(spark, sf, "orders"), customers, "o_custkey"), dim, "c_nationkey")
    return rounded(
        wide.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), 2
    )


@query(
    "fact_dim_left_join",
    """SELECT c_mktsegment, count(*) AS customers, count(o_orderkey) AS orders, count(DISTINCT o_custkey) AS buyers
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
)
def fact_dim_left_join(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    wide = joins.join_dim(table(spark, sf, "customer"), orders, "c_custkey", "left")
    return wide.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count("o_orderkey").alias("orders"),
        F.count_distinct(F.when(F.col("o_orderkey").isNotNull(), F.col("c_custkey"))).alias("buyers"),
    )


@query(
    "strict_lookup_join",
    """SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def strict_lookup_join(spark, sf):
    """Many-to-one join that fails on an unmapped or doubled key."""
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return joins.lookup_join(table(spark, sf, "supplier"), nations, ["s_nationkey"]).select("s_suppkey", "n_name")


@query(
    "fk_violations",
    """SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN
    (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
)
def fk_violations(spark, sf):
    """Order keys of line items whose order is still pending."""
    done = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return joins.fk_violations(table(spark, sf, "lineitem"), done, "l_orderkey", "o_orderkey")


@query(
    "latest_order_per_customer",
    """SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN (
      SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) ON c_custkey = o_custkey AND rn = 1""",
)
def latest_order_per_customer(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", "o_totalprice"
    )
    joined = joins.join_latest(table(spark, sf, "customer"), orders, "c_custkey", ["o_orderdate", "o_orderkey"])
    return joined.select("c_custkey", "o_orderkey", "o_totalprice")


@query(
    "outer_aligned_totals",
    """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS ordered FROM orders GROUP BY 1),
    l AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS shipped FROM lineitem GROUP BY 1),
    e AS (SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1)
    SELECT day, ordered, shipped, events FROM o FULL JOIN l USING (day) FULL JOIN e USING (day)""",
)
def outer_aligned_totals(spark, sf):
    n = F.count(F.lit(1))
    day = lambda c: F.to_date(c).alias("day")
    frames = [
        table(spark, sf, "orders").groupBy(day("o_orderdate")).agg(F.round(F.sum("o_totalprice"), 2).alias("ordered")),
        table(spark, sf, "lineitem").groupBy(day("l_shipdate")).agg(n.alias("shipped")),
        table(spark, sf, "events").groupBy(day("ts")).agg(n.alias("events")),
    ]
    return joins.align_outer(frames, "day")


@query(
    "common_dates",
    f"""WITH {BARS} SELECT ticker, date_key, close_price FROM bars WHERE date_key IN (
      SELECT date_key FROM bars GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT ticker) FROM bars))""",
)
def common_dates(spark, sf):
    return joins.align_common(bars(spark, sf), "ticker", "date_key", "close_price").select(
        "ticker", "date_key", "close_price"
    )


TODAY = dt.date(2000, 6, 1)


def _latest_sql(name: str, until: str) -> str:
    return f"""{name} AS (
  SELECT o_custkey AS cust, o_orderpriority AS tier, o_orderstatus AS status,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS capital
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate < TIMESTAMP '{until}') WHERE rn = 1)"""


VERSIONS = f"""{_latest_sql('old', '1998-01-01')}, {_latest_sql('new', '2000-06-01')},
pairs AS (SELECT cust, o.tier AS o_tier, o.status AS o_status, o.capital AS o_capital, o.cust IS NOT NULL AS had,
  n.tier, n.status, n.capital, n.tier IS NOT NULL AS has,
  had AND has AND (o.tier <> n.tier OR o.status <> n.status
    OR (n.capital IS NOT NULL AND n.capital IS DISTINCT FROM o.capital)) AS changed
  FROM old o FULL JOIN new n USING (cust)),
versions AS (
  SELECT cust, o_tier AS tier, o_status AS status, o_capital AS capital, DATE '2002-01-01' AS valid_from,
    CASE WHEN changed THEN DATE '2000-05-31' ELSE DATE '9999-12-31' END AS valid_to, NOT changed AS is_current
  FROM pairs WHERE o_tier IS NOT NULL
  UNION ALL SELECT cust, tier, status, capital, DATE '2000-06-01', DATE '9999-12-31', true FROM pairs WHERE changed
  UNION ALL SELECT cust, tier, status, capital, DATE '2002-01-01', DATE '9999-12-31', true FROM pairs
  WHERE o_tier IS NULL)""".replace("2002-01-01", "1995-01-01")


def _versions(spark, sf):
    first = dims.scd2_open(snapshot(spark, sf, "1998-01-01"), "1995-01-01")
    return dims.scd2_apply(
        first,
        snapshot(spark, sf, "2000-06-01"),
        "cust",
        ["tier", "status"],
        TODAY,
        tracked_if_present=["capital"],
        first_from="1995-01-01",
    )


@query("versioned_dimension", f"WITH {VERSIONS} SELECT * FROM versions")
def versioned_dimension(spark, sf):
    """Customer tiers as of 1998, then the mid-2000 snapshot applied: closed, new, changed and unchanged rows."""
    return _versions(spark, sf)


@query(
    "point_in_time_join",
    f"""WITH {VERSIONS} SELECT v.tier, v.is_current, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders LEFT JOIN versions v ON o_custkey = cust AND CAST(o_orderdate AS DATE) BETWEEN valid_from AND valid_to
    GROUP BY 1, 2""",
)
def point_in_time_join(spark, sf):
    orders = table(spark, sf, "orders").withColumns({"cust": F.col("o_custkey"), "day": F.to_date("o_orderdate")})
    joined = joins.scd2_asof_join(orders, _versions(spark, sf), "cust", "day")
    return rounded(
        joined.groupBy("tier", "is_current").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), 2
    )


@query(
    "clean_dimension",
    """SELECT min(s_suppkey) AS bank_key, upper(code) AS bank_code, arg_min(s_name, s_suppkey) AS bank_name,
    arg_min('N' || s_nationkey, s_suppkey) AS bank_type, NULL::DOUBLE AS charter_capital
    FROM (SELECT *, substring(s_name, 10, 8) AS code FROM supplier) GROUP BY code""",
)
def clean_dimension(spark, sf):
    """Bank-list layout: several suppliers share a code, the first key wins."""
    raw = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("double").cast("string").alias("No."),
        F.concat(F.lit(" "), "s_name").alias(" Bank"),
        F.concat(F.lower(F.substring("s_name", 10, 8)), F.lit(" ")).alias("Bank Code"),
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("Type of ownership"),
    )
    return dims.bank_dim(raw)


IMPUTE_SQL = f"""WITH {PANEL},
  e1 AS (SELECT entity, median(npl_ratio) AS m1, median(roa) AS m2 FROM panel WHERE year >= 1998 GROUP BY 1),
  g1 AS (SELECT median(npl_ratio) AS g1, median(roa) AS g2 FROM panel WHERE year >= 1998),
  s1 AS (SELECT entity, year, npl_ratio IS NULL OR roa IS NULL AS is_imputed,
    CASE WHEN year < 1998 THEN coalesce(npl_ratio, m1, g1) ELSE npl_ratio END AS npl_ratio,
    CASE WHEN year < 1998 THEN coalesce(roa, m2, g2) ELSE roa END AS roa
    FROM panel LEFT JOIN e1 USING (entity), g1),
  e2 AS (SELECT entity, median(npl_ratio) AS m1, median(roa) AS m2 FROM s1 GROUP BY 1),
  g2 AS (SELECT median(npl_ratio) AS h1, median(roa) AS h2 FROM s1)
  SELECT entity, year, is_imputed, round(coalesce(npl_ratio, m1, h1), 6) AS npl_ratio,
    round(coalesce(roa, m2, h2), 6) AS roa FROM s1 LEFT JOIN e2 USING (entity), g2"""


@query("median_imputation", IMPUTE_SQL)
def median_imputation(spark, sf):
    df = panel(spark, sf).select("entity", "year", "npl_ratio", "roa")
    return rounded(impute_median(df, "entity", "year", ["npl_ratio", "roa"], 1998))


@query(
    "global_median_fill",
    f"""WITH {PANEL} SELECT entity, year, round(coalesce(npl_ratio,
    (SELECT median(npl_ratio) FROM panel WHERE year >= 1998)), 6) AS npl_ratio FROM panel""",
)
def global_median_fill(spark, sf):
    df = panel(spark, sf).select("entity", "year", "npl_ratio")
    return rounded(fill_global_median(df, "npl_ratio", "year", 1998))


@query(
    "dedupe_first",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def dedupe_first_query(spark, sf):
    first = dedupe_first(
        table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
    )
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def _bank_inputs(spark, sf):
    """Yearly statements and the bank list in their source layout, from orders by nation and year."""
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation")
    amount = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")))
    yearly = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("Year"))
        .agg(
            F.sum("o_totalprice").alias("Total Assets"),
            amount("O").alias("Total Deposits"),
            amount("F").alias("Total Loans"),
            F.max("o_totalprice").alias("Total Shareholder's Equity"),
            F.min("o_totalprice").alias("Loan Loss Provisions"),
            F.max("o_totalprice").alias("Interest Incomes"),
            F.min("o_totalprice").alias("Interest Expenses"),
            F.avg("o_totalprice").alias("Non-Interest Income"),
            F.min("o_totalprice").alias("Non-Interest Expenses"),
            F.max("o_totalprice").alias("Profits After Tax"),
            amount("P").alias("__p"),
            F.count(F.lit(1)).alias("Number of Employees"),
        )
    )
    pct = F.try_divide("__p", "Total Assets") * 100
    raw = (
        yearly.withColumn("Non-performing Loans Ratio", F.when(F.col("Year") >= 1997, pct))
        .drop("__p")
        .join(nations.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("Bank Code", F.concat(F.lit(" "), F.lower("n_name")))
        .withColumn("Classification", F.lit("jscb"))
        .withColumn("Total Assets", F.format_number("Total Assets", 2))
        .drop("c_nationkey", "n_nationkey", "n_name")
    )
    banks = nations.select(
        F.col("n_nationkey").alias("No."),
        F.col("n_name").alias("Bank"),
        F.col("n_name").alias("Bank Code"),
        F.lit("JSCB").alias("Type of ownership"),
    )
    return raw, banks


@query(
    "bank_performance_fact",
    f"""WITH y AS (SELECT CAST(c_nationkey AS BIGINT) AS bank_key, year(o_orderdate) AS year, sum(o_totalprice) AS a,
      sum(o_totalprice) FILTER (o_orderstatus = 'F') AS l, sum(o_totalprice) FILTER (o_orderstatus = 'O') AS d,
      sum(o_totalprice) FILTER (o_orderstatus = 'P') AS p, max(o_totalprice) AS hi, min(o_totalprice) AS lo,
      avg(o_totalprice) AS mid, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    r AS (SELECT *, CASE WHEN year >= 1997 THEN p / round(a, 2) END AS npl, lo / l AS llp, hi / d AS etd,
      l / round(a, 2) AS lta, l / d AS ltd FROM y),
    g AS (SELECT median(npl) AS g_npl, median(llp) AS g_llp, median(etd) AS g_etd, median(lta) AS g_lta,
      median(ltd) AS g_ltd FROM r)
    SELECT year * 10000 + 1231 AS date_key, bank_key, n AS num_employees, round(hi - lo, 2) AS net_interest_income,
      npl IS NULL OR l IS NULL OR d IS NULL AS is_imputed, round(coalesce(npl, g_npl), 5) AS npl_ratio,
      round(coalesce(llp, g_llp), 6) AS llp_ratio, round(hi / round(a, 2), 6) AS roa, 1.0::DOUBLE AS roe,
      round((hi - lo) / round(a, 2), 6) AS nim, round(lo / (hi - lo + mid), 6) AS cir,
      round(hi / round(a, 2), 6) AS eta, round(coalesce(etd, g_etd), 6) AS etd, round(coalesce(lta, g_lta), 6) AS lta,
      round(coalesce(ltd, g_ltd), 6) AS ltd, round(coalesce(lta, g_lta), 6) AS gta
    FROM r, g""",
)
def bank_performance_fact(spark, sf):
    """Yearly statements in the source layout to the imputed fact; early ratios are missing for every bank."""
    raw, banks = _bank_inputs(spark, sf)
    fact, _, _ = facts.bank_performance(raw, banks)
    ratios = ["llp_ratio", "roa", "roe", "nim", "cir", "eta", "etd", "lta", "ltd", "gta"]
    keep = ["date_key", "bank_key", "num_employees", "is_imputed", "net_interest_income", "npl_ratio", *ratios]
    return rounded(fact.select(*keep), 6, net_interest_income=2, npl_ratio=5)


@query(
    "quality_checks",
    f"""WITH {NATIONS}, p AS (SELECT * FROM panel)
    SELECT 'not_null:npl_ratio' AS rule, 'panel' AS "table", count(*) FILTER (npl_ratio IS NULL) AS violations FROM p
    UNION ALL SELECT 'not_null:year', 'panel', count(*) FILTER (year IS NULL) FROM p
    UNION ALL SELECT 'check:roa_in_unit', 'panel', count(*) FILTER (roa < 0.05 OR roa > 0.95) FROM p
    UNION ALL SELECT 'audit:audit_key', 'panel', 1
    UNION ALL SELECT 'unique:entity', 'panel', count(*) - count(DISTINCT entity) FROM p
    UNION ALL SELECT 'foreign:entity', 'panel', count(DISTINCT entity) FROM p
      WHERE entity NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL SELECT 'unique:l_orderkey,l_linenumber', 'lineitem',
      count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
    UNION ALL SELECT 'foreign:l_partkey', 'lineitem', count(DISTINCT l_partkey) FROM lineitem
      WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""",
)
def quality_checks(spark, sf):
    held = {
        "panel": panel(spark, sf),
        "lineitem": table(spark, sf, "lineitem"),
        "solvent": table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("entity")),
        "part": table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey")),
    }
    rules = [
        quality.TableRules(
            "panel",
            not_null=("npl_ratio", "year"),
            unique=("entity",),
            foreign={"entity": "solvent"},
            failing={"roa_in_unit": (F.col("roa") < 0.05) | (F.col("roa") > 0.95)},
        ),
        quality.TableRules(
            "lineitem", unique=("l_orderkey", "l_linenumber"), foreign={"l_partkey": "part"}, audit=None
        ),
    ]
    return quality.run_checks(held, rules)


@query(
    "quarantined_rows",
    f"""WITH {PANEL} SELECT entity, year, 'no_finished' AS first_reason,
    NULL AS first_flag FROM panel WHERE finished IS NULL UNION ALL SELECT entity, year, 'too_small', NULL FROM panel WHERE finished IS NOT NULL AND total < 50000
    UNION ALL SELECT entity, year, NULL, CASE WHEN npl_ratio > 0.9 THEN 'high_ratio' END FROM panel
    WHERE finished IS NOT NULL AND total >= 50000""",
)
def quarantined_rows(spark, sf):
    good, bad = quality.quarantine(
        panel(spark, sf),
        reject={"no_finished": F.col("finished").isNull(), "too_small": F.col("total") < 50000},
        flag={"high_ratio": F.col("npl_ratio") > 0.9},
    )
    first = lambda c: F.get(c, F.lit(0))
    none = F.lit(None).cast("string")
    return good.select("entity", "year", none.alias("first_reason"), first("dq_flags").alias("first_flag")).unionByName(
        bad.select("entity", "year", first("dq_reasons").alias("first_reason"), none.alias("first_flag"))
    )


@query(
    "dashboard_price_history",
    f"""WITH {BARS} SELECT date_key, open_price, close_price, trading_volume FROM bars WHERE ticker = '2-HIGH'
    ORDER BY date_key DESC LIMIT 60""",
)
def dashboard_price_history(spark, sf):
    return reports.price_history(bars(spark, sf), "ticker", "2-HIGH").select(
        "date_key", "open_price", "close_price", "trading_volume"
    )


@query(
    "monthly_money_flow",
    f"""WITH {METRICS}, f AS (SELECT CAST(date_key // 10000 AS VARCHAR) || '-' || lpad(CAST((date_key // 100) % 100 AS VARCHAR), 2, '0')
      AS month, ticker, sum(trading_value) / 1e6 AS flow FROM metrics GROUP BY 1, 2)
    SELECT month, ticker, round(flow, 6) AS flow, round(flow / sum(flow) OVER (PARTITION BY month), 6) AS share FROM f
    WHERE month IN (SELECT DISTINCT month FROM f ORDER BY month DESC LIMIT 24)""",
)
def monthly_money_flow(spark, sf):
    """Daily bars, derived measures, monthly traded value and share over the last 24 months."""
    return rounded(reports.money_flow(facts.daily_metrics(bars(spark, sf), "ticker"), "ticker", 24, 1e6))


@query(
    "panel_with_dim",
    f"WITH {NATIONS} SELECT bank_key, bank_code, bank_type, year, date_key, round(total, 2) AS total, "
    "round(npl_ratio, 6) AS npl_ratio, round(llp_ratio, 6) AS llp_ratio, round(roa, 6) AS roa FROM nations",
)
def panel_with_dim(spark, sf):
    return rounded(nation_panel(spark, sf).drop("nim"), 6, total=2)

