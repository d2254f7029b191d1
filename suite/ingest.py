"""Sources, sinks, cleaning, derived columns and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import scalars as S
from ledgerline.operators import filters as FL
from ledgerline.operators.joins import map_codes, session_of
from ledgerline.operators.scaling import normalize_percent, scale_by
from ledgerline.plans import facts
from ledgerline.sources import sinks, tables
from ledgerline.sources.versions import StoredTable, load_once, pointers_status
from ledgerline.spec import TableSpec, with_audit
from suite.registry import query
from suite.views import BARS, METRICS, PANEL, RUN, bars, panel, rounded, scratch, table

CUSTOMER_SPEC = TableSpec(
    "customer_copy",
    {
        "c_name": "string",
        "c_custkey": "bigint",
        "c_acctbal": "double",
        "c_nationkey": "bigint",
        "c_mktsegment": "bigint",
        "valid_to": "date",
        "opened_at": "time",
    },
    defaults={"valid_to": fixed.OPEN_END},
)


@query(
    "typed_csv_read",
    """SELECT c_name, c_custkey, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey,
    CAST(NULL AS BIGINT) AS c_mktsegment, DATE '9999-12-31' AS valid_to, CAST(NULL AS INTEGER) AS opened_at
    FROM customer""",
)
def typed_csv_read(spark, sf):
    """CSV columns come in another order, one lacks, one does not parse as a number."""
    path = scratch(spark)
    sinks.write_report(table(spark, sf, "customer"), path, "csv")
    return tables.read_table(spark, CUSTOMER_SPEC, path, "csv")


@query(
    "coerce_event_props",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CAST(NULL AS DOUBLE) AS event_type, CAST(ts AS DATE) AS ts FROM events""",
)
def coerce_event_props(spark, sf):
    spec = TableSpec("props", {"event_id": "bigint", "k": "bigint", "event_type": "double", "ts": "date"})
    events = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return tables.coerce_types(tables.conform(events.withColumn("ts", F.col("ts").cast("string")), spec), spec)


@query(
    "union_tagged_sources",
    """SELECT 'customer' AS party, c_custkey AS party_key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""",
)
def union_tagged_sources(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_acctbal").alias("balance")
    )
    return tables.union_tagged({"customer": customers, "supplier": suppliers}, "party")


@query(
    "append_overlapping_segments",
    f"""WITH {BARS} SELECT ticker, date_key,
    CASE WHEN date_key < 20000101 THEN close_price ELSE high_price END AS price FROM bars""",
)
def append_overlapping_segments(spark, sf):
    """The first extract wins on the days both cover."""
    daily = bars(spark, sf)
    first = daily.filter("date_key < 20000101").select("ticker", "date_key", F.col("close_price").alias("price"))
    second = daily.filter("date_key >= 19990101").select("ticker", "date_key", F.col("high_price").alias("price"))
    return tables.append_segments([first, second], ["ticker", "date_key"])


@query(
    "calendar_of_orders",
    """WITH days AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders),
    n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, day(d) AS day, month(d) AS month,
    year(d) AS year, quarter(d) AS quarter, isodow(d) < 6 AS is_trading_day, coalesce(n, 0) AS n_orders
    FROM days LEFT JOIN n USING (d)""",
)
def calendar_of_orders(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("full_date"))
    counts = days.groupBy("full_date").agg(F.count(F.lit(1)).alias("n"))
    dim = tables.calendar_of(days.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi")))
    return (
        dim.join(counts, "full_date", "left").withColumn("n_orders", F.coalesce("n", F.lit(0)).cast("bigint")).drop("n")
    )


@query(
    "calendar_with_holidays",
    """WITH days AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders)
    SELECT year(d) AS year, count(*) FILTER (isodow(d) < 6 AND NOT (month(d) = 1 AND day(d) = 1)) AS trading_days,
    count(*) AS days FROM days GROUP BY 1""",
)
def calendar_with_holidays(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("full_date"))
    bounds = days.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
    dim = tables.calendar_of(bounds, tables.calendar_of(bounds).filter("month = 1 AND day = 1"))
    return dim.groupBy("year").agg(
        F.count_if("is_trading_day").alias("trading_days"), F.count(F.lit(1)).alias("days")
    )


BAR_SPEC = TableSpec(
    "bars",
    {
        "date_key": "bigint",
        "ticker": "string",
        "close_price": "double",
        "trading_volume": "bigint",
        "_created_at": "date",
    },
    ("date_key", "ticker"),
    ("year",),
    ("ticker", "date_key"),
)


def _stored(df, created):
    return df.select(
        "date_key", "ticker", "close_price", "trading_volume", F.lit(created).cast("date").alias("_created_at")
    )


@query(
    "overwrite_partitioned",
    f"""WITH {BARS} SELECT date_key // 10000 AS year, ticker, count(*) AS n, round(sum(close_price), 2) AS total
    FROM bars WHERE date_key BETWEEN 19970301 AND 19990630 GROUP BY 1, 2""",
)
def overwrite_partitioned(spark, sf):
    """Reload a table laid out by year and read a date range back through partition pruning."""
    path = scratch(spark)
    sinks.write_overwrite(_stored(bars(spark, sf), "2024-01-01"), BAR_SPEC, path)
    back = FL.between_dates(sinks.read_stored(spark, BAR_SPEC, path), 19970301, 19990630)
    return rounded(
        back.groupBy(F.col("year").cast("bigint").alias("year"), "ticker").agg(
            F.count(F.lit(1)).alias("n"), F.sum("close_price").alias("total")
        ),
        2,
    )


@query(
    "append_by_run",
    """SELECT r.run_key, n_nationkey, n_name FROM nation, (VALUES (CAST(20240102030405 AS BIGINT)), (20240103000000)) r(run_key)""",
)
def append_by_run(spark, sf):
    """Two runs append; repeating the first replaces its rows."""
    path = scratch(spark)
    rows = table(spark, sf, "nation").select("n_nationkey", "n_name")
    spec = TableSpec("runs", {"n_nationkey": "int", "n_name": "string"})
    later = type(RUN)(20240103000000, RUN.created_at, RUN.source_file, "run-2")
    for run in (RUN, later, RUN):
        sinks.write_append(rows, spec, path, run)
    return sinks.read_stored(spark, spec, path)


MERGE_SQL = f"""WITH {BARS}, t AS (SELECT date_key, ticker, close_price, trading_volume, DATE '2024-01-01' AS _created_at
      FROM bars WHERE date_key < 20000101),
    s AS (SELECT date_key, ticker, high_price AS close_price, trading_volume * 2 AS trading_volume,
      DATE '2024-02-01' AS _created_at FROM bars WHERE date_key >= 19990101)
    SELECT date_key, ticker, coalesce(s.close_price, t.close_price) AS close_price,
    coalesce(s.trading_volume, t.trading_volume) AS trading_volume, coalesce(t._created_at, s._created_at) AS _created_at
    FROM t FULL JOIN s USING (date_key, ticker)"""


def _target_and_staging(spark, sf):
    daily = bars(spark, sf)
    target = _stored(daily.filter("date_key < 20000101"), "2024-01-01")
    fresh = daily.filter("date_key >= 19990101").select(
        "date_key", "ticker", F.col("high_price").alias("close_price"), (F.col("trading_volume") * 2).alias("trading_volume")
    )
    return target, _stored(fresh, "2024-02-01")


@query("merge_upsert", MERGE_SQL)
def merge_upsert(spark, sf):
    target, staging = _target_and_staging(spark, sf)
    return sinks.merge_upsert(target, staging, ["date_key", "ticker"])


@query("merge_into_stored_table", MERGE_SQL)
def merge_into_stored_table(spark, sf):
    """Upsert that rewrites only the years the staging rows touch."""
    path = scratch(spark)
    target, staging = _target_and_staging(spark, sf)
    sinks.write_overwrite(target, BAR_SPEC, path)
    sinks.merge_table(spark, BAR_SPEC, path, staging)
    return sinks.read_stored(spark, BAR_SPEC, path).select(*BAR_SPEC.columns)


@query(
    "merge_then_read",
    f"""{MERGE_SQL.replace("FROM t FULL JOIN", ", 1 AS versions FROM t FULL JOIN")}
    UNION ALL SELECT NULL, o_orderpriority, o_totalprice, NULL, DATE '2024-01-01', 1 FROM orders WHERE o_orderstatus = 'P'""",
)
def merge_then_read(spark, sf):
    """A stored table whose rows without a date survive a merge; a load that breaks while it writes leaves no trace."""
    stored = StoredTable(spark, BAR_SPEC, scratch(spark))
    target, staging = _target_and_staging(spark, sf)
    undated = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(
        F.lit(None).cast("bigint").alias("date_key"), F.col("o_orderpriority").alias("ticker"),
        F.col("o_totalprice").alias("close_price"), F.lit(None).cast("bigint").alias("trading_volume"),
        F.lit("2024-01-01").cast("date").alias("_created_at"),
    )
    stored.overwrite(target.unionByName(undated))
    broken = staging.withColumn("close_price", F.when(F.col("trading_volume") > 0, F.raise_error(F.lit("broken off"))).cast("double"))
    for load in (stored.overwrite, stored.merge):
        try:
            load(broken)
        except Exception as e:
            if "broken off" not in str(e):
                raise
    stored.merge(staging)
    versions = len(stored.versions()) - 1  # of the merge; the broken loads published none
    return stored.read().select(*BAR_SPEC.columns, F.lit(versions).alias("versions"))


RUN_SPEC = TableSpec("loads", {"o_orderkey": "bigint", "o_totalprice": "double"}, ("o_orderkey",))
AUDIT_SPEC = TableSpec("dim_audit", fixed.DIM_AUDIT, ("audit_key", "script_name"))


@query(
    "audited_load_once",
    """SELECT CAST(20240102030405 AS BIGINT) AS audit_key, 'run-1' AS run_id, 'load' AS script_name, 'orders.parquet' AS source_file,
    count(*) AS rows_processed, 'SUCCESS' AS status, count(*) AS stored_rows, round(sum(o_totalprice), 2) AS stored_total FROM orders""",
)
def audited_load_once(spark, sf):
    """A run that breaks while it writes, then runs, then is repeated: one SUCCESS row and one copy of the data."""
    path = scratch(spark)
    target, audit = StoredTable(spark, RUN_SPEC, f"{path}/orders"), StoredTable(spark, AUDIT_SPEC, f"{path}/audit")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    broken = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") > 0, F.raise_error(F.lit("broken off"))).cast("double"))
    try:
        load_once(broken, RUN, target, audit, "load")
    except Exception as e:
        if "broken off" not in str(e):
            raise
    for _ in range(2):
        load_once(rows, RUN, target, audit, "load")
    held = target.read().agg(F.count(F.lit(1)).alias("stored_rows"), F.round(F.sum("o_totalprice"), 2).alias("stored_total"))
    return audit.read().drop("run_timestamp").withColumn("_one", F.lit(1)).join(held.withColumn("_one", F.lit(1)), "_one").drop("_one")


@query(
    "stored_table_status",
    """SELECT 'lineitem' AS "table", count(*) AS row_count, true AS has_size FROM lineitem
    UNION ALL SELECT 'orders', count(*), true FROM orders""",
)
def stored_table_status(spark, sf):
    """Rows and bytes of stored tables from their pointers, after a reload and an append."""
    path = scratch(spark)
    orders = StoredTable(spark, RUN_SPEC, f"{path}/orders")
    orders.overwrite(table(spark, sf, "orders"))
    lines = StoredTable(spark, TableSpec("lines", {"l_orderkey": "bigint", "l_linenumber": "int"}), f"{path}/lineitem")
    source = table(spark, sf, "lineitem")
    for key, rows in enumerate((source.filter("l_returnflag = 'N'"), source.filter("l_returnflag <> 'N'"))):
        lines.append(rows, type(RUN)(key, RUN.created_at, RUN.source_file, f"run-{key}"))
    status = pointers_status({"orders": orders, "lineitem": lines})
    return status.select("table", "row_count", (F.col("size_bytes") > 0).alias("has_size"))


@query("json_report", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def json_report(spark, sf):
    path = scratch(spark)
    sinks.write_report(table(spark, sf, "nation"), path, "json")
    return spark.read.schema("n_nationkey int, n_name string, n_regionkey int").json(path)


STATUS_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations")


@query(
    "table_status",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS row_count, true AS has_size FROM {t}" for t in STATUS_TABLES),
)
def table_status(spark, sf):
    status = sinks.table_status({t: table(spark, sf, t) for t in STATUS_TABLES})
    return status.select("table", "row_count", (F.col("size_bytes") > 0).alias("has_size"))


@query(
    "audited_load",
    """SELECT CAST(20240102030405 AS BIGINT) AS audit_key, 'run-1' AS run_id, 'load' AS script_name,
    'orders.parquet' AS source_file, NULL::BIGINT AS rows_processed, 'RUNNING' AS status
    UNION ALL SELECT 20240102030405, 'run-1', 'load', 'orders.parquet', count(*), 'SUCCESS' FROM orders""",
)
def audited_load(spark, sf):
    path = scratch(spark)

    def store(df):
        df.write.parquet(f"{path}/orders")
        return spark.read.parquet(f"{path}/orders")

    sinks.audited(table(spark, sf, "orders"), RUN, f"{path}/audit", "load", store)
    return spark.read.parquet(f"{path}/audit").drop("run_timestamp")


@query(
    "audit_columns",
    """SELECT s_suppkey, CAST(20240102030405 AS BIGINT) AS audit_key, 'orders.parquet' AS _source_file,
    DATE '2024-01-02' AS created_on FROM supplier""",
)
def audit_columns(spark, sf):
    stamped = with_audit(table(spark, sf, "supplier").select("s_suppkey"), RUN)
    return stamped.withColumn("created_on", F.to_date("_created_at")).drop("_created_at", "_updated_at")


@query(
    "numeric_text_clean",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
    CAST(NULL AS DOUBLE) AS bad FROM orders""",
)
def numeric_text_clean(spark, sf):
    """Numbers as text with thousands commas and blanks; a third of the texts is 'nan'."""
    text = F.when(F.col("o_orderstatus") == "P", " nan ").otherwise(
        F.concat(F.lit(" "), F.format_number("o_totalprice", 2), F.lit(" "))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", S.clean_numeric(text).alias("price"), S.clean_numeric("o_orderpriority").alias("bad")
    )


@query(
    "code_and_name_clean",
    "SELECT s_suppkey, upper(s_name) AS code, s_name AS name FROM supplier",
)
def code_and_name_clean(spark, sf):
    padded = F.concat(F.lit("  "), F.col("s_name"), F.lit(" "))
    return table(spark, sf, "supplier").select(
        "s_suppkey", S.clean_code(F.lower(padded)).alias("code"), S.clean_name(padded).alias("name")
    )


@query(
    "normalize_percent",
    """SELECT l_returnflag, round(sum(l_quantity / 100), 4) AS l_quantity, round(sum(l_discount), 4) AS l_discount
    FROM lineitem GROUP BY 1""",
)
def normalize_percent_query(spark, sf):
    """Quantity peaks above the limit and is divided, discount does not."""
    scaled = normalize_percent(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"])
    return rounded(scaled.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("l_quantity"),
                                                      F.sum("l_discount").alias("l_discount")), 4)


@query(
    "date_keys",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
    year(o_orderdate) * 10000 + 1231 AS year_end_key, CAST(o_orderdate AS DATE) AS back,
    year(o_orderdate) AS year, strftime(o_orderdate, '%Y-%m') AS month FROM orders""",
)
def date_keys(spark, sf):
    keyed = table(spark, sf, "orders").withColumn("date_key", S.date_key("o_orderdate"))
    return keyed.select(
        "o_orderkey",
        "date_key",
        S.year_end_key(F.year("o_orderdate")).alias("year_end_key"),
        S.key_to_date("date_key").alias("back"),
        S.key_to_year("date_key").alias("year"),
        S.month_label("o_orderdate").alias("month"),
    )


@query(
    "period_labels",
    """SELECT period, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (
      SELECT CAST(year(o_orderdate) AS VARCHAR) AS period, o_totalprice FROM orders
      UNION ALL SELECT year(o_orderdate) || '-Q' || quarter(o_orderdate), o_totalprice FROM orders) GROUP BY 1""",
)
def period_labels(spark, sf):
    """Annual rows carry quarter code 5, quarterly rows 1 to 4."""
    orders = table(spark, sf, "orders").select("o_totalprice", F.year("o_orderdate").alias("year"),
                                               F.explode(F.array(F.lit(5), F.quarter("o_orderdate"))).alias("quarter"))
    split = tables.annual(orders).unionByName(tables.quarterly(orders))
    labelled = split.groupBy(S.period_label("year", "quarter").alias("period"))
    return rounded(labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), 2)


STATEMENT_SQL = PANEL + """, s AS (
  SELECT entity, year, total AS total_assets, opened AS total_deposits, finished AS total_loans,
         largest AS total_equity, pending AS npl_amount, smallest AS loan_loss_provision, largest AS interest_income,
         smallest AS interest_expense, n_orders * 1000.0::DOUBLE AS non_interest_income,
         smallest AS non_interest_expense, largest - smallest AS profit_after_tax FROM panel)"""


def statements(spark, sf):
    p = panel(spark, sf)
    none = F.lit(None).cast("double")
    named = {
        "total_assets": F.col("total"),
        "total_deposits": F.col("opened"),
        "total_loans": F.col("finished"),
        "total_equity": F.col("largest"),
        "npl_amount": F.col("pending"),
        "loan_loss_provision": F.col("smallest"),
        "interest_income": F.col("largest"),
        "interest_expense": F.col("smallest"),
        "non_interest_income": F.col("n_orders") * 1000.0,
        "non_interest_expense": F.col("smallest"),
        "profit_after_tax": F.col("largest") - F.col("smallest"),
        "etd": F.when(F.col("n_orders") > 1, F.lit(0.5)),
    }
    given = {c: none for c in ("eta", "roa", "roe", "nim", "cir", "npl_ratio", "llp_ratio")}
    return p.select("entity", "year", *[v.alias(k) for k, v in (named | given).items()])


@query(
    "statement_ratios",
    f"""WITH {STATEMENT_SQL} SELECT entity, year, round(total_equity / total_assets, 6) AS eta,
    round(CASE WHEN non_interest_income > 1500 THEN 0.5 ELSE total_equity / total_deposits END, 6) AS etd,
    round(profit_after_tax / total_assets, 6) AS roa, round(profit_after_tax / total_equity, 6) AS roe,
    round((interest_income - interest_expense) / total_assets, 6) AS nim,
    round(non_interest_expense / (abs(interest_income - interest_expense) + abs(non_interest_income)), 6) AS cir,
    round(npl_amount / total_loans, 6) AS npl_ratio, round(loan_loss_provision / total_loans, 6) AS llp_ratio,
    round(total_loans / total_assets, 6) AS lta, round(total_loans / total_deposits, 6) AS ltd,
    round(total_loans / total_assets, 6) AS gta, round(interest_income - interest_expense, 4) AS net_interest_income
    FROM s""",
)
def statement_ratios(spark, sf):
    derived = facts.camels_ratios(statements(spark, sf))
    ratios = ["eta", "etd", "roa", "roe", "nim", "cir", "npl_ratio", "llp_ratio", "lta", "ltd", "gta"]
    return rounded(derived.select("entity", "year", *ratios, "net_interest_income"), 6, net_interest_income=4)


FLOW_SQL = """flow AS (SELECT user_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_key,
      sum(value) FILTER (event_type = 'purchase') AS buy, sum(value) FILTER (event_type = 'error') AS sell,
      count(*) FILTER (event_type = 'purchase') AS n_buy, count(*) FILTER (event_type = 'error') AS n_sell
      FROM events GROUP BY 1, 2)"""


def flows(spark, sf):
    pick = lambda t, v: F.when(F.col("event_type") == t, v)
    return table(spark, sf, "events").groupBy("user_id", S.date_key("ts").alias("date_key")).agg(
        F.sum(pick("purchase", F.col("value"))).alias("buy"),
        F.sum(pick("error", F.col("value"))).alias("sell"),
        F.count(pick("purchase", F.lit(1))).alias("n_buy"),
        F.count(pick("error", F.lit(1))).alias("n_sell"),
    )


@query(
    "net_flow_and_buy_ratio",
    f"""WITH {FLOW_SQL} SELECT user_id, date_key, round(buy - sell, 4) AS net,
    round(n_buy / nullif(n_buy + n_sell, 0), 6) AS buy_ratio FROM flow""",
)
def net_flow_and_buy_ratio(spark, sf):
    f = flows(spark, sf).select(
        "user_id",
        "date_key",
        S.net_flow("buy", "sell").alias("net"),
        S.active_buy_ratio("n_buy", "n_sell").alias("buy_ratio"),
    )
    return rounded(f, 6, net=4)


@query(
    "risk_label",
    f"""WITH {PANEL} SELECT entity, year, coalesce(CAST(npl_ratio >= 0.03 AS INTEGER), 0) AS risk_label FROM panel""",
)
def risk_label(spark, sf):
    return panel(spark, sf).select(
        "entity", "year", S.threshold_label("npl_ratio", fixed.RISK_THRESHOLD).alias("risk_label")
    )


@query(
    "status_labels",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS label, count(*) AS n
    FROM orders GROUP BY 1""",
)
def status_labels(spark, sf):
    label = S.map_label("o_orderstatus", {"F": "finished", "O": "open"}).alias("label")
    return table(spark, sf, "orders").groupBy(label).agg(F.count(F.lit(1)).alias("n"))


@query(
    "percent_and_units",
    """SELECT printf('%.2f%%', l_discount * 100) AS discount, printf('%.1f%%', l_tax * 100) AS tax,
    round(sum(l_extendedprice / 1000), 3) AS thousands, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def percent_and_units(spark, sf):
    scaled = scale_by(scale_by(table(spark, sf, "lineitem"), ["l_discount", "l_tax"], 100.0), ["l_extendedprice"], 1e-3)
    grouped = scaled.groupBy(
        S.percent_text("l_discount").alias("discount"), S.percent_text("l_tax", 1).alias("tax")
    )
    return rounded(grouped.agg(F.sum("l_extendedprice").alias("thousands"), F.count(F.lit(1)).alias("n")), 3)


@query(
    "code_system_map",
    """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'URG' WHEN '5-LOW' THEN 'LOW' ELSE o_orderpriority END AS code,
    count(*) AS n FROM orders GROUP BY 1""",
)
def code_system_map(spark, sf):
    mapped = map_codes(
        table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "code"), "code", {"1-URGENT": "URG", "5-LOW": "LOW"}
    )
    return mapped.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "finite_or_zero",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 1000 THEN 0 ELSE c_acctbal END AS balance
    FROM customer""",
)
def finite_or_zero(spark, sf):
    b = F.col("c_acctbal")
    odd = F.when(b < 0, F.lit(float("inf"))).when(b < 500, F.lit(float("nan"))).when(b >= 1000, b)
    return table(spark, sf, "customer").select("c_custkey", S.finite_or_zero(odd).alias("balance"))


@query(
    "clean_price_fact",
    f"""WITH {BARS} SELECT date_key, ticker, open_price, high_price, low_price, close_price, trading_volume FROM bars""",
)
def clean_price_fact(spark, sf):
    """Text source with local-language headers and every row delivered twice."""
    raw = bars(spark, sf).select(
        "ticker",
        F.date_format(S.key_to_date("date_key"), "yyyy-MM-dd").alias(" Ngày "),
        F.format_number("open_price", 2).alias("Mở cửa"),
        F.col("high_price").cast("string").alias("Cao nhất"),
        F.col("low_price").cast("string").alias("Thấp nhất"),
        F.col("close_price").cast("string").alias("Đóng cửa "),
        F.col("trading_volume").cast("double").cast("string").alias("Khối lượng"),
    )
    twice = tables.union_tagged({1: raw, 2: raw}, "copy")
    return facts.clean_fact(twice, facts.PRICE_RULES, "ticker", order=["copy"])


@query(
    "clean_flow_fact",
    f"""WITH {FLOW_SQL}, v AS (SELECT date_key, user_id, CAST(floor(buy) AS BIGINT) AS b, CAST(floor(sell) AS BIGINT) AS s,
      sell / (buy + sell) AS o FROM flow)
    SELECT date_key, user_id, round(coalesce(o, lag(o) OVER w), 6) AS foreign_ownership_ratio,
    coalesce(b, lag(b) OVER w) AS foreign_buy_volume, coalesce(s, lag(s) OVER w) AS foreign_sell_volume,
    coalesce(b - s, lag(b - s) OVER w) AS foreign_net_volume FROM v
    WINDOW w AS (PARTITION BY user_id ORDER BY date_key)""",
)
def clean_flow_fact(spark, sf):
    """Gaps of one day are filled from the day before, longer gaps stay."""
    raw = flows(spark, sf).select(
        "user_id",
        S.key_to_date("date_key").cast("string").alias("Date"),
        F.floor("buy").cast("string").alias("Foreign Buy Volume"),
        F.floor("sell").cast("string").alias("Foreign Sell Volume"),
        F.try_divide("sell", F.col("buy") + F.col("sell")).alias("Foreign Ownership Ratio"),
    )
    fact = facts.clean_fact(raw, facts.FOREIGN_RULES, "user_id")
    return rounded(fact.drop("foreign_net_value"))


@query(
    "clean_proprietary_fact",
    f"""WITH {FLOW_SQL}, v AS (SELECT date_key, user_id, CAST(floor(buy) AS BIGINT) AS b, CAST(floor(sell) AS BIGINT) AS s FROM flow)
    SELECT date_key, user_id, coalesce(b, lag(b) OVER w) AS prop_buy_volume, coalesce(s, lag(s) OVER w) AS prop_sell_volume,
    coalesce(b - s, lag(b - s) OVER w) AS prop_net_volume FROM v WINDOW w AS (PARTITION BY user_id ORDER BY date_key)""",
)
def clean_proprietary_fact(spark, sf):
    raw = flows(spark, sf).select(
        "user_id",
        S.key_to_date("date_key").cast("string").alias("time"),
        F.floor("buy").cast("string").alias("Prop Buy Volume"),
        F.floor("sell").cast("string").alias("Prop Sell Volume"),
    )
    return facts.clean_fact(raw, facts.PROPRIETARY_RULES, "user_id").drop("prop_net_value")


@query(
    "clean_order_stats_fact",
    f"""WITH {FLOW_SQL} SELECT date_key, user_id, n_buy AS total_buy_orders, CAST(floor(buy) AS BIGINT) AS total_buy_volume,
    n_sell AS total_sell_orders, CAST(floor(sell) AS BIGINT) AS total_sell_volume, n_buy + n_sell AS matched_volume
    FROM flow WHERE buy IS NOT NULL AND sell IS NOT NULL""",
)
def clean_order_stats_fact(spark, sf):
    """Any missing figure rejects the row."""
    raw = flows(spark, sf).select(
        "user_id",
        S.key_to_date("date_key").cast("string").alias("Date"),
        F.col("n_buy").cast("string").alias("Total Buy Orders"),
        F.floor("buy").cast("string").alias("Total Buy Volume"),
        F.col("n_sell").cast("string").alias("Total Sell Orders"),
        F.floor("sell").cast("string").alias("Total Sell Volume"),
        (F.col("n_buy") + F.col("n_sell")).cast("string").alias("Matched Volume"),
    )
    return facts.clean_fact(raw, facts.ORDER_STATS_RULES, "user_id")


@query(
    "daily_metrics",
    f"""WITH {METRICS} SELECT date_key, ticker, open_price, high_price, low_price, close_price, trading_volume,
    round(price_change, 4) AS price_change, round(price_change_pct, 6) AS price_change_pct,
    round(price_amplitude, 6) AS price_amplitude, round(volume_change_pct, 6) AS volume_change_pct,
    round(trading_value, 2) AS trading_value FROM metrics""",
)
def daily_metrics(spark, sf):
    return rounded(facts.daily_metrics(bars(spark, sf), "ticker"), 6, trading_value=2, price_change=4)


@query(
    "stock_features",
    f"""WITH {METRICS} SELECT date_key, ticker, open_price, high_price, low_price, close_price, trading_volume,
    round(price_change_pct, 6) AS price_change_pct, round(volume_change_pct, 6) AS volume_change_pct FROM metrics""",
)
def stock_features(spark, sf):
    return rounded(facts.stock_features(bars(spark, sf), "ticker"), 6)


@query(
    "required_values",
    f"WITH {PANEL} SELECT entity, year, round(npl_ratio, 6) AS npl_ratio FROM panel WHERE npl_ratio IS NOT NULL AND roa IS NOT NULL",
)
def required_values(spark, sf):
    return rounded(FL.require_not_null(panel(spark, sf), ["npl_ratio", "roa"]).select("entity", "year", "npl_ratio"))


@query(
    "excluded_codes",
    """SELECT l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem
    WHERE l_returnflag NOT IN ('A') GROUP BY 1""",
)
def excluded_codes(spark, sf):
    kept = FL.exclude(table(spark, sf, "lineitem"), "l_returnflag", ["A"])
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_suppkey").alias("n_suppliers")
    )


@query(
    "range_trimmed_pairs",
    f"""WITH {PANEL} SELECT entity, year, round(npl_ratio, 6) AS npl_ratio, round(roa, 6) AS roa FROM panel
    WHERE npl_ratio BETWEEN 0.1 AND 0.6 AND roa <= 0.5""",
)
def range_trimmed_pairs(spark, sf):
    trimmed = FL.range_trim(panel(spark, sf), {"npl_ratio": (0.1, 0.6), "roa": (None, 0.5)})
    return rounded(trimmed.select("entity", "year", "npl_ratio", "roa"))


@query(
    "latest_slice",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def latest_slice(spark, sf):
    return FL.latest_slice(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "o_totalprice")


@query(
    "last_periods",
    """WITH m AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders)
    SELECT month, count(*) AS n FROM m
    WHERE month IN (SELECT DISTINCT month FROM m ORDER BY month DESC LIMIT 24) GROUP BY 1""",
)
def last_periods(spark, sf):
    months = table(spark, sf, "orders").withColumn("month", S.month_label("o_orderdate"))
    return FL.last_n_periods(months, "month", 24).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query(
    "since_first_event",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate >= (SELECT min(l_shipdate) + INTERVAL 5 YEAR FROM lineitem)""",
)
def since_first_event(spark, sf):
    shipped = table(spark, sf, "lineitem").select(
        (F.col("l_shipdate") + F.expr("interval 5 years")).alias("o_orderdate")
    )
    kept = FL.since_min_of(table(spark, sf, "orders"), shipped, "o_orderdate")
    return kept.select("o_orderkey", "o_totalprice")


@query(
    "rows_of_flagged",
    f"""WITH {PANEL} SELECT entity, year, round(npl_ratio, 6) AS npl_ratio FROM panel
    WHERE entity IN (SELECT entity FROM panel WHERE npl_ratio >= 0.9)""",
)
def rows_of_flagged(spark, sf):
    kept = FL.rows_of_flagged(panel(spark, sf), "entity", F.col("npl_ratio") >= 0.9)
    return rounded(kept.select("entity", "year", "npl_ratio"))


@query(
    "recent_rows",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 60",
)
def recent_rows(spark, sf):
    return FL.recent(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", 60, ["o_orderkey"]
    )


@query(
    "top_k_scores",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_k_scores(spark, sf):
    return FL.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, ["o_orderkey"])


@query(
    "ticks_by_session",
    """WITH t AS (SELECT *, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS s FROM events)
    SELECT CASE WHEN s BETWEEN 32400 AND 33299 THEN 'ATO' WHEN s BETWEEN 33300 AND 41399 THEN 'Morning'
      WHEN s BETWEEN 46800 AND 52199 THEN 'Afternoon' WHEN s BETWEEN 52200 AND 53100 THEN 'ATC' END AS session_name,
    event_type, count(*) AS n FROM t GROUP BY 1, 2""",
)
def ticks_by_session(spark, sf):
    """Events outside every session keep a NULL session."""
    dim = tables.session_dim(spark).select("session_key", "session_name")
    ticks = table(spark, sf, "events").withColumn("session_key", session_of("ts", fixed.SESSIONS))
    counts = ticks.groupBy("session_key", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(dim, "session_key", "left").drop("session_key")


@query(
    "drop_technical_columns",
    "SELECT o_orderpriority AS period, o_orderkey, o_totalprice FROM orders",
)
def drop_technical_columns(spark, sf):
    from ledgerline.operators.reshape import drop_cols

    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "period")
    return drop_cols(orders, ["o_custkey", "o_orderstatus", "o_orderdate", "absent"], ["period"])


