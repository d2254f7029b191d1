"""The warehouse concepts expressed on the driver's tables, as DataFrames and as SQL common table expressions."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.series import Series
from ledgerline.operators.windows import latest_row
from ledgerline.plans.facts import bars_from_ticks
from ledgerline.spec import RunContext
from ledgerline.storage import shared_folder

RUN = RunContext(20240102030405, dt.datetime(2024, 1, 2, 3, 4, 5), "orders.parquet", "run-1")
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BY_TICKER = Series.of("ticker", "date_key")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for one query's own writes, below the shared folder."""
    return f"{shared_folder(spark)}/ledgerline-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column, so both engines print the same digits."""
    kinds = dict(df.dtypes)
    return df.select(
        *[F.round(c, special.get(c, digits)).alias(c) if k == "double" else F.col(c) for c, k in kinds.items()]
    )


# Daily bars: one series per order priority, one bar per day.
def bars(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "ticker")
    return bars_from_ticks(
        orders, "ticker", "o_orderdate", "o_totalprice", F.count(F.lit(1)), ["o_orderkey"]
    )


BARS = """bars AS (
  SELECT o_orderpriority AS ticker, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
         arg_min(o_totalprice, o_orderkey) AS open_price, max(o_totalprice) AS high_price,
         min(o_totalprice) AS low_price, arg_max(o_totalprice, o_orderkey) AS close_price,
         count(*) AS trading_volume
  FROM orders GROUP BY 1, 2)"""

METRICS = BARS + """, metrics AS (
  SELECT date_key, ticker, open_price, high_price, low_price, close_price, trading_volume,
         close_price - open_price AS price_change,
         coalesce(close_price / nullif(lag(close_price) OVER w, 0) - 1, 0) AS price_change_pct,
         (high_price - low_price) / nullif(open_price, 0) AS price_amplitude,
         coalesce(trading_volume / nullif(lag(trading_volume) OVER w, 0) - 1, 0) AS volume_change_pct,
         close_price * trading_volume AS trading_value
  FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date_key))"""


# Yearly panel: one entity per customer; ratios are NULL in years without such orders.
def panel(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    amount = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")))
    yearly = orders.groupBy(
        F.col("o_custkey").alias("entity"), F.year("o_orderdate").cast("bigint").alias("year")
    ).agg(
        F.sum("o_totalprice").alias("total"),
        amount("F").alias("finished"),
        amount("O").alias("opened"),
        amount("P").alias("pending"),
        F.count(F.lit(1)).alias("n_orders"),
        F.max("o_totalprice").alias("largest"),
        F.min("o_totalprice").alias("smallest"),
    )
    return yearly.withColumns(
        {
            "npl_ratio": F.try_divide("finished", "total"),
            "llp_ratio": F.try_divide("opened", "total"),
            "roa": F.try_divide("pending", "total"),
        }
    )


PANEL = """panel AS (
  SELECT o_custkey AS entity, year(o_orderdate) AS year, sum(o_totalprice) AS total,
         sum(o_totalprice) FILTER (o_orderstatus = 'F') AS finished,
         sum(o_totalprice) FILTER (o_orderstatus = 'O') AS opened,
         sum(o_totalprice) FILTER (o_orderstatus = 'P') AS pending,
         count(*) AS n_orders, max(o_totalprice) AS largest, min(o_totalprice) AS smallest,
         finished / total AS npl_ratio, opened / total AS llp_ratio, pending / total AS roa
  FROM orders GROUP BY 1, 2)"""


# Yearly panel by nation, with its region as type.
def nation_panel(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    yearly = (
        panel(spark, sf)
        .join(customers, F.col("entity") == F.col("c_custkey"))
        .groupBy("c_nationkey", "year")
        .agg(*[F.sum(c).alias(c) for c in ("total", "finished", "opened", "pending", "n_orders")])
    )
    return yearly.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_nationkey").cast("bigint").alias("bank_key"),
        F.col("n_name").alias("bank_code"),
        F.col("r_name").alias("bank_type"),
        "year",
        (F.col("year") * 10000 + 1231).alias("date_key"),
        "total",
        F.try_divide("finished", "total").alias("npl_ratio"),
        F.try_divide("opened", "total").alias("llp_ratio"),
        F.try_divide("pending", "total").alias("roa"),
        F.try_divide("total", F.col("n_orders").cast("double")).alias("nim"),
    )


NATIONS = PANEL + """, nations AS (
  SELECT CAST(c_nationkey AS BIGINT) AS bank_key, n_name AS bank_code, r_name AS bank_type, p.year,
         p.year * 10000 + 1231 AS date_key, sum(p.total) AS total,
         sum(finished) / sum(p.total) AS npl_ratio, sum(opened) / sum(p.total) AS llp_ratio,
         sum(pending) / sum(p.total) AS roa, sum(p.total) / sum(n_orders) AS nim
  FROM panel p JOIN customer ON entity = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3, 4)"""


# Scored rows with a binary label: how well the length of a document predicts its quality.
def scored(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return (
        docs.join(table(spark, sf, "labels"), "doc_id")
        .select(
            "doc_id",
            F.col("quality").cast("bigint").alias("label"),
            (F.col("n_chars") / (F.col("n_chars") + 4000.0)).alias("prob"),
        )
    )


SCORED = """scored AS (
  SELECT doc_id, CAST(quality AS BIGINT) AS label, n_chars / (n_chars + 4000.0::DOUBLE) AS prob
  FROM documents JOIN labels USING (doc_id))"""


# Embedding vectors as columns e0..e63 with their label as the cluster.
EMBEDDING_COLUMNS = [f"e{i}" for i in range(64)]


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").selectExpr(
        "vec_id",
        "cast(label as bigint) as label",
        *[f"cast(embedding[{i}] as double) as {c}" for i, c in enumerate(EMBEDDING_COLUMNS)],
    )


# Per-customer feature rows for clustering and classification.
FEATURES = ["avg_price", "n_orders", "finished_share", "days_span"]


def customer_features(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.groupBy(F.col("o_custkey").alias("entity")).agg(
        F.avg("o_totalprice").alias("avg_price"),
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("finished_share"),
        F.date_diff(F.max(F.to_date("o_orderdate")), F.min(F.to_date("o_orderdate"))).cast("double").alias("days_span"),
    )


# Two snapshots of a customer's latest order, for versioned dimensions and upserts.
def snapshot(spark: SparkSession, sf: str, until: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    return latest_row(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        F.col("o_custkey").alias("cust"),
        F.col("o_orderpriority").alias("tier"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("capital"),
    )
