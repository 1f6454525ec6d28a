"""TPC-H order marts: staging projections, the order fact and the customer
dimension.

Plan shape (see ``explain``):

* ``fct_orders`` aggregates line items per order *before* the join
  (partial + final HashAggregate on ``order_key``), then inner-joins the order
  headers on the same key, so each side is exchanged exactly once and the join
  input is order-grain, not line-grain.
* ``dim_customers`` aggregates the fact per customer (again partial + final)
  and left-joins customers; totals are zero-filled, dates are not.
* Staging models are projections; Catalyst collapses them into the scans,
  which read only the columns a mart uses.

Money is decimal: revenue is exact and independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.operators.versions import VersionedTable
from martlight.sources.tables import Sources, col_or_null

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"
REVENUE = "decimal(38,6)"


# --- staging ---------------------------------------------------------------
def stg_customers(customer: DataFrame) -> DataFrame:
    """Rename projection of ``customer``; absent source columns become typed NULLs."""
    c = customer
    return c.select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("name"),
        col_or_null(c, "c_address", "string").alias("address"),
        F.col("c_nationkey").alias("nation_key"),
        col_or_null(c, "c_phone", "string").alias("phone"),
        F.col("c_acctbal").cast(MONEY).alias("account_balance"),
        F.col("c_mktsegment").alias("market_segment"),
        col_or_null(c, "c_comment", "string").alias("comment"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    """Rename projection of ``orders``; absent source columns become typed NULLs."""
    o = orders
    return o.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast(MONEY).alias("total_price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderpriority").alias("order_priority"),
        col_or_null(o, "o_clerk", "string").alias("clerk"),
        col_or_null(o, "o_shippriority", "int").alias("ship_priority"),
        col_or_null(o, "o_comment", "string").alias("comment"),
    )


def stg_lineitem(lineitem: DataFrame) -> DataFrame:
    """Rename projection of ``lineitem``; absent source columns become typed NULLs."""
    li = lineitem
    return li.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("l_quantity").cast(MONEY).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("extended_price"),
        F.col("l_discount").cast(RATE).alias("discount"),
        F.col("l_tax").cast(RATE).alias("tax"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        col_or_null(li, "l_commitdate", "date").alias("commit_date"),
        col_or_null(li, "l_receiptdate", "date").alias("receipt_date"),
    )


# --- marts -----------------------------------------------------------------
def net_revenue(price="extended_price", discount="discount", tax="tax"):
    """price × (1 − discount) × (1 + tax), on decimals."""
    return F.col(price) * (F.lit(1) - F.col(discount)) * (F.lit(1) + F.col(tax))


def line_revenue(stg_line: DataFrame) -> DataFrame:
    """Line grain: key columns plus net revenue per line."""
    return stg_line.select(
        "order_key", "line_number",
        net_revenue().cast(REVENUE).alias("line_revenue"),
    )


def order_revenue(stg_line: DataFrame) -> DataFrame:
    """Revenue and line count per order (map-side partial aggregation)."""
    return stg_line.groupBy("order_key").agg(
        F.sum(net_revenue()).cast(REVENUE).alias("order_revenue"),
        F.count(F.lit(1)).alias("line_item_count"),
    )


def fct_orders(stg_ord: DataFrame, stg_line: DataFrame) -> DataFrame:
    """Order fact.  Inner join: an order without lines has no revenue row."""
    rev = order_revenue(stg_line)
    return stg_ord.join(rev, "order_key", "inner").select(
        "order_key", "customer_key", "order_status", "order_date",
        "order_priority", "order_revenue", "line_item_count",
    )


def customer_orders(fct: DataFrame) -> DataFrame:
    """Order count, revenue and first/last order date per customer."""
    return fct.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("order_revenue").cast(REVENUE).alias("total_revenue"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def dim_customers(stg_cust: DataFrame, fct: DataFrame) -> DataFrame:
    """Customer dimension: totals zero-filled, order dates left NULL."""
    agg = customer_orders(fct)
    return stg_cust.join(agg, "customer_key", "left").select(
        "customer_key", "name", "address", "phone", "account_balance",
        "market_segment",
        F.coalesce(F.col("total_orders"), F.lit(0).cast("bigint")).alias("total_orders"),
        F.coalesce(F.col("total_revenue"), F.lit(0).cast(REVENUE)).alias("total_revenue"),
        "first_order_date", "last_order_date",
    )


# --- model DAG over a source directory ---------------------------------------
class Marts:
    """The model DAG, lazily: each attribute is a DataFrame plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.src = Sources(spark, sf_dir)

    @property
    def stg_customers(self):
        return stg_customers(self.src.customer)

    @property
    def stg_orders(self):
        return stg_orders(self.src.orders)

    @property
    def stg_lineitem(self):
        return stg_lineitem(self.src.lineitem)

    @property
    def fct_orders(self):
        return fct_orders(self.stg_orders, self.stg_lineitem)

    @property
    def dim_customers(self):
        return dim_customers(self.stg_customers, self.fct_orders)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Full rebuild of a table model: overwrite ``path`` and read it back.

    Reading back cuts the lineage, so a later model (and a lost executor)
    starts from the written files rather than recomputing the upstream plan.
    """
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def build_marts(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, DataFrame]:
    """``run``: staging stays lazy (views), marts are tables in versions, rebuilt in dependency
    order; ``dim_customers`` reads the written fact.  A build that dies leaves the published
    versions readable (``VersionedTable(spark, path).read()``)."""
    m = Marts(spark, sf_dir)
    fct = VersionedTable(spark, f"{out_dir}/fct_orders").rebuild(m.fct_orders)
    dim = VersionedTable(spark, f"{out_dir}/dim_customers").rebuild(dim_customers(m.stg_customers, fct))
    return {"fct_orders": fct, "dim_customers": dim}
