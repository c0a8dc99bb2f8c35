"""Sales-detail view over the TPC-H-like star schema in ``/root/testdata``.

Mapping (one detail row per line item):
corp = nation, customer = customer, office = region, category = brand,
product = part, retired sales rep = order priority; qty, area (qty * size), sales (net price) and profit
(sales - qty * retail price) as exact decimals.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fiscal import fiscal_range, fiscal_year

DETAIL_COLUMNS = (
    "fy", "order_date", "corp_code", "corp_name", "cust_code", "cust_name", "office", "rep_name",
    "category", "prod_code", "prod_name", "qty", "area", "sales", "profit",
)


# Per-session memo of fixture DataFrames (weak keys: entries die with the
# session object, so a new session never sees DataFrames of a stopped one).
_MEMO: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _memo(spark: SparkSession) -> dict:
    if spark not in _MEMO:
        _MEMO[spark] = {}
    return _MEMO[spark]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Fixture table; the DataFrame is reused per session (the inputs are
    read-only), which saves a file listing for every repeated read."""
    memo, key = _memo(spark), ("table", sf_dir.rstrip("/"), name)
    if key not in memo:
        memo[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return memo[key]


def detail_view(
    spark: SparkSession,
    sf_dir: str,
    first_fy: int | None = None,
    last_fy: int | None = None,
    start_month: int = 4,
    dealt: bool = False,
) -> DataFrame:
    """Detail rows of fiscal years ``first_fy..last_fy`` (memoized per session).
    ``dealt``: the same rows, those of one ``cust_code`` in one partition, for
    whoever groups by it and by more: no other exchange is needed then."""
    memo, key = _memo(spark), ("detail", sf_dir.rstrip("/"), first_fy, last_fy, start_month, dealt)
    if key not in memo:
        memo[key] = _detail_view(spark, sf_dir, first_fy, last_fy, start_month, dealt)
    return memo[key]


def _detail_view(
    spark: SparkSession,
    sf_dir: str,
    first_fy: int | None = None,
    last_fy: int | None = None,
    start_month: int = 4,
    dealt: bool = False,
) -> DataFrame:
    """Detail rows of fiscal years ``first_fy..last_fy`` (all years if None).

    Join order is chosen for scale: line items meet the orders
    (range-filtered at the scan) while both are narrow, then the products on
    partkey, and the customers last.  So the names of customers, the widest
    texts, cross no exchange with the line items, and the rows lie by
    ``cust_code``, the text that the customers are joined by, wherever
    customers are not broadcast (with ``dealt`` they never are).
    nation/region are tiny and left to Spark's size-checked automatic
    broadcast."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if first_fy is not None:
        orders = orders.where(fiscal_range("o_orderdate", first_fy, last_fy, start_month))
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )

    # inner joins drop null keys; said here, so that the scans skip them and none is shuffled
    orders = orders.where("o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
    lineitem = lineitem.where("l_orderkey IS NOT NULL AND l_partkey IS NOT NULL")
    customer = customer.where("c_custkey IS NOT NULL AND c_nationkey IS NOT NULL")
    part = part.where("p_partkey IS NOT NULL")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey).withColumn("cust_code", F.col("c_custkey").cast("string"))
    lines = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    lines = lines.join(part, lines.l_partkey == part.p_partkey).withColumn("o_custcode", F.col("o_custkey").cast("string"))
    rows = lines.join(cust.hint("merge") if dealt else cust, F.col("o_custcode") == F.col("cust_code"))

    qty = F.col("l_quantity").cast("decimal(8,2)")
    sales = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return rows.select(
        fiscal_year("o_orderdate", start_month).alias("fy"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("n_nationkey").cast("string").alias("corp_code"),
        F.col("n_name").alias("corp_name"),
        F.col("cust_code"),
        F.col("c_name").alias("cust_name"),
        F.col("r_name").alias("office"),
        F.col("o_orderpriority").alias("rep_name"),
        F.col("p_brand").alias("category"),
        F.col("p_partkey").cast("string").alias("prod_code"),
        F.col("p_name").alias("prod_name"),
        qty.alias("qty"),
        (qty * F.col("p_size")).alias("area"),
        sales.alias("sales"),
        (sales - qty * F.col("p_retailprice").cast("decimal(10,2)")).alias("profit"),
    )


def corp_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corporation master (code, name) from ``nation``."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("corp_code"), F.col("n_name").alias("corp_name")
    )


# SQL text of the same view for DuckDB oracles (``detail`` CTE body).
DETAIL_SQL = """
SELECT CAST(year(o.o_orderdate - INTERVAL 3 MONTH) AS INTEGER) AS fy,
       CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(n.n_nationkey AS VARCHAR) AS corp_code, n.n_name AS corp_name,
       CAST(c.c_custkey AS VARCHAR) AS cust_code, c.c_name AS cust_name,
       r.r_name AS office, o.o_orderpriority AS rep_name, p.p_brand AS category,
       CAST(p.p_partkey AS VARCHAR) AS prod_code, p.p_name AS prod_name,
       CAST(l.l_quantity AS DECIMAL(8,2)) AS qty,
       CAST(l.l_quantity AS DECIMAL(8,2)) * p.p_size AS area,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS sales,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
         - CAST(l.l_quantity AS DECIMAL(8,2)) * CAST(p.p_retailprice AS DECIMAL(10,2)) AS profit
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
"""
