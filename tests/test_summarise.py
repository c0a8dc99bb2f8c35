import re
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from rankloom.functions.fiscal import fiscal_range, fiscal_year
from rankloom.operators import summarise
from rankloom.plans.spec import CORP, CUSTOMER, LEVELS, FiscalSpec

FS = FiscalSpec(2025, start_year=2023)
SCHEMA = "corp_code string, cust_code string, cust_name string, qty double, area double, sales double, profit double"


def test_truncation_and_null_groups(spark):
    rows = [
        ("001", "c1", "n1", 1.0, 1.0, 100.5, -2.5),
        ("001", "c1", "n1", 1.0, 1.0, 0.2, -0.2),
        (None, "c2", "n2", None, None, None, None),
        (None, "c2", "n2", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["corp_code"]: r for r in summarise.summarise_level(df, CORP, FS).collect()}
    assert out["001"]["sales_2025"] == 100 and out["001"]["profit_2025"] == -2
    assert out["001"]["qty_2025"] == 2.0
    # null key forms one group; its all-null sums are 0
    assert out[None]["sales_2025"] == 0 and out[None]["qty_2025"] == 0
    assert dict(summarise.summarise_level(df, CORP, FS).dtypes)["sales_2025"] == "bigint"


def test_truncation_decimal_negative(spark):
    df = spark.createDataFrame([("a", Decimal("-2.70"))], "corp_code string, sales decimal(10,2)")
    r = summarise.summarise_level(df, CORP, FiscalSpec(2025)).collect()[0]
    assert r["sales_2025"] == -2


def test_grouping_sets_equals_separate_groupbys(spark):
    rows = [
        ("01", "c1", "n1", "o1", "cat", "p1", "pn1", 1.0, 2.0, 10.7, 1.1),
        ("01", "c1", "n1", "o1", "cat", "p2", "pn2", 1.0, 2.0, 10.7, 1.1),
        ("02", "c2", "n2", "o2", "cat", "p1", "pn1", 3.0, 1.0, -5.5, 2.0),
        ("02", None, "n2", "o2", "cat", "p1", "pn1", 3.0, 1.0, 4.5, 2.0),
    ]
    cols = "corp_code string, cust_code string, cust_name string, office string, category string, prod_code string, prod_name string, qty double, area double, sales double, profit double"
    df = spark.createDataFrame(rows, cols)
    gs = summarise.summarise_grouping_sets(df, LEVELS, FS)
    for lv in LEVELS:
        sep = summarise.summarise_level(df, lv, FS)
        one = gs.where(F.col("level") == lv.name).select(*sep.columns)
        assert sorted(map(tuple, sep.collect()), key=str) == sorted(map(tuple, one.collect()), key=str)


def test_wide_layout_nulls_for_absent_years(spark):
    df = spark.createDataFrame([("c", "n", 2024, 1.0, 2.0, 3.9, 4.2)], "cust_code string, cust_name string, fy int, qty double, area double, sales double, profit double")
    r = summarise.summarise_wide(df, CUSTOMER, FS).collect()[0].asDict()
    assert r["sales_2024"] == 3 and r["sales_2023"] is None
    assert "qty_2024" not in r  # earlier years carry no quantity


def test_fiscal_year_edges(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 31),), (dt.date(2025, 4, 1),)], "d date")
    assert [r[0] for r in df.select(fiscal_year("d")).collect()] == [2024, 2025]
    assert FiscalSpec.as_of(dt.date(2026, 1, 15)).current_fy == 2025


def test_fiscal_range_is_pushed_to_scan(spark, tmp_out):
    spark.createDataFrame([(dt.datetime(2025, 4, 1),)], "o_orderdate timestamp_ntz").write.parquet(tmp_out)
    df = spark.read.parquet(tmp_out).where(fiscal_range("o_orderdate", 2025))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
    assert df.count() == 1


def test_wide_product_level_shuffles_the_detail_only(spark):
    """No buffer per year and metric goes through the shuffle, and the sums are those of one conditional sum each."""
    product = LEVELS[-1]
    keys = list(product.keys)
    cols = "corp_code string, corp_name string, " + ", ".join(f"{k} string" for k in keys) + ", fy int, " + ", ".join(
        f"{m} decimal(12,2)" for m in ("qty", "area", "sales", "profit"))
    one = lambda code, fy, *v: ("1", "x", "o", code, "n", "k", "p", "q", fy, *[None if x is None else Decimal(x) for x in v])
    df = spark.createDataFrame([
        one("c1", 2024, "1", "2", "3.9", "-4.2"), one("c1", 2024, "1", "2", "3.9", "-4.2"), one("c1", 2023, "1", None, "5", None),
        one(None, 2024, "1", "2", "3", "4"), one(None, 2024, "1", "2", "3", "4"), one("c2", 1999, "1", "2", "3", "4"),
        one("c3", None, "1", "2", "3", "4"), one("c4", 2024, None, None, None, None)], cols)
    wanted = [(y, m) for y in (2024, 2023) for m in ("area", "sales", "profit")]
    value = lambda y, m: F.sum(F.when(F.col("fy") == y, F.col(m)))
    expected = df.groupBy(*keys).agg(*[(value(y, m) if m == "area" else value(y, m).cast("long")).alias(f"{m}_{y}") for y, m in wanted])
    got = summarise.summarise_wide(df, product, FS)
    assert got.dtypes == expected.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    seen = []
    levels = summarise.summarise_wide_levels(df, LEVELS, FS, combined_hook=lambda w: seen.append(w) or w)
    in_years = expected.where(F.coalesce(F.col("cust_code"), F.lit("")).isin("c1", "c4", ""))
    assert sorted(map(tuple, levels["customer_product"].collect()), key=str) == sorted(map(tuple, in_years.collect()), key=str)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    assert not [x for x in plan.splitlines() if "Expand" in x and "prod_code" in x]
