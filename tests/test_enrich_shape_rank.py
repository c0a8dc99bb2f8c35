from pyspark.sql import functions as F

from rankloom.operators import enrich, rank, shape
from rankloom.plans.spec import ANNUAL, CORP, CUSTOMER_PRODUCT, QUARTER, FiscalSpec

FS = FiscalSpec(2025, start_year=2024)


def test_master_join_both_arms_and_leading_zero(spark):
    df = spark.createDataFrame([("001", "kept", 1), ("002", None, 2)], "corp_code string, corp_name string, sales_2025 bigint")
    master = spark.createDataFrame([("001", "M1"), ("002", "M2")], "corp_code string, corp_name string")
    got = {r["corp_code"]: r["corp_name"] for r in enrich.master_join(df, master).collect()}
    assert got == {"001": "kept", "002": "M2"}
    created = enrich.master_join(df.drop("corp_name"), master)
    assert "corp_name" in created.columns and created.where("corp_code = '001'").collect()[0]["corp_name"] == "M1"
    assert enrich.master_join(df, None) is df


def test_backfill_ambiguous_name(spark):
    df = spark.createDataFrame([(None, "N1", 5), ("009", "N9", 1)], "code string, name string, v bigint")
    past = spark.createDataFrame([("001", "N1"), ("002", "N1"), (None, "N1")], "code string, name string")
    one = enrich.backfill_code(df, past, "code", "name", on_ambiguous="min")
    assert sorted((r["code"], r["name"]) for r in one.collect()) == [("001", "N1"), ("009", "N9")]
    fan = enrich.backfill_code(df, past, "code", "name", on_ambiguous="fanout")
    assert sorted((r["code"], r["name"]) for r in fan.collect()) == [("001", "N1"), ("002", "N1"), ("009", "N9")]


def test_dedupe_subset_deterministic(spark):
    df = spark.createDataFrame([("k", "r2", 2), ("k", "r1", 1), (None, "r3", 3), (None, "r0", 0)], "k string, rep string, v bigint")
    got = {(r["k"], r["rep"], r["v"]) for r in enrich.dedupe_subset(df, ["k"], ["rep"]).collect()}
    assert got == {("k", "r1", 1), (None, "r0", 0)}


def test_zero_row_filter_cases(spark):
    df = spark.createDataFrame(
        [("all0", 0.0, 0.0), ("allnull", None, None), ("one", 0.0, 3.0), ("zero_null", 0.0, None), ("neg", -1.0, None)],
        "k string, sales_2025 double, sales_2024 double",
    )
    kept = {r["k"] for r in shape.drop_zero_rows(df, FS).collect()}
    assert kept == {"one", "neg"}
    # same outcome as the literal Kleene OR
    assert kept == {r["k"] for r in df.where("sales_2025 <> 0 OR sales_2024 <> 0").collect()}


def test_finalise_and_fill(spark):
    df = spark.createDataFrame([("a", None, 2)], "corp_code string, sales_2025 bigint, sales_2024 bigint")
    f = shape.finalise_metrics(df, FS, "double")
    assert dict(f.dtypes)["sales_2025"] == "double" and f.collect()[0]["sales_2025"] == 0.0
    g = shape.fill_column(df, "sales_2025", 0)
    assert dict(g.dtypes)["sales_2025"] == "bigint" and g.collect()[0]["sales_2025"] == 0


def test_reorder_filter_drops_last_year_qty_and_junk(spark):
    df = spark.createDataFrame([("a", "n", 1.0, 2.0, 3, "x")], "corp_code string, corp_name string, qty_2025 double, qty_2024 double, sales_2024 bigint, note string")
    assert shape.reorder_filter(df, CORP, FS).columns == ["corp_code", "corp_name", "qty_2025", "sales_2024"]


def test_custom_office_order(spark):
    lv = CUSTOMER_PRODUCT
    rows = [("Z-unlisted", "a"), ("B", "a"), (None, "a"), ("A", "b"), ("A", "a")]
    df = spark.createDataFrame([(o, "c", n, "cat", "p", "pn") for o, n in rows], "office string, cust_code string, cust_name string, category string, prod_code string, prod_name string")
    pol = QUARTER.with_(office_order=("A", "B"))
    got = [(r["office"], r["cust_name"]) for r in rank.rank(df, lv, FS, pol).collect()]
    assert got == [(None, "a"), ("A", "a"), ("A", "b"), ("B", "a"), ("Z-unlisted", "a")]


def test_sales_rank_and_fallback(spark):
    df = spark.createDataFrame([("a", 5, None), ("b", 9, 1), ("c", 9, 3)], "corp_code string, sales_2025 bigint, sales_2024 bigint")
    assert [r[0] for r in rank.rank(df, CORP, FS, ANNUAL).collect()] == ["b", "c", "a"]
    nod = df.drop("sales_2025")
    # fallback: newest existing year's sales, descending with nulls first
    assert [r[0] for r in rank.rank(nod, CORP, FS, ANNUAL).collect()] == ["a", "c", "b"]


def test_top_n_plan_is_take_ordered(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("corp_code"), (F.col("id") % 97).alias("sales_2025"))
    top = rank.top_n(df, rank.rank_order(df, CORP, FS, ANNUAL), 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert [r["rank"] for r in top.collect()] == [1, 2, 3, 4, 5]


def test_global_rank_is_range_partitioned(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("corp_code"), (F.col("id") % 7).alias("sales_2025"))
    plan = rank.rank(df, CORP, FS, ANNUAL)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan
