import random

import pytest
from pyspark.sql import functions as F

from rankloom.operators import merge
from rankloom.plans.spec import ANNUAL, CUSTOMER, QUARTER, FiscalSpec, LevelSpec

FS = FiscalSpec(2025, start_year=2024)
K1 = LevelSpec("corp", ("corp_code",))
CUR = "corp_code string, qty_2025 double, area_2025 double, sales_2025 bigint, profit_2025 bigint"
PAST = "corp_code string, area_2024 double, sales_2024 bigint, profit_2024 bigint"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_full_join_branches_and_null_keys(spark):
    cur = spark.createDataFrame([("A", 1.0, 1.0, 10, 1), ("B", 1.0, 1.0, 20, 2), (None, 1.0, 1.0, 30, 3)], CUR)
    past = spark.createDataFrame([("A", 1.0, 5, 1), ("C", 1.0, 7, 1), (None, 1.0, 9, 1)], PAST)
    out = merge.merge_level(cur, past, K1, FS, ANNUAL)
    got = {(r["corp_code"], r["sales_2025"], r["sales_2024"]) for r in out.collect()}
    assert got == {("A", 10, 5), ("B", 20, None), ("C", None, 7), (None, 30, None), (None, None, 9)}
    assert out.count() == 5  # null keys never match: two rows


def test_left_key_policy(spark):
    cur = spark.createDataFrame([("A", 1.0, 1.0, 10, 1)], CUR)
    past = spark.createDataFrame([("A", 1.0, 5, 1), ("C", 1.0, 7, 1)], PAST)
    out = merge.merge_level(cur, past, K1, FS, ANNUAL.with_(keys="left"))
    assert {(r["corp_code"], r["sales_2024"]) for r in out.collect()} == {("A", 5), (None, 7)}


@pytest.mark.parametrize("conflict,expected", [("fill_null", [5, 7, 7]), ("overwrite", [5, 5, None])])
def test_conflict_policies(spark, conflict, expected):
    cur = spark.createDataFrame(
        [("x", None), ("y", 7), ("z", 7)], "corp_code string, sales_2024 bigint"
    ).select("*", F.lit(1).cast("bigint").alias("sales_2025"))
    past = spark.createDataFrame([("x", 5), ("y", 5), ("z", None)], "corp_code string, sales_2024 bigint")
    out = merge.merge_level(cur, past, K1, FS, ANNUAL.with_(conflict=conflict))
    got = {r["corp_code"]: r["sales_2024"] for r in out.collect()}
    assert [got["x"], got["y"], got["z"]] == expected


def test_empty_past_returns_current(spark):
    cur = spark.createDataFrame([("A", 1.0, 1.0, 10, 1)], CUR)
    assert merge.merge_level(cur, None, K1, FS, ANNUAL) is cur


def test_missing_years_are_null_doubles(spark):
    cur = spark.createDataFrame([("A", 1.0, 1.0, 10, 1)], CUR)
    out = merge.add_missing_years(cur, FS)
    assert dict(out.dtypes)["sales_2024"] == "double"
    assert out.collect()[0]["sales_2024"] is None


def _random_product_tables(spark, seed):
    rnd = random.Random(seed)
    lv = LevelSpec("p", ("office", "prod_code"))
    keys = [("o1", "p1"), ("o1", "p2"), ("o2", "p1"), (None, "p1"), ("o2", None)]
    def val():
        return rnd.choice([None, rnd.randint(-50, 50)])
    cur = [(*rnd.choice(keys), val(), val()) for _ in range(12)]
    past = [(*rnd.choice(keys), rnd.choice(["r1", "r2"]), val(), val()) for _ in range(12)]
    cdf = spark.createDataFrame(cur, "office string, prod_code string, sales_2025 bigint, sales_2024 bigint")
    pdf = spark.createDataFrame(past, "office string, prod_code string, rep_name string, sales_2024 bigint, area_2024 bigint")
    return lv, cdf, pdf


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("policy", [ANNUAL.with_(keep_rep_name=False), QUARTER])
def test_stacked_equals_join_then_reaggregate(spark, seed, policy):
    """Property: the one-shuffle stacked merge reproduces join + group-by
    exactly, including duplicate keys (fan-out), null keys and conflicts."""
    lv, cdf, pdf = _random_product_tables(spark, seed)
    fs = FiscalSpec(2025, start_year=2024, metrics=FS.metrics)
    a = merge.merge_reaggregate(cdf, pdf, lv, fs, policy, stacked=True)
    b = merge.merge_reaggregate(cdf, pdf, lv, fs, policy, stacked=False)
    cols = a.columns
    ra = sorted((tuple(float(x) if isinstance(x, (int, float)) else x for x in r) for r in a.select(*cols).collect()), key=str)
    rb = sorted((tuple(float(x) if isinstance(x, (int, float)) else x for x in r) for r in b.select(*cols).collect()), key=str)
    assert ra == rb


@pytest.mark.parametrize("seed", [4, 5])
def test_stored_sides_are_dealt_as_they_are(spark, seed):
    """Sums before the exchange hold a wide buffer for every row that a task reads."""
    lv, cdf, pdf = _random_product_tables(spark, seed)
    fs = FiscalSpec(2025, start_year=2024, metrics=FS.metrics)
    a = merge.merge_reaggregate(cdf, pdf, lv, fs, QUARTER, stored=True)
    b = merge.merge_reaggregate(cdf, pdf, lv, fs, QUARTER, stacked=False)
    plan = a._jdf.queryExecution().sparkPlan().toString().splitlines()
    below = plan[next(i for i, line in enumerate(plan) if "Exchange" in line or "Repartition" in line):]
    assert not any("Aggregate" in line for line in below)
    assert rows(a.select(*b.columns)) == rows(b)


def test_product_past_finer_counts_current_twice(spark):
    """Past rows differing only in rep_name repeat the current row in the
    join: the quarter re-aggregation counts current sales twice."""
    lv = LevelSpec("p", ("prod_code",))
    cur = spark.createDataFrame([("p1", 10)], "prod_code string, sales_2025 bigint")
    past = spark.createDataFrame([("p1", "r1", 1), ("p1", "r2", 2)], "prod_code string, rep_name string, sales_2024 bigint")
    for stacked in (True, False):
        r = merge.merge_reaggregate(cur, past, lv, FS, QUARTER, stacked=stacked).collect()[0]
        assert r["sales_2025"] == 20 and r["sales_2024"] == 3
    # annual keeps rep_name as a key: two rows, each with the current sales
    rows_ = merge.merge_reaggregate(cur, past, lv, FS, ANNUAL).collect()
    assert sorted(r["sales_2025"] for r in rows_) == [10, 10]


def test_run_merge_years_observes_totals_while_writing(spark, tmp_out):
    from rankloom.plans import catalog as C, jobs
    from rankloom.sources import writers

    d = "/root/testdata/sf0.001"
    paths = writers.level_paths(tmp_out, kind="result")
    run = jobs.run_merge_years(C.cur_all(spark, d), C.past_all(spark, d), C.corp_master(spark, d), C.FISCAL, ANNUAL, paths)
    got = {(r["level"], r["fy"], r["metric"]): r["total"] for r in run.totals.collect()}
    for lv, df in run.tables.items():
        assert got[(lv, 2001, "sales")] == df.agg(F.sum("sales_2001")).collect()[0][0]
    assert {r["level"]: r["rows"] for r in run.totals.collect()}["corp"] == run.tables["corp"].count()


def test_split_keys_meet_in_an_inner_join(spark):
    """A key that is split has rows on both sides; a full join of its pairs took many times as long."""
    side = lambda names: spark.range(700).select(
        F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit(names), "id")).alias("k"), F.col("id").alias(names))
    cur, past = side("a"), side("b")
    got = merge.full_join(cur, past, ["k"], 2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan
    assert "_salt" not in "".join(line for line in plan.splitlines() if "FullOuter" in line)
    assert rows(got) == rows(cur.join(past, ["k"], "full"))


def _annual_tables(spark):
    """Both sides of a product level, with keys twice, without a part, and sales above, at and below zero."""
    rnd = random.Random(7)
    keys = [(rnd.choice(["B", "A", None]), str(i % 23), f"c{i % 23}", rnd.choice(["x", "y"]), str(i % 7) if i % 13 else None, f"p{i % 7}")
            for i in range(400)]
    kd = "office string, cust_code string, cust_name string, category string, prod_code string, prod_name string, "
    cur = [(*rnd.choice(keys), rnd.choice([None, 0, rnd.randint(-90, 90)]), rnd.randint(-5, 5)) for _ in range(120)]
    past = [(*k, rnd.choice([None, rnd.randint(-50, 50)]), rnd.choice([None, 2])) for k in keys]
    return (spark.createDataFrame(cur, kd + "sales_2025 bigint, profit_2025 bigint"),
            spark.createDataFrame(past, kd + "sales_2024 bigint, sales_2023 bigint"))


@pytest.mark.parametrize("sign", [0, 1])
def test_stored_products_are_sorted_once(spark, sign):
    """Rows without current sales lie in the order of their keys after the merge; they crossed the network again for it."""
    from rankloom.plans import jobs
    from rankloom.plans.spec import CUSTOMER_PRODUCT

    cur, past = _annual_tables(spark)
    if sign:
        cur = cur.filter("sales_2025 >= 0")
    fs = FiscalSpec(2025, start_year=2022, metrics=FS.metrics)
    one = lambda stored: jobs.merge_years(
        {"customer_product": cur}, {"customer_product": past}, None, fs, ANNUAL.with_(missing_master="skip"), (CUSTOMER_PRODUCT,), stored=stored
    ).tables["customer_product"]
    got, want = one(True), one(False)
    assert got.columns == want.columns
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("Sort [" in line and line.endswith("], false") for line in plan)  # inside the partitions


def test_stored_years_cross_as_a_list(spark):
    """A key has a value in few of the years: no column of the others is dealt."""
    cur, past = _annual_tables(spark)
    fs = FiscalSpec(2025, start_year=2022, metrics=FS.metrics)
    lv = LevelSpec("p", tuple(cur.columns[:6]))
    plan = merge.merge_reaggregate(cur, past, lv, fs, ANNUAL, stored=True)._jdf.queryExecution().optimizedPlan().toString()
    dealt = next(line for line in plan.splitlines() if "Repartition" in line)
    assert "_values" in plan[plan.index(dealt):] and "Generate" in plan[:plan.index(dealt)]
