"""Bucketed level tables, generations, totals in one pass, bitmaps of keys."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rankloom.operators import merge, reconcile
from rankloom.plans import jobs
from rankloom.plans.spec import ANNUAL, CORP, CUSTOMER, QUARTER, FiscalSpec
from rankloom.sources import tables, writers

FISCAL = FiscalSpec(current_fy=2003, start_year=2001)


def rows_of(df):
    return sorted(map(str, df.collect()))


def customers(spark, fy, n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *(f"{i:03d}" for i in range(40))]), "n'a" if i % 3 else None, *(rng.choice([None, i]) for _ in fy)) for i in range(n)]
    return spark.createDataFrame(rows, "cust_code string, cust_name string, " + ", ".join(f"sales_{y} long" for y in fy))


@pytest.fixture()
def no_broadcast(spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_bucketed_tables_merge_without_an_exchange(spark, tmp_out, no_broadcast):
    cur, past = customers(spark, [2003, 2002], 300, 1), customers(spark, [2001, 2002], 200, 2)
    for name, df in (("cur", cur), ("past's", past)):
        tables.write_bucketed(df, f"{tmp_out}/{name}", CUSTOMER.keys, 4)
    got = merge.merge_level(*(tables.read_bucketed(spark, f"{tmp_out}/{n}") for n in ("cur", "past's")), CUSTOMER, FISCAL, ANNUAL)
    assert rows_of(got) == rows_of(merge.merge_level(cur, past, CUSTOMER, FISCAL, ANNUAL))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_bucketed_tables_need_one_exchange_to_regroup_what_is_joined(spark, tmp_out, no_broadcast):
    sides = customers(spark, [2003], 200, 3), customers(spark, [2002, 2001], 200, 4)
    for name, df in zip(("cur", "past"), sides):
        tables.write_bucketed(df, f"{tmp_out}/{name}", CUSTOMER.keys, 4)
    got = merge.merge_reaggregate(*(tables.read_bucketed(spark, f"{tmp_out}/{n}") for n in ("cur", "past")), CUSTOMER, FISCAL, QUARTER, stacked=False)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rows_of(got) == rows_of(merge.merge_reaggregate(*sides, CUSTOMER, FISCAL, QUARTER, stacked=False))


def test_a_bucketed_table_written_again_is_read_anew(spark, tmp_out):
    for n, buckets in ((30, 4), (50, 4), (20, 2)):
        tables.write_bucketed(customers(spark, [2003], n, n), tmp_out, CUSTOMER.keys, buckets)
        assert rows_of(tables.read_bucketed(spark, tmp_out)) == rows_of(customers(spark, [2003], n, n))
    with pytest.raises(FileNotFoundError):
        tables.read_bucketed(spark, f"{tmp_out}-none")


def test_an_empty_bucketed_table(spark, tmp_out):
    tables.write_bucketed(customers(spark, [2003], 0, 0), tmp_out, CUSTOMER.keys, 4)
    got = tables.read_bucketed(spark, tmp_out)
    assert got.columns == ["cust_code", "cust_name", "sales_2003"] and got.collect() == []


def test_a_broken_generation_leaves_the_old_one(spark, tmp_out):
    assert tables.committed(spark, tmp_out) is None
    with pytest.raises(FileNotFoundError):
        jobs.export_generation(spark, tmp_out, f"{tmp_out}/csv", FISCAL, ANNUAL)
    first = tables.write_generation(tmp_out, {"corp": spark.range(5), "customer": spark.range(7)})
    with pytest.raises(PySparkException):
        tables.write_generation(tmp_out, {"corp": spark.range(50), "customer": spark.range(1).select(F.raise_error(F.lit("x")).cast("long").alias("id"))})
    assert tables.committed(spark, tmp_out) == first
    assert {n: spark.read.parquet(p).count() for n, p in first.paths.items()} == {"corp": 5, "customer": 7}
    second = tables.write_generation(tmp_out, {"corp": spark.range(6)})
    assert tables.committed(spark, tmp_out) == second


def test_a_generation_that_lacks_rows_is_not_committed(spark, tmp_out):
    first = tables.write_generation(tmp_out, {"corp": spark.range(5)})
    late = tables.new_generation(tmp_out, ["corp"])
    spark.range(4).write.parquet(late.paths["corp"])
    with pytest.raises(RuntimeError, match="4 rows"):
        tables.commit(spark, late, {"corp": 5})
    assert tables.committed(spark, tmp_out) == first


def test_old_generations_go_when_told_to(spark, tmp_out):
    made = [tables.write_generation(tmp_out, {"corp": spark.range(i)}) for i in (1, 2, 3)]
    assert tables.forget_generations(spark, tmp_out, keep=1) == [g.name for g in made[:2]]
    assert tables.committed(spark, tmp_out) == made[2] and spark.read.parquet(made[2].paths["corp"]).count() == 3
    assert not writers.available_levels(spark, made[2].paths | {"old": made[0].paths["corp"]}, "available")[0] == ["corp", "old"]
    assert tables.write_generation(tmp_out, {"corp": spark.range(9)}) == tables.committed(spark, tmp_out)


def test_the_job_commits_its_tables_together(spark, tmp_out):
    cur = {"corp": spark.createDataFrame([("1", "a", 5)], "corp_code string, corp_name string, sales_2003 long"),
           "customer": customers(spark, [2003], 20, 5)}
    past = {"corp": None, "customer": customers(spark, [2002], 20, 6)}
    master = spark.createDataFrame([("1", "a")], "corp_code string, corp_name string")
    pol = ANNUAL.with_(missing_past="skip")
    run = jobs.run_merge_generation(cur, past, master, FISCAL, pol, tmp_out, (CORP, CUSTOMER))
    got = tables.committed(spark, tmp_out)
    assert {n: spark.read.parquet(p).count() for n, p in got.paths.items()} == {n: t.count() for n, t in run.tables.items()}
    assert jobs.export_generation(spark, tmp_out, f"{tmp_out}/csv", FISCAL, ANNUAL, levels=(CORP, CUSTOMER)) == ["corp", "customer"]
    broken = {**cur, "customer": cur["customer"].withColumn("cust_name", F.raise_error(F.lit("x")).cast("string"))}
    with pytest.raises(PySparkException):
        jobs.run_merge_generation(broken, past, master, FISCAL, pol, tmp_out, (CORP, CUSTOMER))
    assert tables.committed(spark, tmp_out) == got


@pytest.mark.parametrize("policy", [ANNUAL, QUARTER, ANNUAL.with_(keys="left")])
def test_totals_of_a_merge_in_one_pass(spark, policy):
    cur, past = {"customer": customers(spark, [2003, 2002], 60, 7)}, {"customer": customers(spark, [2001, 2002], 50, 8)}
    got = reconcile.merge_totals(cur, past, (CUSTOMER,), FISCAL, policy)
    merged = {"customer": merge.merge_level(cur["customer"], past["customer"], CUSTOMER, FISCAL, policy)}
    c, p, m = (reconcile.level_totals(t, FISCAL) for t in (cur, past, merged))
    for name, want in (("current", c), ("past", p), ("merged", m), ("before", reconcile.totals_precedence(c, p))):
        want = {tuple(r[:3]): r[3] for r in want.collect()}
        have = {tuple(r[:3]): r[3] for r in got.select("level", "fy", "metric", name).collect()}
        assert {k: v for k, v in have.items() if v is not None} == {k: want[k] for k in have if want.get(k) is not None}
    old = reconcile.compare_relative(reconcile.totals_precedence(c, p), m)
    assert rows_of(reconcile.relative_changes(got.withColumnRenamed("merged", "after"))) == rows_of(old)


def test_totals_without_a_past(spark):
    cur = {"customer": customers(spark, [2003], 60, 7)}
    got = reconcile.merge_totals(cur, {}, (CUSTOMER,), FISCAL, ANNUAL).collect()
    want = reconcile.level_totals(cur, FISCAL).collect()
    assert [(r["level"], r["fy"], r["metric"], r["current"], r["merged"]) for r in got] == [(*r, r["total"]) for r in want]


def test_totals_scan_each_input_once(spark, tmp_out):
    paths = [f"{tmp_out}/{n}" for n in ("cur", "past")]
    customers(spark, [2003], 60, 7).write.parquet(paths[0])
    customers(spark, [2002], 60, 7).write.parquet(paths[1])
    cur, past = ({"customer": spark.read.parquet(p)} for p in paths)
    got = reconcile.relative_changes(reconcile.merge_totals(cur, past, (CUSTOMER,), FISCAL, QUARTER).withColumnRenamed("merged", "after"))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 2


CODES = [None, "", "x1", "7", "007", "07", "0", "00", "12345678901234567", "123456789012345678", "-5", " 7", "７"]


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_count_as_keys_do(spark, seed):
    rng = random.Random(seed)
    side = lambda: spark.createDataFrame(
        [(rng.choice(CODES),) for _ in range(12)] + [(str(rng.randrange(100000)),) for _ in range(3000 * seed)], "`a b` string")
    cur, past = side(), side()
    want = reconcile.key_overlap(cur, past, "a b")
    assert reconcile.key_overlap_bitmaps(cur, past, "a b").collect() == want.collect()
    assert reconcile.overlap(cur, past, "a b").collect() == want.collect()


def test_bitmaps_of_empty_tables_and_whole_numbers(spark):
    none, some = spark.createDataFrame([], "k long"), spark.range(5).withColumnRenamed("id", "k")
    for cur, past in ((none, none), (none, some), (some, none), (some, some)):
        assert reconcile.key_overlap_bitmaps(cur, past, "k").collect() == reconcile.key_overlap(cur, past, "k").collect()


def test_only_bitmaps_of_dense_codes_cross_the_network(spark):
    df = spark.range(0, 200000, 1, 4).select(F.col("id").cast("string").alias("k"))
    assert reconcile.dense_codes(df, "k")
    assert not reconcile.dense_codes(spark.range(2000).select((F.col("id") * 10_000_000).cast("string").alias("k")), "k")
    assert reconcile.key_overlap_bitmaps(df, df.filter("k % 3 = 0"), "k").collect() == [(200000 - 66667, 0, 66667)]
