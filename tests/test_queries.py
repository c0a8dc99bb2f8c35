import re
"""Driver queries against the DuckDB oracle on sf0.001, and plan checks."""

import duckdb
import pytest

import __spark_entry__ as E
from rankloom.plans import catalog, oracle
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"

QUERIES, ORACLES = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "sales_2001" in df.columns


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_scale_shape(spark):
    q = QUERIES
    plan = _plan(q["annual_corp_rank"](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastHashJoin" in plan  # size-checked master broadcast
    # the fiscal range reaches the orders scan
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
    # stacked product merge: one aggregate exchange, no sort-merge join for the merge
    prod = _plan(q["merge_customer_product"](spark, SF))
    assert "CartesianProduct" not in prod and "BroadcastNestedLoopJoin" not in prod


def test_stacked_merge_needs_fewer_shuffles_than_join(spark):
    """The stacked product merge reuses the two summaries' partitioning: no
    exchange above the union; the join form adds a re-aggregation exchange."""
    from rankloom.operators import merge
    from rankloom.plans import catalog as C
    from rankloom.plans.spec import CUSTOMER_PRODUCT, QUARTER

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan, exchanges countable
    try:
        cur = C.cur_level(spark, SF, CUSTOMER_PRODUCT)
        past = C.past_level(spark, SF, CUSTOMER_PRODUCT)
        stacked = _plan(merge.merge_reaggregate(cur, past, CUSTOMER_PRODUCT, C.FISCAL, QUARTER, stacked=True))
        joined = _plan(merge.merge_reaggregate(cur, past, CUSTOMER_PRODUCT, C.FISCAL, QUARTER, stacked=False))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    n_stacked = stacked.count("Exchange hashpartitioning")
    n_joined = joined.count("Exchange hashpartitioning")
    assert n_stacked < n_joined, (n_stacked, n_joined)
    # directly above the union sits the partial aggregate, not an exchange
    above_union = stacked.split("Union")[0].strip().splitlines()[-1]
    assert "Exchange" not in above_union


def test_wide_table_needs_one_exchange_on_its_keys(spark):
    from rankloom.plans import catalog as C
    from rankloom.plans.spec import CUSTOMER_PRODUCT

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(C.past_level(spark, SF, CUSTOMER_PRODUCT))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "pivotfirst" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(r_name", plan)) <= 1


def test_null_join_keys_stay_at_the_scan(spark):
    for setting in ("true", "false"):
        spark.conf.set("spark.sql.constraintPropagation.enabled", setting)
        plan = _plan(catalog.cur_detail(spark, SF))
        assert "IsNotNull(l_orderkey)" in plan and "IsNotNull(l_partkey)" in plan


def test_no_year_is_left_out(spark):
    """The past table and the detail agree on every year's sales."""
    from pyspark.sql import functions as F

    years = {r["fy"]: r["sales"] for r in QUERIES["fiscal_year_totals"](spark, SF).collect()}
    wide = QUERIES["past_wide_customer"](spark, SF)
    detail = catalog.past_detail(spark, SF).groupBy("cust_code", "cust_name", "fy").agg(F.sum("sales").cast("long").alias("s"))
    exact = {r["fy"]: r["s"] for r in detail.groupBy("fy").agg(F.sum("s").alias("s")).collect()}
    sums = wide.agg(*[F.sum(f"sales_{fy}").alias(str(fy)) for fy in exact]).head().asDict()
    assert {int(k): v for k, v in sums.items()} == exact
    assert set(exact) | {2001} == set(years)
    assert all(abs(exact[fy] - years[fy]) <= wide.count() for fy in exact)  # truncation per customer


def test_plans_do_not_depend_on_what_ran_before(spark):
    spark.conf.set("spark.sql.constraintPropagation.enabled", "true")
    QUERIES["summary_corp"](spark, SF)
    assert spark.conf.get("spark.sql.constraintPropagation.enabled") == "false"


def _exchanges(spark, df) -> tuple[int, list[str]]:
    """Exchanges by hash of the static plan, and those of them by a level's keys (an office first)."""
    plan = _plan(df)
    return len(re.findall("Exchange hashpartitioning", plan)), re.findall(r"Exchange hashpartitioning\((?:office|r_name)[^)]*\)", plan)


def test_product_detail_lies_by_customer(spark):
    """Customers, with their names, meet the line items last; then the product
    level of a year or of the past needs no exchange, nor does their join."""
    from rankloom.operators import merge
    from rankloom.plans.spec import CUSTOMER_PRODUCT, QUARTER

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan, exchanges countable
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")  # as tables of any size: nations alone are broadcast
    try:
        cur, past = catalog.cur_level(spark, SF, CUSTOMER_PRODUCT), catalog.past_product_by_rep(spark, SF)
        detail = _exchanges(spark, catalog.past_detail(spark, SF, dealt=True))[0]
        for table in (cur, past):
            assert _exchanges(spark, table) == (detail, [])
        joined, by_keys = _exchanges(spark, merge.merge_level(cur, past, CUSTOMER_PRODUCT, catalog.FISCAL, QUARTER))
        assert joined <= 2 * detail and not by_keys
        plain = _exchanges(spark, catalog.past_detail(spark, SF))[0]
        assert plain == detail
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_past_levels_are_written_once_and_merged_as_stored(spark):
    """Totals of a merge read what was written; product rows cross as lists of years."""
    plan = _plan(catalog._merged_all(spark, SF)["customer_product"])
    assert "array_compact" in plan or "_values" in plan
    assert "rankloom-mat-" in plan and "o_orderdate" not in plan
