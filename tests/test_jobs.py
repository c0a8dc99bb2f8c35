import pytest
from pyspark.sql import functions as F

from rankloom.operators import merge, summarise
from rankloom.plans import jobs
from rankloom.plans.spec import ANNUAL, CORP, CUSTOMER, LEVELS, QUARTER, FiscalSpec
from rankloom.sources import readers

FS = FiscalSpec(2025, start_year=2024)
DET = "corp_code string, cust_code string, cust_name string, office string, category string, prod_code string, prod_name string, qty double, area double, sales double, profit double"


def _detail(spark):
    rows = [
        ("01", "c1", "n1", "o1", "k", "p1", "q1", 1.0, 2.0, 10.6, 1.5),
        ("01", "c1", "n1", "o1", "k", "p2", "q2", 1.0, 2.0, 10.6, 1.5),
        ("02", "c2", "n2", "o2", "k", "p1", "q1", 3.0, 1.0, -5.5, 2.0),
    ]
    return spark.createDataFrame(rows, DET)


def test_projected_csv_read(spark, tmp_out):
    spark.createDataFrame([("001", "x", "1.5", "9")], ["法人コード", "得意先名", "売上数", "売上金額"]).write.option("header", True).csv(tmp_out)
    df = readers.read_detail_csv(spark, tmp_out, encoding="UTF-8", usecols=["sales", "corp_code", "nope"])
    assert df.columns == ["sales", "corp_code"] and df.collect()[0]["sales"] == 9.0


def test_run_summarise_one_job_partitioned(spark, tmp_out):
    levels = jobs.run_summarise(_detail(spark), FS, tmp_out)
    assert {r["corp_code"]: r["sales_2025"] for r in levels["corp"].collect()} == {"01": 21, "02": -5}
    assert levels["customer_product"].count() == 3
    assert sorted(p.name for p in __import__("pathlib").Path(tmp_out).iterdir() if p.name.startswith("level=")) == [
        "level=corp", "level=customer", "level=customer_product"]


def test_missing_past_and_master_policies(spark):
    cur = summarise.summarise(_detail(spark), LEVELS, FS)
    # annual: missing past -> each level unchanged; missing master -> error
    out = merge.merge_levels(cur, {lv.name: None for lv in LEVELS}, LEVELS, FS, ANNUAL)
    assert out["corp"].count() == 2
    with pytest.raises(FileNotFoundError):
        merge.merge_levels(cur, {lv.name: None for lv in LEVELS}, LEVELS, FS, QUARTER)
    with pytest.raises(FileNotFoundError):
        jobs.merge_years(cur, {lv.name: None for lv in LEVELS}, None, FS, ANNUAL)


def test_quarter_job_shapes_and_filters(spark):
    det = _detail(spark)
    cur = summarise.summarise(det, LEVELS, FS)
    past_det = det.select("*", F.lit(2024).alias("fy"))
    past = {lv.name: summarise.summarise_wide(past_det, lv, FS) for lv in LEVELS}
    res = jobs.merge_years(cur, past, None, FS, QUARTER)
    corp = res.tables["corp"]
    assert all(t == "double" for c, t in corp.dtypes if c.startswith(("qty_", "area_", "sales_", "profit_")))
    assert corp.columns[:2] == ["corp_code", "qty_2025"]  # no master, no past names: keys then years
    rel = res.report.collect()
    assert all(r["checkpoint"] in ("merge", "final") for r in rel)
    assert res.checkpoints.select("checkpoint").distinct().count() == 4


@pytest.mark.parametrize("level", ["corp", "customer", "customer_product"])
def test_annual_equals_quarter_on_disjoint_years(spark, level):
    """SURVEY §5 property: with coalesce keys and disjoint year sets the two
    policies agree once annual output is finalised like the quarter one."""
    from rankloom.operators import shape
    from rankloom.plans import catalog as C

    d = "/root/testdata/sf0.001"
    cur, past, master = C.cur_all(spark, d), C.past_all(spark, d), C.corp_master(spark, d)
    a = jobs.merge_years(cur, past, master, C.FISCAL, ANNUAL).tables[level]
    q = jobs.merge_years(cur, past, master, C.FISCAL, QUARTER).tables[level]
    lv = next(x for x in LEVELS if x.name == level)
    a = shape.drop_zero_rows(shape.finalise_metrics(shape.reorder_generated(a, lv, C.FISCAL), C.FISCAL, "double"), C.FISCAL)
    cols = sorted(q.columns)
    assert sorted(a.columns) == cols
    rows = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    assert rows(a) == rows(q)


def test_legacy_rename_idempotent(spark):
    cust = spark.createDataFrame([("1", "n", 5)], "`取引先コード` string, `取引先名` string, `2024売上` bigint")
    prod = spark.createDataFrame([("n", 5)], "`得意先` string, `2024売上` bigint")
    c1, p1 = readers.rename_legacy_coupled(cust, prod)
    c2, p2 = readers.rename_legacy_coupled(c1, p1)
    assert c1.columns == c2.columns == ["得意先コード", "得意先名", "2024売上"]
    assert p1.columns == p2.columns == ["得意先名", "2024売上"]
    # coupled: an absent product table skips both renames
    assert readers.rename_legacy_coupled(cust, None)[0].columns == cust.columns


def test_totals_of_a_merge_sort_nothing(spark):
    det = _detail(spark)
    past = {lv.name: summarise.summarise_wide(det.select("*", F.lit(2024).alias("fy")), lv, FS) for lv in LEVELS}
    res = jobs.merge_years(summarise.summarise(det, LEVELS, FS), past, None, FS, QUARTER)
    plan = res.checkpoints._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" not in plan
    assert "Sort [" in res.tables["customer"]._jdf.queryExecution().optimizedPlan().toString()
