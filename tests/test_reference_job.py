"""The three original stages on reference-shaped (cp932, Japanese) files."""

from pyspark.sql import functions as F

from rankloom.functions.naming import to_reference
from rankloom.plans import jobs
from rankloom.plans.spec import ANNUAL, QUARTER, FiscalSpec
from rankloom.session import prepare
from rankloom.sources.writers import level_paths

FS = FiscalSpec(2025, start_year=2024)
DETAIL = ["法人コード", "得意先コード", "得意先名", "営業所名", "第1階層", "商品コード", "商品名", "売上数", "㎡", "売上金額", "粗利金額"]


def _files(spark, base, policy="annual"):
    prepare(spark)
    rows = [
        ("001", "C1", "髙﨑商店", "札幌", "床材", "P1", "品①", "2", "3.5", "1000.7", "100.2"),
        ("001", "C1", "髙﨑商店", "札幌", "床材", "P2", "品②", "1", "1", "500", "-20.9"),
        ("002", "C2", "二号店", "東京", "壁材", "P1", "品①", "4", "2", "800", "80"),
    ]
    spark.createDataFrame(rows, DETAIL).write.option("header", True).option("encoding", "windows-31j").csv(f"{base}/detail")
    spark.createDataFrame([("001", "法人一"), ("002", "法人二"), ("003", "法人三")], ["法人コード", "法人名"]).write.option(
        "header", True
    ).option("encoding", "windows-31j").csv(f"{base}/master")
    past = {
        "corp": spark.createDataFrame([("001", None, 10.0, 900, 90), ("003", "旧三", 1.0, 50, 5)], "corp_code string, corp_name string, area_2024 double, sales_2024 bigint, profit_2024 bigint"),
        "customer": spark.createDataFrame([("C1", "髙﨑商店", 10.0, 900, 90), ("C3", "三号店", 1.0, 50, 5)], "cust_code string, cust_name string, area_2024 double, sales_2024 bigint, profit_2024 bigint"),
        "customer_product": spark.createDataFrame(
            [("札幌", "C1", "髙﨑商店", "床材", "P1", "品①", 10.0, 900, 90), ("大阪", "C3", "三号店", "壁材", "P9", "品⑨", 1.0, 50, 5)],
            "office string, cust_code string, cust_name string, category string, prod_code string, prod_name string, area_2024 double, sales_2024 bigint, profit_2024 bigint",
        ),
    }
    paths = level_paths(f"{base}/past", policy, "past", reference_names=True)
    for lv, df in past.items():
        to_reference(df, FS).write.parquet(paths[lv])
    return paths


def test_reference_job_annual_and_quarter(spark, tmp_out):
    past_paths = _files(spark, tmp_out)
    for policy in (ANNUAL, QUARTER):
        out = jobs.run_reference_job(spark, f"{tmp_out}/detail", past_paths, f"{tmp_out}/master", f"{tmp_out}/out-{policy.name}", FS, policy)
        assert out["status"] == "ok" and sorted(out["exported"]) == ["corp", "customer", "customer_product"]
        corp = spark.read.parquet(out["result"]["corp"])
        assert "2025売上" in corp.columns and "法人名" in corp.columns
        got = {r["法人コード"]: (r["法人名"], r["2025売上"], r["2024売上"]) for r in corp.collect()}
        # truncation after summing: 1000.7 + 500 -> 1500; master fills names
        assert got["001"][0] == "法人一" and int(got["001"][1]) == 1500 and int(got["001"][2]) == 900
        assert got["003"][0] == "旧三"  # existing (past) name wins over the master
        totals = {(r["level"], r["fy"], r["metric"]): r["total"] for r in out["totals"].collect()}
        assert totals[("corp", 2025, "sales")] == totals[("customer", 2025, "sales")] == 2300.0
    assert jobs.run_reference_job(spark, f"{tmp_out}/none.csv", past_paths, f"{tmp_out}/master", f"{tmp_out}/o", FS, ANNUAL) == {"status": "no detail"}


def test_command_line_stages(spark, tmp_out, capsys):
    import json

    from rankloom.__main__ import main

    _files(spark, tmp_out)
    common = ["--as-of", "2025-06-30", "--start-year", "2024"]
    assert main(["summarise", "--detail", f"{tmp_out}/detail", "--out", f"{tmp_out}/s", *common]) == 0
    assert main(["merge", "--summary-dir", f"{tmp_out}/s", "--past-dir", f"{tmp_out}/past", "--master", f"{tmp_out}/master",
                 "--out", f"{tmp_out}/r", *common]) == 0
    assert main(["export", "--result-dir", f"{tmp_out}/r", "--out", f"{tmp_out}/x", *common]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert sorted(lines[-1]["exported"]) == ["corp", "customer", "customer_product"]
    totals = {(t["level"], t["fy"], t["metric"]): t["total"] for t in lines[1]["totals"]}
    assert totals[("customer_product", 2025, "sales")] == 2300.0
    assert main(["summarise", "--detail", f"{tmp_out}/none", "--out", f"{tmp_out}/s2", *common]) == 1
