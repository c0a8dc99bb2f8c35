import os

from pyspark.sql import functions as F

from rankloom.functions.naming import from_reference, to_reference
from rankloom.plans.spec import FiscalSpec
from rankloom.sources import readers, writers

FS = FiscalSpec(2025, start_year=2024)


def test_cp932_roundtrip(spark, tmp_out):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    df = spark.createDataFrame([("001", "髙﨑①", "1.5", "2", "100.7", "-2.7")], ["法人コード", "得意先名", "売上数", "㎡", "売上金額", "粗利金額"])
    df.write.option("header", True).option("encoding", "windows-31j").csv(tmp_out)
    back = readers.read_detail_csv(spark, tmp_out, encoding="windows-31j", required=True)
    r = back.collect()[0]
    assert back.columns == ["corp_code", "cust_name", "qty", "area", "sales", "profit"]
    assert r["corp_code"] == "001" and r["cust_name"] == "髙﨑①" and r["area"] == 2.0


def test_missing_inputs(spark, tmp_out):
    assert readers.read_detail_csv(spark, tmp_out + "/none.csv") is None
    assert readers.optional_parquet(spark, tmp_out + "/none.parquet") is None
    try:
        readers.read_master_csv(spark, tmp_out + "/none.csv", required=True)
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass


def test_reference_names_roundtrip(spark):
    df = spark.createDataFrame([("a", 1.0, 2)], "corp_code string, qty_2025 double, sales_2024 bigint")
    ref = to_reference(df, FS)
    assert ref.columns == ["法人コード", "2025売上数", "2024売上"]
    assert from_reference(ref, FS).columns == df.columns


def test_export_empty_and_nulls(spark, tmp_out):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert writers.export_level(df.limit(0), tmp_out + "/e1", header_if_empty=False) is False
    assert not os.path.exists(tmp_out + "/e1")
    assert writers.export_level(df.limit(0), tmp_out + "/e2", header_if_empty=True) is True
    assert writers.export_level(df, tmp_out + "/z", on_null="zero")
    text = "".join(open(os.path.join(tmp_out + "/z", f)).read() for f in os.listdir(tmp_out + "/z") if f.endswith(".csv"))
    assert "k,v" in text and "a,0.0" in text


def test_availability_policies(spark, tmp_out):
    paths = writers.level_paths(tmp_out, kind="result")
    spark.range(3).write.parquet(paths["corp"])
    present, missing = writers.available_levels(spark, paths, "available")
    assert present == ["corp"] and set(missing) == {"customer", "customer_product"}
    try:
        writers.available_levels(spark, paths, "all")
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass


def test_chunk_tiers():
    assert [writers.export_chunk_size(n) for n in (10_000, 10_001, 50_000, 50_001)] == [500, 1000, 1000, 2000]


def test_export_chunked_files(spark, tmp_out):
    df = spark.range(25).select(F.col("id").cast("string").alias("k")).coalesce(1)
    assert writers.export_level(df, tmp_out + "/c", max_records_per_file=10)
    files = [f for f in os.listdir(tmp_out + "/c") if f.endswith(".csv")]
    assert len(files) == 3
    rows = sum(len(open(os.path.join(tmp_out + "/c", f)).read().strip().splitlines()) - 1 for f in files)
    assert rows == 25
