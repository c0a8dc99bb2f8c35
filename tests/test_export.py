"""Export: order, chunks, names, exact totals, unreadable inputs."""

import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rankloom.functions.naming import past_file, summary_file
from rankloom.operators import merge, rank, reconcile
from rankloom.plans import jobs
from rankloom.plans.spec import ANNUAL, CUSTOMER, LEVELS, QUARTER, FiscalSpec
from rankloom.sources import csvio, readers, writers

FS = FiscalSpec(2025, start_year=2024)


def customers(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("cust_code"), F.format_string("n%06d", "id").alias("cust_name"),
        ((F.col("id") * 7919) % 10007).alias("sales_2025"))


@pytest.mark.parametrize("rows, chunk", [(900, 500), (12_000, 1000), (51_000, 2000)])
def test_part_files_hold_the_ranking_in_chunks(spark, tmp_out, rows, chunk):
    paths = writers.level_paths(tmp_out, kind="result")
    customers(spark, rows).repartition(6).write.parquet(paths["customer"])
    assert jobs.export_levels(spark, paths, f"{tmp_out}/x", FS, ANNUAL, availability="available") == ["customer"]
    lines, files = [], sorted(glob.glob(f"{tmp_out.removeprefix('file:')}/x/customer/part-*"))
    for f in files:
        part = open(f, encoding="utf-8").read().splitlines()
        assert part[0] == "cust_code,cust_name,sales_2025" and len(part) - 1 <= chunk
        lines += [x.split(",") for x in part[1:]]
    assert len(lines) == rows and len(files) >= rows / chunk
    assert lines == sorted(lines, key=lambda x: (-int(x[2]), x[0], x[1]))
    back = writers.read_export(spark, f"{tmp_out}/x/customer").orderBy("position").collect()
    assert [r["position"] for r in back] == list(range(1, rows + 1))
    assert [[r["cust_code"], r["cust_name"], r["sales_2025"]] for r in back] == lines


def test_flavours(spark, tmp_out):
    paths = writers.level_paths(tmp_out, kind="result")
    spark.createDataFrame([("1", "a", None)], "cust_code string, cust_name string, sales_2025 long").write.parquet(paths["customer"])
    spark.createDataFrame([], "corp_code string, sales_2025 long").write.parquet(paths["corp"])
    with pytest.raises(FileNotFoundError):
        jobs.export_levels(spark, paths, f"{tmp_out}/a", FS, ANNUAL, **jobs.EXPORT_FLAVOURS["annual"])
    assert jobs.export_levels(spark, paths, f"{tmp_out}/b", FS, QUARTER, **jobs.EXPORT_FLAVOURS["first_half"]) == ["customer"]
    assert sorted(jobs.export_levels(spark, paths, f"{tmp_out}/c", FS, QUARTER, **jobs.EXPORT_FLAVOURS["quarter"])) == ["corp", "customer"]
    assert spark.read.option("header", True).csv(f"{tmp_out}/b/customer").head()["sales_2025"] is None


def test_manifest_counts_records_in_the_pass_of_the_quotes(spark, tmp_path, monkeypatch):
    """Only files with line breaks in cells are read once more for their records."""
    (tmp_path / "a.csv").write_bytes(b'h,i\r\n1,"x ""y"""\r\n\r\n2,\r\n')
    (tmp_path / "b.csv").write_bytes(b"h,i\n1,2")
    (tmp_path / "c.csv").write_bytes(b"\n1,2\n")
    called, real = [], csvio._records
    monkeypatch.setattr(csvio, "_records", lambda *a: called.append(a) or real(*a))
    counted = lambda: {r["file"]: r["rows"] for r in csvio.manifest(spark, str(tmp_path)).collect()}
    assert counted() == {"a.csv": 2, "b.csv": 1, "c.csv": 1} and not called
    (tmp_path / "e.csv").write_bytes(b'h\n"1\n2"\n3\n')
    assert counted() == {"a.csv": 2, "b.csv": 1, "c.csv": 1, "e.csv": 2} and called


def test_quarter_files_have_two_labels():
    assert summary_file("quarter", "corp") == "2Q_ランキング（得意先）_法人.parquet"
    assert past_file("quarter", "corp") == "第２四半期_ランキング（得意先）_法人.parquet"
    assert writers.level_paths("x", "quarter", "past", True)["corp"] == "x/" + past_file("quarter", "corp")


def test_skip_rule_sorts_nothing(spark):
    df = customers(spark, 5).drop("sales_2025")
    order = rank.rank_order(df, CUSTOMER, FS, QUARTER)
    assert order == [] and rank.ordered(df, order) is df
    assert "Exchange" not in rank.rank(df, CUSTOMER, FS, QUARTER)._jdf.queryExecution().executedPlan().toString()


def test_past_table_without_keys_is_an_error(spark):
    past = spark.createDataFrame([(1,)], "sales_2024 long")
    with pytest.raises(ValueError, match="key columns"):
        merge.merge_level(customers(spark, 3), past, CUSTOMER, FS, ANNUAL)


def test_unreadable_is_not_missing(spark, tmp_out):
    assert readers.optional_parquet(spark, f"{tmp_out}/none") is None

    class Denied(AnalysisException):
        def getCondition(self):
            return "ACCESS_DENIED"

    class Broken:
        @property
        def read(self):
            raise Denied("no access")

    for read in (readers.optional_parquet, readers.path_exists):
        with pytest.raises(AnalysisException):
            read(Broken(), "x")


def test_totals_beyond_double(spark):
    big = 2 ** 53
    table = lambda extra: spark.createDataFrame([("1", big), ("2", extra)], "corp_code string, sales_2025 long")
    a, b = (reconcile.level_totals({"corp": table(x)}, FS, ("sales",)) for x in (1, 2))
    r = reconcile.compare_absolute(a, b).head()
    assert r["status"] == "changed" and int(r["diff"]) == 1
    assert reconcile.compare_relative(a, b).count() == 1


def test_advice_and_verdict_without_a_past(spark, tmp_out):
    assert len(reconcile.premerge_advice(2, False)) == 2 and len(reconcile.premerge_advice(0, True)) == 1
    rows = [("01", "c1", "n1", "o1", "k", "p1", "q1", 1.0, 2.0, 10.0, 1.0)]
    det = spark.createDataFrame(rows, "corp_code string, cust_code string, cust_name string, office string, category string, "
                                      "prod_code string, prod_name string, qty double, area double, sales double, profit double")
    from rankloom.operators import summarise

    cur = summarise.summarise(det, LEVELS, FS)
    master = spark.createDataFrame([("99", "x")], "corp_code string, corp_name string")
    run = jobs.run_merge_years(cur, {lv.name: None for lv in LEVELS}, master, FS, ANNUAL, writers.level_paths(tmp_out, kind="result"))
    assert run.report is None and run.verdict.head()["valid"] and run.advice == [reconcile.ADVICE_NO_PAST]
    assert run.null_names == 1 and any("without a corp name" in x for x in run.lines())
