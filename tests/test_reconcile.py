from rankloom.operators import reconcile
from rankloom.plans.spec import FiscalSpec

FS = FiscalSpec(2025, start_year=2024)
T = "level string, fy int, metric string, total double"


def test_absolute_severity_ladder(spark):
    before = spark.createDataFrame([("corp", 2024, "sales", 0.0)] * 1, T)
    cases = {100_000: "minor", 100_001: "warning", 1_000_000: "warning", 1_000_001: "severe"}
    for diff, sev in cases.items():
        after = spark.createDataFrame([("corp", 2024, "sales", float(diff))], T)
        r = reconcile.compare_absolute(before, after).collect()[0]
        assert r["severity"] == sev, diff
        assert r["issue"] == (sev != "minor")


def test_lost_and_new_columns(spark):
    before = spark.createDataFrame([("corp", 2023, "sales", 1.0)], T)
    after = spark.createDataFrame([("corp", 2025, "sales", 1.0)], T)
    got = {(r["fy"], r["status"], r["issue"]) for r in reconcile.compare_absolute(before, after).collect()}
    assert got == {(2023, "lost", True), (2025, "new", False)}


def test_relative_ladder_and_zero_before(spark):
    rows = [("l", 1, "m", 100.0), ("l", 2, "m", 100.0), ("l", 3, "m", 100.0), ("l", 4, "m", 100.0), ("l", 5, "m", 0.0)]
    after = [("l", 1, "m", 105.0), ("l", 2, "m", 105.01), ("l", 3, "m", 110.0), ("l", 4, "m", 110.01), ("l", 5, "m", 7.0)]
    out = {r["fy"]: (r["severity"], round(r["rel_pct"], 2)) for r in reconcile.compare_relative(spark.createDataFrame(rows, T), spark.createDataFrame(after, T)).collect()}
    assert out == {1: ("low", 5.0), 2: ("medium", 5.01), 3: ("medium", 10.0), 4: ("high", 10.01), 5: ("low", 0.0)}


def test_premerge_tolerance(spark):
    cur = spark.createDataFrame([("corp", 2025, "sales", 11000.0), ("corp", 2024, "sales", 11000.01)], T)
    past = spark.createDataFrame([("corp", 2025, "sales", 10000.0), ("corp", 2024, "sales", 10000.0)], T)
    assert [r["fy"] for r in reconcile.premerge_conflicts(cur, past).collect()] == [2024]


def test_cross_level_and_verdict(spark):
    after = spark.createDataFrame([("corp", 2025, "sales", 5.0), ("customer", 2025, "sales", 5.0), ("customer_product", 2025, "sales", 6.0)], T)
    cross = reconcile.cross_level(after)
    assert sum(r["issue"] for r in cross.collect()) == 2
    absolute = reconcile.compare_absolute(after.limit(0), after)
    v = reconcile.verdict(absolute, cross).collect()[0]
    assert v["valid"] is False and v["issues"] == 2


def test_key_overlap_null_is_a_value(spark):
    cur = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    past = spark.createDataFrame([("b",), ("c",), (None,)], "k string")
    r = reconcile.key_overlap(cur, past, "k").collect()[0]
    assert (r["only_current"], r["only_past"], r["both"]) == (1, 1, 2)


def test_table_profile_empty_table(spark):
    df = spark.createDataFrame([], "a string, b double")
    rows = reconcile.table_profile(df, "t").collect()
    assert {r["column"] for r in rows} == {"a", "b"} and all(r["null_pct"] is None for r in rows)
