"""Row numbers, stored ranks, split keys."""

import random

from pyspark.sql import functions as F

from rankloom.operators import merge, rank
from rankloom.operators.numbering import number_rows


def test_numbers_follow_the_order(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(3000)]
    got = number_rows(spark.createDataFrame(rows, "a int, b int").repartition(7), [F.col("a").desc_nulls_first(), F.asc("b")], "n")
    want = sorted(rows, key=lambda r: (r[0] is not None, -(r[0] or 0), r[1]))
    assert [(r["a"], r["b"], r["n"]) for r in got.orderBy("n").collect()] == [(*r, i + 1) for i, r in enumerate(want)]


def test_empty_table_and_existing_column(spark):
    assert number_rows(spark.createDataFrame([], "a int"), [F.asc("a")]).collect() == []
    got = number_rows(spark.createDataFrame([(5, 9)], "a int, rank int"), [F.asc("a")])
    assert [tuple(r) for r in got.collect()] == [(5, 1)]


def test_one_range_exchange(spark):
    got = number_rows(spark.range(100).repartition(3), [F.desc("id")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # it was done while writing


def test_ranges_of_a_stored_rank(spark):
    ranked = spark.range(5000).withColumn("rank", F.col("id") + 1).repartition(7)
    got = rank.by_ranges(ranked, "rank", 5000, 500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and got.rdd.getNumPartitions() == 10
    assert [r["rank"] for r in got.collect()] == list(range(1, 5001))


def sides(spark):
    def side(n, v, mod):
        return spark.createDataFrame(
            [(None if i % 11 == 0 else "hot" if i % 3 == 0 else f"k{i % mod}", "y" if i % 3 == 0 or i % 5 else None, i) for i in range(n)],
            f"k1 string, k2 string, {v} long")

    return side(900, "a", 50), side(600, "b", 70)


def test_split_keys_equal_the_plain_join(spark):
    cur, past = sides(spark)
    got = merge.full_join(cur, past, ["k1", "k2"], 20)
    want = cur.join(past, ["k1", "k2"], "full").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "_salt" in got._jdf.queryExecution().analyzed().toString()


def test_a_heavy_key_of_one_side_comes_out_once(spark):
    cur, past = sides(spark)
    past = past.filter("k1 <> 'hot'")
    got = merge.full_join(cur, past, ["k1", "k2"], 20)
    want = cur.join(past, ["k1", "k2"], "full").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_tasks_of_a_split_key_are_even(spark):
    cur = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("a"))
    past = spark.range(60).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("b"))
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = merge.full_join(cur, past, ["k"], 20)
        sizes = sorted(r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep[1])
    assert sum(sizes) == 2000 * 20 + 4000
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
