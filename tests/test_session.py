import os
from types import SimpleNamespace

import pytest

from rankloom import session


def fake(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://h:7077", "k8s://x", "local-cluster[3,2,1000]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
    assert session.shared_dir(fake("yarn", **{"spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"


def test_scratch_is_empty_after_release(spark):
    path = session.scratch_path(spark, "t")
    assert session.materialize(spark.range(5), path).count() == 5 and os.path.exists(path.removeprefix("file:"))
    session.release(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_summaries_leave_no_scratch(spark, tmp_out):
    from rankloom.plans import catalog as C, jobs
    from rankloom.sources import writers

    folder = session.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    jobs.summarise_to_files(C.cur_detail(spark, "/root/testdata/sf0.001"), C.FISCAL, writers.level_paths(tmp_out), reference_names=False)
    assert not [f for f in set(os.listdir(folder)) - before if "summary" in f]


def test_command_line_on_a_plain_session(tmp_path):
    """Nothing but Spark's defaults: no scratch folder is configured."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root, conf = Path(__file__).resolve().parents[1], tmp_path / "conf"
    conf.mkdir()
    detail = "法人コード,得意先コード,得意先名,営業所名,第1階層,商品コード,商品名,売上数,㎡,売上金額,粗利金額\n"
    (tmp_path / "d.csv").write_bytes((detail + '1,10,"甲, ""A""",東京,a,p,"24"" panel",1,2,300,40\n1,11,乙,東京,a\n').encode("cp932"))
    (tmp_path / "m.csv").write_bytes("法人コード,法人名\n1,法人\n".encode("cp932"))
    import pyarrow as pa
    import pyarrow.parquet as pq

    from rankloom.plans.spec import LEVELS
    from rankloom.sources import writers

    keys = {"corp": ["法人コード"], "customer": ["得意先コード", "得意先名"],
            "customer_product": ["営業所名", "得意先コード", "得意先名", "第1階層", "商品コード", "商品名"]}
    for lv, path in writers.level_paths(str(tmp_path / "past"), "quarter", "past", True, tuple(x.name for x in LEVELS)).items():
        Path(path).parent.mkdir(exist_ok=True)  # past tables without rows
        pq.write_table(pa.table({**{k: pa.array([], pa.string()) for k in keys[lv]}, "2024売上": pa.array([], pa.float64())}), path)
    env = {k: v for k, v in os.environ.items() if not k.startswith("SPARK_")} | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": str(root)}
    env["PYSPARK_SUBMIT_ARGS"] = "--master local[2] --conf spark.ui.enabled=false pyspark-shell"
    got = subprocess.run(
        [sys.executable, "-m", "rankloom", "all", "--detail", "d.csv", "--past-dir", "past", "--master", "m.csv", "--out", "out",
         "--as-of", "2025-06-30", "--policy", "quarter"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr[-2000:]
    assert '"rejected": {"detail": 1, "master": 0}' in got.stdout
    assert sorted(p.name for p in (tmp_path / "out" / "export").iterdir()) == ["corp", "customer", "customer_product"]


def test_a_task_takes_a_bounded_part_of_a_shuffle(spark):
    session.prepare(spark)
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    assert parts is not None and int(parts) >= session.SHUFFLE_PARTS
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == session.PART_BYTES
    assert spark.range(100).groupBy("id").count().rdd.getNumPartitions() <= 10  # joined again where there is little


def test_line_items_of_other_years_are_left_out_before_the_shuffle(spark, tmp_path):
    """By its own size rules Spark makes no filter here: the scan is below 10 GB."""
    from pyspark.sql import functions as F

    small, large = f"{tmp_path}/small", f"{tmp_path}/large"
    spark.range(2000).withColumn("d", F.col("id") % 50).write.parquet(small)
    spark.range(5_000_000).select((F.rand(1) * 1e15).alias("x"), (F.col("id") % 4000).alias("k")).write.parquet(large)  # 40 MB
    session.prepare(spark)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for orders, which are too many for it
    try:
        few = spark.read.parquet(small).where("d = 7 AND id IS NOT NULL")
        found = spark.read.parquet(large).where("k IS NOT NULL").join(few, F.col("k") == F.col("id"))
        assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.agg(F.count("x")).head()[0] == 40 * 1250
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_shuffle_files_go_with_their_query(spark, tmp_out):
    """After a written query nothing of its shuffles is left; the same frame can still be acted on again."""
    import glob
    import os
    import time

    from pyspark.sql import functions as F

    from rankloom.session import prepare

    prepare(spark)
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in local for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}
    before = files()
    df = spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy("k")
    df.write.parquet(tmp_out)
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert len(df.collect()) == len(df.collect()) == spark.read.parquet(tmp_out).count() == 1000
