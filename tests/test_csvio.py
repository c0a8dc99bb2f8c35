"""CSV as RFC 4180 has it: over several splits, against DuckDB, with rejected records."""

import glob
import random

import duckdb
import pytest

from rankloom.session import prepare
from rankloom.sources import csvio, readers, writers

VALUES = ['24" panel', 'A "Q", B', "line\nbreak", "blank\n\n\nlines", "crlf\r\nx", "back\\", 'back\\"q', " lead", "trail ", "", "plain",
          None, '"', '""', "a,b", "日本㎡", "#c", "-", "\n", '"\n"', "x" * 50]


@pytest.fixture()
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "700")
    spark.conf.set(keys[1], "10")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_values_over_many_splits_equal_duckdb(spark, tmp_out, small_splits):
    rng = random.Random(1)
    rows = [(str(i), rng.choice(VALUES), rng.choice(VALUES), f"z{i}") for i in range(600)]
    csvio.write_csv(spark.createDataFrame(rows, "i string, v string, w string, z string").coalesce(1), tmp_out)
    got = csvio.read_csv(spark, tmp_out)
    assert got.rows.rdd.getNumPartitions() > 8
    assert sorted(map(tuple, got.rows.collect()), key=lambda r: int(r[0])) == rows
    assert got.rejected.isEmpty()
    file = glob.glob(f"{tmp_out.removeprefix('file:')}/part*")[0]
    duck = duckdb.sql(f"select * from read_csv('{file}', header=true, all_varchar=true, quote='\"', escape='\"', delim=',', "
                      "allow_quoted_nulls=false)").fetchall()
    assert duck == rows


def write(path, data):
    from pathlib import Path

    p = Path(path.removeprefix("file:"))
    p.mkdir(parents=True, exist_ok=True)
    (p / "a.csv").write_bytes(data)
    return path


def test_rejected_records(spark, tmp_out):
    prepare(spark)
    data = '﻿a,b,c\r\n1,2,3\r\n\r\n4,5\r\n6,7,8,9\r\n"x\r\ny",2,3\r\n7,"8,9\r\n'.encode()
    got = csvio.read_csv(spark, write(tmp_out, data))
    assert sorted(map(tuple, got.rows.collect())) == [("1", "2", "3"), ("x\r\ny", "2", "3")]
    assert sorted((r["record"], r["reason"]) for r in got.rejected.collect()) == [
        ("4,5", "number of cells"), ("6,7,8,9", "number of cells"), ('7,"8,9', "unclosed quote")]


def test_a_stray_quote_is_not_gathered(spark, tmp_out):
    data = b'a,b\n1,"2\n' + b"3,4\n" * 50
    got = csvio.read_csv(spark, write(tmp_out, data), max_record_lines=10)
    assert got.rows.collect() == []
    assert [(r["record"], r["reason"]) for r in got.rejected.collect()] == [('1,"2', "too many lines")]


def test_plain_files_need_no_shuffle(spark, tmp_out, small_splits):
    write(tmp_out, b"a,b\n" + b"".join(b'%d,"x, ""y"""\n' % i for i in range(500)))
    plan = csvio.read_csv(spark, tmp_out).rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_header_faults(spark, tmp_out):
    with pytest.raises(ValueError, match="each once"):
        csvio.read_csv(spark, write(tmp_out, b"a,a\n1,2\n"))


def test_empty_file_and_header_only(spark, tmp_out):
    assert csvio.read_csv(spark, write(tmp_out + "-e", b"")).rows.columns == []
    got = csvio.read_csv(spark, write(tmp_out + "-h", b"a,b\n"))
    assert got.rows.columns == ["a", "b"] and got.rows.isEmpty()


def test_cp932_detail_with_quotes(spark, tmp_out):
    prepare(spark)
    write(tmp_out, '法人コード,得意先名,㎡,売上金額\n007,"表, ""特""\n㎡",1.5,10\n008,x\n'.encode("cp932"))
    got = readers.read_detail_csv(spark, tmp_out).collect()
    assert [tuple(r) for r in got] == [("007", '表, "特"\n㎡', 1.5, 10.0)]
    assert [r["reason"] for r in readers.rejected_rows(spark, tmp_out).collect()] == ["number of cells"]


def test_manifest_finds_changed_files(spark, tmp_out):
    writers.export_level(spark.range(30).selectExpr("id", "concat('n', id) AS name").repartition(3), tmp_out)
    assert writers.check_export(spark, tmp_out).isEmpty()
    said = spark.read.json(f"{tmp_out}/_manifest").collect()
    assert sum(r["rows"] for r in said) == 30 and all(len(r["sha256"]) == 64 for r in said)
    file = sorted(glob.glob(f"{tmp_out.removeprefix('file:')}/part*"))[0]
    text = open(file).read()
    open(file, "w").write(text.replace("n", "m", 3))
    crc = file.rsplit("/", 1)
    import os

    os.remove(f"{crc[0]}/.{crc[1]}.crc")  # Hadoop's own check would stop the read
    assert [r["file"] for r in writers.check_export(spark, tmp_out).collect()] == [crc[1]]
