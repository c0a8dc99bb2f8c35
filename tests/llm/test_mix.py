import re

import pytest

from rankloom.llm import mix, queries

from .conftest import SF, docs, sql


def by_hand(sizes, weights, epochs=3):
    """Water filling, step by step."""
    total, target, open_ = sum(sizes), {}, set(range(len(sizes)))
    while open_:
        rest = total - sum(target.values())
        share = {i: rest * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > epochs * sizes[i]}
        if not over:
            return target | share
        for i in over:
            target[i] = epochs * sizes[i]
        open_ -= over
    return target


def test_targets_by_hand(spark):
    for sizes in ([100, 100, 100], [1, 1000, 5], [10, 0, 3, 900, 40, 2, 77], [5], [0, 0], [7, 7, 7, 7, 1000]):
        rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
        got = {r["source"]: r["target"] for r in mix.source_targets(
            spark.createDataFrame(rows, "source string, source_size long")).collect()}
        want = by_hand(sizes, [i % 3 + 1 for i in range(len(sizes))])
        for i in range(len(sizes)):
            assert got[f"s{i}"] == pytest.approx(want[i], abs=1e-6), sizes


def test_query_meets_its_budgets(spark):
    rows = queries.op9_source_mix(spark, SF).collect()
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in sql("select doc_id, text from '{sf}/documents.parquet'")}
    source = dict(sql("select doc_id, source from '{sf}/documents.parquet'"))
    taken, target = {}, {}
    for r in rows:
        assert r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert len(rows) == len(sizes)
    assert all(t - 1 < taken[s] <= t for s, t in target.items())


def test_epochs_and_one_cut_document(spark):
    rows = [(i, "w " * 10, "a") for i in range(5)] + [(100 + i, "w " * 10, "b") for i in range(100)]
    out = mix.mix_sources(docs(spark, rows)).collect()
    a = [r["taken"] for r in out if r["source"] == "a"]
    assert a == [30] * 5  # its share is above three times its size
    b = [r["taken"] for r in out if r["source"] == "b"]
    assert sum(b) == 1050 - 150 and sum(1 for t in b if 0 < t < 10) <= 1


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "", "x"), (None, "a b c", None), (3, "a b", "x"), (3, "a b", "x"), (4, " \n ", "y")]
    df = docs(spark, rows).withColumnRenamed("lang", "target")
    out = mix.mix_sources(df).collect()
    assert len(out) == 6 and sum(r["size"] for r in out) == 7
    assert {r["target"] for r in out if r["source"] == "y"} == {0.0}
    assert sum(r["taken"] for r in out) in (6, 7)
    again = mix.mix_sources(df.repartition(3)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, out))
    assert mix.mix_sources(docs(spark, [])).count() == 0


def test_mix_takes_effect(spark):
    rows = [(1, "a b  c\nd ", "a"), (2, "x " * 40, "b"), (3, "y " * 40, "b"), (4, "", "b")]
    mixed = mix.mix_sources(docs(spark, rows))
    out = mix.apply_mix(mixed)
    assert out.columns == docs(spark, rows).columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == {r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]}
    cut = spark.createDataFrame([(" a b  c\nd ", n) for n in (1, 3, 4)], "t string, n int").select(
        mix.first_words("t", "n").alias("c")).collect()
    assert [r["c"] for r in cut] == [" a", " a b  c", " a b  c\nd"]
