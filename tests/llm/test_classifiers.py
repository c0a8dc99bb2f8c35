import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import labelled, quality, queries, toxicity
from rankloom.llm.common import table

from .conftest import docs

LARGER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("query, label, folds, held, least", [
    (queries.op4_quality, "quality", 4, 2, 0.98), (queries.op8_toxicity, "toxic", 3, 1, 0.96)])
def test_held_out_accuracy(spark, query, label, folds, held, least):
    out = query(spark, LARGER).toPandas()
    assert len(out) == table(spark, LARGER, "documents").count()
    assert (out["held_out"] == out["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % folds == held)).all()
    assert out["score"].between(0, 1).all() and (out["predicted"] == (out["score"] >= 0.7)).all()
    both = out.merge(table(spark, LARGER, "labels").toPandas(), on="doc_id")
    both = both[both["held_out"]]
    assert (both["predicted"] == both[label]).mean() >= least


def test_labels_of_the_held_out_fold_are_not_read(spark):
    d = docs(spark, [(i, f"text {i}") for i in range(60)])
    labels = spark.createDataFrame([(i, 1 if zlib.crc32(str(i).encode()) % 4 == 2 else 0) for i in range(60)], "doc_id long, quality int")
    rows, counts = labelled.sample(d, labels, "quality", 4, 2, 100)
    assert set(counts) == {0} and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in rows.collect())
    few, _ = labelled.sample(d, labels.withColumn("quality", F.col("doc_id") % 2), "quality", 4, 2, 10)
    assert few.count() == 10


def test_one_row_of_a_repeated_doc_id(spark):
    rows = [(i, f"text {i}") for i in range(20)] + [(4, f"copy {i}") for i in range(30)] + [(4, None), (4, "text 4"), (None, "x")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(4, 1), (None, 1)], "doc_id long, quality int")
    got, _ = labelled.sample(docs(spark, rows).repartition(5), labels, "quality", 4, 2, 100, ("lang",))
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == len(set(ids)) and 4 in ids and got.columns == ["doc_id", "text", "y", "lang"]
    again, _ = labelled.sample(docs(spark, rows[::-1]), labels, "quality", 4, 2, 100, ("lang",))
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))


def test_metadata_of_the_document_itself(spark):
    d = docs(spark, [(i, "same words") for i in range(80)]).withColumn("n_chars", (F.col("doc_id") % 2 * 90000).cast("long"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    got = quality.classify(d, labels, metadata=("n_chars",), keep=["doc_id"]).collect()
    assert min(r["score"] for r in got if r["doc_id"] % 2) > max(r["score"] for r in got if not r["doc_id"] % 2)
    nulls = quality.classify(d.withColumn("n_chars", F.lit(None).cast("long")), labels, metadata=("n_chars",), keep=["doc_id"]).collect()
    assert len({r["score"] for r in nulls}) == 1


def test_pairwise_part_by_sum_of_squares():
    rng = np.random.default_rng(0)
    size = quality.WORDS + quality.STATISTICS
    m = quality.Machine(0.3, rng.normal(size=size).astype(np.float32), rng.normal(size=(size, quality.FACTORS)).astype(np.float32))
    at, of = np.array([3, 8, 20, 5, 9], np.int32), rng.normal(size=5).astype(np.float32)
    got = m.margins(at, of, np.array([0, 3]))
    for (a, b), g in zip(((0, 3), (3, 5)), got):
        want = 0.3 + sum(m.linear[at[i]] * of[i] for i in range(a, b)) + sum(
            float(m.factors[at[i]] @ m.factors[at[j]]) * of[i] * of[j] for i in range(a, b) for j in range(i + 1, b))
        assert g == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_features_of_odd_texts():
    for text in (None, "", " \n", "A", "é" * 10, "x" * 100000, "a b " * 50000):
        at, of = quality.features(text, (None, 5))
        assert np.isfinite(of).all() and len(at) == len(of) and at.max() < quality.WORDS + quality.STATISTICS + 2


def test_convolution_and_pooling_against_loops():
    net = toxicity.fresh(3)
    rng = np.random.default_rng(1)
    net.words[:] = rng.normal(size=net.words.shape)
    docs_ = [rng.integers(0, 1 << 16, n) for n in (0, 1, 2, 7, 40)]
    got = net.pooled(docs_)
    for d, g in zip(docs_, got):
        x = net.embedded(d)
        for w, width in enumerate(toxicity.WIDTHS):
            best = np.zeros(toxicity.FILTERS)
            for p in range(len(d)):
                r = net.offsets[w].astype(float).copy()
                for o in range(min(width, len(d) - p)):
                    r += x[p + o] @ net.filters[w][o]
                best = np.maximum(best, r)
            assert g[w * toxicity.FILTERS:(w + 1) * toxicity.FILTERS] == pytest.approx(best, abs=1e-3)


def test_windows_do_not_change_a_long_text(monkeypatch):
    net = toxicity.fresh(3)
    net.words[:] = np.random.default_rng(1).normal(size=net.words.shape)
    long = np.random.default_rng(2).integers(0, 1 << 16, 5000)
    whole = net.pooled([long])
    monkeypatch.setattr(toxicity, "WINDOW", 64)
    monkeypatch.setattr(toxicity, "BLOCK", 500)
    assert net.pooled([long, long[:10]])[0] == pytest.approx(whole[0], abs=1e-4)


def test_thresholds_by_language():
    r = random.Random(0)
    net = toxicity.constant(0.5)
    net.out[:] = 1
    kinds = {"en": "the of and to", "de": "der die und von"}
    samples, y = [], []
    for i in range(80):
        lang = "en" if i % 2 else "de"
        samples.append(toxicity.encode(kinds[lang] + f" w{r.random()}"))
        y.append(float(i % 4 < 2))
    assert {toxicity.language(s) for s in samples} == {0, 1}
    assert toxicity.language(toxicity.encode("xyz")) == len(toxicity.FUNCTION_WORDS)
    net = toxicity.calibrate(net, samples, np.array(y))
    assert np.isfinite(net.shift).all()


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_cases(spark, module, label):
    rows = [(1, None), (2, ""), (None, "some text"), (3, "a b c"), (3, "a b c"), (4, "w " * 60000)]
    d = docs(spark, rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "predicted")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    out = module.classify(d, none, label).collect()
    assert len(out) == len(rows) and {round(r["score"], 6) for r in out} == {0.5}
    odd = spark.createDataFrame([(3, 1), (3, 0), (3, None), (None, 1), (2, 1), (99, 0)], f"doc_id long, {label} int")
    out = module.classify(d, odd, label).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert module.classify(docs(spark, []), odd, label).count() == 0
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [True]
