import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from rankloom.llm import queries, resample
from rankloom.llm.words import Splitter

from .conftest import SF, docs, sql

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def by_hand(rows, target, percent=5):
    """(doc_id, n_features, weight, score, rank), ranks by a plain sort."""
    found = [(i, *features(t)) for i, t in rows]
    s = collections.Counter(x for _, _, f in found for x in f)
    t = collections.Counter(x for text in target for x in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(eligible[: percent * len(eligible) // 100])}
    return [(r[0], *r[2:], rank.get(id(r))) for r in out]


def test_query_equals_brute_force(spark):
    rows = sql("select doc_id, text from '{sf}/documents.parquet'")
    target = [t for (t,) in sql("select text from '{sf}/benchmark.parquet'")]
    got = [tuple(r) for r in queries.op12_resample(spark, SF).collect()]
    assert sorted(got) == sorted(by_hand(rows, target))
    eligible = sum(features(t)[0] >= 20 for _, t in rows)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, eligible * 5 // 100 + 1))


def test_kth_key_by_quickselect(spark):
    rng = random.Random(4)
    keys = [(rng.randrange(50), rng.randrange(3), i) for i in range(2000)]
    df = spark.createDataFrame(keys, "a long, b long, c long")
    for k in (1, 2, 777, 1999, 2000):
        assert resample.kth_key(df, k, pivots=5) == sorted(keys)[k - 1]
    assert resample.kth_key(df, 2001) is None and resample.kth_key(df.limit(0), 1) is None


def test_checksums_of_runs_come_from_those_of_words():
    import pyarrow as pa

    texts = ["a bb ccc", "", "É日 " + "x" * 700 + " y", "one two three four " * 9, None, "z"]
    buckets = (1 << 32) - 5
    made = resample.Features(buckets)
    made.splitter = Splitter(resample.SPACES, slice_bytes=16)
    got = []
    for part in made.splitter.slices(pa.array(texts)):
        bucket, there = made.of(part)
        got += bucket[there].tolist()
    want = []
    for t in texts:
        w = WORD.findall(t or "")
        want += [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    assert sorted(got) == sorted(want)


def test_edge_cases(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(1, None), (2, ""), (None, text), (3, text), (3, text), (4, "  . "), (5, "x " * 150_000)] + [(i, text) for i in range(10, 60)]
    df = docs(spark, rows).withColumnRenamed("lang", "rank").withColumnRenamed("source", "score")
    target = spark.createDataFrame([(text,), (None,)], "text string")
    got = resample.resample(df.select("doc_id", "text", "rank", "score"), target)
    want = by_hand(rows, [text, None])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    with pytest.raises(ValueError, match="rank"):
        resample.resample(df, target, keep=["rank"])
    kept = resample.resample(docs(spark, rows), target, keep=["lang"]).collect()
    assert {r["lang"] for r in kept} == {"en"} and len(kept) == len(rows)


def test_empty_tables(spark):
    none = docs(spark, [])
    assert resample.resample(none, none).collect() == []
    got = resample.resample(docs(spark, [(1, "a " * 30)]), none).collect()
    assert [r["rank"] for r in got] == [None] and got[0]["n_features"] == 87
