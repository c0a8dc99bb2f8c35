import base64
import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from rankloom.llm import queries, sketch

from .conftest import SF, docs


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def shingles(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    out = set()
    for i in range(max(1, len(h) - 4) if h else 0):
        seed = 42
        for x in h[i:i + 5]:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", x), seed)
        out.add(signed(seed))
    return out


def coded(s, k=sketch.K):
    return base64.b64encode(b"".join(struct.pack(">q", x) for x in sorted(s)[:k])).decode()


def test_query_against_brute_force(spark, sf_docs):
    got = {r["doc_id"]: r for r in queries.op1_fingerprints(spark, SF).collect()}
    assert len(got) == len(sf_docs)
    errors = []
    for i, (doc_id, text) in enumerate(sf_docs):
        after = sf_docs[(i + 1) % len(sf_docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r, a, b, c = got[doc_id], shingles(text), shingles(edited), shingles(after)
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (coded(a), coded(b))
        errors += [abs(r["near_edited"] - len(a & b) / len(a | b)), abs(r["near_next"] - len(a & c) / len(a | c))]
    assert max(errors) < 0.16 and sum(errors) / len(errors) < 0.02


def test_edge_cases(spark):
    rows = [(3, None), (1, ""), (2, "one two"), (None, "x y z u v w"), (2, "one two"), (9, "é" * 7)]
    out = {}
    for r in sketch.edited_fingerprints(docs(spark, rows)).collect():
        out.setdefault(r["doc_id"], []).append(r)
    assert len(out[2]) == 2 and {len(x["sketch"]) for x in out[2]} == {1}
    assert out[3][0]["sketch"] == [] and out[1][0]["sketch"] == [] and out[None][0]["n_chars"] == 11
    # order: null, 1, 2, 2, 3, 9 and round to the first
    assert out[9][0]["edited"] == "éééé" + "x y" and out[1][0]["edited"] == ""
    assert out[None][0]["edited"] == "x y z " and out[3][0]["edited"] == ""
    assert sketch.edited_fingerprints(docs(spark, [])).count() == 0
    one = sketch.edited_fingerprints(docs(spark, [(1, "abcd")])).collect()
    assert one[0]["edited"] == "abab"


def test_many_ranges_find_the_next_document(spark):
    rows = [(i * i, f"text number {i}") for i in range(200)]
    got = {r["doc_id"]: r["edited"] for r in sketch.edited_fingerprints(docs(spark, rows)).collect()}
    for i, (doc_id, text) in enumerate(rows):
        after, half = rows[(i + 1) % 200][1], len(text) // 2
        assert got[doc_id] == text[:len(text) - half] + after[:half]


def test_estimates_and_merge(spark):
    a, b = [f"w{i}" for i in range(3000)], [f"w{i}" for i in range(1500, 4500)]
    df = sketch.sketched(sketch.sketched(
        spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string"), "a", "sa"), "b", "sb")
    r = df.select(
        sketch.resemblance(F.col("sa"), F.col("sb")).alias("j"), sketch.containment(F.col("sa"), F.col("sb")).alias("c"),
        sketch.distinct_shingles(F.col("sa")).alias("n"), sketch.merge(F.col("sa"), F.col("sb")).alias("m"),
        "sa", "sb").head()
    assert r["j"] == pytest.approx(1 / 3, abs=0.15) and r["c"] == pytest.approx(0.5, abs=0.2)
    assert r["n"] == pytest.approx(2996, rel=0.3)
    assert r["m"] == sorted({*r["sa"], *r["sb"]})[:sketch.K]
    parts = spark.createDataFrame([(1, r["sa"]), (1, r["sb"]), (2, [5])], "k int, s array<bigint>")
    merged = {x["k"]: x["s"] for x in sketch.merge_by(parts, ["k"], "s").collect()}
    assert merged == {1: r["m"], 2: [5]}
    empty = spark.range(1).select(sketch.resemblance(F.array().cast("array<bigint>"), F.array().cast("array<bigint>")).alias("j"))
    assert empty.head()["j"] == 1.0
