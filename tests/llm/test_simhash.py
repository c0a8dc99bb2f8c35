import random
import re

import numpy as np
import xxhash

from rankloom.llm import queries, simhash

from .conftest import SF, docs

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TO_LOWER))
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, bits=2):
    """Smallest id reachable, from all pairs."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_query_against_brute_force(spark, sf_docs):
    got = {r["doc_id"]: r for r in queries.op7_simhash(spark, SF).collect()}
    fps = [slow(t) for _, t in sf_docs]
    for (doc_id, _), fp, c in zip(sf_docs, fps, classes(fps)):
        assert got[doc_id]["fingerprint"] == f"{fp:016x}" and got[doc_id]["component_id"] == sf_docs[c][0]


def planted(n, seed):
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(8)]
    return list({c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for c in centres for _ in range(n)})


def edges_classes(spark, fps, **kw):
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, **kw)).collect()}
    return {f: roots.get(simhash.signed(f), simhash.signed(f)) for f in fps}


def test_links_are_complete_in_small_and_in_split_blocks(spark):
    fps = planted(60, 3)
    want = classes(fps)
    for block_rows in (512, 4):  # 4: nearly every block is cut again
        got = edges_classes(spark, fps, block_rows=block_rows)
        groups = {}
        for f, c in zip(fps, want):
            groups.setdefault(c, set()).add(got[f])
        assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_other_distances(spark):
    fps = planted(25, 5)
    for bits in (1, 3):
        want, got = classes(fps, bits), edges_classes(spark, fps, bits=bits, block_rows=8)
        assert len(set(want)) == len(set(got.values()))


def test_pivot_coordinates_never_differ_by_more_than_the_distance():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2 ** 64, 500, dtype=np.uint64)
    b = a ^ np.uint64(1 << 5) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    apart = np.abs(simhash.pivot_table(a).astype(int) - simhash.pivot_table(b)).max(axis=1)
    assert (apart <= np.bitwise_count(a ^ b)).all()


def test_edge_cases(spark):
    rows = [(5, None), (4, ""), (7, " \n "), (3, "one two"), (None, "one two"), (3, "one two"), (9, "ONE\ttwo"), (None, "q w e")]
    out = simhash.near_duplicates(docs(spark, rows).withColumnRenamed("lang", "fp")).collect()
    assert len(out) == len(rows)
    assert {r["component_id"] for r in out if r["fp"] == 0} == {4}
    assert sorted(str(r["doc_id"]) for r in out if r["component_id"] == 3) == ["3", "3", "9", "None"]
    assert [r["component_id"] for r in out if r["fp"] == simhash.signed(slow("q w e"))] == [None]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    kept = simhash.keep_first(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "None"]


def test_repeated_ids_with_other_texts_all_stay(spark):
    texts = ["first text of its own here", "second one quite different words", "third with yet other content"]
    assert simhash.keep_first(docs(spark, [(1, t) for t in texts])).count() == 3
