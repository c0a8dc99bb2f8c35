import collections
import math
import re
import tracemalloc
import zlib

import numpy as np
import pytest

from rankloom.llm import lm, queries

from .conftest import SF, docs, sql

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, rounds=lm.ROUNDS):
    """The same model with dictionaries, a token at a time."""
    texts = [(i, zlib.crc32(("" if i is None else str(i)).encode()), re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(LOWER)) + [1])
             for i, x in rows]

    def counts(chosen):
        c = collections.Counter()
        for _, k, t in texts:
            if chosen(k):
                s = [0, 0] + t
                c.update([0, (0, 0)])
                for j in range(2, len(s)):
                    c.update([("n",), s[j], (s[j - 1], s[j]), (s[j - 2], s[j - 1], s[j])])
        return c

    train, left_out = counts(lambda k: k % 10), counts(lambda k: k % 20 == 1)
    n, v = train[("n",)], sum(1 for x in train if not isinstance(x, tuple) and x != 0)
    bucket = lambda x: 0 if x == 0 else min(int(math.log2(x)) + 1, lm.BUCKETS - 1)

    def tokens(t, get):
        s = [0, 0] + t
        for j in range(2, len(s)):
            u, x, w = s[j - 2: j + 1]
            yield get(w), get((x, w)), get((u, x, w)), get(x), get((u, x))

    one, two = 0.9, [0.0] + [0.5] * (lm.BUCKETS - 1)
    three = list(two)

    def mix(q, size):
        f = [a / b if b else 0.0 for a, b in zip(q[:3], (size, q[3], q[4]))]
        l2, l3 = two[bucket(q[3])], three[bucket(q[4])]
        p1 = one * f[0] + (1 - one) / (v + 1)
        p2 = l2 * f[1] + (1 - l2) * p1
        p3 = l3 * f[2] + (1 - l3) * p2
        return p3, l3 * f[2] / p3, l2 * f[1] / p2, one * f[0] / p1

    held = [q for _, k, t in texts if k % 20 == 1 for q in tokens(t, lambda x: train[x] - left_out[x])]
    for _ in range(rounds if held else 0):
        e = np.zeros((5, lm.BUCKETS))
        for q in held:
            _, r3, r2, r1 = mix(q, n - left_out[("n",)])
            for row, at, x in ((0, bucket(q[4]), r3), (1, bucket(q[4]), 1), (2, bucket(q[3]), (1 - r3) * r2), (3, bucket(q[3]), 1 - r3),
                               (4, 0, (1 - r3) * (1 - r2) * r1), (4, 1, (1 - r3) * (1 - r2))):
                e[row, at] += x
        three, two = (list((e[i] + 0.5) / (e[i + 1] + 1)) for i in (0, 2))
        three[0] = two[0] = 0.0
        one = (e[4, 0] + 0.5) / (e[4, 1] + 1)
    one = one if n else 0.0
    return [(i, k % 10 == 0, len(t), sum(train[w] > 0 for w in t), n,
             sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t),
             sum(math.log10(mix(q, n)[0]) for q in tokens(t, lambda x: train[x]))) for i, k, t in texts]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    assert [r[6] for r in got] == pytest.approx([r[6] for r in want], rel=1e-9)


def test_query_equals_brute_force_and_beats_the_base(spark):
    got = queries.op13_lm_score(spark, SF).collect()
    same(got, by_hand(sql("select doc_id, text from '{sf}/documents.parquet'")))
    held = [r for r in got if r["held_out"]]
    assert held and all(r["score"] > r["base_score"] for r in held)


def test_small_blocks_and_parts_change_nothing(spark):
    rows = sql("select doc_id, text from '{sf}/documents.parquet'")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(lm.score(df, block_words=3000, part_words=5000).collect(), by_hand(rows))


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "a b a"), (3, "a b c"), (3, "a b c"), (4, " \n "), (5, "Q a b " * 40_000), (30, "zz a B")]
    rows += [(i, "a b c d") for i in range(100, 160)]
    df = docs(spark, rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "words")
    same(lm.score(df).collect(), by_hand(rows))


def test_long_text_goes_through_several_blocks(spark):
    rows = [(i, " ".join(f"w{(j * j + i) % 97}" for j in range(n))) for i, n in ((1, 9000), (2, 50), (11, 4000), (12, 700))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    import rankloom.llm.words as words

    keep = words.Splitter.__init__.__defaults__
    words.Splitter.__init__.__defaults__ = (b"", 400)
    try:
        import pyarrow as pa

        packed, blocks = lm._Texts(), []
        for part in words.Splitter(b" ").slices(pa.array([rows[0][1]])):
            counts = np.bincount(part.row - part.first, minlength=part.last - part.first + 1)
            packed.add(part.words, counts, [(0, 1, lm.TRAIN)], part.goes_on, part.ends)
            if packed.size >= 1000:
                blocks.append(packed.take())
        if packed.size:
            blocks.append(packed.take())
    finally:
        words.Splitter.__init__.__defaults__ = keep
    assert len(blocks) > 5 and [b[0] for b in blocks[1:]] == [2] * (len(blocks) - 1)
    spelled = []
    for skip, tokens, held, sizes, known, _, place in blocks:
        names = dict(zip(place.tolist(), known.to_pylist())) | {lm.BEGIN: "<", lm.END: ">"}
        assert sum(sizes) == len(tokens)
        spelled += [names[t] for t in tokens[skip:].tolist()]
    assert spelled == ["<", *rows[0][1].split(), ">"]
    same(lm.score(df, block_words=1000, part_words=3000).collect(), by_hand(rows))


def test_nothing_to_learn_from(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = [(i, "a b") for i in held]
    same(lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), by_hand(rows))


def test_empty_table(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_round_does_not_lower_the_likelihood():
    rng = np.random.default_rng(3)
    o2, o3 = rng.integers(0, 50, 500), rng.integers(0, 9, 500)
    counts = [rng.integers(0, 30, 500), rng.integers(0, o2 + 1), rng.integers(0, o3 + 1)]
    totals, mixture, last = lm.Totals(9000, 10, 300, 0, 0), lm.first_mixture(), -np.inf
    for _ in range(8):
        est = lm._estimates(counts, (o2, o3), totals.tokens)
        now = np.log(lm.probabilities(mixture, est, (o2, o3), totals.known)[2]).sum()
        assert now >= last - 0.5  # half a token is added on either side of every weight
        last, mixture = now, lm.maximise(lm.expectations(mixture, counts, (o2, o3), totals))


@pytest.mark.parametrize("collide", [False, True])
def test_equal_runs_meet_whatever_their_hash(monkeypatch, collide):
    if collide:
        monkeypatch.setattr(lm, "_mixed", lambda key: np.zeros(len(key), np.uint64))
    rng = np.random.default_rng(5)
    head, tail = rng.integers(0, 9, 4000), rng.integers(0, 30, 4000) << 32 | rng.integers(0, 5, 4000)
    group, groups = lm._alike(head, tail)
    runs = np.stack([head, tail], axis=1)
    known, place = np.unique(runs, axis=0, return_inverse=True)
    assert groups == len(known) == len(np.unique(group)) == len(np.unique(np.stack([group, place.reshape(-1)], axis=1), axis=0))


@pytest.mark.parametrize("bits", [1, 12, 40, 62])
def test_numbers_sorted_with_their_places_keep_equal_ones_in_order(bits):
    rng = np.random.default_rng(7)
    code = rng.integers(0, 1 << bits, 3000)
    assert (lm._order(code, bits) == np.argsort(code, kind="stable")).all()
    assert len(lm._order(code[:0], bits)) == 0
    high, low = code >> bits // 2, code & ((1 << bits // 2) - 1)
    one, two, place = lm._distinct(high, low)
    assert (one[place] == high).all() and (two[place] == low).all() and len(one) == len(np.unique(code))


@pytest.mark.parametrize("top", [50, 1 << 31])
def test_requests_go_by_part_and_first_two_words(top):
    rng = np.random.default_rng(6)
    part, head, second, third = (rng.integers(0, x, 3000) for x in (7, top, top, 40))
    order = lm._sorted(part, head, second << 32 | third)
    got = list(zip(part[order], head[order], second[order]))
    assert got == sorted(got)


def a_block(n: int, words: int) -> tuple[dict, int]:
    """A block of random words, one text, as the tasks for runs read it; and its tokens."""
    rng = np.random.default_rng(8)
    tokens = np.concatenate([[lm.BEGIN], rng.integers(2, words + 2, n), [lm.END]]).astype(np.int32)
    gid, m = np.arange(1, words + 3), np.full(words + 2, n)
    return {"block": 1, "deleted": False, "skip": 0, "tokens": lm.pack(tokens), "lexicon": lm.pack(gid, m, m, m * 0),
            "docs": [{"row": 0, "doc_id": 0, "kind": lm.TRAIN, "size": len(tokens)}], "replies": None}, len(tokens)


def test_memory_of_a_block():
    """Where hardly a run repeats: about 185 bytes a token at the most (330 with numbers of 8 bytes, all kept)."""
    row, n = a_block(200_000, 40_000)
    lm._counts(row, 5, lm.Totals(n, 1, 40_001, 0, 0))
    tracemalloc.start()
    try:
        lm._counts(row, 5, lm.Totals(n, 1, 40_001, 0, 0))
        assert tracemalloc.get_traced_memory()[1] < 230 * n
    finally:
        tracemalloc.stop()


def test_scores_do_not_depend_on_the_step():
    rng = np.random.default_rng(9)
    contexts = [rng.integers(0, 50, 500), rng.integers(0, 9, 500)]
    counts = [rng.integers(1, 30, 500), rng.integers(0, contexts[0] + 1), rng.integers(0, contexts[1] + 1)]
    totals = lm.Totals(9000, 10, 300, 0, 0)
    some, whole = (lm.scores(lm.first_mixture(), counts, contexts, totals, step) for step in (7, 1000))
    assert (some == whole).all() and len(some) == 500
