import random
from collections import Counter

import numpy as np
import xxhash

from rankloom.llm import queries, repeats

from .conftest import SF, docs


def slow(texts, length):
    """(bytes, removed, runs, kept) per text, from every substring."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, bytes(b for b, g in zip(r, gone) if not g)))
    return out


def removed(spark, rows, **kw):
    return [(r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])))
            for r in repeats.remove_repeats(docs(spark, rows), **kw).collect()]


def test_interval_expansion_on_random_strings():
    r = random.Random(2)
    for _ in range(120):
        letters = r.choice([b"ab", b"abcdefgh"])
        parts = [bytes(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(r.randint(1, 5))]
        text = b"\xff".join(r.choice(parts) + r.choice(parts) for _ in range(r.randint(1, 8))) + b"\xff"
        length = r.choice([8, 10, 17])
        got = repeats.repeated_starts(np.frombuffer(text, np.uint8), length)
        seen = Counter(text[i:i + length] for i in range(len(text) - length + 1))
        for i in range(len(text) - length + 1):
            if b"\xff" not in text[i:i + length]:
                assert got[i] == (seen[text[i:i + length]] > 1)


def texts(seed, n):
    r = random.Random(seed)
    words = [f"wort{i}" for i in range(300)] + ["é", "ß", "\n"]
    base = [" ".join(r.choice(words) for _ in range(r.randint(5, 300))) for _ in range(20)]
    out = []
    for _ in range(n):
        x, y, k = r.choice(base), r.choice(base), r.random()
        out.append(x if k < 0.2 else x[:len(x) // 2] + y[len(y) // 3:] if k < 0.7 else
                   " ".join(r.choice(words) for _ in range(r.randint(0, 200))))
    return out + [f"{i * 977} {base[0][50:450]} {i * 7919}" for i in range(30)]


def test_against_every_substring(spark):
    found = texts(2, 80) + ["ab" * 500, "z" * 150 + "é"]
    want = slow(found, 200)
    for hot in (2000, 3):  # 3: nearly every shared anchor is split
        got = dict(removed(spark, list(enumerate(found)), hot_pieces=hot))
        assert [got[i] for i in range(len(found))] == want
    assert sum(w[1] for w in want) > 10000


def test_query_on_a_small_table(spark, sf_docs):
    got = {r["doc_id"]: r for r in queries.op5_repeats(spark, SF).collect()}
    raws = {d: t.encode() for d, t in sf_docs}
    seen = set()
    twice = set()
    for r in raws.values():
        for i in range(len(r) - 199):
            h = hash(r[i:i + 200])
            (twice if h in seen else seen).add(h)
    for d, r in raws.items():
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if hash(r[i:i + 200]) in twice:
                gone[i:i + 200] = b"\1" * 200
        assert (got[d]["n_bytes"], got[d]["n_removed"]) == (len(r), sum(gone))


def test_large_group_is_cut_into_windows(monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 100)
    r = random.Random(4)
    middle = bytes(r.choice(b"abcd") for _ in range(30))
    group, raws = [], []
    for i in range(40):
        raw = bytes(r.choice(b"ab") for _ in range(6)) + middle + bytes(r.choice(b"ab") for _ in range(6))
        raws.append(raw)
        group.append(((i, 0, 0, raw, True), 6))
    got = {}
    for d, _, low, high in repeats.group_repeats(group, 33):
        for k in range(low, high):
            got.setdefault(d, set()).add(k)
    seen = Counter(x[i:i + 33] for x in raws for i in range(len(x) - 32))
    for i, x in enumerate(raws):
        want = {k for a in range(len(x) - 32) if seen[x[a:a + 33]] > 1 for k in range(a, a + 33)}
        assert got.get(i, set()) == want


def test_classes_cover_each_window_once_and_agree():
    r = random.Random(6)
    raw = bytes(r.choice(b"abcdef") for _ in range(150))
    for width in (1, 7, 16):
        windows = Counter()
        for key, low, high in repeats.classes(raw, 60, 100, width, 5):
            windows.update(range(low, high + 1))
            cut = raw[low:high + 100]  # a piece with fewer of the windows has the same key for them
            again = {k: (a, b) for k, a, b in repeats.classes(cut, 60 - low, 100, width, 5)}
            assert key in again
        assert windows == Counter(range(51))


def test_texts_of_one_doc_id_with_half_a_hash_in_common(spark):
    r = random.Random(9)
    passage, other = ("".join(r.choice("abcdefgh ") for _ in range(n)) for n in (260, 500))
    seen, pair = {}, None
    for i in range(400_000):
        text = f"{passage} {i}" if i % 2 else f"{i} {other}"
        h = xxhash.xxh64_intdigest(text.encode(), 42) % (1 << 31)
        if h in seen and (seen[h] - i) % 2:
            pair = (seen[h], i)
            break
        seen[h] = i
    found = [f"{passage} {i}" if i % 2 else f"{i} {other}" for i in pair]
    want = Counter(slow([*found, passage], 200))
    for doc_id in (None, 5):
        got = removed(spark, [(doc_id, t) for t in [*found, passage]])
        assert Counter(x for _, x in got) == want
    assert sorted(w[1] for w in want) == [0, 260, 260]


def test_edge_cases(spark):
    x = "".join(random.Random(1).choice("abcdefgh") for _ in range(260))
    rows = [(1, None), (2, ""), (None, x), (3, x[30:] + "tail"), (4, "short"), (5, "q" + x[:199]), (6, x[61:260] + "!")]
    got = dict(removed(spark, rows))
    want = slow([t for _, t in rows], 200)
    assert [got[d] for d, _ in rows] == want
    same = removed(spark, [(7, x), (7, x), (8, "own text")])
    assert sorted(s[1][:3] for s in same) == [(8, 0, 0), (260, 260, 1), (260, 260, 1)]
    out = repeats.remove_repeats(docs(spark, rows).withColumnRenamed("lang", "spans").withColumnRenamed("source", "tail"))
    assert out.count() == len(rows)
    assert repeats.remove_repeats(docs(spark, [])).count() == 0
