import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rankloom.llm import packing, queries

from .conftest import SF, docs


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        tried = set()
        for b in range(len(bins)):
            if bins[b] + items[i] <= capacity and bins[b] not in tried:
                tried.add(bins[b])
                bins[b] += items[i]
                place(i + 1, bins)
                bins[b] -= items[i]
        bins.append(items[i])
        place(i + 1, bins)
        bins.pop()

    place(0, [])
    return best[0]


def sequences(rows):
    out = defaultdict(list)
    for s, low, high, first, times, offset in rows:
        for k in range(high - low):
            out[first + k // times].append((offset + k % times * s, s))
    return out


def gapless(places, capacity):
    end = 0
    for offset, length in sorted(places):
        assert offset == end
        end += length
    assert end <= capacity


def test_reduction_keeps_an_optimum_and_plan_is_whole():
    r = random.Random(1)
    for _ in range(250):
        capacity = r.choice([10, 20, 30])
        items = [r.randint(1, capacity) for _ in range(r.randint(1, 10))]
        counts = Counter(items)
        optimum = fewest(items, capacity)
        fixed, left = packing.reduce_instance(dict(counts), capacity)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + (fewest(rest, capacity) if rest else 0) == optimum
        found = sequences(packing.plan(dict(counts), capacity))
        for places in found.values():
            gapless(places, capacity)
        assert Counter(s for p in found.values() for _, s in p) == counts
        assert packing.lower_bound(dict(counts), capacity) <= optimum <= len(found) <= optimum + 1


def test_query_ids_equal_the_tokenizers_file(spark, sf_docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = queries.op2_packing(spark, SF).collect()
    by = {(r["doc_id"], r["piece"]): r for r in rows}
    for doc_id, text in sf_docs:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        n = len(ids) // 4
        for i, (start, length) in enumerate(packing.cut(n, 1024)):
            r = by.pop((doc_id, i))
            assert (r["start"], r["length"]) == (start, length) and length == (1024 if i or n % 1024 == 0 else n % 1024)
            assert r["ids_crc32"] == zlib.crc32(ids[4 * start:4 * (start + length)])
    assert not by
    found = defaultdict(list)
    for r in rows:
        found[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in found.values():
        gapless(places, 1024)
    bound = packing.lower_bound(Counter(r["length"] for r in rows), 1024)
    assert len(found) <= bound * 1.01 + 1


def test_memo_equals_whole_text():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    encode = packing.encoder()
    for text in ("", " ", "a", " a", "a ", "a  b", "a \n b", "a\n\n b c\n", "it's 'x  \t  y z", "<|endoftext|> q",
                 "é" * 300 + " ü ß", "ab " * 5 + "\r\n x", "a b c", "x" * 5000 + " " + "y" * 100):
        assert encode(text) == np.array(t.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), repr(text)


def test_added_tokens_have_the_ids_of_the_file_as_loaded(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(7)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}x", f"a  {end}  b\n", f"<|{end}|>", f"<|endoftext{end[1:]}", f" {end}",
             end[:-1], end.upper(), f"x{end}\u00e9 \u00fc", f"{'word ' * 1500}{end} {'word ' * 1500}"]
    texts += ["".join(r.choice([end, " ", "  ", "\n", "a", " it's", "<|", "|>", "9"]) for _ in range(12)) for _ in range(200)]
    assert t.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    rows = packing.pieces(docs(spark, list(enumerate(texts)))).collect()
    by = {(p["doc_id"], p["piece"]): (p["start"], p["length"], p["ids_crc32"]) for p in rows}
    want = {}
    for d, text in enumerate(texts):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        for i, (start, length) in enumerate(packing.cut(len(ids), 1024)):
            want[d, i] = (start, length, zlib.crc32(ids[start:start + length].tobytes()))
    assert by == want


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "word " * 3000), (3, "word " * 3000), (1, None)]
    out = packing.pack_documents(docs(spark, rows).withColumnRenamed("lang", "length")).collect()
    assert sum(1 for r in out if r["doc_id"] in (1, 2) and r["length"] == 1) == 3
    whole = sum(r["length"] for r in out if r["doc_id"] == 3)
    assert whole % 2 == 0 and whole > 6000
    found = defaultdict(list)
    for r in out:
        found[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in found.values():
        gapless(places, 1024)
    assert packing.pack_documents(docs(spark, [])).count() == 0


def test_without_the_tokenizers_file_there_are_no_ids(monkeypatch, tmp_path):
    packing.added_tokens.cache_clear()
    monkeypatch.setattr(public_tokenizers, "path", lambda name: str(tmp_path / name))
    with pytest.raises(FileNotFoundError):
        packing.added_tokens()
    packing.added_tokens.cache_clear()
