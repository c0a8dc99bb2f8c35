"""The pipeline, stage by stage and as a whole, against plain Python."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
from rankloom.llm import packing, quality, simhash
from rankloom.llm.common import table
from rankloom.session import materialize

from .conftest import SF, SCHEMA, docs

SPACE = " \t\n\x0b\x0c\r"
TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "packing"]
    all_docs = table(spark, SF, "documents")
    judged, deduped, single, mixed, packed = (f for _, f in corpus_pipeline.STAGES)

    a = materialize(judged(spark, all_docs, SF))
    good = {r["doc_id"] for r in quality.classify(all_docs, table(spark, SF, "labels")).filter("predicted = 1").collect()}
    assert a.columns == all_docs.columns and {d for d, _ in rows(a)} == good

    b = materialize(deduped(spark, a, SF))
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACE).translate(TO_LOWER)
    for d, t in rows(a):
        for line in t.split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(d)
    want = {d: "\n".join(x for x in t.split("\n") if len(holders[key(x)]) < 3 or max(holders[key(x)]) == d) for d, t in rows(a)}
    assert dict(rows(b)) == want and all(r["n_chars"] == len(r["text"]) for r in b.collect())

    c = materialize(single(spark, b, SF))
    found = sorted((d, simhash.fingerprint(t)) for d, t in rows(b))
    first = {}
    for d, fp in found:  # ascending ids, so a component's first row is its smallest
        first[d] = next((e for e in first if first[e] is not None and (first[e] ^ fp).bit_count() <= 2), None)
        first[d] = fp if first[d] is None else None
    assert {d for d, _ in rows(c)} <= {d for d, _ in found}
    assert len(rows(c)) <= len(found) and len({d for d, _ in rows(c)}) == len(rows(c))
    fps = {d: fp for d, fp in found}
    for d, _ in rows(c):
        assert not any(e < d and (fps[e] ^ fps[d]).bit_count() <= 2 for e, _ in rows(c))

    m = materialize(mixed(spark, c, SF))
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes = {d: words(t) for d, t in rows(c)}
    taken = Counter()
    for d, t in rows(m):
        taken[d] += words(t)
    assert all(taken[d] <= 3 * sizes[d] for d in taken)
    assert abs(sum(taken.values()) - sum(sizes.values())) <= len({r["source"] for r in c.collect()})

    p = packed(spark, m, SF).collect()
    encode, pieces = packing.encoder(), Counter()
    for d, t in rows(m):
        pieces.update((d, i, s, n) for i, (s, n) in enumerate(packing.cut(len(encode(t)) // 4 + 1, 1024)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in p) == pieces


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:3] == ["doc_id", "piece", "start"] and out.count() > 0


def test_stages_on_an_empty_table_and_on_nulls(spark):
    for data in ([], [(None, None), (None, None), (1, ""), (1, ""), (2, None)]):
        d = docs(spark, data)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            d = materialize(stage(spark, d, SF))
            assert d.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() >= 0


def test_columns_of_any_name_go_through(spark):
    """Names that the operators use for their results or for themselves."""
    names = ["score", "predicted", "held_out", "kept", "n_lines", "size", "target", "_key", "_words", "_n", "_id", "taken", "row"]
    text = "good words in a plain document about {} and what else there is to say, at some length"
    df = docs(spark, [(i, text.format(i) + f"\nline {i}", "ab"[i % 2]) for i in range(40)])
    for i, name in enumerate(names):
        df = df.selectExpr("*", f"concat('{i}:', doc_id) AS `{name}`")
    now = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = materialize(stage(spark, now, SF))
        assert now.columns == df.columns, name
        if now.isEmpty():  # the classifier may reject such texts: go on with the documents themselves
            now = df
        for r in now.collect():
            assert [r[n] for n in names] == [f"{i}:{r['doc_id']}" for i in range(len(names))], name
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert not packed.isEmpty()
