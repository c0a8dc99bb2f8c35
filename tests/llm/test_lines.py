from rankloom.llm import lines

from .conftest import docs

LINE = "a line that is long enough"


def kept(spark, rows, **kw):
    return {(r["doc_id"], r["text"]): r for r in lines.dedup_lines(docs(spark, rows), **kw).collect()}


def test_frequent_lines_stay_in_the_last_document(spark):
    rows = [(1, f"x\n{LINE}\ny"), (2, f"  {LINE.upper()}\t\n{LINE}"), (5, f"{LINE}\nz\n{LINE}"), (3, "short"), (4, "other")]
    got = {k[0]: (r["n_lines"], r["n_dropped"], r["kept"]) for k, r in kept(spark, rows).items()}
    assert got == {1: (3, 1, "x\ny"), 2: (2, 2, ""), 5: (3, 0, rows[2][1]), 3: (1, 0, "short"), 4: (1, 0, "other")}


def test_two_documents_and_short_keys_are_no_reason(spark):
    rows = [(1, LINE), (2, f"{LINE}\n{LINE}\n{LINE}"), (3, "nineteen chars long"), (4, "nineteen chars long"), (5, "nineteen chars long")]
    assert all(r["n_dropped"] == 0 for r in kept(spark, rows).values())


def test_accents_are_not_lowered(spark):
    rows = [(i, t) for i, t in enumerate(["É" * 20, "é" * 20, "É" * 20])]
    assert all(r["n_dropped"] == 0 for r in kept(spark, rows).values())


def test_edge_cases(spark):
    rows = [(None, LINE), (1, LINE), (1, LINE), (1, f"{LINE}\nq"), (2, None), (3, ""), (7, LINE)]
    out = lines.dedup_lines(docs(spark, rows).withColumnRenamed("lang", "kept").withColumnRenamed("source", "words")).collect()
    assert len(out) == len(rows)
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in out), key=str)
    assert got == sorted([(None, 1, 1, ""), (1, 1, 1, ""), (1, 1, 1, ""), (1, 2, 1, "q"), (2, 1, 0, ""), (3, 1, 0, ""),
                          (7, 1, 0, LINE)], key=str)
    assert lines.dedup_lines(docs(spark, [])).count() == 0


def test_long_document_uses_many_words_of_the_bitmap(spark):
    long = "\n".join([LINE if i % 3 == 0 else f"own line number {i}" for i in range(1000)])
    got = kept(spark, [(1, long), (2, LINE), (3, LINE)])
    r = got[1, long]
    assert (r["n_lines"], r["n_dropped"]) == (1000, 334)
    assert r["kept"] == "\n".join(f"own line number {i}" for i in range(1000) if i % 3)
    marks = lines.drop_bitmaps(docs(spark, [(1, long), (2, LINE), (3, LINE)])).collect()
    assert {m["doc"]: len(m["words"]) for m in marks} == {1: 16, 2: 1}


def test_one_key_in_all_documents_is_dealt_over_salts(spark):
    rows = [(i, f"{LINE}\nn{i}") for i in range(500)]
    got = kept(spark, rows, salts=8)
    assert sum(r["n_dropped"] for r in got.values()) == 499 and got[499, rows[499][1]]["n_dropped"] == 0
