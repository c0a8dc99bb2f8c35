"""SimHash near-dedup with pivot distance tables.

1. A fingerprint per document (Arrow batches, XXH64 of word shingles).
2. Equal fingerprints become one row with their smallest doc_id.
3. Each distinct fingerprint's Hamming distances to fixed pivots are
   computed once and travel with it as bytes.  Two fingerprints within
   ``bits`` differ by at most ``bits`` in every coordinate of that table.
4. Pairs meet in blocks: 64 bits are cut into ``bits + 2`` parts, and two
   fingerprints within ``bits`` agree on at least two of them, so one key
   for each pair of parts finds every link.  A block that holds more than
   ``block_rows`` fingerprints is cut again by its free bits (see
   ``finer``): what is left after that agrees on all but a byte, so no block
   is ever larger than 256.  Nothing is capped or skipped.
5. Inside a block, pairs are discarded by the maximum difference of their
   pivot coordinates, survivors are verified by popcount, and links leave
   as one edge per member to the smallest fingerprint it is joined to there.
6. Components of the edges by alternating large-star and small-star steps
   on Spark, each step written to the shared folder.

Defined cases
* null or empty text, or text without words: fingerprint zero, linked like
  any other; fewer words than a shingle has: one shingle of all words;
* repeated doc_ids: a doc_id is the smallest of its component once; rows
  with null doc_id link like others and never name a component unless it has
  no other document;
* repeated rows each keep their row; empty input: empty output;
* other columns pass through; an existing fingerprint or component_id is
  replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, release, scratch_path
from .common import partitions, require, text_or_empty

SHINGLE = 3
BITS = 2
PIVOTS = 16
#: Fingerprints in a block before it is cut by its free bits.
BLOCK_ROWS = 512
#: Hashes unpacked to bits at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - size + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(size, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, body, fp): body a hash of the
    text, which tells rows with one doc_id apart, fp a signed 64-bit integer."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fps = np.array([fingerprint(t.as_py(), size) for t in b.column("text")], dtype="<u8")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("body"), pa.array(fps.view("<i8"))], ["doc_id", "body", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_or_empty()).alias("body"),
                       F.col("text").cast("string")).mapInArrow(batches, "doc_id long, body long, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints, from a seeded generator."""
    return np.random.default_rng(64).integers(0, 2 ** 64, n, dtype=np.uint64)


def pivot_table(fps: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Hamming distances of the fingerprints to the pivots, one row each."""
    return np.bitwise_count(fps[:, None] ^ pivots(n)[None, :]).astype(np.uint8)


def block_masks(bits: int) -> list[int]:
    """64 bits in bits + 2 parts; a mask for each choice of two parts."""
    cuts = [64 * i // (bits + 2) for i in range(bits + 3)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(parts, 2)]


def finer(mask: int, bits: int) -> list[int]:
    """Masks that cut a block with ``mask`` again: its free bits in parts of
    at most 8 // bits bits, all but ``bits`` of them fixed.  Two members
    within ``bits`` agree on one of these at least."""
    free = [i for i in range(64) if not mask >> i & 1]
    width = max(1, 8 // max(1, bits))
    parts = [sum(1 << i for i in free[a:a + width]) for a in range(0, len(free), width)]
    whole = mask | sum(parts)
    return [whole & ~sum(left) for left in combinations(parts, min(bits, len(parts)))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    """(fp, pivot, block, key): a row for each mask, numbered by block."""
    keys = F.array(*[F.struct(F.lit(n).alias("block"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                     for n, m in enumerate(masks)])
    return fps.withColumn("_k", F.explode(keys)).select("fp", "pivot", "_k.block", "_k.key")


def linked(key: np.ndarray, fps: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """For rows sorted by (key, fp): the index of the smallest row each is
    joined to inside its block, by pivot filter, popcount and union."""
    n = len(fps)
    low = np.arange(n)
    pairs_a, pairs_b = [], []
    alive = np.arange(n)
    lag = 1
    while len(alive):  # all blocks at once, one lag after the other
        alive = alive[alive + lag < n]
        alive = alive[(key[alive] == key[alive + lag]).all(axis=1)]
        if len(alive):
            a, b = alive, alive + lag
            apart = np.abs(table[a].astype(np.int16) - table[b]).max(axis=1)
            a, b = a[apart <= bits], b[apart <= bits]
            near = np.bitwise_count(fps[a] ^ fps[b]) <= bits
            pairs_a.append(a[near])
            pairs_b.append(b[near])
        lag += 1
    a = np.concatenate(pairs_a) if pairs_a else np.empty(0, int)
    b = np.concatenate(pairs_b) if pairs_b else np.empty(0, int)
    while len(a):  # smallest label along the links until nothing changes
        before = low.copy()
        np.minimum.at(low, b, low[a])
        np.minimum.at(low, a, low[b])
        low = low[low]
        if (before == low).all():
            break
    return low


def block_edges(blocks: DataFrame, bits: int, n_pivots: int) -> DataFrame:
    """Edges (u, v) from rows dealt and sorted by (block, key, fp): u a member
    of a block, v the smallest one it is joined to there."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in it:
            held = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            block, key = np.asarray(held.column("block")), np.asarray(held.column("key"))
            last = np.flatnonzero((block != block[-1]) | (key != key[-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last block may go on in the next batch
            if cut:
                yield edges(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield edges(held)

    def edges(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.asarray(b.column("fp"))
        key = np.stack([np.asarray(b.column("block")).astype(np.int64), np.asarray(b.column("key"))], axis=1)
        table = np.frombuffer(b"".join(b.column("pivot").to_pylist()), dtype=np.uint8).reshape(len(fps), n_pivots)
        low = linked(key, fps.view(np.uint64), table, bits)
        at = np.flatnonzero(low != np.arange(len(low)))
        return pa.RecordBatch.from_arrays([pa.array(fps[at]), pa.array(fps[low[at]])], ["u", "v"])

    return blocks.select("block", "key", "fp", "pivot").mapInArrow(batches, "u long, v long")


def links(fps: DataFrame, bits: int = BITS, n_pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges between distinct fingerprints; joined by them are exactly those
    within ``bits`` of each other and what hangs together so."""
    def tables(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = pivot_table(np.asarray(b.column("fp")).view(np.uint64), n_pivots)
            yield pa.RecordBatch.from_arrays(
                [b.column("fp"), pa.array([r.tobytes() for r in rows], pa.binary())], ["fp", "pivot"])

    spark = fps.sparkSession
    n = partitions(spark)
    masks = block_masks(bits)
    coded = keyed(materialize(fps.mapInArrow(tables, "fp long, pivot binary")), masks)
    sizes = coded.groupBy("block", "key").agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
    shared = coded.join(sizes, ["block", "key"])
    even = shared.filter(F.col("rows") <= block_rows).select("fp", "pivot", "block", "key")
    inner = F.lit([[signed(m) for m in finer(mask, bits)] for mask in masks])
    hot = shared.filter(F.col("rows") > block_rows).select("fp", "pivot", "block", F.posexplode(
        F.get(inner, F.col("block"))).alias("part", "mask"))
    both = even.unionByName(hot.select(
        "fp", "pivot", (F.lit(1000) * (F.col("block") + 1) + F.col("part")).alias("block"),
        F.col("fp").bitwiseAND(F.col("mask")).alias("key")))
    dealt = both.repartition(n, "block", "key").sortWithinPartitions("block", "key", "fp")
    return block_edges(dealt, bits, n_pivots).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of the edges hangs together
    with.  Alternates large-star (every larger neighbour goes to the smallest
    one) and small-star (smaller neighbours go to the smallest) until the
    edges stop changing; a node's neighbours meet only as a minimum, and each
    step is a table in the shared folder."""
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v"), path)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        next_path = scratch_path(spark, "edges")
        then = materialize(small, next_path)
        mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
        same = now.agg(*mark).head() == then.agg(*mark).head()
        release(spark, path)
        now, path = then, next_path
        if same:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, bits: int = BITS, n_pivots: int = PIVOTS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, body, fp, root, component_id) for every row of ``docs``;
    root, the smallest fingerprint of a component, names it."""
    require(docs, ["doc_id", "text"])
    coded = materialize(fingerprints(docs, size))
    groups = coded.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(groups.select("fp"), bits, n_pivots, block_rows))
    named = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(least, "root").select("fp", "root", "component_id")
    return coded.join(classes, "fp").select("doc_id", "body", "fp", "root", "component_id")


def keep_first(docs: DataFrame, size: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` without near-duplicates: of each group one row with its
    smallest doc_id stays (null only where there is no other)."""
    found = near_duplicates(docs, size, bits)
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body")).alias("r"))
    keep = first.select(F.struct("r.doc_id", "r.body").alias("_id"))
    rows = docs.withColumn("_id", F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                                           F.xxhash64(text_or_empty()).alias("body")))
    kept = rows.join(keep, "_id", "left_semi")
    one = W.partitionBy("_id").orderBy(*[F.col(c).cast("string") for c in docs.columns if c != "text"])
    return kept.withColumn("_n", F.row_number().over(one)).filter("_n = 1").select(*docs.columns)
