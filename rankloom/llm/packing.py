"""Best-fit packing after Martello-Toth dominance reduction.

Pieces have one of ``capacity`` lengths, so an instance of any size is its
histogram: a count per length.  The plan works on that histogram alone, with
whole runs of equal sequences at a time, and its size depends on the
capacity, not on the documents:

* reduction: while some length's best company provably dominates every
  alternative (see ``dominating``), as many sequences of that make-up as
  the counts allow are fixed, and the instance shrinks;
* the remainder is packed best-fit in decreasing order.

Spark tokenizes and cuts the documents, counts lengths, ranks the pieces of
each length (ranges of hashed ids plus prefix sums, so that a length that
most pieces have is dealt over many tasks) and looks each rank up in the
plan.

Ids: a document's text by the byte-level BPE vocabulary, then the end id.
The ids are those of its tokenizers file, as loaded and without special tokens
put around the text.  Where the text has one of the file's added tokens, that
is one id; the parts between are encoded with the vocabulary's rank file, which
gives the same ids (the tests compare them) at a fraction of the time; words
are remembered within a Python worker, up to ``MEMO`` of them.

Defined cases
* null or empty text: one piece that holds the end id alone;
* text of any length is cut as a whole; strings of added tokens in it
  (``<|endoftext|>``) become the one id that the tokenizers file gives them;
* null doc_id, repeated doc_ids, repeated rows: each row is cut and packed
  on its own;
* empty input: empty output;
* other columns of the input are not read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import require

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
#: Words a Python worker remembers, and the longest of them in characters.
MEMO = 400_000
MEMO_CHARS = 64
#: Pieces that one rank range holds at most, and the fewest ranges of a length.
RANGE_ROWS = 50_000
MIN_RANGES = 256

_APART = re.compile(r" (?=\s|\Z)")


class _Ids(dict):
    """Word -> its ids with a space before it, as little-endian bytes."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(" " + word), dtype="<u4").tobytes()
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY):
    """Ordinary text, without added tokens -> ids as little-endian unsigned 32-bit bytes."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    encode = tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    memo = _Ids(encode)

    def ids(text: str) -> bytes:
        # a space before anything but white space always starts a token, so
        # the parts between such spaces can be encoded one by one
        if _APART.search(text):
            return np.array(encode(text), dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(encode(first), dtype="<u4").tobytes() + b"".join(map(memo.__getitem__, rest))

    return ids


@lru_cache(maxsize=2)
def added_tokens(vocabulary: str = VOCABULARY) -> dict[str, int]:
    """The added tokens of the tokenizers file and their ids.  Without that file the ids of texts
    that hold one are not known, which is an error."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    for t in added:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"{vocabulary}: added token {t['content']!r} does not stand for its string alone")
    return {t["content"]: t["id"] for t in added}


@lru_cache(maxsize=2)
def text_encoder(vocabulary: str = VOCABULARY):
    """Any text -> ids as little-endian unsigned 32-bit bytes."""
    ordinary = encoder(vocabulary)
    added = {t: np.array([i], dtype="<u4").tobytes() for t, i in added_tokens(vocabulary).items()}
    if not added:
        return ordinary
    # the longest of those that start at one place
    split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split

    def ids(text: str) -> bytes:
        parts = split(text)
        if len(parts) == 1:
            return ordinary(text)
        return b"".join(added[p] if i % 2 else ordinary(p) for i, p in enumerate(parts))

    return ids


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: whole pieces at the end, what is left
    over at the start."""
    head = n % capacity
    starts = ([0] if head else []) + list(range(head, n, capacity))
    return [(a, head if head and a == 0 else capacity) for a in starts]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
           vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    require(docs, ["doc_id", "text"])
    end = np.array([end_id], dtype="<u4").tobytes()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(vocabulary)
        for b in it:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = encode(text.as_py() or "") + end
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, i, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
            cols = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "doc_id long, piece int, start long, length long, ids_crc32 long")


# -- the plan: runs of sequences that are made up alike ---------------------

Run = tuple[list[tuple[int, int]], int]  # [(length, times)], number of sequences


def dominating(j: int, counts: dict[int, int], capacity: int) -> list[int] | None:
    """Company for one piece of length j that dominates every other choice,
    after Martello and Toth: [] alone, [a], [a, b], or None if unproven."""
    rest = capacity - j
    left = dict(counts)
    left[j] -= 1
    sizes = sorted(s for s, c in left.items() if c > 0)
    fitting = [s for s in sizes if s <= rest]
    if not fitting:
        return []
    a = fitting[-1]
    least = [s for s in sizes[:3] for _ in range(min(3, left[s]))][:3]
    if a == rest or len(least) < 2 or least[0] + least[1] > rest:
        return [a]  # a perfect fit, or no room for more than one
    if len(least) == 3 and sum(least) <= rest:
        return None  # room for three or more
    best, lo, hi = (0, 0, 0), 0, len(fitting) - 1
    while lo <= hi:  # the fullest pair, by two pointers
        x, y = fitting[hi], fitting[lo]
        if x + y > rest or (lo == hi and left[x] < 2):
            hi -= 1
            continue
        best = max(best, (x + y, x, y))
        lo += 1
    total, x, y = best
    if a >= total:
        return [a]
    above = [s for s in sizes if s > y]
    two = [s for s in above[:2] for _ in range(min(2, left[s]))][:2]
    if x == a and (len(two) < 2 or sum(two) > rest):
        return [x, y]
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """Runs that some optimal packing has, and the counts that are left."""
    counts, runs, changed = dict(counts), [], True
    while changed:
        changed = False
        for j in sorted(counts, reverse=True):
            while counts.get(j, 0):
                company = dominating(j, counts, capacity)
                if company is None:
                    break
                make_up: dict[int, int] = {}
                for s in [j, *company]:
                    make_up[s] = make_up.get(s, 0) + 1
                # the proof holds while the same lengths last: fewer other pieces only strengthen it
                times = min(counts[s] // n for s, n in make_up.items())
                runs.append((sorted(make_up.items(), reverse=True), times))
                for s, n in make_up.items():
                    counts[s] -= n * times
                counts = {s: c for s, c in counts.items() if c}
                changed = True
    return runs, counts


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit in decreasing order of length, whole runs at a time."""
    open_runs: dict[int, list[Run]] = {}
    for s in sorted(counts, reverse=True):
        left = counts[s]
        while left:
            room = min((r for r in open_runs if r >= s), default=None)
            make_up, times = open_runs[room].pop() if room is not None else ([], left)
            if room is not None and not open_runs[room]:
                del open_runs[room]
            room = capacity if room is None else room
            each = room // s
            used = min(times, left // each)
            if used:
                open_runs.setdefault(room - each * s, []).append((make_up + [(s, each)], used))
                left -= used * each
            if used < times and 0 < left < each:
                open_runs.setdefault(room - left * s, []).append((make_up + [(s, left)], 1))
                used, left = used + 1, 0
            if used < times and make_up:
                open_runs.setdefault(room, []).append((make_up, times - used))
    return [run for runs in open_runs.values() for run in runs]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: no packing has fewer sequences."""
    best = 0
    for alpha in range(0, capacity // 2 + 1):
        big = sum(c for s, c in counts.items() if s > capacity - alpha)
        half = sum(c for s, c in counts.items() if capacity // 2 < s <= capacity - alpha)
        space = sum((capacity - s) * c for s, c in counts.items() if capacity // 2 < s <= capacity - alpha)
        small = sum(s * c for s, c in counts.items() if alpha <= s <= capacity // 2)
        best = max(best, big + half + max(0, -(-(small - space) // capacity)))
    return best


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, low, high, first sequence, times, offset): of the pieces
    of a length, those ranked low to high - 1 fill ``times`` places each in
    sequences that follow the first, from the offset on."""
    fixed, left = reduce_instance({s: c for s, c in counts.items() if c}, capacity)
    rows, ranked, sequence = [], {}, 0
    for make_up, number in fixed + best_fit(left, capacity):
        offset = 0
        for s, times in make_up:
            low = ranked.get(s, 0)
            ranked[s] = low + times * number
            rows.append((s, low, ranked[s], sequence, times, offset))
            offset += s * times
        sequence += number
    return rows


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    spark = cut_pieces.sparkSession
    held = materialize(cut_pieces)
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan(counts, capacity)  # at most a few times ``capacity`` rows, whatever the input
    table = spark.createDataFrame(
        rows, "p_length long, low long, high long, first long, times long, at long")

    ranges = max(MIN_RANGES, -(-sum(counts.values()) // RANGE_ROWS))
    dealt = held.withColumn("_range", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(ranges)))
    sums = dealt.groupBy("length", "_range").agg(F.count("*").alias("_n"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(
        W.partitionBy("length").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = W.partitionBy("length", "_range").orderBy(F.col("doc_id").asc_nulls_first(), "piece", "ids_crc32", "start")
    ranked = dealt.withColumn("_row", F.row_number().over(inside)).join(before, ["length", "_range"]).withColumn(
        "_rank", F.col("_before") + F.col("_row") - 1)
    placed = ranked.join(
        F.broadcast(table),
        (F.col("length") == F.col("p_length")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high")))
    place = F.col("_rank") - F.col("low")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(place / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("at") + (place % F.col("times")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                   vocabulary: str = VOCABULARY) -> DataFrame:
    return pack(pieces(docs, capacity, end_id, vocabulary), capacity)
