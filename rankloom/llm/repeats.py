"""Suffix-array dedup: removal of byte strings that occur twice or more.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, in the same document or another, is removed.  The strings meet without
moving all suffixes:

1. *Anchors.*  Each window of ``length`` bytes has an anchor: the substring
   of ``anchor`` bytes in it with the smallest hash.  Equal windows have
   equal anchors at equal places.  Runs of windows with one anchor are a
   piece (a run of starts); every window lies in exactly one piece.  Pieces
   meet by their anchor's hash; an anchor that occurs once has no repeat.
2. *Counts.*  Pieces equal byte for byte are collapsed to one with its
   count.  A piece that occurs twice is a repeat in all its windows.
3. *Index.*  What shares an anchor but differs is put, anchor by anchor,
   into the Burrows-Wheeler transform of a block of text.  Interval
   expansion goes breadth-first backwards: an interval of suffixes that
   begin with w yields, for each character c before them, the interval of
   cw; where the entry behind its end has no common-prefix length yet, it
   is the length of w.  So lengths are found in increasing order, and the
   expansion stops at ``length``: entries that were not reached separate
   suffixes with at least that much in common.
4. *Removal.*  Covered ranges meet their documents again.

An anchor with more than ``HOT_PIECES`` different pieces (a passage in very
many contexts) is split by the bytes that a narrow class of its windows has in
common, so it spreads over many tasks, and a group that is still larger than
a block is split by whole windows inside its task.

Defined cases
* null or empty text, or fewer than ``length`` bytes: nothing is removed;
* repeated rows and repeated doc_ids: each row is a document; rows equal in
  doc_id and text repeat each other and get the same result;
* null doc_id: a document like others;
* strings overlap freely, also with their own repeat; they are judged on
  the input and never cross documents;
* empty input: empty output; other columns pass through, an existing
  n_bytes, n_removed, n_spans, spans or kept is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import partitions, require, text_or_empty

LENGTH = 200
ANCHOR = 64
#: Bytes of text indexed together, and bytes hashed together.
BLOCK = 1 << 20
HASH_BLOCK = 1 << 21
#: Different pieces of one anchor from which on it is split, and windows in a class then.
HOT_PIECES = 2000
CLASS = 16

_LOW = np.uint64((1 << 24) - 1)
_ODD = 0x9E3779B97F4A7C15


# -- anchors -----------------------------------------------------------------

@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        out = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def substring_hashes(buf: np.ndarray, length: int) -> np.ndarray:
    """Hash of buf[i:i + length] for each i, from prefix sums modulo 2^64."""
    n = len(buf)
    power, inverse = _powers(max(HASH_BLOCK + 1, 1 << (n + 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        h = (sums[length:] - sums[:-length]) * inverse[:n - length + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
    return h


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    k, low = 1, values
    while 2 * k <= width:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    return np.minimum(low[:len(low) - (width - k)], low[width - k:]) if k < width else low


def pieces_of(docs: list[bytes], length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(document, start, windows, place of the anchor from start, anchor's
    hash, hash of the piece's bytes, repetitions) of the pieces of some
    documents.  In periodic text the same short piece follows itself; such
    a run is one row."""
    joined = b"".join(docs)
    buf = np.frombuffer(joined, np.uint8)
    empty = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    if len(buf) < length:
        return empty
    sizes = np.array([len(d) for d in docs])
    ends = np.cumsum(sizes)
    h = substring_hashes(buf, anchor)
    place = np.arange(len(h), dtype=np.uint64)
    at = _window_minima((h & ~_LOW) | (place & _LOW), length - anchor + 1)
    starts = np.arange(len(at))
    # the low bits of the place are enough to find it near its window
    at = starts + ((at.astype(np.int64) - starts) & int(_LOW))
    owner = np.repeat(np.arange(len(docs)), sizes)[:len(at)]
    whole = starts + length <= ends[owner]
    begins = whole.copy()
    begins[1:] &= (at[1:] != at[:-1]) | ~whole[:-1]
    first = np.flatnonzero(begins)
    if not len(first):
        return empty
    windows = np.flatnonzero(whole)
    last = windows[np.searchsorted(windows, np.append(first[1:], len(at))) - 1]
    digest = xxhash.xxh3_64_intdigest
    body = np.array([digest(joined[a:b + length]) for a, b in zip(first.tolist(), last.tolist())], np.uint64)
    doc, key, n = owner[first], h[at[first]], last - first + 1
    again = np.append(False, (doc[1:] == doc[:-1]) & (key[1:] == key[:-1]) & (body[1:] == body[:-1])
                      & (n[1:] == n[:-1]) & (first[1:] == last[:-1] + 1))
    run = np.flatnonzero(~again)
    times = np.diff(np.append(run, len(first)))
    first, doc, n, key, body = first[run], doc[run], n[run], key[run], body[run]
    return doc, first - (ends - sizes)[doc], n, at[first] - first, key, body, times


def all_pieces(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """(key, body, doc_id, tail, a, n, o, reps) of every piece of ``docs`` (doc_id, tail, text)."""
    names = ["key", "body", "doc_id", "tail", "a", "n", "o", "reps"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, tails = np.array(b.column("doc_id").to_pylist(), dtype=object), np.asarray(b.column("tail"))
            raw, at = b.column("text").cast(pa.binary()), 0
            while at < len(raw):
                block, size, begin = [], 0, at
                while at < len(raw) and (not block or size + (n := len(raw[at].as_buffer() or b"")) < HASH_BLOCK):
                    block.append(raw[at].as_py())
                    size += len(block[-1])
                    at += 1
                doc, a, n_, o, key, body, reps = pieces_of(block, length, anchor)
                doc = doc + begin
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(body.view(np.int64)), pa.array(ids[doc], pa.int64()),
                     pa.array(tails[doc], pa.int64()), pa.array(a, pa.int64()),
                     pa.array(n_.astype(np.int32)), pa.array(o.astype(np.int32)), pa.array(reps.astype(np.int32))], names)

    return docs.select("doc_id", "tail", "text").mapInArrow(
        batches, "key long, body long, doc_id long, tail long, a long, n int, o int, reps int")


def shared_pieces(pieces: DataFrame) -> DataFrame:
    """Pieces whose anchor occurs at least twice: (key, doc_id, tail, a, n,
    o, reps) and ``times`` their bytes occur, whether the row is the ``first`` of
    those, and how many different pieces (``kinds``) the anchor has."""
    names = ["key", "doc_id", "tail", "a", "n", "o", "reps", "times", "first", "kinds"]

    def judged(t: pa.Table) -> pa.RecordBatch:
        key, body = np.asarray(t["key"]), np.asarray(t["body"])
        new_key = np.append(True, key[1:] != key[:-1])
        new = new_key | np.append(True, body[1:] != body[:-1])
        group, kind = np.cumsum(new_key) - 1, np.cumsum(new) - 1
        reps = np.asarray(t["reps"])
        rows, times = (np.bincount(of, reps).astype(np.int64)[of] for of in (group, kind))
        kinds = np.bincount(group[new])[group]
        keep = np.flatnonzero(rows > 1)
        t = t.take(pa.array(keep))
        return pa.RecordBatch.from_arrays(
            [*[t[c].combine_chunks() if t.num_rows else pa.array([], t.schema.field(c).type) for c in names[:7]],
             pa.array(times[keep], pa.int64()), pa.array(new[keep]), pa.array(kinds[keep], pa.int64())], names)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last anchor, which may go on
        for b in it:
            if not b.num_rows:
                continue
            key = np.asarray(b.column("key"))
            before = np.flatnonzero(key != key[-1])
            cut = int(before[-1]) + 1 if len(before) else 0
            if cut or (held and held[-1].column("key")[-1].as_py() != key[0]):
                yield judged(pa.Table.from_batches([*held, b.slice(0, cut)] if cut else held))
                held = []
            held.append(b.slice(cut))
        if held:
            yield judged(pa.Table.from_batches(held))

    n = partitions(pieces.sparkSession)
    dealt = pieces.repartition(n, "key").sortWithinPartitions("key", "body", "doc_id", "tail", "a")
    return dealt.mapInArrow(batches, "key long, doc_id long, tail long, a long, n int, o int, reps int, "
                                     "times long, first boolean, kinds long")


# -- the index ---------------------------------------------------------------

def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` bytes at least, by doubling."""
    n = len(text)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = text.astype(np.uint64) + np.uint64(0)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:i + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.append(True, sorted_key[1:] != sorted_key[:-1])
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # a group's number is its first place
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = group, -1
    h = 8
    while h < depth:
        alone = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        at = order[open_]
        pair = (group[open_] << 32) + rank[np.minimum(at + h, n)] + 1
        by = np.argsort(pair, kind="stable")
        order[open_] = at[by]
        pair = pair[by]
        differs = np.append(True, pair[1:] != pair[:-1])
        new[open_] = differs
        group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = group
        h *= 2
    return order


def repeated_starts(text: np.ndarray, length: int, wall: int = 0xFF) -> np.ndarray:
    """Whether the string of ``length`` bytes from each place on also starts
    elsewhere, for strings without ``wall``.  ``length`` is at least 8."""
    n = len(text)
    order = suffix_order(text, length)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = text[order - 1]                       # the Burrows-Wheeler transform
    step = place[order - 1]                        # and where each suffix goes with that byte put before it
    first = np.zeros(n + 1, bool)                  # entries whose common-prefix length is known (shorter than length)
    first[0] = first[n] = True
    known = np.zeros((n, 8), np.uint8)
    for i in range(8):                             # lengths below eight come from the first eight bytes
        known[:max(0, n - i), i] = text[i:]
    eight = known.view(">u8").ravel()[order]
    first[1:n] = eight[1:] != eight[:-1]
    low = np.flatnonzero(first[:n])
    high = np.append(low[1:], n) - 1
    for _ in range(8, length):                     # intervals of w, |w| = 8, 9, ...: entries of length |w|
        if not len(low):
            break
        single = low == high
        one = low[single]
        one = one[before[one] != wall]
        lows, highs = [step[one]], [step[one]]
        a, b = low[~single], high[~single]
        if len(a):
            size = b - a + 1
            owner = np.repeat(np.arange(len(a)), size)
            at = np.arange(len(owner)) + np.repeat(a - np.append(0, np.cumsum(size)[:-1]), size)
            at, owner = at[before[at] != wall], owner[before[at] != wall]
            to, c = step[at], before[at]
            by = np.lexsort((to, owner)) if len(at) else at
            to, c, owner = to[by], c[by], owner[by]
            new = np.append(True, (c[1:] != c[:-1]) | (owner[1:] != owner[:-1])) if len(to) else np.empty(0, bool)
            lows.append(to[new])
            highs.append(to[np.append(new[1:], True)] if len(to) else to)
        low, high = np.concatenate(lows), np.concatenate(highs)
        fresh = ~first[high + 1]
        low, high = low[fresh], high[fresh]
        first[high + 1] = True
    same = np.flatnonzero(~first[:n])              # at least ``length`` in common with the suffix before
    out = np.zeros(n, bool)
    out[order[same]] = True
    out[order[same - 1]] = True
    return out


Piece = tuple[int | None, int, int, bytes, bool]  # doc_id, tail, start, bytes, whether an answer is wanted


def block_repeats(pieces: list[Piece], length: int) -> list[tuple[int | None, int, int, int]]:
    """Covered ranges (doc_id, tail, start, end) of the wanted pieces."""
    text = np.frombuffer(b"\xff".join(p[3] for p in pieces) + b"\xff", np.uint8)
    hit = repeated_starts(text, length)
    out, at = [], 0
    for doc_id, tail, start, raw, wanted in pieces:
        if wanted:
            mine = np.flatnonzero(hit[at:at + len(raw) - length + 1])
            if len(mine):
                cuts = np.flatnonzero(np.diff(mine) > 1)
                for lo, hi in zip(mine[np.append(0, cuts + 1)].tolist(), mine[np.append(cuts, len(mine) - 1)].tolist()):
                    out.append((doc_id, tail, start + lo, start + hi + length))
        at += len(raw) + 1
    return out


def classes(raw: bytes, anchor_at: int, length: int, width: int, key: int) -> Iterator[tuple[int, int, int]]:
    """A piece's windows in classes of ``width`` by the anchor's place in
    them: (key, first window, last window).  The key is of the bytes that all
    windows of a class have in common, so equal windows get equal keys."""
    last = len(raw) - length
    for c in range((anchor_at - last) // width, anchor_at // width + 1):
        low, high = max(0, anchor_at - width * c - width + 1), min(last, anchor_at - width * c)
        end = anchor_at - width * c - width + 1 + length
        common = raw[high:min(end, low + length)] if width == 1 else raw[anchor_at - width * c:end]
        yield xxhash.xxh64_intdigest(common, (key + c) % (1 << 64)), low, high


def group_repeats(group: list[tuple[Piece, int]], length: int) -> list[tuple[int | None, int, int, int]]:
    """Repeats among the pieces of one key.  A group beyond a block is cut
    into its windows, of which no string needs more than two."""
    if sum(len(p[3]) for p, _ in group) <= 4 * BLOCK:
        return block_repeats([p for p, _ in group], length)
    times: dict[int, int] = {}
    for (_, _, _, raw, _), _ in group:
        for h in substring_hashes(np.frombuffer(raw, np.uint8), length).tolist():
            times[h] = times.get(h, 0) + 1
    out, held, size = [], [], 0
    seen: dict[int, int] = {}
    pairs: dict[int, list[Piece]] = {}
    for (doc_id, tail, start, raw, wanted), _ in group:
        for i, h in enumerate(substring_hashes(np.frombuffer(raw, np.uint8), length).tolist()):
            if times[h] > 1:
                one = (doc_id, tail, start + i, raw[i:i + length], wanted)
                mate = pairs.setdefault(h, one)
                # each such window is indexed beside the first of its kind
                if mate is not one:
                    held += [(*mate[:4], mate[4] and not seen.get(h)), one]
                    seen[h] = 1
                    size += 2 * length
                    if size > BLOCK:
                        out += block_repeats(held, length)
                        held, size = [], 0
    return out + (block_repeats(held, length) if held else [])


def indexed(parts: DataFrame, length: int) -> DataFrame:
    """Covered ranges from ``parts`` (key, doc_id, tail, a, o, raw, wanted)."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows):
            cols = list(zip(*rows)) if rows else [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "tail", "low", "high"])

        block: list[Piece] = []
        group: list[tuple[Piece, int]] = []
        size, last = 0, None

        def close():  # the group of one key goes into the block, or is worked off alone
            nonlocal block, group, size
            own = sum(len(p[3]) for p, _ in group)
            rows = []
            if len(group) > 1 and any(p[4] for p, _ in group):
                if own > 4 * BLOCK:
                    rows = group_repeats(group, length)
                else:
                    block += [p for p, _ in group]
                    size += own
                    if size >= BLOCK:
                        rows = block_repeats(block, length)
                        block, size = [], 0
            group = []
            return rows

        for b in it:
            cols = [b.column(c).to_pylist() for c in ("key", "doc_id", "tail", "a", "o", "raw", "wanted")]
            found = []
            for key, doc_id, tail, a, o, raw, wanted in zip(*cols):
                if key != last:
                    found += close()
                    last = key
                group.append(((doc_id, tail, a, raw, wanted), o))
            yield done(found)
        found = close()
        yield done(found + (block_repeats(block, length) if block else []))

    n = partitions(parts.sparkSession)
    dealt = parts.repartition(n, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(batches, "doc_id long, tail long, low long, high long")


def piece_texts(docs: DataFrame, wanted: DataFrame, length: int, hot_pieces: int) -> DataFrame:
    """The bytes of the pieces to index; those of a hot anchor by classes."""
    lists = wanted.groupBy("doc_id", "tail").agg(
        F.collect_list(F.struct("key", "a", "n", "o", (F.col("times") == 1).alias("wanted"),
                                (F.col("kinds") > hot_pieces).alias("hot"))).alias("pieces"))
    joined = docs.join(lists.withColumnsRenamed({"doc_id": "_d", "tail": "_t"}),
                       F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tail") == F.col("_t"))).select(
        "doc_id", "tail", "text", "pieces")
    names = ["key", "doc_id", "tail", "a", "o", "raw", "wanted"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = b.column("text").cast(pa.binary())
            rows, size = [], 0
            for doc_id, tail, text, found in zip(
                    b.column("doc_id").to_pylist(), b.column("tail").to_pylist(), texts, b.column("pieces")):
                text = text.as_py()
                for p in found.as_py():
                    a, raw = p["a"], text[p["a"]:p["a"] + p["n"] - 1 + length]
                    if p["hot"]:
                        for key, low, high in classes(raw, p["o"], length, CLASS, p["key"]):
                            rows.append((np.uint64(key).astype(np.int64).item(), doc_id, tail, a + low,
                                         p["o"] - low, raw[low:high + length], p["wanted"]))
                    else:
                        rows.append((p["key"], doc_id, tail, a, p["o"], raw, p["wanted"]))
                    size += len(raw)
                if size > 8 * BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows, size = [], 0
            cols = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return joined.mapInArrow(batches, "key long, doc_id long, tail long, a long, o int, raw binary, wanted boolean")


# -- the operator ------------------------------------------------------------

def keyed(docs: DataFrame) -> DataFrame:
    """``_tail``, a 64-bit hash of the text, tells rows with one doc_id apart."""
    return docs.withColumn("text", text_or_empty()).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(
        "_tail", F.xxhash64("text"))


def covered(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """(doc_id, tail, low, high): byte ranges that repeats cover; they may
    overlap and touch."""
    shared = materialize(shared_pieces(all_pieces(docs, length, anchor)))
    twice = shared.filter("times > 1").select(
        "doc_id", "tail", F.col("a").alias("low"), (F.col("a") + F.col("n") * F.col("reps") - 1 + length).alias("high"))
    parts = piece_texts(docs, shared.filter("first and kinds > 1"), length, hot_pieces)
    return materialize(twice.unionByName(indexed(parts, length)))


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot_pieces: int = HOT_PIECES,
                   keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_bytes, n_removed, n_spans,
    spans (start and end of the removed runs) and kept (bytes)."""
    require(docs, ["doc_id", "text"])
    new = ["n_bytes", "n_removed", "n_spans", "spans", "kept"]
    keep = [c for c in keep or docs.columns if c not in new]
    held = keyed(docs)
    ranges = covered(held.select("doc_id", F.col("_tail").alias("tail"), "text"), length, anchor, hot_pieces).groupBy("doc_id", "tail").agg(
        F.sort_array(F.collect_set(F.struct("low", "high"))).alias("_ranges")).withColumnsRenamed(
        {"doc_id": "_d", "tail": "_t"})
    joined = held.join(ranges, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_tail") == F.col("_t")), "left")
    schema = T.StructType([held.schema[c] for c in keep] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("kept", T.BinaryType())])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for text, found in zip(b.column("text").cast(pa.binary()), b.column("_ranges")):
                raw, spans = text.as_py(), []
                for r in found.as_py() or []:
                    if spans and r["low"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r["high"])
                    else:
                        spans.append([r["low"], r["high"]])
                at, parts = 0, []
                for low, high in spans:
                    parts.append(raw[at:low])
                    at = high
                rows.append((len(raw), sum(h - a for a, h in spans), len(spans), spans, b"".join([*parts, raw[at:]])))
            cols = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, keep), *[pa.array(c, t) for c, t in zip(cols, types)]], [*keep, *new])

    return joined.select(*dict.fromkeys([*keep, "text", "_ranges"])).mapInArrow(batches, schema)
