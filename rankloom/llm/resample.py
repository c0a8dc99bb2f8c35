"""Target-distribution importance resampling.

Documents are drawn so that their word features are distributed like those of
a target table.  Features are all runs of one to three words, hashed into
buckets (CRC-32 of their UTF-8 bytes modulo ``BUCKETS``).

* **Array-scored weights.**  One pass counts the buckets of the corpus, one
  those of the target; the two arrays (``BUCKETS`` numbers each, whatever the
  data) give one array of log gains.  A second pass over the texts looks up
  the gain of every feature and sums it per document.  Only distinct words
  are hashed; the checksum of a run comes from those of its words, since
  CRC-32 is linear: the checksum of "a b" is that of "a" moved by the length
  of " b", xor that of " b".
* **Gumbel key.**  The score adds a noise drawn from a hash of the doc_id, so
  that the largest scores are a sample without replacement by weight.
* **Distributed quickselect.**  The k-th largest composite key (score, doc_id,
  row) is found by rounds over the written scores: random rows of the open
  interval become pivots, one aggregate counts exactly how many keys are
  above, at or below each, and the interval between two pivots that holds the
  k-th stays open.  Every round keeps only counts and pivots (``PIVOTS`` of
  them) on the driver.  The winners alone are range-sorted and numbered.

Defined results: a null text has no features and weight 0; a null doc_id is
hashed as the empty string and comes first among ties; repeated rows are
documents of their own, of which each has its own rank; equal composite keys
are told apart by a row number that is fixed once the scores are written.
Texts of any length are read in slices of bounded size.  An empty target, an
empty corpus or one with fewer eligible documents than one draw needs gives
null ranks; the output has the columns named in ``OUTPUT``, extra input
columns and their names play no part unless asked for by ``keep``, which
stay as they are (a name of OUTPUT may not be kept).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.numbering import number_rows
from ..session import materialize
from .common import require, text_or_empty
from .words import Slice, Splitter

BUCKETS = 10_000
MIN_WORDS = 20     # documents with fewer words are never drawn
PERCENT = 5        # of the eligible documents
PIVOTS = 24        # per round
OUTPUT = ("n_features", "weight", "score", "rank")

#: Words are digits, ASCII letters and every byte of a longer UTF-8 sequence.
SPACES = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))


def _byte_step() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


class Shifts:
    """Moves a CRC-32 past so many bytes: ``shift(crc(a), len(b)) ^ crc(b)``
    is the checksum of a + b.  A move is linear over the bits, so it is four
    lookups of a byte each; the tables of a length are made when first met."""

    def __init__(self):
        step, bits = _byte_step(), (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None]))
        self._power = [(bits >> 8) ^ step[bits & 255]]  # by 1, 2, 4, 8 ... bytes
        self._identity, self._at, self.tables = bits, {}, np.zeros((0, 4, 256), np.uint32)

    @staticmethod
    def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]

    def places(self, lengths: np.ndarray) -> np.ndarray:
        """Where the tables of these lengths are."""
        known, inverse = np.unique(lengths, return_inverse=True)
        new = [int(n) for n in known if int(n) not in self._at]
        for n in new:
            table, j = self._identity, 0
            while n >> j:
                while len(self._power) <= j:
                    self._power.append(self._through(self._power[-1], self._power[-1]))
                if n >> j & 1:
                    table = self._through(self._power[j], table)
                j += 1
            self._at[n] = len(self.tables)
            self.tables = np.concatenate([self.tables, table[None]])
        return np.array([self._at[int(n)] for n in known], np.int64)[inverse]

    def move(self, crc: np.ndarray, place: np.ndarray) -> np.ndarray:
        t = self.tables
        return t[place, 0, crc & 255] ^ t[place, 1, (crc >> 8) & 255] ^ t[place, 2, (crc >> 16) & 255] ^ t[place, 3, crc >> 24]


class Features:
    """Buckets of the runs that end at each word, slice by slice of one task."""

    def __init__(self, buckets: int):
        self.buckets, self.shifts, self.splitter = buckets, Shifts(), Splitter(SPACES)
        self._before = np.zeros((0,), np.uint32), np.zeros((0,), np.uint32)  # a long text's last two words, last run of two

    def of(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(buckets x 3, there x 3): per word the runs of 1, 2 and 3 words that end there."""
        coded = part.words.dictionary_encode()
        known = coded.dictionary.cast(pa.binary()).to_pylist()
        code = coded.indices.to_numpy(zero_copy_only=False)
        alone = np.array([zlib.crc32(w) for w in known], np.uint32)
        spaced = np.array([zlib.crc32(b" " + w) for w in known], np.uint32)
        place = self.shifts.places(np.array([len(w) + 1 for w in known], np.int64)) if known else np.zeros(0, np.int64)
        one, tail, by = alone[code], spaced[code], place[code]
        n, row = len(one), part.row
        last_one, last_two = self._before if part.goes_on else (np.zeros(0, np.uint32),) * 2
        two, three = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        has_two, has_three = np.zeros(n, bool), np.zeros(n, bool)
        if n:
            first = row == part.first
            has_two[1:] = row[1:] == row[:-1]
            before = np.concatenate([last_one[-1:] if len(last_one) else np.zeros(1, np.uint32), one[:-1]])
            has_two[0] = len(last_one) > 0 and first[0]
            two[has_two] = self.shifts.move(before[has_two], by[has_two]) ^ tail[has_two]
            before = np.concatenate([last_two[-1:] if len(last_two) else np.zeros(1, np.uint32), two[:-1]])
            has_three[1:] = has_two[1:] & has_two[:-1]
            has_three[0] = has_two[0] and len(last_two) > 0
            three[has_three] = self.shifts.move(before[has_three], by[has_three]) ^ tail[has_three]
            self._before = one[-1:], two[-1:][has_two[-1:]]
        elif not part.goes_on:
            self._before = one, two
        return (np.stack([one, two, three]) % np.uint32(self.buckets)).astype(np.int64), np.stack([np.ones(n, bool), has_two, has_three])


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; each task hands on one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, total = Features(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in made.splitter.slices(batch.column(0)):
                bucket, there = made.of(part)
                total += np.bincount(bucket[there], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"])

    schema = StructType([StructField("bucket", IntegerType()), StructField("n", LongType())])
    return docs.select(text_or_empty(text).alias("text")).mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket in thousandths, from two tables of (bucket, n)
    with at most ``buckets`` rows each."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for table, into in ((corpus, s), (target, t)):
        for r in table.collect():
            into[r["bucket"]] = r["n"]
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (all_s + buckets) / ((int(a) + 1) * (all_t + buckets))))
                     for a, b in zip(s, t)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", keep: list[str] = ()) -> DataFrame:
    """``keep`` and n_words, n_features, weight of every document."""
    buckets = len(gain)
    kept = [f for f in docs.schema.fields if f.name in keep]
    schema = StructType(kept + [StructField(n, LongType()) for n in ("n_words", "n_features", "weight")])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features(buckets)
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for part in made.splitter.slices(batch.column(n_kept)):
                bucket, there = made.of(part)
                size = part.last - part.first + 1
                at = slice(part.first, part.last + 1)
                words[at] += np.bincount(part.row - part.first, minlength=size)
                for runs, ok in zip(bucket, there):
                    row = part.row[ok] - part.first
                    features[at] += np.bincount(row, minlength=size)
                    np.add.at(weight, part.row[ok], gain[runs[ok]])
            yield pa.RecordBatch.from_arrays(
                batch.columns[:n_kept] + [pa.array(x) for x in (words, features, weight)], names=[f.name for f in schema.fields])

    n_kept = len(kept)
    return docs.select(*[F.col(f"`{f.name}`") for f in kept], text_or_empty(text).alias("_text")).mapInArrow(score, schema)


def gumbel(doc_id: str = "doc_id", seed: int = 42):
    """The noise of a document in thousandths, from sha256 of ``seed:doc_id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _key(r) -> tuple:
    return r["a"], r["b"], r["c"]


def kth_key(keys: DataFrame, k: int, seed: int = 42, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest of the distinct long triples (a, b, c) in ``keys``,
    by quickselect; None where there are fewer."""
    at_or_below = lambda p: (F.struct("a", "b", "c") <= F.struct(*[F.lit(x).cast("long") for x in p]))
    low, rest, rounds = None, k, 0  # the key looked for is the rest-th above low
    open_ = keys
    while True:
        rounds += 1
        drawn = open_.agg(*[F.min_by(F.struct("a", "b", "c"), F.xxhash64("a", "b", "c", F.lit(seed + rounds * pivots + i))).alias(f"p{i}")
                            for i in range(pivots)]).head()
        found = sorted({_key(p) for p in drawn if p is not None})
        if not found:
            return None
        below = open_.agg(*[F.count_if(at_or_below(p)).alias(f"n{i}") for i, p in enumerate(found)],
                          *[F.count_if(F.struct("a", "b", "c") == F.struct(*[F.lit(x).cast("long") for x in p])).alias(f"e{i}")
                            for i, p in enumerate(found)], F.count(F.lit(1)).alias("n")).head()
        if rest > below["n"] or rest < 1:
            return None
        low, high, passed = None, None, 0
        for i, p in enumerate(found):
            upto, equal = below[f"n{i}"], below[f"e{i}"]
            if upto - equal < rest <= upto:
                return p
            if upto < rest:
                low, passed = p, upto
            elif high is None:
                high = p
        rest -= passed
        if low is not None:
            open_ = open_.filter(~at_or_below(low))
        if high is not None:
            open_ = open_.filter(at_or_below(high))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = 42,
             doc_id: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """Every document's doc_id, the columns in ``keep`` and ``OUTPUT``: the
    floor(percent * N / 100) documents with the highest scores, of the N with
    at least ``min_words`` words, have a rank."""
    require(docs, [doc_id, text, *keep])
    require(target, [text])
    keep = [doc_id, *[c for c in keep if c != doc_id]]
    clash = {*OUTPUT, "n_words"} & set(keep)
    if clash:
        raise ValueError(f"names of results can't be kept: {', '.join(sorted(clash))}")
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    scored = weigh(docs, gain, text, keep).withColumn("score", F.col("weight") + gumbel(doc_id, seed))
    row = "_row_of_resample"
    scored = materialize(scored.withColumn(row, F.monotonically_increasing_id()))
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    eligible = F.col("n_words") >= min_words
    a, b, c = -F.col("score"), number, F.col(row)
    keys = scored.filter(eligible).select(a.alias("a"), b.alias("b"), c.alias("c"))
    n = keys.count()
    last = kth_key(keys, percent * n // 100, seed) if percent * n // 100 else None
    out = [*keep, "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return scored.select(*out, none)
    drawn = eligible & (F.struct(a.alias("a"), b.alias("b"), c.alias("c")) <= F.struct(*[F.lit(x).cast("long") for x in last]))
    winners = number_rows(scored.filter(drawn), [F.desc("score"), F.asc_nulls_first(doc_id), F.asc(row)])
    return winners.select(*out, "rank").unionByName(scored.filter(~drawn).select(*out, none))
