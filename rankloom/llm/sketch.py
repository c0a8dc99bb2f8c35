"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the sorted array of the k smallest distinct 64-bit hashes of a
text's word shingles.  The sketch of a union is the k smallest of the two
sketches together, so sketches of parts merge without the parts.  Two
sketches estimate resemblance (Jaccard), containment and the number of
distinct shingles; where a sketch holds fewer than k hashes it is the whole
set and the figures are exact.

Main path: DataFrame functions only; a document is sketched inside its own
row, so nothing is exploded or shuffled for it.

Defined cases
* null or empty text, or text without words: the empty sketch; two empty
  sketches have resemblance and containment 1, an empty and a full one 0;
* fewer words than a shingle has: one shingle of all words;
* null doc_id: orders before every other doc_id;
* repeated doc_ids order by the hash of their text; repeated rows are
  interchangeable; each gets its own row of the result;
* a single document is its own next document; empty input: empty output;
* other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, require, text_or_empty

SHINGLE = 5
K = 128
#: Key ranges per shuffle partition when documents are dealt by doc_id.
RANGES = 4
NO_ID = -(1 << 63)


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_sketch(hashes: Column, size: int = SHINGLE, k: int = K) -> Column:
    """Sketch from a column of word hashes (an array held in a column of its
    own, since each element is read ``size`` times)."""
    n = F.size(hashes)
    full = F.transform(
        F.sequence(F.lit(0), n - size),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]))
    short = F.when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
    return bottom(F.when(n >= size, full).otherwise(short), k)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketched(df: DataFrame, text: str, out: str, size: int = SHINGLE, k: int = K) -> DataFrame:
    """``df`` with the sketch of column ``text`` in column ``out``."""
    return df.withColumn(f"_{out}_words", word_hashes(text_or_empty(text))).withColumn(
        out, shingle_sketch(F.col(f"_{out}_words"), size, k)).drop(f"_{out}_words")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what ``a`` and ``b`` sketch."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_by(df: DataFrame, keys: list[str], sketch: str, k: int = K, salts: int = 64) -> DataFrame:
    """One merged sketch per key.  A key's rows are dealt over ``salts``
    groups that keep k hashes each before they meet."""
    hashes = df.select(*keys, F.explode(sketch).alias("_h")).distinct()
    salted = hashes.withColumn("_salt", F.pmod(F.col("_h"), F.lit(salts)))
    low = salted.withColumn(
        "_n", F.row_number().over(W.partitionBy(*keys, "_salt").orderBy("_h"))).filter(F.col("_n") <= k)
    return low.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list("_h")), 1, k).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Exact below k; above, (k - 1) over the share of the hash range that
    the k-th hash has reached."""
    reached = (F.element_at(a, -1).cast("double") - float(NO_ID)) / float(2 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reached)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of a's shingles that b has, by inclusion and exclusion."""
    na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
    j = resemblance(a, b, k)
    both = j * (na + nb) / (1 + j)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / na))


def as_text(a: Column) -> Column:
    """A sketch as base64 of its hashes, eight bytes each, ascending."""
    digits = F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")
    return F.regexp_replace(F.base64(F.unhex(digits)), "[\r\n]", "")


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(doc_id, text, bucket, rank columns) dealt by ranges of doc_id, so
    that a window over a bucket sees each document and the next one.

    The bounds are values of doc_id taken at equal shares of the rows (their
    number depends on the number of partitions only).  The rows at a bound
    are also sent, as ``ghost``, to the end of the bucket before, and the
    very first ones to the end of the last bucket."""
    keyed = docs.select("doc_id", text_or_empty().alias("text")).withColumn(
        "_k", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    n = partitions(docs.sparkSession)
    ranges = ranges or RANGES * n
    found = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_k")).agg(
        F.min("_k").alias("least"),
        F.percentile_approx("_k", [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges).alias("at")).head()
    bounds = sorted({found["least"], *(found["at"] or [])}) if found["least"] is not None else [0]
    array, last = F.lit(bounds), len(bounds) - 1
    steps = [1 << i for i in reversed(range(max(1, math.ceil(math.log2(len(bounds) + 1)))))]
    below = F.aggregate(  # binary search: how many bounds are at most the key
        F.lit(steps), F.lit(0),
        lambda at, step: F.when(F.get(array, at + step - 1) <= F.col("_k"), at + step).otherwise(at))
    placed = keyed.withColumn("_b", below - 1)
    at_bound = F.get(array, F.col("_b")) == F.col("_k")
    before = F.when(F.col("_b") == 0, F.lit(last)).otherwise(F.col("_b") - 1)
    own = F.struct(F.col("_b").alias("bucket"), F.lit(False).alias("ghost"))
    placed = placed.withColumn("_to", F.explode(
        F.when(at_bound, F.array(own, F.struct(before.alias("bucket"), F.lit(True).alias("ghost"))))
        .otherwise(F.array(own))))
    return placed.select("doc_id", "text", "_k", "_to.bucket", "_to.ghost").repartition(n, "bucket")


def edited_fingerprints(docs: DataFrame, size: int = SHINGLE, k: int = K) -> DataFrame:
    """For every document: sketch; edited (its last floor(n/2) code points
    replaced by the first as many of the next document, in ascending order
    of doc_id, after the last the first) and edited_sketch; next_sketch."""
    require(docs, ["doc_id", "text"])
    dealt = sketched(with_next(docs), "text", "sketch", size, k)
    order = W.partitionBy("bucket").orderBy("ghost", "_k", "_tie")
    paired = dealt.withColumn("_tie", F.xxhash64("text")).select(
        "*", F.lead("text").over(order).alias("next_text"),
        F.lead("sketch").over(order).alias("next_sketch")).filter(~F.col("ghost"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = paired.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                           F.substring("next_text", F.lit(1), half)))
    return sketched(edited, "edited", "edited_sketch", size, k).drop("bucket", "ghost", "_k", "_tie", "next_text")
