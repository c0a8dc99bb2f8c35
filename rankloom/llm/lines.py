"""Line dedup: frequent lines go from every document but one.

The text of a document is split at \\n.  Each line's key (see ``line_key``)
is hashed to 128 bits; rows (hash, document, position) are range-partitioned
by (hash, salt) with a secondary sort by document and position, so that one
pass over a sorted stream sees each key's first occurrence in each document.
The salt, taken from the document, splits a key that fills a third of the
table over many ranges; what each range found (documents, last document) is
one row and is merged by hash.  What comes back per document is a bitmap of
its lines, 64 per word, of which only words with a dropped line are stored.
Text moves once, when the bitmaps are applied.

Main path: DataFrame functions only.

Defined cases
* null or empty text: one empty line, which stays;
* a line repeated within one document counts as one document; in the kept
  document all its lines stay;
* several rows with one doc_id are one document for the count; each row has
  its own bitmap (rows equal in text share one, and stay separate rows);
* null doc_id: a document of its own, below every other doc_id;
* empty input: empty output;
* other columns pass through; an existing n_lines, n_dropped or kept is
  replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import ASCII_SPACE, ascii_lower, partitions, require, text_or_empty

MIN_CHARS = 20
MIN_DOCS = 3
#: Ranges that one key's documents are dealt over.
SALTS = 64


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """Array with, for each line, the 128-bit hash of its key, or null where
    the key is too short to count.  Key: stripped of ASCII white space at
    both ends, A-Z lower-cased."""
    def hashed(line: Column) -> Column:
        key = F.btrim(line, F.lit(ASCII_SPACE))
        return F.when(F.length(key) >= min_chars,
                      F.struct(F.xxhash64(key).alias("a"), F.xxhash64(key, F.lit(1)).alias("b")))
    return F.transform(F.split(ascii_lower(text), "\n"), hashed)


def frequent(rows: DataFrame, min_docs: int) -> DataFrame:
    """(a, b, salt, keep): keys in at least ``min_docs`` documents, each
    salt that they occur with, and the last document that holds each.
    ``rows``: a, b, salt, doc, pos."""
    n = partitions(rows.sparkSession)
    dealt = rows.repartitionByRange(n, "a", "b", "salt")
    stream = W.partitionBy("a", "b", "salt").orderBy(F.col("doc").asc_nulls_first(), "pos")
    first = dealt.withColumn(
        "new", F.row_number().over(stream).eqNullSafe(1) | ~F.col("doc").eqNullSafe(F.lag("doc").over(stream)))
    found = first.filter("new").groupBy("a", "b", "salt").agg(
        F.count("*").alias("docs"), F.max("doc").alias("last"))
    return found.groupBy("a", "b").agg(
        F.sum("docs").alias("docs"), F.max("last").alias("keep"), F.collect_list("salt").alias("salts")).filter(
        F.col("docs") >= min_docs).select("a", "b", F.explode("salts").alias("salt"), "keep")


def drop_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 salts: int = SALTS) -> DataFrame:
    """(doc, body, words): for each document that loses lines, the words of
    its bitmap that aren't zero, as (word, bits); bit p % 64 of word p / 64
    is set where line p goes.  ``body`` is the hash of the row's text, which
    tells rows with one doc_id apart."""
    keys = docs.select(
        F.col("doc_id").alias("doc"), F.xxhash64(text_or_empty()).alias("body"),
        F.posexplode(line_keys(text_or_empty(), min_chars)).alias("pos", "key"))
    rows = materialize(keys.filter(F.col("key").isNotNull()).select(
        "doc", "body", "pos", "key.a", "key.b", F.pmod(F.xxhash64("doc"), F.lit(salts)).alias("salt")))
    keep = frequent(rows.select("a", "b", "salt", "doc", "pos"), min_docs)
    gone = rows.join(keep, ["a", "b", "salt"]).filter(~F.col("doc").eqNullSafe(F.col("keep")))
    words = gone.groupBy("doc", "body", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc", "body").agg(F.collect_list(F.struct("word", "bits")).alias("words"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                salts: int = SALTS) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept (the text that stays)."""
    require(docs, ["doc_id", "text"])
    docs = docs.drop(*[c for c in ("n_lines", "n_dropped", "kept") if c in docs.columns])
    marks = drop_bitmaps(docs, min_chars, min_docs, salts).select(
        F.struct("doc", "body").alias("_id"), F.col("words").alias("_words"))
    left = docs.withColumn("_id", F.struct(F.col("doc_id").alias("doc"), F.xxhash64(text_or_empty()).alias("body")))
    # a struct is never null itself, and its null fields compare equal: a plain equi-join
    joined = left.join(marks, "_id", "left")
    lines = F.split(text_or_empty(), "\n")
    dense = F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size(lines) - 1, 6)),
        lambda w: F.coalesce(F.get(F.filter(F.col("_words"), lambda x: x["word"] == w), F.lit(0))["bits"], F.lit(0)))
    stays = F.filter(
        F.col("_lines"),
        lambda line, i: F.getbit(F.get(F.col("_dense"), F.shiftright(i, 6)), F.pmod(i, F.lit(64))) == 0)
    changed = F.col("_words").isNotNull()
    return joined.withColumn("_lines", lines).withColumn("_dense", F.when(changed, dense)).withColumn(
        "_kept", F.when(changed, stays)).select(
        *docs.columns,
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(changed, F.size("_lines") - F.size("_kept")).otherwise(0).cast("long").alias("n_dropped"),
        F.when(changed, F.array_join("_kept", "\n")).otherwise(text_or_empty()).alias("kept"))


DEDUP_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT r, doc_id, string_split(text, chr(10)) AS lines FROM docs),
lines AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut),
keys AS (
  SELECT r, doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keep FROM keys WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.*, (f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.keep) AS gone
  FROM keys k LEFT JOIN frequent f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
