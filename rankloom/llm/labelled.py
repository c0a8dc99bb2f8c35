"""A bounded sample of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int,
           extra: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """(doc_id, text, y and the columns ``extra``) of at most ``rows`` labelled documents outside the
    held-out fold, half of the places for each class, picked by a hash of the
    doc_id; and how many labels of each class there are.

    A doc_id with several labels counts as 1 if at least half of them are;
    null labels and null doc_ids are left out.  Of documents with one doc_id,
    however many, one is taken, by a hash of its text.  The picked labels (at most
    ``rows``) are what the join broadcasts."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.filter(remainder("doc_id", folds) != held_out)
    known = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id", F.lit(label)), "doc_id"]
    picked = known.filter("y = 0").orderBy(*order).limit(rows // 2).unionByName(
        known.filter("y = 1").orderBy(*order).limit(rows // 2))
    of = docs.select("doc_id", F.struct(F.xxhash64("text").alias("hash"), "text", *extra).alias("one")).join(F.broadcast(picked), "doc_id")
    one = of.groupBy("doc_id").agg(F.min("one").alias("one"), F.min("y").alias("y"))
    return one.select("doc_id", "one.text", "y", *[f"one.{c}" for c in extra]), counts
