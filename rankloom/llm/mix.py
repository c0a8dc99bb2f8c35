"""Mixing sources to target weights.

Every row gets a hash-random key.  Within a source the rows are dealt into
key ranges (keys are uniform, so ranges of equal width hold equally many
rows) and sorted there; running sums of the sizes inside each range plus
the totals of the ranges before it are a distributed prefix sum over the
whole source.  The mix takes whole epochs of a source and cuts the last one
exactly at the source's budget.

Main path: DataFrame functions only.

Defined cases
* null text, or text without words: size 0, nothing taken;
* null source: a source of its own, last in the order;
* null doc_id, repeated doc_ids, repeated rows: each row counts on its own;
  rows equal in every input column are interchangeable;
* a source without words: target 0;
* empty input: empty output;
* other columns of the input pass through untouched unless they carry one
  of the output's names, which then replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, require, text_or_empty

#: Rows that one key range should hold at most, and the fewest hex digits that number the ranges.
RANGE_ROWS = 50_000
MIN_DIGITS = 2

OUTPUT = ["size", "source_size", "target", "taken"]


def word_count(col: str = "text") -> Column:
    """Number of runs of anything but ASCII white space."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def cyclic_weights(order: Column) -> Column:
    """1, 2, 3, 1, 2, 3, ... by a source's place in the order of sources."""
    return ((order - 1) % 3 + 1).cast("long")


def source_targets(sizes: DataFrame, weight=cyclic_weights, max_epochs: int = 3) -> DataFrame:
    """Columns source, source_size, target from rows (source, source_size).

    The total of all sizes is shared by weight; a target stops at
    ``max_epochs`` times its source's size and the excess is shared again by
    weight among the others, until none is above.  In closed form: with the
    sources in ascending order of cap / weight, the first k are capped, where
    k is the smallest number for which (total - caps of the first k) / (their
    remaining weight) is at most the next source's cap / weight.

    The windows here have no partition key: they run over one row per
    *source*, never over documents."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", weight(F.row_number().over(order)))
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(max_epochs)).withColumn(
        "ratio", F.col("cap") / F.col("weight"))
    whole = W.partitionBy()
    rising = W.orderBy("ratio", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    level = weighed.select(
        "*",
        F.row_number().over(rising).alias("place"),
        F.sum("source_size").over(whole).alias("total"),
        F.sum("weight").over(whole).alias("weights"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    ).withColumn(
        "share", (F.col("total") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before")))
    level = level.withColumn(
        "level", F.min(F.when(F.col("share") <= F.col("ratio"), F.struct("place", "share"))).over(whole)["share"])
    return level.select(
        "source", "source_size",
        F.when(F.col("level").isNull() | (F.col("ratio") < F.col("level")), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double"))).alias("target"))


def mix_sources(docs: DataFrame, weight=cyclic_weights, max_epochs: int = 3,
                range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with size, source_size, target
    and taken: how many of the row's words the mix takes, repeats counted."""
    require(docs, ["doc_id", "source", "text"])
    docs = docs.drop(*[c for c in OUTPUT if c in docs.columns])
    out = take(with_size(docs), weight, max_epochs, range_rows, hold=False)
    return out.select(*docs.columns, *OUTPUT)


def with_size(docs: DataFrame) -> DataFrame:
    """Adds size, and _tie: the order among rows of one doc_id."""
    return docs.withColumn("size", word_count()).withColumn("_tie", F.md5(text_or_empty().cast("binary")))


def range_digits(rows: int, range_rows: int = RANGE_ROWS) -> int:
    """Hex digits of the key that number its range."""
    d = MIN_DIGITS
    while rows > range_rows * 16 ** d:
        d += 1
    return d


def take(sized: DataFrame, weight=cyclic_weights, max_epochs: int = 3,
         range_rows: int = RANGE_ROWS, hold: bool = True) -> DataFrame:
    """The mix over rows (doc_id, source, size, _tie, ...); ``hold`` writes
    them once instead of reading the documents for each of three passes."""
    sized = materialize(sized) if hold else sized
    digits = range_digits(sized.count(), range_rows)
    keyed = sized.withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    # a key without nulls, so that the join below reuses the window's partitioning
    keyed = keyed.withColumn("_range", F.substring("_key", 1, digits)).withColumn(
        "_src", F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source"))))

    # one row per (source, range): its total, and the totals of the ranges before it
    ranges = keyed.groupBy("_src", "_range").agg(F.sum("size").alias("_sum"), F.first("source").alias("_name"))
    by_source = W.partitionBy("_src").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sizes = ranges.groupBy("_src").agg(F.first("_name").alias("source"), F.sum("_sum").alias("source_size"))
    targets = source_targets(sizes.select("source", "source_size"), weight, max_epochs).select(
        F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source"))).alias("_src"),
        "source_size", "target")
    offsets = ranges.select(
        "_src", "_range", F.coalesce(F.sum("_sum").over(by_source), F.lit(0)).alias("_before")).join(targets, "_src")

    inside = W.partitionBy("_src", "_range").orderBy(
        "_key", F.col("doc_id").asc_nulls_last(), "_tie").rowsBetween(W.unboundedPreceding, -1)
    running = keyed.withColumn("_run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = running.join(offsets, ["_src", "_range"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before") - F.col("_run")))
    return out.withColumn("taken", (epochs * F.col("size") + part).cast("long")).drop(
        "_key", "_tie", "_range", "_src", "_run", "_before")


def apply_mix(mixed: DataFrame) -> DataFrame:
    """The mix as documents: a row for each whole time it is taken, and one
    cut after its last taken word for a part.  Rows that are not taken go."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    copies = F.when(whole > 0, F.array_repeat(F.lit(-1), whole)).otherwise(F.array().cast("array<int>"))
    copies = F.concat(copies, F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    rows = mixed.withColumn("_words", F.explode(copies))
    cut = F.when(F.col("_words") < 0, F.col("text")).otherwise(first_words("text", "_words"))
    rows = rows.withColumn("text", cut).drop("_words", *OUTPUT)
    return rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in rows.columns else rows


def first_words(text: str, n: str) -> Column:
    """The text up to the end of its n-th word, white space kept."""
    parts = F.regexp_extract_all(F.col(text), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(parts, F.lit(1), F.col(n)), "")


TAKEN_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS tie, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM sources),
ratios AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS ratio FROM weighed),
prefix AS (
  SELECT *, row_number() OVER (ORDER BY ratio, source ASC NULLS LAST) AS place, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(3 * source_size) OVER p, 0) AS cap_before, coalesce(sum(weight) OVER p, 0) AS weight_before
  FROM ratios WINDOW p AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
  SELECT *, CAST(total - cap_before AS DOUBLE) / CAST(weights - weight_before AS DOUBLE) AS share FROM prefix),
level AS (
  SELECT arg_min(share, place) AS level FROM shares WHERE share <= ratio),
targets AS (
  SELECT source, source_size,
         CASE WHEN level IS NULL OR ratio < level THEN CAST(3 * source_size AS DOUBLE)
              ELSE least(weight * level, CAST(3 * source_size AS DOUBLE)) END AS target
  FROM shares LEFT JOIN level ON TRUE),
running AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id ASC NULLS LAST, s.tie
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
budgets AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS budget FROM running),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM budgets)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM epochs
"""
