"""Reconciliation: totals before and after each step and their checks
(A-5..A-12, V-1..V-10, D-3..D-5).

Totals are tidy rows ``(level, fy, metric, total)``: one aggregate job per
level table (all columns in one ``agg``), never one job per column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.exprs import severity_absolute, severity_relative
from ..plans.spec import (
    HIGH_REL_PCT, MEDIUM_REL_PCT, PREMERGE_TOLERANCE_YEN, SEVERE_ABS_YEN, WARNING_ABS_YEN, FiscalSpec, LevelSpec, MergePolicy,
)
from .merge import stacked_groups

LEVEL_ORDER = ("corp", "customer", "customer_product")


#: Totals stay exact up to the report: sums of whole numbers never pass through double.
EXACT = "decimal(38,6)"


def exact_sum(df: DataFrame, c: str) -> Column:
    """Sum of a column as a decimal; integral columns are summed as decimals."""
    whole = df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long")
    return F.sum(F.col(c).cast("decimal(20,0)") if whole else F.col(c)).cast(EXACT)


def as_double(totals: DataFrame) -> DataFrame:
    """A report or totals table with plain doubles, for display and export."""
    return totals.select(*[
        F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in totals.schema.fields])


def _totals_one(df: DataFrame, level: str, cols: list[str], fiscal: FiscalSpec) -> DataFrame:
    info = fiscal.metric_of()
    pairs = [
        F.struct(
            F.lit(info[c][1]).alias("fy"),
            F.lit(info[c][0].name).alias("metric"),
            exact_sum(df, c).alias("total"),
        )
        for c in cols
    ]
    return df.agg(F.array(*pairs).alias("_t")).select(
        F.lit(level).alias("level"), F.inline("_t")
    )


def level_totals(
    dfs: dict[str, DataFrame | None],
    fiscal: FiscalSpec,
    metrics: tuple[str, ...] | None = None,
    rule: str = "each",
) -> DataFrame | None:
    """Column totals per level, year and metric.

    rule='all_levels' (A-5): a column counts only if every level has it, and
    an absent corp table gives no totals.  rule='corp' (A-6): a column counts
    if the corp table has it.  rule='each' (A-7): every level on its own."""
    info = fiscal.metric_of()
    wanted = [c for c in fiscal.all_year_columns() if metrics is None or info[c][0].name in metrics]
    present = {lv: df for lv, df in dfs.items() if df is not None}
    if rule in ("all_levels", "corp") and "corp" not in present:
        return None
    parts = []
    for lv, df in present.items():
        if rule == "all_levels":
            cols = [c for c in wanted if all(c in d.columns for d in present.values()) and len(present) == len(dfs)]
        elif rule == "corp":
            cols = [c for c in wanted if c in present["corp"].columns and c in df.columns]
        else:
            cols = [c for c in wanted if c in df.columns]
        if cols:
            parts.append(_totals_one(df, lv, cols, fiscal))
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b), parts)


def totals_precedence(current: DataFrame | None, past: DataFrame | None) -> DataFrame | None:
    """A-6 combined view: for each (level, fy, metric) the current table's
    total if it has one, else the past table's."""
    if current is None:
        return past
    if past is None:
        return current
    k = ["level", "fy", "metric"]
    j = current.alias("c").join(past.alias("p"), k, "full")
    return j.select(*k, F.coalesce(F.col("c.total"), F.col("p.total")).alias("total"))


def merge_totals(
    cur: dict[str, DataFrame],
    past: dict[str, DataFrame | None],
    levels: tuple[LevelSpec, ...],
    fiscal: FiscalSpec,
    policy: MergePolicy,
    stored: bool = False,
) -> DataFrame:
    """A-5..A-7 before and after a merge, from one pass over its inputs:
    (level, fy, metric, current, past, before, merged) for every year column
    that an input has.

    A level's two tables are stacked and grouped by key once.  The sums of
    each side per key add up to the totals of the inputs; what the merge makes
    of them (each row as often as the join repeats it, for either key policy)
    adds up to the total of the merge.  ``before`` is the current total, or
    the past one where the current table lacks the column (A-6).  A merged
    column without any value totals 0.  All levels end in one small table.
    ``stored``: the product tables are read from files (``merge.stacked_groups``)."""
    parts = []
    for lv in levels:
        c, p = cur[lv.name], past.get(lv.name)
        if p is None:
            p = c.drop(*fiscal.all_year_columns()).limit(0)
        keys = [k for k in lv.keys if k in c.columns and k in p.columns]
        info, nothing = fiscal.metric_of(), F.lit(None).cast(EXACT)
        g, values = stacked_groups(c, p, keys, fiscal, policy, stored and lv.name == "customer_product")
        wanted = [x for x in fiscal.all_year_columns() if f"{x}__c" in g.columns or f"{x}__p" in g.columns]
        g = g.select([s for x in wanted for s in (f"{x}__c", f"{x}__p") if s in g.columns] + [values[x].alias(x) for x in wanted])
        side = lambda x: exact_sum(g, x) if x in g.columns else nothing
        rows = [F.struct(F.lit(info[x][1]).alias("fy"), F.lit(info[x][0].name).alias("metric"), side(f"{x}__c").alias("current"),
                         side(f"{x}__p").alias("past"), (side(f"{x}__c") if f"{x}__c" in g.columns else side(f"{x}__p")).alias("before"),
                         exact_sum(g, x).alias("merged")) for x in wanted]
        parts.append(g.agg(F.array(*rows).alias("_t")).select(F.lit(lv.name).alias("level"), F.inline("_t")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def compare_absolute(
    before: DataFrame,
    after: DataFrame,
    severe: float = SEVERE_ABS_YEN,
    warning: float = WARNING_ABS_YEN,
) -> DataFrame:
    """V-1 / V-3 / D-5: before vs after per (level, fy, metric).

    diff = after - before; rate = |diff| / max(before, 1) * 100;
    severity: > severe 'severe', > warning 'warning', else 'minor'.
    status: 'ok' (equal), 'changed', 'lost' (before only: an issue that
    invalidates), 'new' (after only: allowed).  ``issue`` marks rows that
    count against the verdict."""
    k = ["level", "fy", "metric"]
    j = before.withColumnRenamed("total", "before").join(after.withColumnRenamed("total", "after"), k, "full")
    diff = F.col("after") - F.col("before")
    absd = F.abs(diff)
    status = (
        F.when(F.col("after").isNull(), "lost")
        .when(F.col("before").isNull(), "new")
        .when(F.col("after") == F.col("before"), "ok")
        .otherwise("changed")
    )
    sev = F.when(status == "changed", severity_absolute(absd, severe, warning))
    return j.select(
        *k,
        "before",
        "after",
        diff.alias("diff"),
        absd.alias("abs_diff"),
        F.when(diff > 0, "increase").when(diff < 0, "decrease").alias("direction"),
        (absd.cast("double") / F.greatest(F.col("before").cast("double"), F.lit(1.0)) * 100).alias("rate_pct"),
        sev.alias("severity"),
        status.alias("status"),
        ((status == "lost") | F.coalesce(sev.isin("severe", "warning"), F.lit(False))).alias("issue"),
    )


LEVEL_PAIRS = (("corp", "customer"), ("customer", "customer_product"), ("corp", "customer_product"))


def cross_level(after: DataFrame, pairs: tuple[tuple[str, str], ...] = LEVEL_PAIRS) -> DataFrame:
    """V-2: the after-totals of the levels must agree pairwise.  One row per
    (fy, metric, pair); ``issue`` when the two totals differ."""
    levels = sorted({lv for p in pairs for lv in p})
    wide = after.groupBy("fy", "metric").agg(
        *[F.max(F.when(F.col("level") == lv, F.col("total"))).alias(lv) for lv in levels]
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("level_a"), F.lit(b).alias("level_b"), F.col(a).alias("total_a"), F.col(b).alias("total_b"))
            for a, b in pairs
        ]
    )
    out = wide.select("fy", "metric", F.inline(rows))
    return out.select(
        "*",
        F.abs(F.col("total_a") - F.col("total_b")).alias("abs_diff"),
        (~F.col("total_a").eqNullSafe(F.col("total_b"))).alias("issue"),
    )


def verdict(absolute: DataFrame | None, cross: DataFrame) -> DataFrame:
    """V-4: one row.  Valid only with at least one compared column, no
    severe difference and zero issues.  (A failing verdict does not stop
    the save: the merge job returns it beside the data.)  Without a past
    there is nothing to compare with, and the levels alone decide."""
    if absolute is None:
        t = cross.agg(F.count(F.lit(1)).alias("n_columns"), F.lit(0).cast("long").alias("severe"),
                      F.coalesce(F.sum(F.col("issue").cast("int")), F.lit(0)).alias("issues"))
        return t.select("*", ((F.col("n_columns") > 0) & (F.col("issues") == 0)).alias("valid"))
    a = absolute.select(
        F.lit(1).alias("col"),
        F.col("issue").cast("int").alias("abs_issue"),
        (F.col("severity") == "severe").cast("int").alias("is_severe"),
        F.lit(0).alias("cross_issue"),
    )
    c = cross.select(
        F.lit(0).alias("col"), F.lit(0).alias("abs_issue"), F.lit(0).alias("is_severe"),
        F.col("issue").cast("int").alias("cross_issue"),
    )
    t = a.unionByName(c).agg(
        F.coalesce(F.sum("col"), F.lit(0)).alias("n_columns"),
        F.coalesce(F.sum("is_severe"), F.lit(0)).alias("severe"),
        F.coalesce(F.sum("abs_issue") + F.sum("cross_issue"), F.lit(0)).alias("issues"),
    )
    return t.select(
        "n_columns", "severe", "issues",
        ((F.col("n_columns") > 0) & (F.col("severe") == 0) & (F.col("issues") == 0)).alias("valid"),
    )


def premerge_conflicts(current_totals: DataFrame, past_totals: DataFrame, level: str = "corp", metric: str = "sales", tolerance: float = PREMERGE_TOLERANCE_YEN) -> DataFrame:
    """V-5 / V-6: a year present in both inputs whose corp-level totals differ
    by more than ``tolerance`` is a conflict; each conflict row carries the
    recommendation text."""
    k = ["level", "fy", "metric"]
    c = current_totals.where((F.col("level") == level) & (F.col("metric") == metric)).withColumnRenamed("total", "current")
    p = past_totals.where((F.col("level") == level) & (F.col("metric") == metric)).withColumnRenamed("total", "past")
    j = c.join(p, k, "inner")
    d = F.col("current") - F.col("past")
    return j.select(*k, "current", "past", d.alias("diff")).where(F.abs(d) > tolerance).select(
        "*", F.lit("check year overlap before merging; verify totals after the merge").alias("recommendation")
    )


#: V-6: what to do about the findings before the merge.
ADVICE_CONFLICT = ("take care that year columns are not overwritten when merging",
                   "verify the totals in detail after the merge")
ADVICE_NO_PAST = "the past table is empty: processing the current year alone is enough"


def premerge_advice(conflicts: int, past_is_empty: bool) -> list[str]:
    """V-6: both texts on a conflict, one more if there is no past."""
    return (list(ADVICE_CONFLICT) if conflicts else []) + ([ADVICE_NO_PAST] if past_is_empty else [])


def totals_text(totals: DataFrame) -> DataFrame:
    """S-17: totals as lines of text, with thousands separators."""
    return totals.select("level", "fy", "metric", F.format_number(F.col("total"), 0).alias("text"))


def compare_relative(before: DataFrame, after: DataFrame, high: float = HIGH_REL_PCT, medium: float = MEDIUM_REL_PCT, checkpoint: str | None = None) -> DataFrame:
    """V-7 / V-8: inner join of totals (keys missing on either side are
    ignored), null as 0, exact inequality; rel = |diff| / |before| * 100,
    0 when before is 0; severity 'high' > 10 %, 'medium' > 5 %, else 'low'."""
    k = ["level", "fy", "metric"]
    return relative_changes(before.withColumnRenamed("total", "before").join(after.withColumnRenamed("total", "after"), k, "inner"),
                            high, medium, checkpoint)


def relative_changes(both: DataFrame, high: float = HIGH_REL_PCT, medium: float = MEDIUM_REL_PCT, checkpoint: str | None = None) -> DataFrame:
    """:func:`compare_relative` of totals that are side by side (``before``, ``after``)."""
    k = ["level", "fy", "metric"]
    b = F.coalesce(F.col("before"), F.lit(0).cast(EXACT))
    a = F.coalesce(F.col("after"), F.lit(0).cast(EXACT))
    absd = F.abs(a - b)
    rel = F.when(b != 0, absd.cast("double") / F.abs(b).cast("double") * 100).otherwise(F.lit(0.0))
    out = both.where(a != b).select(
        *k, b.alias("before"), a.alias("after"), absd.alias("abs_diff"), rel.alias("rel_pct"), severity_relative(rel, high, medium).alias("severity")
    )
    if checkpoint is not None:
        out = out.select(F.lit(checkpoint).alias("checkpoint"), "*")
    return out


def checkpoint_report(checkpoints: dict[str, DataFrame | None]) -> DataFrame:
    """V-9: totals at each named checkpoint in one table."""
    parts = [t.select(F.lit(name).alias("checkpoint"), "*") for name, t in checkpoints.items() if t is not None]
    return reduce(lambda a, b: a.unionByName(b), parts)


def key_overlap(cur: DataFrame, past: DataFrame, key: str) -> DataFrame:
    """D-3 / D-4 / V-10: distinct key values only in current, only in past,
    in both (null counts as one value).  One shuffle: tag, union, group."""
    tagged = cur.select(F.col(key).alias("k"), F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(
        past.select(F.col(key).alias("k"), F.lit(0).alias("c"), F.lit(1).alias("p"))
    )
    per_key = tagged.groupBy("k").agg(F.max("c").alias("c"), F.max("p").alias("p"))
    return per_key.agg(
        F.sum(((F.col("c") == 1) & (F.col("p") == 0)).cast("long")).alias("only_current"),
        F.sum(((F.col("c") == 0) & (F.col("p") == 1)).cast("long")).alias("only_past"),
        F.sum(((F.col("c") == 1) & (F.col("p") == 1)).cast("long")).alias("both"),
    )


#: Codes of at most so many digits are numbers of bits.
CODE_DIGITS = 17
#: Bytes of one bitmap, and of one key in a shuffle.
BITMAP_BYTES, KEY_BYTES = 4096, 32


def key_overlap_bitmaps(cur: DataFrame, past: DataFrame, key: str) -> DataFrame:
    """:func:`key_overlap` without a shuffle of keys.

    A code of digits is a number (with a 1 before it, so that leading zeros
    count) and sets a bit of the bitmap of its bucket (32,768 numbers), for its
    side and for either; map tasks build the bitmaps, the shuffle merges those
    of a bucket, and their counts give the overlap.  Other keys, null too, go by
    :func:`key_overlap`.  Exact for any codes; worth it for dense ones, as
    :func:`dense_codes` tells (:func:`overlap` chooses by it)."""
    k = F.col(f"`{key}`").cast("string")
    coded = F.coalesce(k.rlike(f"^[0-9]{{1,{CODE_DIGITS}}}$"), F.lit(False))
    number = F.concat(F.lit("1"), k).cast("long")
    side = lambda df, c: df.filter(coded).select(number.alias("n"), F.lit(c).alias("c"))
    bit = F.bitmap_bit_position("n")
    counts = [F.bitmap_count(F.bitmap_construct_agg(x)).alias(name) for name, x in (
        ("a", F.when(F.col("c"), bit)), ("b", F.when(~F.col("c"), bit)), ("any", bit))]
    per_bucket = side(cur, True).unionByName(side(past, False)).groupBy(F.bitmap_bucket_number("n").alias("bucket")).agg(*counts)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    by_bits = per_bucket.agg(total(F.col("any") - F.col("b")).alias("only_current"), total(F.col("any") - F.col("a")).alias("only_past"),
                             total(F.col("a") + F.col("b") - F.col("any")).alias("both"), F.count(F.lit(1)).alias("found"))
    rest = key_overlap(cur.filter(~coded), past.filter(~coded), key).withColumn("found", F.col("both").isNotNull().cast("long"))
    names = ("only_current", "only_past", "both")  # null for tables without a key, as in key_overlap
    return by_bits.unionByName(rest).agg(*[F.when(F.sum("found") > 0, F.sum(n)).alias(n) for n in names])


def dense_codes(df: DataFrame, key: str) -> bool:
    """Are the bitmaps of a table's codes smaller than its distinct codes?
    One aggregate of two approximate counts."""
    k = F.col(f"`{key}`").cast("string")
    coded = df.filter(k.rlike(f"^[0-9]{{1,{CODE_DIGITS}}}$")).select(F.concat(F.lit("1"), k).cast("long").alias("n"))
    got = coded.agg(F.approx_count_distinct("n").alias("keys"), F.approx_count_distinct(F.bitmap_bucket_number("n")).alias("buckets")).head()
    return got["buckets"] * BITMAP_BYTES <= got["keys"] * KEY_BYTES


def overlap(cur: DataFrame, past: DataFrame, key: str) -> DataFrame:
    """The key overlap by bitmaps where both sides' codes are dense, else by keys."""
    dense = dense_codes(cur, key) and dense_codes(past, key)
    return (key_overlap_bitmaps if dense else key_overlap)(cur, past, key)


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A-10 / F-6: null count of every column, one ``agg`` for all."""
    cols = df.columns if cols is None else cols
    pairs = [F.struct(F.lit(c).alias("column"), F.sum(F.col(c).isNull().cast("long")).alias("nulls")) for c in cols]
    return df.agg(F.array(*pairs).alias("_p")).select(F.inline("_p"))


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """A-11: rows, column count, type, null count and null percentage per
    column (null percentage is null for an empty table)."""
    fields = df.schema.fields
    pairs = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.sum(F.col(f.name).isNull().cast("long")).alias("nulls"),
        )
        for f in fields
    ]
    agg = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*pairs).alias("_p"))
    return agg.select(
        F.lit(name).alias("table"), "rows", F.lit(len(fields)).alias("n_columns"), F.inline("_p")
    ).select(
        "table", "rows", "n_columns", "column", "dtype", "nulls",
        (F.col("nulls") * 100.0 / F.nullif(F.col("rows"), F.lit(0))).alias("null_pct"),
    )


def observe_totals(df: DataFrame, name: str, cols: list[str], null_in: str | None = None) -> tuple[DataFrame, Observation]:
    """A-7 + A-12 (+ F-6) during a write: row count, one exact sum per column
    and the nulls of ``null_in``, gathered by the write job itself
    (``Observation.get`` after the action)."""
    obs = Observation(name)
    nulls = F.count_if(F.col(null_in).isNull()) if null_in in df.columns else F.max(F.lit(0))
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), nulls.cast("long").alias("null_names"),
                      *[exact_sum(df, c).alias(c) for c in cols]), obs
