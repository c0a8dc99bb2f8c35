"""Name master join and code backfill (J-10..J-12, F-2..F-4, D-1, D-2, A-8, A-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def master_join(
    df: DataFrame,
    master: DataFrame | None,
    code: str = "corp_code",
    name: str = "corp_name",
) -> DataFrame:
    """J-10: left join the master on the code; an existing name wins, else
    the master's; the name column is created if absent.  Duplicate master
    codes fan out (as a left join does).  ``master=None`` (missing, lenient
    policy) returns the frame unchanged.

    No broadcast hint: Spark broadcasts a master whose file size is below its
    threshold, AQE one whose measured size is, and a larger one is shuffled."""
    if master is None:
        return df
    m = master.select(F.col(code), F.col(name).alias(name + "_master"))
    joined = df.join(m, code, "left")
    if name in df.columns:
        cols = [F.coalesce(F.col(name), F.col(name + "_master")).alias(name) if c == name else F.col(c) for c in df.columns]
        return joined.select(*cols)
    return joined.select(*df.columns, F.col(name + "_master").alias(name))


def name_code_mapping(past: DataFrame, code: str, name: str, on_ambiguous: str = "min") -> DataFrame:
    """Distinct non-null (name, code) pairs (D-1, F-4).  'min' reduces a name
    with several codes (F-3, A-8) to its smallest code (A-9, deterministic);
    'fanout' keeps them all.  Both are aggregations with map-side combine."""
    pairs = past.select(name, code).dropna("any")
    if on_ambiguous == "min":
        return pairs.groupBy(name).agg(F.min(code).alias(code))
    return pairs.distinct()


def backfill_code(
    df: DataFrame,
    past: DataFrame | None,
    code: str,
    name: str,
    on_ambiguous: str = "min",
) -> DataFrame:
    """J-11 (corp, 'min') / J-12 (customer, 'fanout'): rows with a null code
    and a known name (F-2) take the code the past table gives that name.

    With 'min' the mapping is unique per name, so the join cannot add rows.
    With 'fanout' an ambiguous name yields one row per candidate code, as in
    the original job.  Rows that already have a code are untouched."""
    if past is None or name not in df.columns or name not in past.columns or code not in past.columns:
        return df
    mapping = name_code_mapping(past, code, name, on_ambiguous).withColumnsRenamed(
        {code: code + "_fill", name: name + "_fill"}
    )
    need = F.col(code).isNull() & F.col(name).isNotNull()
    # only rows that need a code take part in the join condition
    joined = df.join(mapping, (F.col(name) == F.col(name + "_fill")) & need, "left")
    cols = [F.coalesce(F.col(code), F.col(code + "_fill")).alias(code) if c == code else F.col(c) for c in df.columns]
    return joined.select(*cols)


def dedupe_subset(df: DataFrame, subset: list[str], order_by: list[str] | None = None) -> DataFrame:
    """D-2: one row per ``subset`` value.  The survivor is the row with the
    smallest (order_by, remaining columns) tuple, chosen by a ``min(struct)``
    aggregate: deterministic, and partially aggregated map-side, so a hot
    key never gathers all its rows in one task."""
    rest = [c for c in df.columns if c not in subset]
    order = list(order_by or []) + [c for c in rest if c not in (order_by or [])]
    if not rest:
        return df.select(*subset).distinct()
    best = F.min(F.struct(*[F.col(c) for c in order])).alias("_best")
    return df.groupBy(*subset).agg(best).select(*subset, *[F.col("_best." + c).alias(c) for c in rest]).select(*df.columns)
