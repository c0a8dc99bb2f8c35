"""Multi-year merge: current-year level tables full-outer-merged with the
wide past tables (J-1..J-9, P-6..P-9).

Two physical shapes compute the same result:

* :func:`merge_level` - a full outer equi-join on the level keys followed by
  one projection that applies the key and conflict policies.  Used for the
  corp and customer levels, whose result keeps one row per joined pair.
* :func:`merge_reaggregate` - merge + product re-aggregation (A-3/A-4) as a
  single ``union`` + ``groupBy``: one shuffle with map-side partial sums
  instead of join exchange + sort-merge + re-aggregation exchange.  Row
  multiplicities of the join (a key repeated on one side repeats the other
  side's rows) are reproduced exactly from per-key row counts.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.exprs import null_double, sum0
from ..plans.spec import REP_NAME, FiscalSpec, LevelSpec, MergePolicy

PAST = "_past"


def year_column_universe(fiscal: FiscalSpec) -> set[str]:
    """Every ``{metric}_{fy}`` name in the year range, wanted or not (e.g. an
    earlier year's quantity, which the merge discards)."""
    return {fiscal.col(m.name, fy) for fy in fiscal.years_desc() for m in fiscal.metrics}


def add_missing_years(df: DataFrame, fiscal: FiscalSpec) -> DataFrame:
    """P-8: every wanted year column absent from ``df`` becomes a null double."""
    missing = [c for c in fiscal.all_year_columns() if c not in df.columns]
    return df.select("*", *[null_double().alias(c) for c in missing]) if missing else df


def _year_value(c: str, fy: int, fiscal: FiscalSpec, policy: MergePolicy, cur_cols: set[str], past_cols: set[str]) -> Column:
    """One merged year column under the conflict policy (J-7 / J-8)."""
    pc = c + PAST
    if fy == fiscal.current_fy:
        # the current year is never taken from the past table
        return F.col(c) if c in cur_cols else null_double()
    if c in past_cols:
        if policy.conflict == "overwrite" or c not in cur_cols:
            return F.col(pc)
        return F.coalesce(F.col(c), F.col(pc))
    return F.col(c) if c in cur_cols else null_double()


def without_empty(past: dict[str, DataFrame | None]) -> dict[str, DataFrame | None]:
    """F-5: a past table without rows counts as none (J-9, V-6).  Reads the
    first row at most."""
    return {k: None if p is None or p.isEmpty() else p for k, p in past.items()}


#: How many heavy keys a side may have: a key of more than 1/64 of its rows is found.
HEAVY_KEYS = 64
#: Over how many salts a key is dealt at most: the other side's rows of it are copied as often.
MOST_SALTS = 256


def _whole(keys: list[str]) -> Column:
    return reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])


def heavy_keys(df: DataFrame, keys: list[str], rows_in_task: int) -> dict[int, int]:
    """Hashes of keys that hold more than ``rows_in_task`` rows, with their
    approximate counts, from one pass with a frequency sketch of bounded size."""
    hashed = f"xxhash64({', '.join(f'`{k}`' for k in keys)})"
    got = df.filter(_whole(keys)).agg(F.expr(f"approx_top_k({hashed}, {HEAVY_KEYS}, {16 * HEAVY_KEYS})").alias("top")).head()["top"]
    return {r["item"]: r["count"] for r in got or [] if r["count"] > rows_in_task}


def full_join(cur: DataFrame, past: DataFrame, keys: list[str], rows_in_task: int = 1_000_000) -> DataFrame:
    """``cur.join(past, keys, "full")`` where a key, or null, may hold a
    large part of the rows of both sides.

    Rows with a null in a key match nothing: they by-pass the join.  Keys
    with more than ``rows_in_task`` rows are split: the side that has more
    rows of a key deals them over salts by a hash of the whole row, the other
    side's rows of that key go to every salt.  A key is only split where both
    sides have it: each of its rows has a match, so these keys need an inner
    join only, which makes pairs many times faster than a full one.  All
    other rows meet without salts."""
    left, right = heavy_keys(cur, keys, rows_in_task), heavy_keys(past, keys, rows_in_task)
    extra_cur, extra_past = ([c for c in df.columns if c not in keys] for df in (cur, past))
    cols = [*keys, *extra_cur, *extra_past]
    nothing = lambda df, names: [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names]
    loose = cur.filter(~_whole(keys)).select("*", *nothing(past, extra_past)).select(*cols).unionByName(
        past.filter(~_whole(keys)).select("*", *nothing(cur, extra_cur)).select(*cols))
    cur, past = cur.filter(_whole(keys)), past.filter(_whole(keys))
    found = sorted({*left, *right})
    if found:  # at most 2 * HEAVY_KEYS
        for df in (cur, past):
            there = df.select(F.xxhash64(*keys).alias("h")).filter(F.col("h").isin(found)).distinct().collect()
            found = sorted(r["h"] for r in there)
            if not found:
                break
    if not found:
        return cur.join(past, keys, "full").select(*cols).unionByName(loose)
    most = max(max(left.get(h, 0), right.get(h, 0)) for h in found)
    salts = max(2, min(MOST_SALTS, -(-2 * most // max(rows_in_task, 1))))  # half a share each: their hashes fall more evenly
    by_cur = [h for h in found if left.get(h, 0) >= right.get(h, 0)]
    by_past = [h for h in found if h not in by_cur]

    def salted(df: DataFrame, dealt: list[int], copied: list[int]) -> DataFrame:
        h = F.xxhash64(*keys)
        one = F.array(F.pmod(F.xxhash64(F.struct(*df.columns), F.lit(1)), F.lit(salts)).cast("int"))
        salt = F.when(h.isin(copied), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(one) if copied else one
        return df.filter(h.isin([*dealt, *copied])).withColumn("_salt", F.explode(salt))

    light = ~F.xxhash64(*keys).isin(found)
    split = salted(cur, by_cur, by_past).join(salted(past, by_past, by_cur).hint("merge"), [*keys, "_salt"])
    rest = cur.filter(light).join(past.filter(light), keys, "full")
    return split.select(*cols).unionByName(rest.select(*cols)).unionByName(loose)


def merge_level(
    cur: DataFrame,
    past: DataFrame | None,
    level: LevelSpec,
    fiscal: FiscalSpec,
    policy: MergePolicy,
    rows_in_task: int | None = None,
) -> DataFrame:
    """Full outer merge of one level (J-1..J-8).

    * J-9: no past table -> the current table, unchanged.
    * J-4: join keys are the level keys present on both sides.
    * keys='coalesce': a USING full join (key = coalesce(left, right));
      keys='left': past-only rows keep null keys (the right keys are dropped).
    * id columns (non-year, non-key, e.g. corp_name) are filled from the past
      only where null; year columns follow ``policy.conflict``; wanted year
      columns absent on both sides are null doubles; other past columns
      (current-year values, earlier-year quantity) are discarded.
    * ``rows_in_task`` (keys='coalesce' only) splits keys with more rows than
      that and lets null keys by-pass the join (:func:`full_join`); it looks
      for them in one pass over each side first.
    """
    if past is None:
        return cur
    join_keys = [k for k in level.keys if k in cur.columns and k in past.columns]
    if not join_keys:
        raise ValueError(f"the past table of level {level.name} has none of the key columns {', '.join(level.keys)}")
    universe = year_column_universe(fiscal)
    cur_years = {c for c in cur.columns if c in universe}
    past_years = {c for c in past.columns if c in universe}
    cur_ids = [c for c in cur.columns if c not in universe and c not in join_keys]
    past_ids = [c for c in past.columns if c not in universe and c not in join_keys]

    if policy.keys == "left":
        p = past.withColumnsRenamed({c: c + PAST for c in past.columns})
        cond = reduce(and_, [cur[k] == p[k + PAST] for k in join_keys])
        joined = cur.join(p, cond, "full")
        key_cols = [cur[k].alias(k) for k in join_keys]
    else:
        p = past.withColumnsRenamed({c: c + PAST for c in past.columns if c not in join_keys})
        joined = cur.join(p, join_keys, "full") if rows_in_task is None else full_join(cur, p, join_keys, rows_in_task)
        key_cols = [F.col(k) for k in join_keys]

    id_cols = []
    for c in cur_ids:
        id_cols.append(F.coalesce(F.col(c), F.col(c + PAST)).alias(c) if c in past_ids else F.col(c))
    for c in past_ids:
        if c not in cur_ids:
            id_cols.append(F.col(c + PAST).alias(c))

    year_cols = [
        _year_value(c, fy, fiscal, policy, cur_years, past_years).alias(c)
        for fy in fiscal.years_desc()
        for c in fiscal.year_columns(fy)
    ]
    return joined.select(*key_cols, *id_cols, *year_cols)


def reaggregate(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """A-3 / A-4: group by the keys present and sum every numeric column
    (an all-null group sums to 0); non-numeric non-key columns vanish.
    With no key or no numeric column the frame is returned unchanged."""
    keys = [k for k in keys if k in df.columns]
    numeric = [f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, NumericType)]
    if not keys or not numeric:
        return df
    return df.groupBy(*keys).agg(*[sum0(c).alias(c) for c in numeric])


def product_group_keys(level: LevelSpec, df: DataFrame, policy: MergePolicy) -> list[str]:
    """Keys of the product re-aggregation: the retired rep_name is kept as a
    key (annual) or dropped beforehand (quarter)."""
    keys = list(level.keys)
    if policy.keep_rep_name and REP_NAME in df.columns:
        keys.insert(1, REP_NAME)
    return keys


def _stackable(cur: DataFrame, past: DataFrame, level: LevelSpec, fiscal: FiscalSpec, policy: MergePolicy) -> bool:
    universe = year_column_universe(fiscal)
    if policy.keys != "coalesce":
        return False
    if any(k not in cur.columns or k not in past.columns for k in level.keys):
        return False
    if policy.keep_rep_name and REP_NAME in past.columns:
        return False
    for df in (cur, past):
        for f in df.schema.fields:
            if f.name in level.keys or f.name in universe or f.name == REP_NAME:
                continue
            if isinstance(f.dataType, NumericType):
                return False  # another summed column: use the join path
    return True


def merge_reaggregate(
    cur: DataFrame,
    past: DataFrame | None,
    level: LevelSpec,
    fiscal: FiscalSpec,
    policy: MergePolicy,
    stacked: bool | None = None,
    stored: bool = False,
    in_ranges: bool = False,
) -> DataFrame:
    """Merge + product re-aggregation (J-3 then A-3/A-4).

    ``stacked=None`` picks the one-shuffle form whenever it is exact
    (coalesce keys, no rep_name group key, no extra numeric columns).
    ``stored``, ``in_ranges``: see :func:`stacked_groups`."""
    if past is None:
        out = cur.drop(REP_NAME) if not policy.keep_rep_name else cur
        return reaggregate(out, product_group_keys(level, out, policy))
    if stacked is None:
        stacked = _stackable(cur, past, level, fiscal, policy)
    if not stacked:
        merged = merge_level(cur, past, level, fiscal, policy)
        if not policy.keep_rep_name:
            merged = merged.drop(REP_NAME)
        return reaggregate(merged, product_group_keys(level, merged, policy))
    return _merge_stacked(cur, past, level, fiscal, policy, stored, in_ranges)


def _merge_stacked(cur: DataFrame, past: DataFrame, level: LevelSpec, fiscal: FiscalSpec, policy: MergePolicy, stored: bool = False,
                   in_ranges: bool = False) -> DataFrame:
    """Exact stacked form of ``groupBy(keys).sum()`` over the full join.

    Per key K let m, n be the row counts of K on the current and the past
    side, and call K matched when it has no null component and m, n > 0
    (null keys never match in a join).  A matched K yields m*n joined rows,
    so a current-side sum S_c becomes n*S_c and a past-side sum S_p becomes
    m*S_p; an unmatched K yields its m + n rows unpaired.  Under the
    'fill_null' policy a joined pair takes the current value unless it is
    null: n*S_c + z*S_p with z the number of current rows whose value is null.
    """
    keys = list(level.keys)
    g, values = stacked_groups(cur, past, keys, fiscal, policy, stored, in_ranges)
    return g.select(*keys, *[v.alias(c) for c, v in values.items()])


def may_lie_in_ranges(cur: DataFrame, past: DataFrame | None, level: LevelSpec, fiscal: FiscalSpec, policy: MergePolicy) -> bool:
    """Can :func:`merge_reaggregate` leave its rows in ranges of the keys, in
    the order that the ranking gives them (codes as text)?"""
    return past is not None and _stackable(cur, past, level, fiscal, policy) and all(
        isinstance(df.schema[k].dataType, StringType) for df in (cur, past) for k in level.keys)


def _packed(stacked: DataFrame, keys: list[str], years: dict[str, int], metrics: dict[str, str]) -> tuple[DataFrame, list[Column]]:
    """The stacked rows with their year columns in one list, and the sums that
    take them out of its entries (``_value``) again.

    Most rows have a value in one year of many.  The list holds an entry for
    each year and side with a value, so that an exchange carries no empty
    columns: ``years`` and ``metrics`` tell both of a column.  Columns of one
    metric share a field where their types are equal."""
    fields: dict[tuple[str, str], str] = {}
    places: dict[tuple[int, str], dict[str, str]] = {}
    for c, metric in metrics.items():
        kind = stacked.schema[c].dataType.simpleString()
        field = fields.setdefault((metric, kind), f"v{len(fields)}")
        places.setdefault((years[c], c[-3:]), {})[field] = c
    kinds = {field: kind for (_, kind), field in fields.items()}
    entries, sums = [], []
    for i, at in enumerate(places.values()):
        value = lambda field, at=at: F.col(at[field]) if field in at else F.lit(None).cast(kinds[field])
        entry = F.struct(F.lit(i).alias("at"), *[value(field).alias(field) for field in kinds])
        entries.append(F.when(reduce(or_, [F.col(c).isNotNull() for c in at.values()]), entry))
        sums += [F.sum(F.when(F.col("_value.at") == i, F.col(f"_value.{field}"))).alias(c) for field, c in at.items()]
    return stacked.select(*keys, "_m", "_n", F.array_compact(F.array(*entries)).alias("_values")), sums


def stacked_groups(
    cur: DataFrame, past: DataFrame, keys: list[str], fiscal: FiscalSpec, policy: MergePolicy, stored: bool = False,
    in_ranges: bool = False,
) -> tuple[DataFrame, dict[str, Column]]:
    """One row per key, with the sums of the current (``{column}__c``) and of
    the past side (``{column}__p``), and an expression on it for every merged
    year column.

    ``stored``: the sides are read from files and hold about one row per key.
    They are then dealt by the keys as they are, in one exchange: sums made
    before it would save no rows, and a table of buffers for both sides'
    columns would grow with the files that a task reads.  Their year columns
    cross it as a list of those with a value (:func:`_packed`).
    ``in_ranges``: of stored sides, each partition of the groups gets a range
    of the keys (ascending, nulls first), in the order of the partitions; the
    sides are read once more for it, as a sample."""
    universe = year_column_universe(fiscal)
    cur_years = [c for c in cur.columns if c in universe]
    past_years = [c for c in past.columns if c in universe and not c.endswith(f"_{fiscal.current_fy}")]
    past_years = [c for c in past_years if c in set(fiscal.past_year_columns())]
    both = [c for c in cur_years if c in past_years]
    fill_both = both if policy.conflict == "fill_null" else []

    cur_side = cur.select(
        *keys,
        F.lit(1).alias("_m"),
        F.lit(0).alias("_n"),
        *[F.col(c).alias(c + "__c") for c in cur_years],
        *[F.when(F.col(c).isNull(), F.lit(1).cast("long")).alias(c + "__z") for c in fill_both],
    )
    past_side = past.select(
        *keys,
        F.lit(0).alias("_m"),
        F.lit(1).alias("_n"),
        *[F.col(c).alias(c + "__p") for c in past_years],
    )
    stacked = cur_side.unionByName(past_side, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in (*keys, "_m", "_n")]
    if stored and values:
        info = fiscal.metric_of()
        of = {c: info[c[:-3]] for c in values}
        packed, sums = _packed(stacked, keys, {c: fy for c, (_, fy) in of.items()},
                               {c: m.name + (c[-3:] if c.endswith("__z") else "") for c, (m, _) in of.items()})
        dealt = (packed.repartitionByRange if in_ranges else packed.repartition)(*[F.col(k) for k in keys])
        rows = dealt.select(*keys, "_m", "_n", F.posexplode_outer("_values").alias("_place", "_value"))
        first = F.coalesce(F.col("_place"), F.lit(0)) == 0  # a row counts once, however many values it has
        g = rows.groupBy(*keys).agg(*[F.sum(F.when(first, F.col(c)).otherwise(0)).alias(c) for c in ("_m", "_n")], *sums)
    else:
        g = stacked.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("_m", "_n", *values)])

    matched = reduce(and_, [F.col(k).isNotNull() for k in keys]) & (F.col("_m") > 0) & (F.col("_n") > 0)
    m, n = F.col("_m"), F.col("_n")

    def z(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    out = {}
    for fy in fiscal.years_desc():
        for c in fiscal.year_columns(fy):
            cc, pc = c + "__c", c + "__p"
            if fy == fiscal.current_fy:
                v = F.when(matched, n * z(cc)).otherwise(z(cc)) if c in cur_years else F.lit(0.0)
            elif c in past_years and (policy.conflict == "overwrite" or c not in cur_years):
                v = F.when(matched, m * z(pc)).otherwise(z(pc))
            elif c in past_years:  # fill_null, both sides
                v = F.when(matched, n * z(cc) + z(c + "__z") * z(pc)).otherwise(z(cc) + z(pc))
            elif c in cur_years:
                v = F.when(matched, n * z(cc)).otherwise(z(cc))
            else:
                v = F.lit(0.0)
            out[c] = v
    return g, out


def merge_levels(
    cur: dict[str, DataFrame],
    past: dict[str, DataFrame | None],
    levels: tuple[LevelSpec, ...],
    fiscal: FiscalSpec,
    policy: MergePolicy,
    reaggregate_level: str = "customer_product",
    stored: bool = False,
    in_ranges: bool = False,
) -> dict[str, DataFrame]:
    """Merge every level; the product level is merged and re-aggregated
    (``stored``, ``in_ranges``: see :func:`stacked_groups`).

    Each level is treated on its own: an empty past table of one level does
    not affect the others (the original job tested the corp table only)."""
    out = {}
    for lv in levels:
        p = past.get(lv.name)
        if p is None and policy.missing_past == "error":
            raise FileNotFoundError(f"past table of level {lv.name} is missing")
        if lv.name == reaggregate_level:
            out[lv.name] = merge_reaggregate(cur[lv.name], p, lv, fiscal, policy, stored=stored, in_ranges=in_ranges)
        else:
            out[lv.name] = merge_level(cur[lv.name], p, lv, fiscal, policy)
    return out
