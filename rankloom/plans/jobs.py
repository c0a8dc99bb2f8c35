"""The job's composites: summarise (C-1), annual / quarter merge (C-2, C-3)
and export (C-4).  Every function returns lazy DataFrames; nothing but the
small reconciliation tables is ever collected."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import from_reference, to_reference
from ..session import materialize, prepare, release, scratch_path
from ..operators import enrich, merge, rank, reconcile, shape, summarise
from ..operators.numbering import number_rows
from ..sources import readers, tables, writers
from .spec import LEVELS, FiscalSpec, LevelSpec, MergePolicy


def summarise_stage(detail: DataFrame, fiscal: FiscalSpec, levels: tuple[LevelSpec, ...] = LEVELS) -> DataFrame:
    """C-1 as one plan: all level summaries from a single scan of the detail
    (GROUPING SETS), tagged by ``level``."""
    return summarise.summarise_grouping_sets(detail, levels, fiscal)


def run_summarise(detail: DataFrame, fiscal: FiscalSpec, out_dir: str, levels: tuple[LevelSpec, ...] = LEVELS) -> dict[str, DataFrame]:
    """C-1 end to end: one job writes every level (partitioned by level);
    the per-level tables are read back with partition pruning."""
    writers.write_summary(summarise_stage(detail, fiscal, levels), out_dir)
    combined = detail.sparkSession.read.parquet(out_dir)
    return summarise.split_levels(combined, levels)


def summarise_to_files(
    detail: DataFrame,
    fiscal: FiscalSpec,
    paths: dict[str, str],
    levels: tuple[LevelSpec, ...] = LEVELS,
    reference_names: bool = True,
) -> None:
    """C-1 with one file per level (W-1): the detail is scanned once
    (GROUPING SETS), the small combined result is written once to the shared
    folder, and each level file is a filtered copy of it -- not one scan of
    the detail per level."""
    spark = detail.sparkSession
    scratch = scratch_path(spark, "summary")
    combined = materialize(summarise_stage(detail, fiscal, levels), scratch)
    writers.write_levels(summarise.split_levels(combined, levels), paths, fiscal, reference_names=reference_names)
    release(spark, scratch)


class MergeResult:
    """Ranked, typed level tables plus the reconciliation tables.

    The tables are built at once; the reports are built on first access,
    so a caller that only writes the tables pays no analysis for them."""

    def __init__(self, tables: dict[str, DataFrame], reports: Callable[[], tuple], orders: dict[str, list]):
        self.tables = tables
        self.orders = orders
        self._reports = reports
        self._built: tuple | None = None

    def _get(self, i: int):
        if self._built is None:
            self._built = self._reports()
        return self._built[i]

    @property
    def report(self) -> DataFrame | None:
        return self._get(0)

    @property
    def verdict(self) -> DataFrame | None:
        return self._get(1)

    @property
    def checkpoints(self) -> DataFrame | None:
        return self._get(2)


def _totals_metrics(policy: MergePolicy) -> tuple[str, ...] | None:
    return ("sales",) if policy.severity == "absolute" else None


def merge_years(
    cur: dict[str, DataFrame],
    past: dict[str, DataFrame | None],
    master: DataFrame | None,
    fiscal: FiscalSpec,
    policy: MergePolicy,
    levels: tuple[LevelSpec, ...] = LEVELS,
    on_merged: Callable[[str, DataFrame], DataFrame] | None = None,
    stored: bool = False,
) -> MergeResult:
    """C-2 (policy ANNUAL) and C-3 (policy QUARTER) as one function; the past
    tables have English names (``readers.read_past`` renames legacy ones).
    ``on_merged`` sees each level after the merge, before the master and all
    that follows, and hands on the table to go on with.
    ``stored``: the inputs are read from files (``merge.stacked_groups``);
    a product level that is ranked by sales and then by its keys is merged in
    ranges of the keys, and only rows with current sales are sorted again."""
    names = [lv.name for lv in levels]
    by_name = {lv.name: lv for lv in levels}
    if master is None and policy.missing_master == "error":
        raise FileNotFoundError("corporation master is required by this policy")

    fine = by_name.get(summarise.FINE_LEVEL)
    in_ranges = (stored and on_merged is None and fine is not None and policy.product_order == "sales" and fiscal.sales_col in cur[fine.name].columns
                 and rank.keys_in_order(fine) and merge.may_lie_in_ranges(cur[fine.name], past.get(fine.name), fine, fiscal, policy))
    # a sum of current sales is below zero only where some row is
    below = in_ranges and not cur[fine.name].filter(F.col(fiscal.sales_col) < 0).isEmpty()
    merged = merge.merge_levels(cur, past, levels, fiscal, policy, stored=stored, in_ranges=in_ranges)
    if on_merged is not None:
        merged = {n: on_merged(n, df) for n, df in merged.items()}
    if "corp" in merged:
        merged["corp"] = enrich.master_join(merged["corp"], master)

    out = {}
    for n in names:
        lv, df = by_name[n], merged[n]
        if policy.name == "annual":
            df = shape.reorder_filter(df, lv, fiscal)
            df = shape.fill_column(df, fiscal.sales_col, 0)
            df = shape.codes_to_string(df)
        else:
            df = shape.reorder_generated(df, lv, fiscal)
            df = shape.codes_to_string(df)
            df = shape.finalise_metrics(df, fiscal, policy.final_type)
        if policy.drop_zero_rows:
            df = shape.drop_zero_rows(df, fiscal)
        out[n] = df

    sales_everywhere = all(fiscal.sales_col in out[n].columns for n in ("corp", "customer") if n in out)
    orders = {n: rank.rank_order(out[n], by_name[n], fiscal, policy, sales_present=None if policy.name == "annual" else sales_everywhere)
              for n in names}
    unsorted = out  # the totals need no order
    out = {n: rank.ordered_from_ranges(out[n], orders[n], fiscal.sales_col, below) if in_ranges and n == fine.name
           else rank.ordered(out[n], orders[n]) for n in names}

    def reports():
        # totals before the merge
        cur_totals = reconcile.level_totals(cur, fiscal, rule="corp")
        if policy.severity == "absolute":
            past_totals = reconcile.level_totals(past, fiscal, ("sales",), rule="all_levels")
            before = past_totals
        else:
            past_totals = reconcile.level_totals(past, fiscal, rule="corp")
            before = reconcile.totals_precedence(cur_totals, past_totals)
        merged_totals = reconcile.level_totals(merged, fiscal, rule="each")
        rule = "all_levels" if policy.severity == "absolute" else "each"
        final_totals = reconcile.level_totals(unsorted, fiscal, _totals_metrics(policy), rule=rule)
        report = verdict = None
        if policy.severity == "absolute":
            if final_totals is not None:
                report = None if before is None else reconcile.compare_absolute(before, final_totals)
                verdict = reconcile.verdict(report, reconcile.cross_level(final_totals))
        elif before is not None and merged_totals is not None and final_totals is not None:
            report = reconcile.compare_relative(before, merged_totals, checkpoint="merge").unionByName(
                reconcile.compare_relative(merged_totals, final_totals, checkpoint="final")
            )
        marks = {"current": cur_totals, "past": past_totals, "merged": merged_totals, "final": final_totals}
        checkpoints = reconcile.checkpoint_report(marks) if any(t is not None for t in marks.values()) else None
        return report, verdict, checkpoints

    return MergeResult(out, reports, orders)


@dataclass
class MergeRun:
    """What a written merge returns.  ``tables`` are read back and therefore
    unordered (the part files are in rank order; a reader's partitions need
    not be).  The rest are small tables made from totals: ``totals`` of what
    was written, ``report`` and ``verdict`` of the comparison with the
    inputs, totals at each of the ``checkpoints``, ``conflicts`` found before
    the merge with ``advice``, ``overlap`` of the corp codes and the number
    of rows without a corp name after the master."""

    tables: dict[str, DataFrame]
    totals: DataFrame
    report: DataFrame | None
    verdict: DataFrame | None
    checkpoints: DataFrame
    conflicts: DataFrame | None
    advice: list[str]
    overlap: DataFrame | None
    null_names: int

    def lines(self) -> list[str]:
        """The findings as text; every table here has a row per level, year
        and metric at most."""
        out = [f"advice: {a}" for a in self.advice]
        if self.overlap is not None:
            o = self.overlap.head()
            out.append(f"corp codes: {o['only_current']:,} current only, {o['only_past']:,} past only, {o['both']:,} in both")
        if self.null_names:
            out.append(f"{self.null_names:,} rows without a corp name")
        out += [f"{r['level']} {r['fy']} {r['metric']}: {r['text']}" for r in reconcile.totals_text(self.totals).collect()]
        if self.report is not None:
            out += [f"{r['level']} {r['fy']} {r['metric']}: {r['before']} -> {r['after']} {r['severity'] or ''}".rstrip()
                    for r in self.report.collect() if r["before"] != r["after"]]
        if self.verdict is not None:
            out.append("verdict: " + ", ".join(f"{k} {v}" for k, v in self.verdict.head().asDict().items()))
        return out


def _held(totals: DataFrame | None) -> DataFrame | None:
    """A totals table as literal rows (levels x years x metrics at most), so
    that the reports built on it do not aggregate their inputs again."""
    return None if totals is None else totals.sparkSession.createDataFrame(totals.collect(), totals.schema)


def _observed_rows(level: str, cols: list[str], got: dict, fiscal: FiscalSpec) -> list[tuple]:
    """Observed totals as rows of (level, fy, metric, total, rows)."""
    info = fiscal.metric_of()
    return [(level, info[c][1], info[c][0].name, None if got.get(c) is None else Decimal(str(got[c])), int(got["rows"])) for c in cols]


def run_merge_years(
    cur: dict[str, DataFrame],
    past: dict[str, DataFrame | None],
    master: DataFrame | None,
    fiscal: FiscalSpec,
    policy: MergePolicy,
    paths: dict[str, str],
    levels: tuple[LevelSpec, ...] = LEVELS,
    reference_names: bool = False,
    rank_column: str | None = None,
) -> MergeRun:
    """C-2 / C-3 end to end: check the inputs, write each ranked level table
    once (W-2/W-3), collect its row count and column totals with ``observe``
    during the same write job (A-7, A-12), and compare them with the totals
    of the inputs -- the report never recomputes the merge.

    A past table without rows (F-5, J-9) is no past: its level is the current
    table.  The quarter job compares twice (V-9): inputs with the merge, and
    the merge with what is written; the merge is observed while it is written
    to the shared folder, from where the sort (which reads its input twice)
    takes it.  ``rank_column`` stores each row's rank (O-1..O-4), which lets
    the export read ranges of it."""
    absolute = policy.severity == "absolute"
    past = merge.without_empty(past)
    policy = policy.with_(missing_past="skip")  # whoever read the past has seen to that it is there
    metrics = _totals_metrics(policy)
    cur_totals = _held(reconcile.level_totals(cur, fiscal, rule="corp"))
    past_totals = _held(reconcile.level_totals(past, fiscal, metrics, rule="all_levels" if absolute else "corp"))
    past_is_empty = all(p is None for p in past.values())
    conflicts = None if cur_totals is None or past_totals is None else reconcile.premerge_conflicts(cur_totals, past_totals)
    advice = reconcile.premerge_advice(0 if conflicts is None else conflicts.count(), past_is_empty)
    overlap = None
    if cur.get("corp") is not None and past.get("corp") is not None:
        overlap = reconcile.key_overlap(cur["corp"], past["corp"], "corp_code")

    spark = next(iter(cur.values())).sparkSession
    seen, held = [], []

    def observed_merge(name: str, df: DataFrame) -> DataFrame:
        cols = [c for c in fiscal.all_year_columns() if c in df.columns]
        watched, obs = reconcile.observe_totals(df, f"{name} merged", cols)
        held.append(scratch_path(spark, "merged"))
        out = materialize(watched, held[-1])
        seen.extend(_observed_rows(name, cols, obs.get, fiscal))
        return out

    result = merge_years(cur, past, master, fiscal, policy, levels, None if absolute else observed_merge, stored=True)
    rows, null_names = [], 0
    for lv in levels:
        df = result.tables[lv.name]
        if rank_column is not None:
            df = number_rows(df, [] if result.orders[lv.name] else [F.lit(0)], rank_column)
        cols = [c for c in fiscal.all_year_columns() if c in df.columns]
        observed, obs = reconcile.observe_totals(df, lv.name, cols, "corp_name" if lv.name == "corp" else None)
        if reference_names:
            observed = to_reference(observed, fiscal)
        observed.write.mode("overwrite").option("compression", "snappy").parquet(paths[lv.name])
        null_names += int(obs.get["null_names"] or 0)
        rows += _observed_rows(lv.name, cols, obs.get, fiscal)
    release(spark, *held)
    as_totals = lambda r: spark.createDataFrame(r, f"level string, fy int, metric string, total {reconcile.EXACT}, rows long")
    written = as_totals(rows)
    final = written.drop("rows")
    if absolute:
        final = final.filter(F.col("metric").isin(*metrics))
        report = None if past_totals is None else reconcile.compare_absolute(past_totals, final)
        verdict = reconcile.verdict(report, reconcile.cross_level(final))
    else:
        before = reconcile.totals_precedence(cur_totals, past_totals)
        merged = as_totals(seen).drop("rows")
        report = None if before is None else reconcile.compare_relative(before, merged, checkpoint="merge").unionByName(
            reconcile.compare_relative(merged, final, checkpoint="final"))
        verdict = None
    marks = reconcile.checkpoint_report({"current": cur_totals, "past": past_totals, "merged": as_totals(seen).drop("rows") if seen else None,
                                         "final": written.drop("rows")})
    tables = {lv.name: spark.read.parquet(paths[lv.name]) for lv in levels}
    return MergeRun(tables, written, report, verdict, marks, conflicts, advice, overlap, null_names)


def run_merge_generation(
    cur: dict[str, DataFrame],
    past: dict[str, DataFrame | None],
    master: DataFrame | None,
    fiscal: FiscalSpec,
    policy: MergePolicy,
    base: str,
    levels: tuple[LevelSpec, ...] = LEVELS,
    **options,
) -> MergeRun:
    """:func:`run_merge_years` with one commit for all its tables (W-2, W-3):
    whoever reads :func:`tables.committed` finds all of them or, after a
    failure anywhere before, those of the run before."""
    spark = next(iter(cur.values())).sparkSession
    generation = tables.new_generation(base, [lv.name for lv in levels])
    run = run_merge_years(cur, past, master, fiscal, policy, generation.paths, levels, **options)
    rows = {r["level"]: r["rows"] for r in run.totals.select("level", "rows").distinct().collect()}
    tables.commit(spark, generation, rows)
    return run


def export_generation(spark, base: str, out_dir: str, fiscal: FiscalSpec, policy: MergePolicy, **options) -> list[str]:
    """C-4 from the newest complete generation (W-7); none is an error."""
    generation = tables.committed(spark, base)
    if generation is None:
        raise FileNotFoundError(f"{base} has no complete generation")
    return export_levels(spark, generation.paths, out_dir, fiscal, policy, **options)


def run_reference_job(
    spark,
    detail_csv: str,
    past_paths: dict[str, str],
    master_csv: str,
    out_dir: str,
    fiscal: FiscalSpec,
    policy: MergePolicy,
    levels: tuple[LevelSpec, ...] = LEVELS,
    metric_type: str = "double",
    flavour: str | None = None,
) -> dict:
    """The original three stages on reference-shaped files.

    1. Summarise: the cp932 detail CSV (Japanese headers) -> one summary
       table per level under ``out_dir/summary`` with the reference names.
    2. Merge: those summaries with the past wide parquet tables (reference
       names, legacy names tolerated) and the cp932 master -> ranked result
       tables ``{level}_転記用データ.parquet`` under ``out_dir/result``, with
       totals observed while writing.
    3. Export: one ordered CSV per level under ``out_dir/export``, in the
       ``flavour`` of the term (by default that of the policy's name).

    Missing detail -> nothing is done (as in the original); missing past or
    master follow ``policy``.  Returns paths, totals, the export list and the
    number of records that the CSV readers left out."""
    prepare(spark)
    detail = readers.read_detail_csv(spark, detail_csv, required=False, metric_type=metric_type)
    if detail is None:
        return {"status": "no detail"}
    summary_paths = writers.level_paths(f"{out_dir}/summary", policy.name, "summary", reference_names=True)
    summarise_to_files(detail, fiscal, summary_paths, levels)
    cur = {lv.name: spark.read.parquet(summary_paths[lv.name]).transform(lambda d: from_reference(d, fiscal)) for lv in levels}
    past = readers.read_past(spark, past_paths, fiscal, policy, levels)
    master = readers.read_master_csv(spark, master_csv, required=policy.missing_master == "error")

    result_paths = writers.level_paths(f"{out_dir}/result", policy.name, "result", reference_names=True)
    run = run_merge_years(cur, past, master, fiscal, policy, result_paths, levels, reference_names=True)
    exported = export_levels(spark, result_paths, f"{out_dir}/export", fiscal, policy, levels=levels,
                             **EXPORT_FLAVOURS[flavour or policy.name])
    rejected = {name: readers.rejected_rows(spark, path).count() for name, path in (("detail", detail_csv), ("master", master_csv))
                if name == "detail" or master is not None}
    return {"status": "ok", "summary": summary_paths, "result": result_paths, "run": run, "totals": run.totals,
            "exported": exported, "rejected": rejected}


#: Export flavours: which levels must be there, and what becomes of nulls and of empty tables.
EXPORT_FLAVOURS = {
    "annual": {"availability": "all", "on_null": "zero", "header_if_empty": True},
    "first_half": {"availability": "available", "on_null": "blank", "header_if_empty": False},
    "quarter": {"availability": "available", "on_null": "blank", "header_if_empty": True},
}


def export_levels(
    spark,
    paths: dict[str, str],
    out_dir: str,
    fiscal: FiscalSpec,
    policy: MergePolicy,
    availability: str = "all",
    on_null: str = "zero",
    header_if_empty: bool = True,
    levels: tuple[LevelSpec, ...] = LEVELS,
    rank_column: str | None = None,
) -> list[str]:
    """C-4: availability check (W-7 all-or-nothing / W-8 best effort), read
    each result table (R-9), put it in rank order again (a read does not keep
    the order of part files), fill numeric nulls (P-16) and write one CSV
    table per level (W-5), in files of as many rows as the tier of the
    table's size says (W-6).  With the ``rank_column`` of the tables each file
    takes a range of ranks, and nothing is sorted as a whole again; the
    column itself is not exported.  Returns the exported levels."""
    by_name = {lv.name: lv for lv in levels}
    present, _missing = writers.available_levels(spark, paths, availability)
    done = []
    for lv in present:
        df = from_reference(spark.read.parquet(paths[lv]), fiscal)
        named = df.columns != spark.read.parquet(paths[lv]).columns
        rows = df.count()  # from the file footers
        if rank_column is None:
            df = rank.rank(df, by_name[lv], fiscal, policy)
        else:
            df = rank.by_ranges(df, rank_column, rows, writers.export_chunk_size(rows)).drop(rank_column)
        df = to_reference(df, fiscal) if named else df
        if writers.export_level(df, f"{out_dir.rstrip('/')}/{lv}", on_null=on_null, header_if_empty=header_if_empty,
                                max_records_per_file=writers.export_chunk_size(rows)):
            done.append(lv)
    return done
