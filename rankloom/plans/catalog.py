"""Registered driver queries over the star-schema fixture.

FY2001 is the current year, FY1994 (the first year of the data) to FY2000
the past.  Every query reads the whole tables; scenario
variants (codes missing for one region's extract, a past file written
mid-year, a past product file still split by sales rep) are derived from
the data by ordinary predicates, never by sampling or capping rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import truncate_long
from ..functions.naming import (
    LEGACY_CUSTOMER_RENAMES, LEGACY_PRODUCT_RENAMES, REFERENCE_DETAIL_METRICS, REFERENCE_KEY_NAMES, from_reference, to_reference,
)
from ..operators import enrich, merge, rank, reconcile, shape, summarise
from ..operators.numbering import number_rows
from ..session import materialize, prepare, release, scratch_path
from ..sources import csvio, readers, tables, writers
from ..sources.fixtures import corp_master, detail_view, table
from . import jobs
from .spec import ANNUAL, CORP, CUSTOMER, CUSTOMER_PRODUCT, LEVELS, QUARTER, REP_NAME, FiscalSpec, LevelSpec

CUR_FY = 2001
FIRST_PAST = 1994             # first fiscal year of the data (orders from 1995-01-01 on)
FISCAL = FiscalSpec(current_fy=CUR_FY, start_year=FIRST_PAST)
PRELIM_END = "2000-10-01"      # first half of FY2000: a preliminary figure
ASOF_CUT = "2001-06-01"        # past file written before FY2001 was complete
OFFICE_ORDER = ("EUROPE", "ASIA", "AMERICA", "AFRICA")  # MIDDLE EAST unlisted
MASKED_REGION = "AFRICA"       # extract without codes for this region
TOP = 10
LOST_YEAR = 1999               # year that the faulty merge of recon_absolute_faults loses
NAMELESS = "7"                 # the corporation without a name in master_lacks_name
BUCKETS = 8                    # of the tables in merge_bucketed
NAME_GROUPS = 400              # customers share so many names in backfill_customer_ambiguous

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------- fixtures
def typed(df: DataFrame) -> DataFrame:
    """Output types: quantity and area double, sales and profit long."""
    info = FISCAL.metric_of()
    return df.select(
        *[
            F.col(c).cast("long" if info[c][0].integral else "double").alias(c) if c in info else F.col(c)
            for c in df.columns
        ]
    )


def cur_detail(spark, d, dealt: bool = False):
    return detail_view(spark, d, CUR_FY, CUR_FY, dealt=dealt)


def past_detail(spark, d, dealt: bool = False):
    return detail_view(spark, d, FIRST_PAST, CUR_FY - 1, dealt=dealt)


def cur_level(spark, d, level: LevelSpec) -> DataFrame:
    return summarise.summarise_level(cur_detail(spark, d, dealt=level.name == summarise.FINE_LEVEL), level, FISCAL)


def past_level(spark, d, level: LevelSpec) -> DataFrame:
    """Past wide table; the corp table also carries the corp name."""
    fine = level.name == summarise.FINE_LEVEL
    return summarise.summarise_wide(past_detail(spark, d, dealt=fine), LevelSpec(level.name, level.columns), FISCAL, dealt=fine)


def past_product_by_rep(spark, d) -> DataFrame:
    """Past product table still split by the retired sales-rep key."""
    lv = LevelSpec("customer_product", CUSTOMER_PRODUCT.keys + (REP_NAME,))
    return summarise.summarise_wide(past_detail(spark, d, dealt=True), lv, FISCAL, dealt=True)


def cur_all(spark, d, materialized: bool = False) -> dict[str, DataFrame]:
    """All current level tables from one pass over the FY detail
    (optionally written once to the shared checkpoint folder)."""
    combined = summarise.summarise_grouping_sets(cur_detail(spark, d), LEVELS, FISCAL)
    if materialized:
        combined = materialize(combined)
    return summarise.split_levels(combined, LEVELS)


def past_all(spark, d, materialized: bool = False, path: str | None = None) -> dict[str, DataFrame]:
    """All past wide tables from one pass over the past detail (``path``:
    where they are written once, for whoever releases them)."""
    specs = tuple(LevelSpec(lv.name, lv.columns) for lv in LEVELS)
    hook = (lambda df: materialize(df, path)) if materialized else None
    return summarise.summarise_wide_levels(past_detail(spark, d, dealt=True), specs, FISCAL, combined_hook=hook, dealt=True)


def merged(spark, d, level: LevelSpec, policy=ANNUAL) -> DataFrame:
    if level.name == "customer_product":
        return merge.merge_reaggregate(cur_level(spark, d, level), past_level(spark, d, level), level, FISCAL, policy)
    return merge.merge_level(cur_level(spark, d, level), past_level(spark, d, level), level, FISCAL, policy)


def cur_customer_with_prelim(spark, d) -> DataFrame:
    """Current customer table that also holds a preliminary FY2000 figure
    (first half only; null for customers without such orders)."""
    det = detail_view(spark, d, CUR_FY - 1, CUR_FY)
    cur = F.col("fy") == CUR_FY
    pre = (F.col("fy") == CUR_FY - 1) & (F.col("order_date") < F.lit(PRELIM_END).cast("date"))
    aggs = []
    for m in FISCAL.metrics_for(CUR_FY):
        aggs.append(summarise.metric_sum(m, F.when(cur, F.col(m.name))).alias(FISCAL.col(m.name, CUR_FY)))
    for m in FISCAL.metrics_for(CUR_FY - 1):
        s = F.sum(F.when(pre, F.col(m.name)))
        aggs.append((truncate_long(s) if m.integral else s).alias(FISCAL.col(m.name, CUR_FY - 1)))
    return det.groupBy(*CUSTOMER.keys).agg(*aggs)


def masked_code_level(spark, d, code: str, name: str, extra_keys=()) -> DataFrame:
    """Current table whose code is missing for one region's rows."""
    det = cur_detail(spark, d).withColumn(code, F.when(F.col("office") == MASKED_REGION, F.lit(None)).otherwise(F.col(code)))
    return summarise.summarise_level(det, LevelSpec("x", (code, name) + tuple(extra_keys)), FISCAL)


# ------------------------------------------------------------------ queries
def q_summary(level):
    return lambda spark, d: typed(cur_level(spark, d, level))


def q_fiscal_year_totals(spark, d):
    from .spec import QTY, SALES

    return detail_view(spark, d).groupBy("fy").agg(
        F.count(F.lit(1)).alias("n_lines"),
        summarise.metric_sum(QTY).cast("double").alias("qty"),
        summarise.metric_sum(SALES).alias("sales"),
    )


def q_summary_grouping_sets(spark, d):
    return typed(jobs.summarise_stage(cur_detail(spark, d), FISCAL))


def q_summarise_partitioned(spark, d):
    out = scratch_path(spark, "summary")
    levels = jobs.run_summarise(cur_detail(spark, d), FISCAL, out)
    return typed(levels["customer_product"])


def q_past_wide_customer(spark, d):
    return typed(past_level(spark, d, CUSTOMER))


def q_merge(level):
    return lambda spark, d: typed(merged(spark, d, level))


def q_merge_left_key_policy(spark, d):
    pol = ANNUAL.with_(keys="left")
    return typed(merge.merge_level(cur_level(spark, d, CUSTOMER), past_level(spark, d, CUSTOMER), CUSTOMER, FISCAL, pol))


def q_merge_conflict(conflict):
    def q(spark, d):
        pol = ANNUAL.with_(conflict=conflict)
        return typed(merge.merge_level(cur_customer_with_prelim(spark, d), past_level(spark, d, CUSTOMER), CUSTOMER, FISCAL, pol))

    return q


def q_merge_empty_past(spark, d):
    past = readers.optional_parquet(spark, f"{d.rstrip('/')}/no_such_past_table.parquet")
    return typed(merge.merge_level(cur_level(spark, d, CUSTOMER), past, CUSTOMER, FISCAL, ANNUAL))


def q_merge_long_pivot(spark, d):
    det = detail_view(spark, d, FIRST_PAST, CUR_FY)
    return typed(summarise.summarise_wide(det, CUSTOMER, FISCAL, FISCAL.years_desc()))


def with_legacy_names(past: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Reference-named past tables as older files have them: customer and
    product level under their legacy column names."""
    back = lambda names: {v: k for k, v in names.items()}
    out = {k: to_reference(v, FISCAL) for k, v in past.items()}
    out["customer"] = out["customer"].withColumnsRenamed(back(LEGACY_CUSTOMER_RENAMES))
    out["customer_product"] = out["customer_product"].withColumnsRenamed(back(LEGACY_PRODUCT_RENAMES))
    return out


def q_legacy_rename(spark, d):
    old = with_legacy_names({"customer": past_level(spark, d, CUSTOMER), "customer_product": past_level(spark, d, CUSTOMER_PRODUCT)})
    cust, prod = readers.rename_legacy_coupled(old["customer"], old["customer_product"])
    wanted = ["cust_code", "cust_name", "no_such_column"] + FISCAL.past_year_columns()
    cust, prod = from_reference(cust, FISCAL), from_reference(prod, FISCAL)
    return typed(summarise.safe_select(cust, wanted)).withColumn("level", F.lit("customer")).unionByName(
        typed(prod).withColumn("level", F.lit("customer_product")), allowMissingColumns=True)


def q_missing_years(spark, d):
    return typed(merge.add_missing_years(cur_level(spark, d, CUSTOMER), FISCAL))


def q_master_join(spark, d):
    det = past_detail(spark, d)
    past = summarise.summarise_wide(det, LevelSpec("corp", ("corp_code",)), FISCAL)
    names = det.groupBy("corp_code").agg(
        F.max(F.when(F.col("office") != MASKED_REGION, F.lower("corp_name"))).alias("corp_name")
    )
    past = past.join(names, "corp_code")
    m = merge.merge_level(cur_level(spark, d, CORP), past, CORP, FISCAL, ANNUAL)
    return typed(enrich.master_join(m, corp_master(spark, d)))


def q_product_reaggregate(stacked: bool | None, policy):
    def q(spark, d):
        return typed(
            merge.merge_reaggregate(
                cur_level(spark, d, CUSTOMER_PRODUCT), past_product_by_rep(spark, d), CUSTOMER_PRODUCT, FISCAL, policy, stacked=stacked
            )
        )

    return q


def q_backfill_corp_code(spark, d):
    cur = masked_code_level(spark, d, "corp_code", "corp_name")
    return typed(enrich.backfill_code(cur, past_level(spark, d, CORP), "corp_code", "corp_name", on_ambiguous="min"))


def q_backfill_customer_fanout(spark, d):
    cur = masked_code_level(spark, d, "cust_code", "cust_name")
    return typed(enrich.backfill_code(cur, past_level(spark, d, CUSTOMER), "cust_code", "cust_name", on_ambiguous="fanout"))


def q_dedupe_subset(spark, d):
    return typed(enrich.dedupe_subset(past_product_by_rep(spark, d), list(CUSTOMER_PRODUCT.keys), order_by=[REP_NAME]))


def _merged_customer_with_noise(spark, d):
    m = merged(spark, d, CUSTOMER)
    return m.select("*", F.lit(None).cast("double").alias(FISCAL.col("qty", CUR_FY - 1)), F.lit("x").alias("note"))


def q_reorder_filter(spark, d):
    return typed(shape.reorder_filter(_merged_customer_with_noise(spark, d), CUSTOMER, FISCAL))


def q_reorder_generated(spark, d):
    return typed(shape.reorder_generated(_merged_customer_with_noise(spark, d), CUSTOMER, FISCAL))


def _finalised_customer(spark, d):
    return shape.finalise_metrics(shape.codes_to_string(merged(spark, d, CUSTOMER)), FISCAL, "double")


def q_finalise_metrics(spark, d):
    return _finalised_customer(spark, d)


def q_zero_row_filter(spark, d):
    """All customers of the table, with the current year where they have
    one: those without it have only zeros and go."""
    everyone = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("cust_code"), F.col("c_name").alias("cust_name"))
    m = everyone.join(cur_level(spark, d, CUSTOMER), list(CUSTOMER.keys), "left")
    return shape.drop_zero_rows(shape.finalise_metrics(m, FISCAL, "double"), FISCAL)


def q_backfill_ambiguous(code: str, name: str, level: LevelSpec, new_name, how: str):
    """Names that stand for several codes: 'min' takes one, 'fanout' gives a
    row for each."""

    def q(spark, d):
        named = lambda det: det.withColumn(name, new_name())
        det = named(cur_detail(spark, d)).withColumn(
            code, F.when(F.col("office") == MASKED_REGION, F.lit(None)).otherwise(F.col(code)))
        cur = summarise.summarise_level(det, LevelSpec("x", (code, name)), FISCAL)
        past = summarise.summarise_wide(named(past_detail(spark, d)), LevelSpec(level.name, (code, name)), FISCAL)
        return typed(enrich.backfill_code(cur, past, code, name, on_ambiguous=how))

    return q


def q_rank_top(level):
    def q(spark, d):
        m = shape.fill_column(merged(spark, d, level), FISCAL.sales_col, 0)
        return typed(rank.top_n(m, rank.rank_order(m, level, FISCAL, ANNUAL), TOP))

    return q


def q_rank_fallback(spark, d):
    m = merged(spark, d, CUSTOMER).drop(FISCAL.sales_col)
    return typed(rank.top_n(m, rank.rank_order(m, CUSTOMER, FISCAL, ANNUAL), TOP))


def q_rank_product_fallback(spark, d):
    m = merged(spark, d, CUSTOMER_PRODUCT).drop(FISCAL.sales_col)
    return typed(rank.top_n(m, rank.rank_order(m, CUSTOMER_PRODUCT, FISCAL, ANNUAL), TOP))


def q_rank_custom_office(spark, d):
    pol = QUARTER.with_(office_order=OFFICE_ORDER)
    m = merged(spark, d, CUSTOMER_PRODUCT, pol)
    return typed(rank.top_n(m, rank.rank_order(m, CUSTOMER_PRODUCT, FISCAL, pol), 2 * TOP))


def _merged_all(spark, d, policy=ANNUAL) -> dict[str, DataFrame]:
    cur, past = cur_all(spark, d, materialized=True), past_all(spark, d, materialized=True)
    return merge.merge_levels(cur, past, LEVELS, FISCAL, policy, stored=True)


def q_totals_by_level_year(spark, d):
    return reconcile.as_double(reconcile.level_totals(_merged_all(spark, d), FISCAL, rule="each"))


def q_totals_text(spark, d):
    totals = reconcile.level_totals(cur_all(spark, d), FISCAL, ("sales", "profit"), rule="each")
    return reconcile.totals_text(totals)


def q_totals_precedence(spark, d):
    c = reconcile.level_totals({"customer": cur_customer_with_prelim(spark, d)}, FISCAL, rule="each")
    p = reconcile.level_totals({"customer": past_level(spark, d, CUSTOMER)}, FISCAL, rule="each")
    return reconcile.as_double(reconcile.totals_precedence(c, p))


def _absolute_parts(spark, d):
    """Past totals before the merge and totals after it: both branches read
    the same past tables, written once to the shared folder."""
    cur, past = cur_all(spark, d, materialized=True), past_all(spark, d, materialized=True)
    before = reconcile.level_totals(past, FISCAL, ("sales",), rule="all_levels")
    merged_ = merge.merge_levels(cur, past, LEVELS, FISCAL, ANNUAL, stored=True)
    after = reconcile.level_totals(merged_, FISCAL, ("sales",), rule="all_levels")
    return before, after


def q_recon_absolute(spark, d):
    before, after = _absolute_parts(spark, d)
    return reconcile.as_double(reconcile.compare_absolute(before, after))


def q_recon_absolute_faults(spark, d):
    """A merge that went wrong: FY1999 is lost, FY1998 misses the urgent
    orders, FY1997 those of one customer."""
    specs = tuple(LevelSpec(lv.name, lv.columns) for lv in LEVELS)
    det = past_detail(spark, d, dealt=True)
    kept = det.where(~((F.col("fy") == LOST_YEAR - 1) & (F.col("rep_name") == "1-URGENT"))
                     & ~((F.col("fy") == LOST_YEAR - 2) & (F.col("cust_code") == "10")))
    after = summarise.summarise_wide_levels(kept, specs, FISCAL, combined_hook=materialize, dealt=True)
    after = {k: v.drop(*FISCAL.year_columns(LOST_YEAR)) for k, v in after.items()}
    totals = lambda t: reconcile.level_totals(t, FISCAL, ("sales",), rule="all_levels")
    return reconcile.as_double(reconcile.compare_absolute(totals(past_all(spark, d, materialized=True)), totals(after)))


def q_recon_cross_level(spark, d):
    return reconcile.as_double(reconcile.cross_level(reconcile.level_totals(_merged_all(spark, d), FISCAL, rule="each")))


def q_recon_verdict(spark, d):
    before, after = _absolute_parts(spark, d)
    return reconcile.verdict(reconcile.compare_absolute(before, after), reconcile.cross_level(after))


def q_premerge_conflicts(spark, d):
    det = detail_view(spark, d, FIRST_PAST, CUR_FY).where(F.col("order_date") < F.lit(ASOF_CUT).cast("date"))
    past = summarise.summarise_wide(det, LevelSpec("corp", CORP.columns), FISCAL, FISCAL.years_desc())
    c = reconcile.level_totals({"corp": cur_level(spark, d, CORP)}, FISCAL, ("sales",), rule="each")
    p = reconcile.level_totals({"corp": past}, FISCAL, ("sales",), rule="each")
    return reconcile.as_double(reconcile.premerge_conflicts(c, p))


def _quarter_inputs_by_rep(spark, d):
    """Current tables plus past tables whose product table is still split by
    sales rep -- all past levels from one pass over the past detail."""
    specs = (
        LevelSpec("corp", CORP.columns),
        CUSTOMER,
        LevelSpec("customer_product", CUSTOMER_PRODUCT.keys + (REP_NAME,)),
    )
    past = summarise.summarise_wide_levels(past_detail(spark, d, dealt=True), specs, FISCAL, combined_hook=materialize, dealt=True)
    return cur_all(spark, d, materialized=True), past


def q_recon_relative(spark, d):
    """V-7: each input is read once, for its own totals and those of the merge."""
    cur, past = _quarter_inputs_by_rep(spark, d)
    totals = reconcile.merge_totals(cur, past, LEVELS, FISCAL, QUARTER, stored=True)
    return reconcile.as_double(reconcile.relative_changes(totals.withColumnRenamed("merged", "after"), checkpoint="merge"))


def q_merge_totals(spark, d):
    cur, past = _quarter_inputs_by_rep(spark, d)
    return reconcile.as_double(reconcile.merge_totals(cur, past, LEVELS, FISCAL, QUARTER, stored=True))


def q_merge_bucketed(spark, d):
    """W-1..W-3, J-2: both customer tables bucketed and sorted by their keys,
    merged without an exchange."""
    base = scratch_path(spark, "bucketed")
    for name, df in (("cur", cur_level(spark, d, CUSTOMER)), ("past", past_level(spark, d, CUSTOMER))):
        tables.write_bucketed(df, f"{base}/{name}", CUSTOMER.keys, BUCKETS)
    cur, past = (tables.read_bucketed(spark, f"{base}/{name}") for name in ("cur", "past"))
    return typed(merge.merge_level(cur, past, CUSTOMER, FISCAL, ANNUAL))


def q_generation_commit(spark, d):
    """W-2, W-3, W-7: a second generation breaks off after its first table;
    the export still takes the first, whole."""
    base = scratch_path(spark, "generations")
    cur = {k: v for k, v in cur_all(spark, d, materialized=True).items() if k != "customer_product"}
    tables.write_generation(base, cur)
    wrong = {"corp": cur["corp"].withColumn(FISCAL.sales_col, F.lit(0)),
             "customer": cur["customer"].withColumn("cust_name", F.raise_error(F.lit("broken off")).cast("string"))}
    try:
        tables.write_generation(base, wrong)
        failed = False
    except PySparkException:
        failed = True
    done = jobs.export_generation(spark, base, f"{base}/csv", FISCAL, ANNUAL, levels=(CORP, CUSTOMER))
    return _union([_level_summary(lv, writers.read_export(spark, f"{base}/csv/{lv}")).withColumn("kept", F.lit(failed)) for lv in done])


def _merged_years(spark, d, policy, materialized: bool = False):
    cur, past = cur_all(spark, d, materialized), past_all(spark, d, materialized)
    return jobs.merge_years(cur, past, corp_master(spark, d), FISCAL, policy, stored=materialized)


def q_checkpoint_report(spark, d):
    return reconcile.as_double(_merged_years(spark, d, QUARTER, materialized=True).checkpoints)


def q_key_overlap(spark, d):
    return reconcile.key_overlap(cur_level(spark, d, CUSTOMER), past_level(spark, d, CUSTOMER), "cust_code")


def q_key_overlap_bitmaps(spark, d):
    """D-3, D-4: the same by bitmaps, which is what crosses the network."""
    return reconcile.key_overlap_bitmaps(cur_level(spark, d, CUSTOMER), past_level(spark, d, CUSTOMER), "cust_code")


def q_null_profile(spark, d):
    return reconcile.null_profile(typed(merged(spark, d, CUSTOMER))).withColumnRenamed("column", "column_name")


def q_table_profile(spark, d):
    return reconcile.table_profile(typed(merged(spark, d, CUSTOMER)), "customer").withColumnRenamed("column", "column_name")


def q_export_ready(spark, d):
    return writers.export_ready(typed(merged(spark, d, CUSTOMER)), "zero")


def q_csv_cp932_roundtrip(spark, d):
    """Detail rows written as a reference-shaped cp932 CSV, read back with the
    detail reader and summarised (metrics as exact decimals after the read)."""
    out = scratch_path(spark, "csv")
    det = cur_detail(spark, d).select(*CUSTOMER.keys, "qty", "area", "sales", "profit")
    names = {**REFERENCE_KEY_NAMES, **REFERENCE_DETAIL_METRICS}
    det.withColumnsRenamed({c: names[c] for c in det.columns}).write.option("header", True).option(
        "encoding", "windows-31j"
    ).csv(out)
    back = readers.read_detail_csv(spark, out, encoding="windows-31j", required=True)
    back = back.select(*CUSTOMER.keys, *[F.col(m).cast("decimal(20,4)").alias(m) for m in ("qty", "area", "sales", "profit")])
    return typed(summarise.summarise_level(back, CUSTOMER, FISCAL))


#: Names as they occur in real files, by customer code; valid in Spark and DuckDB SQL.
AWKWARD_NAME = """CASE CAST(cust_code AS BIGINT) % 7
    WHEN 0 THEN concat('24" ', cust_name) WHEN 1 THEN concat('A "Q", ', cust_name)
    WHEN 2 THEN concat(cust_name, chr(10), chr(10), 'second line') WHEN 3 THEN concat(cust_name, chr(92))
    WHEN 4 THEN concat(' ', cust_name, ' ') WHEN 5 THEN '' ELSE NULL END"""


def q_csv_quoted_roundtrip(spark, d):
    """R-1: names with quotes, commas, line breaks, backslashes, blanks at
    the ends, empty and missing ones, through a detail CSV."""
    out = scratch_path(spark, "csv")
    names = {**REFERENCE_KEY_NAMES, **REFERENCE_DETAIL_METRICS}
    det = cur_detail(spark, d).select("cust_code", F.expr(AWKWARD_NAME).alias("cust_name"), "qty", "area", "sales", "profit")
    csvio.write_csv(det.withColumnsRenamed({c: names[c] for c in det.columns}), out)
    back = readers.read_detail_csv(spark, out, encoding="UTF-8", required=True, metric_type="decimal(20,4)")
    return typed(summarise.summarise_level(back, CUSTOMER, FISCAL))


def q_csv_rejected_rows(spark, d):
    """Records with a cell too few or too many, and the others beside them."""
    out = scratch_path(spark, "csv")
    code, name = F.col("c_custkey"), F.col("c_name")
    line = F.when(code % 5 == 0, F.concat_ws(",", code, name)).when(code % 5 == 1, F.concat_ws(",", code, name, F.lit("1,2"))).otherwise(
        F.concat(code.cast("string"), F.lit(',"'), name, F.lit('"",",1')))
    table(spark, d, "customer").select(line.alias("code,name,n")).write.option("header", True).option("sep", "\u0001").option(
        "quote", "\u0000").csv(out)
    read = csvio.read_csv(spark, out)
    return read.rejected.select("record", "reason").unionByName(
        read.rows.select(F.concat_ws("|", "code", "name", "n").alias("record"), F.lit(None).cast("string").alias("reason")))


def q_export_values_roundtrip(spark, d):
    """W-5 / C-4: the same names through the export, and what its manifest finds changed."""
    base = scratch_path(spark, "values")
    paths = writers.level_paths(base, "annual", "result")
    writers.write_levels({"customer": cur_level(spark, d, CUSTOMER).withColumn("cust_name", F.expr(AWKWARD_NAME))}, paths)
    done = jobs.export_levels(spark, paths, f"{base}/csv", FISCAL, ANNUAL, availability="available")
    at = f"{base}/csv/{done[0]}"
    return typed(writers.read_export(spark, at).drop("position")).withColumn(
        "files_changed", F.lit(writers.check_export(spark, at).count()))


def q_rank_persisted(spark, d):
    """O-1, O-2: ranks stored with the written tables."""
    run = _job_run(spark, d, ANNUAL, past_all(spark, d, materialized=True), rank_column="rank")
    return _union([run.tables[lv.name].select(F.lit(lv.name).alias("level"), "rank", *lv.keys, F.col(FISCAL.sales_col).cast("long").alias(
        FISCAL.sales_col)) for lv in LEVELS])


def q_export_rank_ranges(spark, d):
    """W-5, W-6: the export takes ranges of stored ranks; each row with its place."""
    base = scratch_path(spark, "ranges")
    paths = {lv: p for lv, p in writers.level_paths(base, "annual", "result").items() if lv != "corp"}
    tables = {lv.name: typed(shape.fill_column(merged(spark, d, lv), FISCAL.sales_col, 0)) for lv in LEVELS if lv.name in paths}
    writers.write_levels({lv.name: number_rows(tables[lv.name], rank.rank_order(tables[lv.name], lv, FISCAL, ANNUAL), "rank")
                          for lv in LEVELS if lv.name in tables}, paths)
    jobs.export_levels(spark, paths, f"{base}/csv", FISCAL, ANNUAL, rank_column="rank")
    keys = {"customer": CUSTOMER.keys, "customer_product": CUSTOMER_PRODUCT.keys}
    return _union([
        writers.read_export(spark, f"{base}/csv/{lv}").select(
            F.lit(lv).alias("level"), F.col("position").cast("long"), *keys[lv],
            F.col(FISCAL.sales_col).cast("long").alias(FISCAL.sales_col))
        for lv in paths])


#: A code that a third of the rows share, and no code for some; valid in Spark and DuckDB SQL.
SHARED_CODE = """CASE WHEN CAST(cust_code AS BIGINT) % 3 = 0 THEN '0' WHEN CAST(cust_code AS BIGINT) % 11 = 1 THEN NULL
    ELSE cust_code END"""


def q_merge_split_keys(spark, d):
    """J-1..J-3 where one key has a third of the rows of both sides."""
    shared = lambda t: t.drop("cust_name").withColumn("cust_code", F.expr(SHARED_CODE))
    lv = LevelSpec("customer", ("cust_code",))
    m = merge.merge_level(shared(cur_level(spark, d, CUSTOMER)), shared(past_level(spark, d, CUSTOMER)), lv, FISCAL, ANNUAL, rows_in_task=100)
    return m.groupBy("cust_code").agg(F.count(F.lit(1)).alias("pairs"), *[
        F.sum(FISCAL.col("sales", fy)).cast("long").alias(FISCAL.col("sales", fy)) for fy in (CUR_FY, CUR_FY - 1)])


def q_merge_zero_row_past(spark, d):
    """F-5, J-9, V-6: past tables that are there and have no rows."""
    past_paths = writers.level_paths(scratch_path(spark, "past"), "annual", "past")
    writers.write_levels({k: v.limit(0) for k, v in past_all(spark, d).items()}, past_paths)
    run = _job_run(spark, d, ANNUAL, readers.read_levels(spark, past_paths))
    return typed(run.tables["customer"]).withColumn("n_advice", F.lit(len(run.advice)))


def q_master_lacks_name(spark, d):
    """F-6: a corporation that neither the master nor the past names."""
    past = past_all(spark, d, materialized=True)
    past["corp"] = past["corp"].drop("corp_name")
    master = corp_master(spark, d).withColumn("corp_name", F.when(F.col("corp_code") != NAMELESS, F.col("corp_name")))
    run = _job_run(spark, d, ANNUAL, past, master=master)
    return spark.createDataFrame([("corp", run.null_names)], "level string, null_names long")


def q_rank_skipped(spark, d):
    """O-5: the quarter job sorts nothing without the current sales."""
    m = merged(spark, d, CUSTOMER, QUARTER).drop(FISCAL.sales_col)
    order = rank.rank_order(m, CUSTOMER, FISCAL, QUARTER)
    return typed(rank.ordered(m, order)).withColumn("sorted_by", F.lit(len(order)))


def q_detail_projected(spark, d):
    """R-2: a projected read of the CSV, then the corp summary."""
    out = scratch_path(spark, "csv")
    names = {**REFERENCE_KEY_NAMES, **REFERENCE_DETAIL_METRICS}
    det = cur_detail(spark, d).select("corp_code", "office", "qty", "area", "sales", "profit")
    det.withColumnsRenamed({c: names[c] for c in det.columns}).write.option("header", True).csv(out)
    back = readers.read_detail_csv(spark, out, encoding="UTF-8", required=True, metric_type="decimal(20,4)",
                                   usecols=["corp_code", "sales", "no_such_column"])
    return summarise.summarise_level(back, CORP, FISCAL)


def q_master_missing_lenient(spark, d):
    """R-4: the quarter job without a master keeps the names of the past."""
    master = readers.read_master_csv(spark, f"{d.rstrip('/')}/no_such_master.csv", required=False)
    m = merge.merge_level(cur_level(spark, d, CORP), past_level(spark, d, CORP), CORP, FISCAL, QUARTER)
    return typed(enrich.master_join(m, master))


def q_parquet_roundtrip(spark, d):
    """All level tables written and read back, as (level, rows, sales, profit)."""
    paths = writers.level_paths(scratch_path(spark, "pq"), "annual", "summary", reference_names=True)
    writers.write_levels(cur_all(spark, d, materialized=True), paths, FISCAL, reference_names=True)
    back = readers.read_levels(spark, paths, required=True)
    return _union([_level_summary(lv, from_reference(t, FISCAL)) for lv, t in back.items()])


def _level_summary(level: str, t: DataFrame) -> DataFrame:
    return t.agg(F.lit(level).alias("level"), F.count(F.lit(1)).alias("rows"), *[
        F.sum(F.col(FISCAL.col(m, CUR_FY)).cast("long")).alias(m) for m in ("sales", "profit")])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def q_availability_policy(spark, d):
    """W-7 / W-8 with one of three level tables missing: best effort takes
    the others, all-or-nothing names the missing one and stops."""
    paths = writers.level_paths(scratch_path(spark, "avail"), "annual", "result")
    cur = cur_all(spark, d, materialized=True)
    writers.write_levels({k: cur[k] for k in ("corp", "customer")}, paths)
    present, _ = writers.available_levels(spark, paths, policy="available")
    try:
        writers.available_levels(spark, paths, policy="all")
        stopped = False
    except FileNotFoundError as e:
        stopped = str(e) == paths["customer_product"]
    return _union([_level_summary(lv, spark.read.parquet(paths[lv])).withColumn("all_stops", F.lit(stopped)) for lv in present])


def q_export_csv_roundtrip(spark, d):
    """C-4: result tables written as parquet, exported per level as ordered
    CSV (availability 'available', numeric nulls -> 0), read back."""
    base = scratch_path(spark, "export")
    paths = writers.level_paths(base, "annual", "result")
    writers.write_levels({"customer": cur_level(spark, d, CUSTOMER)}, paths)
    done = jobs.export_levels(spark, paths, f"{base}/csv", FISCAL, ANNUAL, availability="available")
    return typed(writers.read_export(spark, f"{base}/csv/{done[0]}").drop("position"))


def q_export_rank_order(spark, d):
    """W-5, W-6: each exported row with its place in the part files."""
    base = scratch_path(spark, "order")
    paths = {lv: p for lv, p in writers.level_paths(base, "annual", "result").items() if lv != "corp"}
    tables = {lv.name: shape.fill_column(merged(spark, d, lv), FISCAL.sales_col, 0) for lv in LEVELS if lv.name in paths}
    writers.write_levels({k: typed(t) for k, t in tables.items()}, paths)
    jobs.export_levels(spark, paths, f"{base}/csv", FISCAL, ANNUAL)
    keys = {"customer": CUSTOMER.keys, "customer_product": CUSTOMER_PRODUCT.keys}
    return _union([
        writers.read_export(spark, f"{base}/csv/{lv}").select(
            F.lit(lv).alias("level"), F.col("position").cast("long"), *keys[lv],
            F.col(FISCAL.sales_col).cast("long").alias(FISCAL.sales_col))
        for lv in paths])


def q_merge_observed_totals(spark, d):
    """C-2 end to end: the three ranked tables are written once and their
    totals and row counts are observed during the same write jobs."""
    return reconcile.as_double(_job_run(spark, d, ANNUAL, past_all(spark, d, materialized=True)).totals)


def _job_run(spark, d, policy, past, master=None, **options) -> jobs.MergeRun:
    paths = writers.level_paths(scratch_path(spark, "merge"), policy.name, "result")
    return jobs.run_merge_years(cur_all(spark, d, materialized=True), past, master or corp_master(spark, d), FISCAL, policy, paths, **options)


def q_annual_job_report(spark, d):
    """What the written annual job reports: the comparison with its inputs,
    with the verdict and the checks around it on every row."""
    run = _job_run(spark, d, ANNUAL, past_all(spark, d, materialized=True))
    return reconcile.as_double(run.report).crossJoin(F.broadcast(run.verdict)).crossJoin(F.broadcast(run.overlap)).withColumn(
        "null_names", F.lit(run.null_names).cast("long")).withColumn("n_advice", F.lit(len(run.advice)))


def q_quarter_job_report(spark, d):
    """The same for the quarter, with a past that is still split by sales
    rep, so that current figures are counted more than once."""
    cur, past = _quarter_inputs_by_rep(spark, d)
    paths = writers.level_paths(scratch_path(spark, "merge"), "quarter", "result")
    run = jobs.run_merge_years(cur, past, corp_master(spark, d), FISCAL, QUARTER, paths)
    return reconcile.as_double(run.report).crossJoin(F.broadcast(run.overlap)).withColumn(
        "null_names", F.lit(run.null_names).cast("long")).withColumn("n_advice", F.lit(len(run.advice)))


def _reference_files(spark, d, policy, legacy: bool) -> tuple[str, dict[str, str]]:
    """The original job's inputs, derived from the given tables: FY2001
    detail as a cp932 CSV with Japanese headers, the past tables as
    reference-named parquet, the master as a cp932 CSV."""
    base = scratch_path(spark, "ref")
    names = {**REFERENCE_KEY_NAMES, **REFERENCE_DETAIL_METRICS}
    det = cur_detail(spark, d).select(*CUSTOMER_PRODUCT.keys, "corp_code", "qty", "area", "sales", "profit")
    det.withColumnsRenamed({c: names[c] for c in det.columns}).write.option("header", True).option(
        "encoding", "windows-31j"
    ).csv(f"{base}/detail")
    corp_master(spark, d).withColumnsRenamed({c: names[c] for c in ("corp_code", "corp_name")}).write.option(
        "header", True
    ).option("encoding", "windows-31j").csv(f"{base}/master")
    past_paths = writers.level_paths(f"{base}/past", policy.name, "past", reference_names=True)
    scratch = scratch_path(spark)
    past = past_all(spark, d, materialized=True, path=scratch)
    writers.write_levels(with_legacy_names(past) if legacy else {k: to_reference(v, FISCAL) for k, v in past.items()}, past_paths)
    release(spark, scratch)
    return base, past_paths


def _reference_run(spark, d, policy, legacy: bool) -> dict[str, DataFrame]:
    base, past_paths = _reference_files(spark, d, policy, legacy)
    out = jobs.run_reference_job(
        spark, f"{base}/detail", past_paths, f"{base}/master", f"{base}/out", FISCAL, policy, metric_type="decimal(20,4)")
    return {lv: from_reference(spark.read.parquet(p), FISCAL) for lv, p in out["result"].items()}


def q_reference_job(level: str):
    """One result table of the three original stages on their own files."""
    return lambda spark, d: typed(_reference_run(spark, d, ANNUAL, legacy=False)[level])


def q_reference_job_legacy(policy):
    """All three result tables, from past files with legacy column names."""

    def q(spark, d):
        tables = _reference_run(spark, d, policy, legacy=True)
        fixed = typed if policy.name == "annual" else (lambda t: t)
        return _union([fixed(t).withColumn("level", F.lit(lv)) for lv, t in tables.items()])

    return q


def q_ranking(policy, level):
    """The merge job restricted to one level (inputs of that level only)."""

    def q(spark, d):
        lv = next(x for x in LEVELS if x.name == level)
        master = corp_master(spark, d) if level == "corp" else None
        pol = policy.with_(missing_master="skip")
        t = jobs.merge_years({level: cur_level(spark, d, lv)}, {level: past_level(spark, d, lv)}, master, FISCAL, pol, (lv,)).tables[level]
        return typed(t) if policy.name == "annual" else t

    return q


def prepared(query: Query) -> Query:
    """The query on a session with the job's settings, whatever ran before."""
    return lambda spark, d: query(prepare(spark), d)


def queries() -> dict[str, Query]:
    return {name: prepared(query) for name, query in _queries().items()}


def _queries() -> dict[str, Query]:
    return {
        "summary_corp": q_summary(CORP),
        "summary_customer": q_summary(CUSTOMER),
        "summary_customer_product": q_summary(CUSTOMER_PRODUCT),
        "fiscal_year_totals": q_fiscal_year_totals,
        "summary_grouping_sets": q_summary_grouping_sets,
        "summarise_partitioned": q_summarise_partitioned,
        "past_wide_customer": q_past_wide_customer,
        "merge_corp": q_merge(CORP),
        "merge_customer": q_merge(CUSTOMER),
        "merge_customer_product": q_merge(CUSTOMER_PRODUCT),
        "merge_left_key_policy": q_merge_left_key_policy,
        "merge_conflict_fill_null": q_merge_conflict("fill_null"),
        "merge_conflict_overwrite": q_merge_conflict("overwrite"),
        "merge_empty_past": q_merge_empty_past,
        "merge_long_pivot": q_merge_long_pivot,
        "legacy_rename": q_legacy_rename,
        "missing_years": q_missing_years,
        "master_join": q_master_join,
        "product_reaggregate": q_product_reaggregate(False, QUARTER),
        "product_reaggregate_stacked": q_product_reaggregate(True, QUARTER),
        "product_reaggregate_rep_key": q_product_reaggregate(None, ANNUAL),
        "backfill_corp_code": q_backfill_corp_code,
        "backfill_customer_fanout": q_backfill_customer_fanout,
        "backfill_corp_ambiguous": q_backfill_ambiguous("corp_code", "corp_name", CORP, lambda: F.col("office"), "min"),
        "backfill_customer_ambiguous": q_backfill_ambiguous(
            "cust_code", "cust_name", CUSTOMER,
            lambda: F.concat(F.lit("group "), (F.regexp_extract("cust_name", r"(\d+)$", 1).cast("long") % NAME_GROUPS).cast("string")),
            "fanout"),
        "dedupe_subset": q_dedupe_subset,
        "reorder_filter": q_reorder_filter,
        "reorder_generated": q_reorder_generated,
        "finalise_metrics": q_finalise_metrics,
        "zero_row_filter": q_zero_row_filter,
        "rank_corp_top": q_rank_top(CORP),
        "rank_customer_top": q_rank_top(CUSTOMER),
        "rank_product_top": q_rank_top(CUSTOMER_PRODUCT),
        "rank_fallback": q_rank_fallback,
        "rank_product_fallback": q_rank_product_fallback,
        "rank_custom_office": q_rank_custom_office,
        "totals_by_level_year": q_totals_by_level_year,
        "totals_precedence": q_totals_precedence,
        "totals_text": q_totals_text,
        "recon_absolute": q_recon_absolute,
        "recon_absolute_faults": q_recon_absolute_faults,
        "recon_cross_level": q_recon_cross_level,
        "recon_verdict": q_recon_verdict,
        "premerge_conflicts": q_premerge_conflicts,
        "recon_relative": q_recon_relative,
        "merge_totals": q_merge_totals,
        "merge_bucketed": q_merge_bucketed,
        "generation_commit": q_generation_commit,
        "checkpoint_report": q_checkpoint_report,
        "key_overlap": q_key_overlap,
        "key_overlap_bitmaps": q_key_overlap_bitmaps,
        "null_profile": q_null_profile,
        "table_profile": q_table_profile,
        "export_ready": q_export_ready,
        "csv_cp932_roundtrip": q_csv_cp932_roundtrip,
        "csv_quoted_roundtrip": q_csv_quoted_roundtrip,
        "csv_rejected_rows": q_csv_rejected_rows,
        "export_values_roundtrip": q_export_values_roundtrip,
        "rank_persisted": q_rank_persisted,
        "export_rank_ranges": q_export_rank_ranges,
        "merge_split_keys": q_merge_split_keys,
        "merge_zero_row_past": q_merge_zero_row_past,
        "master_lacks_name": q_master_lacks_name,
        "rank_skipped": q_rank_skipped,
        "detail_projected": q_detail_projected,
        "master_missing_lenient": q_master_missing_lenient,
        "parquet_roundtrip": q_parquet_roundtrip,
        "availability_policy": q_availability_policy,
        "export_csv_roundtrip": q_export_csv_roundtrip,
        "export_rank_order": q_export_rank_order,
        "merge_observed_totals": q_merge_observed_totals,
        "annual_job_report": q_annual_job_report,
        "quarter_job_report": q_quarter_job_report,
        "reference_job_corp": q_reference_job("corp"),
        "reference_job_product": q_reference_job("customer_product"),
        "reference_job_legacy_annual": q_reference_job_legacy(ANNUAL),
        "reference_job_legacy_quarter": q_reference_job_legacy(QUARTER),
        "annual_corp_rank": q_ranking(ANNUAL, "corp"),
        "annual_customer_rank": q_ranking(ANNUAL, "customer"),
        "annual_product_rank": q_ranking(ANNUAL, "customer_product"),
        "quarter_corp_rank": q_ranking(QUARTER, "corp"),
        "quarter_customer_rank": q_ranking(QUARTER, "customer"),
        "quarter_product_rank": q_ranking(QUARTER, "customer_product"),
    }
