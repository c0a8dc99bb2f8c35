"""DuckDB oracle SQL for every registered query.

Written as plain SQL over the pre-registered star-schema views: full outer
joins with COALESCE for the merges, GROUP BY for re-aggregation, UNION ALL
for totals.  Decimal sums are truncated with ``trunc`` before the BIGINT
cast (DuckDB's cast rounds).  Column lists are generated from the fixture
constants so both sides name columns identically.
"""

from __future__ import annotations

from ..sources.fixtures import DETAIL_SQL
from .catalog import (
    ASOF_CUT, AWKWARD_NAME, CUR_FY, LOST_YEAR, MASKED_REGION, NAME_GROUPS, NAMELESS, OFFICE_ORDER, PRELIM_END, SHARED_CODE, TOP,
)

FIRST_PAST = 1994  # stated here on its own: the data's first fiscal year

PAST_YEARS = list(range(CUR_FY - 1, FIRST_PAST - 1, -1))
ALL_YEARS = [CUR_FY] + PAST_YEARS
CORP_K = ["corp_code"]
CUST_K = ["cust_code", "cust_name"]
PROD_K = ["office", "cust_code", "cust_name", "category", "prod_code", "prod_name"]
KEYS = {"corp": CORP_K, "customer": CUST_K, "customer_product": PROD_K}
PAST_COLS = {"corp": CORP_K + ["corp_name"], "customer": CUST_K, "customer_product": PROD_K}
INTEGRAL = {"sales", "profit"}


def metrics_for(fy: int) -> list[str]:
    return ["qty", "area", "sales", "profit"] if fy == CUR_FY else ["area", "sales", "profit"]


def ycols(years=None) -> list[str]:
    return [f"{m}_{fy}" for fy in (years or ALL_YEARS) for m in metrics_for(fy)]


CUR_COLS = ycols([CUR_FY])
PAST_YCOLS = ycols(PAST_YEARS)
ALL_YCOLS = ycols()


def metric_of(col: str) -> str:
    return col.rsplit("_", 1)[0]


def fy_of(col: str) -> int:
    return int(col.rsplit("_", 1)[1])


def typed(col: str, expr: str | None = None) -> str:
    e = expr or col
    return f"CAST({e} AS {'BIGINT' if metric_of(col) in INTEGRAL else 'DOUBLE'}) AS {col}"


def jk(keys, a="c", b="p") -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def csum(m: str, val: str | None = None, zero: bool = True) -> str:
    v = val or m
    s = f"COALESCE(SUM({v}), 0)" if zero else f"SUM({v})"
    return f"CAST(TRUNC({s}) AS BIGINT)" if m in INTEGRAL else s


def cur_sql(keys, where=f"fy = {CUR_FY}", src="detail") -> str:
    k = ", ".join(keys)
    aggs = ", ".join(f"{csum(m)} AS {m}_{CUR_FY}" for m in metrics_for(CUR_FY))
    return f"SELECT {k}, {aggs} FROM {src} WHERE {where} GROUP BY {k}"


def wide_sql(keys, years=None, where=f"fy BETWEEN {FIRST_PAST} AND {CUR_FY - 1}", src="detail", extra="") -> str:
    years = years or PAST_YEARS
    k = ", ".join(keys)
    aggs = []
    for fy in years:
        for m in metrics_for(fy):
            aggs.append(f"{csum(m, f'CASE WHEN fy = {fy} THEN {m} END', zero=False)} AS {m}_{fy}")
    return f"SELECT {k}, {', '.join(aggs)}{extra} FROM {src} WHERE {where} GROUP BY {k}"


def with_(**ctes) -> str:
    parts = [f"detail AS ({DETAIL_SQL})"] + [f"{n} AS ({s})" for n, s in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def merged_sql(level: str, conflict: str = "fill_null", keys_mode: str = "coalesce", cur_cols=None, past_cols=None,
               ids_from_past: list[str] | None = None) -> str:
    """Full outer merge of ``cur`` and ``past`` CTEs (one row per pair)."""
    keys = KEYS[level]
    cur_cols = CUR_COLS if cur_cols is None else cur_cols
    past_cols = PAST_YCOLS if past_cols is None else past_cols
    ids_from_past = ["corp_name"] if (level == "corp" and ids_from_past is None) else (ids_from_past or [])
    if keys_mode == "left":
        kx = [f"c.{k} AS {k}" for k in keys]
    else:
        kx = [f"COALESCE(c.{k}, p.{k}) AS {k}" for k in keys]
    sel = kx + [f"p.{i} AS {i}" for i in ids_from_past]
    for c in ALL_YCOLS:
        if fy_of(c) == CUR_FY:
            sel.append(f"c.{c} AS {c}" if c in cur_cols else f"CAST(NULL AS DOUBLE) AS {c}")
        elif c in past_cols and (conflict == "overwrite" or c not in cur_cols):
            sel.append(f"p.{c} AS {c}")
        elif c in past_cols:
            sel.append(f"COALESCE(c.{c}, p.{c}) AS {c}")
        elif c in cur_cols:
            sel.append(f"c.{c} AS {c}")
        else:
            sel.append(f"CAST(NULL AS DOUBLE) AS {c}")
    return f"SELECT {', '.join(sel)} FROM cur c FULL OUTER JOIN past p ON {jk(keys)}"


def reagg_sql(keys, src="m", cols=None) -> str:
    cols = cols or ALL_YCOLS
    k = ", ".join(keys)
    return f"SELECT {k}, {', '.join(f'COALESCE(SUM({c}), 0) AS {c}' for c in cols)} FROM {src} GROUP BY {k}"


def out(cols_keys, cols=None, src="m", where="", order="") -> str:
    cols = ALL_YCOLS if cols is None else cols
    return f"SELECT {', '.join(cols_keys + [typed(c) for c in cols])} FROM {src} {where} {order}"


def std_ctes(level: str) -> dict:
    return {"cur": cur_sql(KEYS[level]), "past": wide_sql(PAST_COLS[level])}


def merged_level_ctes(level: str, conflict="fill_null") -> dict:
    ctes = std_ctes(level)
    if level == "customer_product":
        ctes["j"] = merged_sql(level, conflict)
        ctes["m"] = reagg_sql(PROD_K, "j")
    else:
        ctes["m"] = merged_sql(level, conflict)
    return ctes


def level_out_keys(level: str) -> list[str]:
    return PAST_COLS[level] if level == "corp" else KEYS[level]


def q_merge(level: str) -> str:
    return with_(**merged_level_ctes(level)) + out(level_out_keys(level))


# ------------------------------------------------------------- totals SQL
def totals_union(tables: dict[str, str], cols_by_level: dict[str, list[str]]) -> str:
    parts = []
    for lv, t in tables.items():
        for c in cols_by_level[lv]:
            parts.append(
                f"SELECT '{lv}' AS level, {fy_of(c)} AS fy, '{metric_of(c)}' AS metric, CAST(SUM({c}) AS DOUBLE) AS total FROM {t}"
            )
    return " UNION ALL ".join(parts)


def all_merged_ctes(policy_conflict="fill_null", past_prod_by_rep=False, drop_rep=True) -> dict:
    ctes = {}
    for lv, short in (("corp", "co"), ("customer", "cu"), ("customer_product", "pr")):
        ctes[f"cur_{short}"] = cur_sql(KEYS[lv])
        if lv == "customer_product" and past_prod_by_rep:
            ctes[f"past_{short}"] = wide_sql(PROD_K + ["rep_name"])
        else:
            ctes[f"past_{short}"] = wide_sql(PAST_COLS[lv])
        body = merged_sql(lv, policy_conflict).replace("FROM cur c FULL OUTER JOIN past p", f"FROM cur_{short} c FULL OUTER JOIN past_{short} p")
        if lv == "customer_product":
            ctes[f"j_{short}"] = body
            ctes[f"m_{short}"] = reagg_sql(PROD_K, f"j_{short}")
        else:
            ctes[f"m_{short}"] = body
    return ctes


SHORT = {"corp": "co", "customer": "cu", "customer_product": "pr"}


def _cur_cols_all():
    return {lv: CUR_COLS for lv in KEYS}


def _past_cols_all():
    return {lv: PAST_YCOLS for lv in KEYS}


def _all_cols():
    return {lv: ALL_YCOLS for lv in KEYS}


def sales_only(cols):
    return [c for c in cols if metric_of(c) == "sales"]


def rank_sql(level: str, order: str, n: int, src_ctes: dict, cols=None, extra_keys=None) -> str:
    keys = extra_keys or level_out_keys(level)
    cols = ALL_YCOLS if cols is None else cols
    sel = [f"CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank"] + keys + [typed(c) for c in cols]
    return with_(**src_ctes) + f"SELECT {', '.join(sel)} FROM m ORDER BY {order} LIMIT {n}"


def tie(keys) -> str:
    return ", ".join(f"{k} ASC NULLS FIRST" for k in keys)


def office_ordinal(col="office") -> str:
    whens = " ".join(f"WHEN {col} = '{o}' THEN {i}" for i, o in enumerate(OFFICE_ORDER))
    return f"CASE WHEN {col} IS NULL THEN NULL {whens} ELSE {len(OFFICE_ORDER)} END"


def ranking_sql(level: str, policy: str) -> str:
    ctes = merged_level_ctes(level, "fill_null" if policy == "annual" else "overwrite")
    keys = level_out_keys(level)
    if level == "corp":
        ctes["mm"] = (
            "SELECT m.* REPLACE (COALESCE(m.corp_name, n.n_name) AS corp_name) FROM m LEFT JOIN nation n "
            "ON m.corp_code = CAST(n.n_nationkey AS VARCHAR)"
        )
        src = "mm"
    else:
        src = "m"
    if policy == "annual":
        sc = f"sales_{CUR_FY}"
        cols = [typed(c, f"COALESCE({c}, 0)") if c == sc else typed(c) for c in ALL_YCOLS]
        return with_(**ctes) + f"SELECT {', '.join(keys + cols)} FROM {src}"
    cols = [f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in ALL_YCOLS]
    nz = " OR ".join(f"COALESCE({c}, 0) <> 0" for c in ALL_YCOLS)
    return with_(**ctes) + f"SELECT {', '.join(keys + cols)} FROM {src} WHERE {nz}"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for lv in ("corp", "customer", "customer_product"):
        q[f"summary_{lv}"] = with_(cur=cur_sql(KEYS[lv])) + out(KEYS[lv], CUR_COLS, "cur")
    q["fiscal_year_totals"] = with_() + (
        "SELECT fy, COUNT(*) AS n_lines, CAST(COALESCE(SUM(qty), 0) AS DOUBLE) AS qty, "
        "CAST(TRUNC(COALESCE(SUM(sales), 0)) AS BIGINT) AS sales FROM detail GROUP BY fy"
    )
    all_keys = ["corp_code", "cust_code", "cust_name", "office", "category", "prod_code", "prod_name"]
    aggs = ", ".join(f"{typed(f'{m}_{CUR_FY}', csum(m))}" for m in metrics_for(CUR_FY))
    q["summary_grouping_sets"] = with_() + (
        "SELECT CASE WHEN GROUPING(corp_code) = 0 THEN 'corp' WHEN GROUPING(office) = 0 THEN 'customer_product' "
        f"ELSE 'customer' END AS level, {', '.join(all_keys)}, {aggs} FROM detail WHERE fy = {CUR_FY} "
        "GROUP BY GROUPING SETS ((corp_code), (cust_code, cust_name), "
        "(office, cust_code, cust_name, category, prod_code, prod_name))"
    )
    q["summarise_partitioned"] = q["summary_customer_product"]
    q["past_wide_customer"] = with_(past=wide_sql(CUST_K)) + out(CUST_K, PAST_YCOLS, "past")
    for lv in ("corp", "customer", "customer_product"):
        q[f"merge_{lv}"] = q_merge(lv)
    q["merge_left_key_policy"] = with_(**std_ctes("customer"), m=merged_sql("customer", keys_mode="left")) + out(CUST_K)

    prelim_cols = [f"{m}_{CUR_FY - 1}" for m in metrics_for(CUR_FY - 1)]
    cur_pre = (
        f"SELECT cust_code, cust_name, "
        + ", ".join(f"{csum(m, f'CASE WHEN fy = {CUR_FY} THEN {m} END')} AS {m}_{CUR_FY}" for m in metrics_for(CUR_FY))
        + ", "
        + ", ".join(
            f"{csum(m, f'CASE WHEN fy = {CUR_FY - 1} AND order_date < DATE {chr(39)}{PRELIM_END}{chr(39)} THEN {m} END', zero=False)} AS {m}_{CUR_FY - 1}"
            for m in metrics_for(CUR_FY - 1)
        )
        + f" FROM detail WHERE fy BETWEEN {CUR_FY - 1} AND {CUR_FY} GROUP BY cust_code, cust_name"
    )
    for conflict in ("fill_null", "overwrite"):
        q[f"merge_conflict_{conflict}"] = with_(
            cur=cur_pre, past=wide_sql(CUST_K), m=merged_sql("customer", conflict, cur_cols=CUR_COLS + prelim_cols)
        ) + out(CUST_K)
    q["merge_empty_past"] = q["summary_customer"]
    q["merge_long_pivot"] = q["merge_customer"]
    q["legacy_rename"] = (
        f"SELECT 'customer' AS level, * FROM ({q['past_wide_customer']}) UNION ALL BY NAME "
        f"SELECT 'customer_product' AS level, * FROM ({with_(past=wide_sql(PROD_K)) + out(PROD_K, PAST_YCOLS, 'past')})"
    )
    q["missing_years"] = with_(cur=cur_sql(CUST_K)) + (
        "SELECT cust_code, cust_name, "
        + ", ".join(typed(c) if c in CUR_COLS else typed(c, "NULL") for c in CUR_COLS + PAST_YCOLS)
        + " FROM cur"
    )
    names = f", MAX(CASE WHEN office <> '{MASKED_REGION}' THEN lower(corp_name) END) AS corp_name"
    q["master_join"] = with_(
        cur=cur_sql(CORP_K),
        past=wide_sql(CORP_K, extra=names),
        m0=merged_sql("corp"),
        m="SELECT m0.* REPLACE (COALESCE(m0.corp_name, n.n_name) AS corp_name) FROM m0 LEFT JOIN nation n ON m0.corp_code = CAST(n.n_nationkey AS VARCHAR)",
    ) + out(CORP_K + ["corp_name"])

    rep_ctes = {"cur": cur_sql(PROD_K), "past": wide_sql(PROD_K + ["rep_name"])}
    q["product_reaggregate"] = with_(**rep_ctes, j=merged_sql("customer_product", "overwrite", ids_from_past=["rep_name"]),
                                     m=reagg_sql(PROD_K, "j")) + out(PROD_K)
    q["product_reaggregate_stacked"] = q["product_reaggregate"]
    rep_keys = ["office", "rep_name", "cust_code", "cust_name", "category", "prod_code", "prod_name"]
    q["product_reaggregate_rep_key"] = with_(**rep_ctes, j=merged_sql("customer_product", "fill_null", ids_from_past=["rep_name"]),
                                             m=reagg_sql(rep_keys, "j")) + out(rep_keys)

    for code, name, lvl, amb in (("corp_code", "corp_name", "corp", "min"), ("cust_code", "cust_name", "customer", "fanout")):
        masked = f"SELECT CASE WHEN office = '{MASKED_REGION}' THEN NULL ELSE {code} END AS {code}, * EXCLUDE ({code}) FROM detail WHERE fy = {CUR_FY}"
        past_src = wide_sql(PAST_COLS[lvl])
        pairs = f"SELECT DISTINCT {name}, {code} FROM past WHERE {name} IS NOT NULL AND {code} IS NOT NULL"
        mapping = f"SELECT {name}, MIN({code}) AS code_fill FROM ({pairs}) GROUP BY {name}" if amb == "min" else f"SELECT {name}, {code} AS code_fill FROM ({pairs})"
        q[f"backfill_{'corp_code' if lvl == 'corp' else 'customer_fanout'}"] = with_(
            md=masked,
            cur=cur_sql([code, name], where="TRUE", src="md"),
            past=past_src,
            mp=mapping,
            m=f"SELECT COALESCE(c.{code}, mp.code_fill) AS {code}, c.* EXCLUDE ({code}) FROM cur c LEFT JOIN mp "
            f"ON c.{name} = mp.{name} AND c.{code} IS NULL AND c.{name} IS NOT NULL",
        ) + out([code, name], CUR_COLS)

    group = f"'group ' || CAST(CAST(regexp_extract(cust_name, '([0-9]+)$', 1) AS BIGINT) % {NAME_GROUPS} AS VARCHAR)"
    for query, code, name, new in (("backfill_corp_ambiguous", "corp_code", "corp_name", "office"),
                                   ("backfill_customer_ambiguous", "cust_code", "cust_name", group)):
        renamed = f"SELECT * REPLACE ({new} AS {name}) FROM detail"
        masked = f"SELECT * REPLACE (CASE WHEN office = '{MASKED_REGION}' THEN NULL ELSE {code} END AS {code}) FROM rn WHERE fy = {CUR_FY}"
        pairs = f"SELECT DISTINCT {name}, {code} AS code_fill FROM past WHERE {name} IS NOT NULL AND {code} IS NOT NULL"
        if code == "corp_code":
            pairs = f"SELECT {name}, MIN(code_fill) AS code_fill FROM ({pairs}) GROUP BY {name}"
        q[query] = with_(
            rn=renamed, md=masked, cur=cur_sql([code, name], where="TRUE", src="md"),
            past=wide_sql([code, name], src="rn"), mp=pairs,
            m=f"SELECT COALESCE(c.{code}, mp.code_fill) AS {code}, c.* EXCLUDE ({code}) FROM cur c LEFT JOIN mp "
            f"ON c.{name} = mp.{name} AND c.{code} IS NULL AND c.{name} IS NOT NULL",
        ) + out([code, name], CUR_COLS)

    q["dedupe_subset"] = with_(
        past=wide_sql(PROD_K + ["rep_name"]),
        m=f"SELECT * FROM past QUALIFY row_number() OVER (PARTITION BY {', '.join(PROD_K)} ORDER BY rep_name) = 1",
    ) + out(PROD_K + ["rep_name"], PAST_YCOLS)
    q["reorder_filter"] = q["merge_customer"]
    q["reorder_generated"] = q["merge_customer"]
    fin = [f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in ALL_YCOLS]
    q["finalise_metrics"] = with_(**merged_level_ctes("customer")) + f"SELECT {', '.join(CUST_K + fin)} FROM m"
    nz = " OR ".join(f"COALESCE({c}, 0) <> 0" for c in ALL_YCOLS)
    q["zero_row_filter"] = with_(cur=cur_sql(CUST_K)) + (
        "SELECT CAST(k.c_custkey AS VARCHAR) AS cust_code, k.c_name AS cust_name, "
        + ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in CUR_COLS)
        + " FROM customer k LEFT JOIN cur ON cur.cust_code = CAST(k.c_custkey AS VARCHAR) AND cur.cust_name = k.c_name WHERE "
        + " OR ".join(f"COALESCE({c}, 0) <> 0" for c in CUR_COLS)
    )

    sc = f"sales_{CUR_FY}"
    for lv, name in (("corp", "rank_corp_top"), ("customer", "rank_customer_top"), ("customer_product", "rank_product_top")):
        ctes = merged_level_ctes(lv)
        ctes["m0"] = ctes.pop("m")
        ctes["m"] = f"SELECT * REPLACE (COALESCE({sc}, 0) AS {sc}) FROM m0"
        if lv == "customer_product":
            order = f"{sc} DESC NULLS FIRST, office ASC NULLS FIRST, {tie(KEYS[lv])}"
        else:
            order = f"{sc} DESC NULLS FIRST, {tie(KEYS[lv])}"
        q[name] = rank_sql(lv, order, TOP, ctes)
    no_sales = [c for c in ALL_YCOLS if c != sc]
    q["rank_fallback"] = rank_sql("customer", f"sales_{CUR_FY - 1} DESC NULLS FIRST, {tie(CUST_K)}", TOP,
                                  merged_level_ctes("customer"), cols=no_sales)
    q["rank_product_fallback"] = rank_sql(
        "customer_product",
        f"office ASC NULLS FIRST, cust_name ASC NULLS FIRST, category ASC NULLS FIRST, {tie(PROD_K)}",
        TOP, merged_level_ctes("customer_product"), cols=no_sales)
    q["rank_custom_office"] = rank_sql(
        "customer_product",
        f"{office_ordinal()} ASC NULLS FIRST, cust_name ASC NULLS FIRST, category ASC NULLS FIRST, {tie(PROD_K)}",
        2 * TOP,
        merged_level_ctes("customer_product", "overwrite"),
    )

    am = all_merged_ctes()
    merged_tables = {lv: f"m_{SHORT[lv]}" for lv in KEYS}
    q["totals_by_level_year"] = with_(**am) + totals_union(merged_tables, _all_cols())

    q["totals_precedence"] = with_(
        cur=cur_pre, past=wide_sql(CUST_K),
        ct=totals_union({"customer": "cur"}, {"customer": CUR_COLS + prelim_cols}),
        pt=totals_union({"customer": "past"}, {"customer": PAST_YCOLS}),
    ) + "SELECT level, fy, metric, COALESCE(c.total, p.total) AS total FROM ct c FULL OUTER JOIN pt p USING (level, fy, metric)"

    past_tables = {lv: f"past_{SHORT[lv]}" for lv in KEYS}
    before = totals_union(past_tables, {lv: sales_only(PAST_YCOLS) for lv in KEYS})
    after = totals_union(merged_tables, {lv: sales_only(ALL_YCOLS) for lv in KEYS})
    absolute = (
        "SELECT level, fy, metric, b.total AS before, a.total AS after, a.total - b.total AS diff, "
        "abs(a.total - b.total) AS abs_diff, "
        "CASE WHEN a.total - b.total > 0 THEN 'increase' WHEN a.total - b.total < 0 THEN 'decrease' END AS direction, "
        "abs(a.total - b.total) / greatest(b.total, 1.0) * 100 AS rate_pct, "
        "CASE WHEN a.total IS NOT NULL AND b.total IS NOT NULL AND a.total <> b.total THEN "
        "  CASE WHEN abs(a.total - b.total) > 1000000 THEN 'severe' WHEN abs(a.total - b.total) > 100000 THEN 'warning' ELSE 'minor' END END AS severity, "
        "CASE WHEN a.total IS NULL THEN 'lost' WHEN b.total IS NULL THEN 'new' WHEN a.total = b.total THEN 'ok' ELSE 'changed' END AS status "
        "FROM bef b FULL OUTER JOIN aft a USING (level, fy, metric)"
    )
    q["recon_absolute"] = with_(**am, bef=before, aft=after, x=absolute) + (
        "SELECT *, (status = 'lost' OR COALESCE(severity IN ('severe', 'warning'), FALSE)) AS issue FROM x"
    )
    all_totals = totals_union(merged_tables, _all_cols())
    pairs = [("corp", "customer"), ("customer", "customer_product"), ("corp", "customer_product")]
    cross_parts = " UNION ALL ".join(
        f"SELECT fy, metric, '{a}' AS level_a, '{b}' AS level_b, {a} AS total_a, {b} AS total_b FROM w" for a, b in pairs
    )
    wide = "SELECT fy, metric, " + ", ".join(f"MAX(CASE WHEN level = '{lv}' THEN total END) AS {lv}" for lv in KEYS) + " FROM t GROUP BY fy, metric"
    kept = (f"SELECT * FROM detail WHERE NOT (fy = {LOST_YEAR - 1} AND rep_name = '1-URGENT') "
            f"AND NOT (fy = {LOST_YEAR - 2} AND cust_code = '10')")
    past_only = {f"past_{SHORT[lv]}": wide_sql(PAST_COLS[lv]) for lv in KEYS}
    bad = {f"bad_{SHORT[lv]}": wide_sql(PAST_COLS[lv], src="kept") for lv in KEYS}
    q["recon_absolute_faults"] = with_(
        kept=kept, **past_only, **bad, bef=before,
        aft=totals_union({lv: f"bad_{SHORT[lv]}" for lv in KEYS},
                         {lv: [c for c in sales_only(PAST_YCOLS) if fy_of(c) != LOST_YEAR] for lv in KEYS}),
        x=absolute) + "SELECT *, (status = 'lost' OR COALESCE(severity IN ('severe', 'warning'), FALSE)) AS issue FROM x"
    q["totals_text"] = with_(**{f"cur_{SHORT[lv]}": cur_sql(KEYS[lv]) for lv in KEYS}) + " UNION ALL ".join(
        f"SELECT '{lv}' AS level, {CUR_FY} AS fy, '{m}' AS metric, format('{{:,}}', CAST(SUM({m}_{CUR_FY}) AS BIGINT)) AS text "
        f"FROM cur_{SHORT[lv]}" for lv in KEYS for m in ("sales", "profit"))
    q["recon_cross_level"] = with_(**am, t=all_totals, w=wide, x=cross_parts) + (
        "SELECT *, abs(total_a - total_b) AS abs_diff, (total_a IS DISTINCT FROM total_b) AS issue FROM x"
    )
    sales_totals = totals_union(merged_tables, {lv: sales_only(ALL_YCOLS) for lv in KEYS})
    q["recon_verdict"] = with_(
        **am, bef=before, aft=after, x=absolute,
        ab="SELECT *, (status = 'lost' OR COALESCE(severity IN ('severe', 'warning'), FALSE)) AS issue FROM x",
        t=sales_totals, w=wide, cx=cross_parts,
        cr="SELECT (total_a IS DISTINCT FROM total_b) AS issue FROM cx",
        s="SELECT CAST(COUNT(*) AS BIGINT) AS n_columns, CAST(COALESCE(SUM(CASE WHEN severity = 'severe' THEN 1 ELSE 0 END), 0) AS BIGINT) AS severe, "
          "CAST(COALESCE(SUM(CAST(issue AS INTEGER)), 0) + (SELECT COALESCE(SUM(CAST(issue AS INTEGER)), 0) FROM cr) AS BIGINT) AS issues FROM ab",
    ) + "SELECT n_columns, severe, issues, (n_columns > 0 AND severe = 0 AND issues = 0) AS valid FROM s"

    q["premerge_conflicts"] = with_(
        cur=cur_sql(CORP_K),
        past=wide_sql(CORP_K + ["corp_name"], years=ALL_YEARS,
                      where=f"fy BETWEEN {FIRST_PAST} AND {CUR_FY} AND order_date < DATE '{ASOF_CUT}'"),
        ct=totals_union({"corp": "cur"}, {"corp": sales_only(CUR_COLS)}),
        pt=totals_union({"corp": "past"}, {"corp": sales_only(ALL_YCOLS)}),
    ) + (
        "SELECT level, fy, metric, c.total AS current, p.total AS past, c.total - p.total AS diff, "
        "'check year overlap before merging; verify totals after the merge' AS recommendation "
        "FROM ct c JOIN pt p USING (level, fy, metric) WHERE abs(c.total - p.total) > 1000.0"
    )

    rep = all_merged_ctes("overwrite", past_prod_by_rep=True)
    cur_tables = {lv: f"cur_{SHORT[lv]}" for lv in KEYS}
    q["recon_relative"] = with_(
        **rep,
        ct=totals_union(cur_tables, _cur_cols_all()),
        pt=totals_union(past_tables, _past_cols_all()),
        bef="SELECT level, fy, metric, COALESCE(c.total, p.total) AS total FROM ct c FULL OUTER JOIN pt p USING (level, fy, metric)",
        aft=totals_union(merged_tables, _all_cols()),
    ) + (
        "SELECT 'merge' AS checkpoint, level, fy, metric, COALESCE(b.total, 0.0) AS before, COALESCE(a.total, 0.0) AS after, "
        "abs(COALESCE(a.total, 0.0) - COALESCE(b.total, 0.0)) AS abs_diff, "
        "CASE WHEN COALESCE(b.total, 0.0) <> 0 THEN abs(COALESCE(a.total, 0.0) - COALESCE(b.total, 0.0)) / abs(COALESCE(b.total, 0.0)) * 100 ELSE 0.0 END AS rel_pct, "
        "CASE WHEN (CASE WHEN COALESCE(b.total, 0.0) <> 0 THEN abs(COALESCE(a.total, 0.0) - COALESCE(b.total, 0.0)) / abs(COALESCE(b.total, 0.0)) * 100 ELSE 0.0 END) > 10 THEN 'high' "
        "WHEN (CASE WHEN COALESCE(b.total, 0.0) <> 0 THEN abs(COALESCE(a.total, 0.0) - COALESCE(b.total, 0.0)) / abs(COALESCE(b.total, 0.0)) * 100 ELSE 0.0 END) > 5 THEN 'medium' ELSE 'low' END AS severity "
        "FROM bef b JOIN aft a USING (level, fy, metric) WHERE COALESCE(a.total, 0.0) <> COALESCE(b.total, 0.0)"
    )

    q["merge_totals"] = with_(
        **rep,
        ct=totals_union(cur_tables, _cur_cols_all()),
        pt=totals_union(past_tables, _past_cols_all()),
        aft=totals_union(merged_tables, _all_cols()),
    ) + (
        "SELECT level, fy, metric, c.total AS current, p.total AS past, COALESCE(c.total, p.total) AS before, a.total AS merged "
        "FROM aft a LEFT JOIN ct c USING (level, fy, metric) LEFT JOIN pt p USING (level, fy, metric)"
    )

    overlap = (
        "SELECT CAST(SUM(CASE WHEN c = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS only_current, "
        "CAST(SUM(CASE WHEN c = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS only_past, "
        "CAST(SUM(CASE WHEN c = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS both "
        "FROM (SELECT k, MAX(c) AS c, MAX(p) AS p FROM (SELECT corp_code AS k, 1 AS c, 0 AS p FROM cur_co "
        "UNION ALL SELECT corp_code AS k, 0 AS c, 1 AS p FROM past_co) GROUP BY k)"
    )
    around = "(SELECT COUNT(*) FROM m_co m LEFT JOIN nation n ON m.corp_code = CAST(n.n_nationkey AS VARCHAR) " \
             "WHERE COALESCE(m.corp_name, n.n_name) IS NULL) AS null_names, 0 AS n_advice"
    q["quarter_job_report"] = q["recon_relative"].replace("SELECT 'merge' AS checkpoint", f"SELECT o.*, {around}, 'merge' AS checkpoint").replace(
        "FROM bef b JOIN aft a USING (level, fy, metric)", f"FROM bef b JOIN aft a USING (level, fy, metric), ({overlap}) o")
    verdict = q["recon_verdict"]
    head, tail = verdict.rsplit("SELECT n_columns, severe, issues,", 1)
    q["annual_job_report"] = head + (
        f"SELECT ab.*, v.*, o.*, {around} FROM ab, (SELECT n_columns, severe, issues,{tail}) v, ({overlap}) o")

    qm = all_merged_ctes("overwrite")
    final = {}
    for lv in KEYS:
        keys = level_out_keys(lv) if lv != "corp" else CORP_K
        nzq = " OR ".join(f"COALESCE({c}, 0) <> 0" for c in ALL_YCOLS)
        final[f"f_{SHORT[lv]}"] = f"SELECT {', '.join(f'CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}' for c in ALL_YCOLS)} FROM m_{SHORT[lv]} WHERE {nzq}"
    q["checkpoint_report"] = with_(**qm, **final) + " UNION ALL ".join(
        [
            f"SELECT 'current' AS checkpoint, * FROM ({totals_union(cur_tables, _cur_cols_all())})",
            f"SELECT 'past' AS checkpoint, * FROM ({totals_union(past_tables, _past_cols_all())})",
            f"SELECT 'merged' AS checkpoint, * FROM ({totals_union(merged_tables, _all_cols())})",
            f"SELECT 'final' AS checkpoint, * FROM ({totals_union({lv: f'f_{SHORT[lv]}' for lv in KEYS}, _all_cols())})",
        ]
    )

    q["key_overlap"] = with_(**std_ctes("customer")) + (
        "SELECT CAST(SUM(CASE WHEN c = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS only_current, "
        "CAST(SUM(CASE WHEN c = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS only_past, "
        "CAST(SUM(CASE WHEN c = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS both "
        "FROM (SELECT k, MAX(c) AS c, MAX(p) AS p FROM (SELECT cust_code AS k, 1 AS c, 0 AS p FROM cur "
        "UNION ALL SELECT cust_code AS k, 0 AS c, 1 AS p FROM past) GROUP BY k)"
    )
    q["key_overlap_bitmaps"] = q["key_overlap"]
    q["merge_bucketed"] = q["merge_customer"]
    typed_m = f"SELECT {', '.join(CUST_K + [typed(c) for c in ALL_YCOLS])} FROM m"
    cols = CUST_K + ALL_YCOLS
    q["null_profile"] = with_(**merged_level_ctes("customer"), t=typed_m) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls FROM t" for c in cols
    )
    dtype = {c: ("string" if c in CUST_K else ("bigint" if metric_of(c) in INTEGRAL else "double")) for c in cols}
    q["table_profile"] = with_(**merged_level_ctes("customer"), t=typed_m, n="SELECT COUNT(*) AS rows FROM t") + " UNION ALL ".join(
        f"SELECT 'customer' AS \"table\", (SELECT rows FROM n) AS rows, {len(cols)} AS n_columns, '{c}' AS column_name, '{dtype[c]}' AS dtype, "
        f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls, "
        f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / NULLIF((SELECT rows FROM n), 0) AS null_pct FROM t"
        for c in cols
    )
    q["export_ready"] = with_(**merged_level_ctes("customer")) + (
        f"SELECT {', '.join(CUST_K + [typed(c, f'COALESCE({c}, 0)') for c in ALL_YCOLS])} FROM m"
    )
    q["csv_cp932_roundtrip"] = q["summary_customer"]
    level_sums = lambda levels, extra="": with_(**{f"cur_{SHORT[lv]}": cur_sql(KEYS[lv]) for lv in levels}) + " UNION ALL ".join(
        f"SELECT '{lv}' AS level, COUNT(*) AS rows, CAST(SUM(sales_{CUR_FY}) AS BIGINT) AS sales, "
        f"CAST(SUM(profit_{CUR_FY}) AS BIGINT) AS profit{extra} FROM cur_{SHORT[lv]}" for lv in levels)
    q["parquet_roundtrip"] = level_sums(list(KEYS))
    q["detail_projected"] = with_(cur=cur_sql(CORP_K)) + f"SELECT corp_code, sales_{CUR_FY} FROM cur"
    q["master_missing_lenient"] = with_(**std_ctes("corp"), m=merged_sql("corp", "overwrite")) + out(CORP_K + ["corp_name"])
    q["availability_policy"] = level_sums(["corp", "customer"], ", TRUE AS all_stops")
    q["generation_commit"] = level_sums(["corp", "customer"], ", TRUE AS kept")
    q["export_csv_roundtrip"] = q["summary_customer"]
    quoted = with_(named=f"SELECT * REPLACE ({AWKWARD_NAME} AS cust_name) FROM detail", cur=cur_sql(CUST_K, src="named"))
    q["csv_quoted_roundtrip"] = quoted + out(CUST_K, CUR_COLS, "cur")
    q["export_values_roundtrip"] = quoted + out(CUST_K, CUR_COLS, "cur").replace("SELECT ", "SELECT 0 AS files_changed, ", 1)
    q["csv_rejected_rows"] = (
        "SELECT CASE c_custkey % 5 WHEN 0 THEN concat(c_custkey, ',', c_name) WHEN 1 THEN concat(c_custkey, ',', c_name, ',1,2') "
        "ELSE concat(c_custkey, '|', c_name, '\",|1') END AS record, "
        "CASE WHEN c_custkey % 5 < 2 THEN 'number of cells' END AS reason FROM customer")
    shared = lambda t: f"(SELECT * REPLACE ({SHARED_CODE} AS cust_code) FROM {t})"
    two = [f"sales_{CUR_FY}", f"sales_{CUR_FY - 1}"]
    q["merge_split_keys"] = with_(**std_ctes("customer")) + (
        f"SELECT COALESCE(c.cust_code, p.cust_code) AS cust_code, COUNT(*) AS pairs, "
        + ", ".join(f"CAST(SUM({s}.{x}) AS BIGINT) AS {x}" for s, x in zip("cp", two))
        + f" FROM {shared('cur')} c FULL OUTER JOIN {shared('past')} p ON c.cust_code = p.cust_code GROUP BY 1")
    q["merge_zero_row_past"] = with_(cur=cur_sql(CUST_K)) + out(CUST_K, CUR_COLS, "cur").replace("SELECT ", "SELECT 1 AS n_advice, ", 1)
    q["master_lacks_name"] = with_() + (
        "SELECT 'corp' AS level, COUNT(DISTINCT corp_code) AS null_names FROM detail "
        f"WHERE fy BETWEEN {FIRST_PAST} AND {CUR_FY} AND corp_code = '{NAMELESS}'")
    q["rank_skipped"] = with_(**merged_level_ctes("customer", "overwrite")) + (
        f"SELECT 0 AS sorted_by, {', '.join(CUST_K + [typed(c) for c in ALL_YCOLS if c != sc])} FROM m")
    ranks = [with_(**merged_level_ctes(lv)) + (
        f"SELECT '{lv}' AS level, row_number() OVER (ORDER BY COALESCE({sc}, 0) DESC, "
        f"{'office ASC NULLS FIRST, ' if lv == 'customer_product' else ''}{tie(KEYS[lv])}) AS rank, {', '.join(KEYS[lv])}, "
        f"CAST(COALESCE({sc}, 0) AS BIGINT) AS {sc} FROM m") for lv in KEYS]
    q["rank_persisted"] = " UNION ALL BY NAME ".join(f"SELECT * FROM ({x})" for x in ranks)
    places = []
    for lv, order in (("customer", ""), ("customer_product", "office ASC NULLS FIRST, ")):
        places.append(
            with_(**merged_level_ctes(lv)) + f"SELECT '{lv}' AS level, row_number() OVER (ORDER BY COALESCE({sc}, 0) DESC NULLS FIRST, "
            f"{order}{tie(KEYS[lv])}) AS position, {', '.join(KEYS[lv])}, CAST(COALESCE({sc}, 0) AS BIGINT) AS {sc} FROM m")
    q["export_rank_order"] = " UNION ALL BY NAME ".join(f"SELECT * FROM ({x})" for x in places)
    q["export_rank_ranges"] = q["export_rank_order"]
    for pol in ("annual", "quarter"):
        q[f"reference_job_legacy_{pol}"] = " UNION ALL BY NAME ".join(
            f"SELECT '{lv}' AS level, * FROM ({ranking_sql(lv, pol)})" for lv in KEYS)
    q["reference_job_corp"] = ranking_sql("corp", "annual")
    q["reference_job_product"] = ranking_sql("customer_product", "annual")
    ctes = {}
    for lv in KEYS:
        c = merged_level_ctes(lv)
        for name, sql in c.items():
            ctes[f"{name}_{SHORT[lv]}"] = sql.replace("FROM cur c FULL OUTER JOIN past p", f"FROM cur_{SHORT[lv]} c FULL OUTER JOIN past_{SHORT[lv]} p").replace(" FROM j ", f" FROM j_{SHORT[lv]} ")
        if lv == "corp":
            ctes["mm_co"] = (
                "SELECT m_co.* REPLACE (COALESCE(m_co.corp_name, n.n_name) AS corp_name) FROM m_co LEFT JOIN nation n "
                "ON m_co.corp_code = CAST(n.n_nationkey AS VARCHAR)"
            )
        src = "mm_co" if lv == "corp" else f"m_{SHORT[lv]}"
        sc = f"sales_{CUR_FY}"
        ctes[f"f_{SHORT[lv]}"] = f"SELECT {', '.join(level_out_keys(lv) + [typed(c, f'COALESCE({c}, 0)') if c == sc else typed(c) for c in ALL_YCOLS])} FROM {src}"
    parts = []
    for lv in KEYS:
        for c in ALL_YCOLS:
            parts.append(
                f"SELECT '{lv}' AS level, {fy_of(c)} AS fy, '{metric_of(c)}' AS metric, CAST(SUM({c}) AS DOUBLE) AS total, "
                f"CAST(COUNT(*) AS BIGINT) AS rows FROM f_{SHORT[lv]}"
            )
    q["merge_observed_totals"] = with_(**ctes) + " UNION ALL ".join(parts)
    for pol in ("annual", "quarter"):
        for lv in KEYS:
            q[f"{pol}_{'product' if lv == 'customer_product' else lv}_rank"] = ranking_sql(lv, pol)
    return q
