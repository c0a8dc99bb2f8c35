"""Command line: the job's three stages on reference-shaped files.

    python -m rankloom all --detail D --past-dir P --master M --out O --as-of 2025-06-30 [--policy quarter]
    python -m rankloom summarise --detail D --out O --as-of ...
    python -m rankloom merge --summary-dir S --past-dir P --master M --out O --as-of ...
    python -m rankloom export --result-dir R --out O [--availability available]

The fiscal year comes from ``--as-of`` (never from the clock).  Paths may
be on any file system Spark can read; the session is taken as configured by
``spark-submit`` (master, memory, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from .functions.naming import from_reference
from .operators import reconcile
from .plans import jobs
from .session import prepare
from .plans.spec import ANNUAL, LEVELS, QUARTER, START_YEAR, FiscalSpec
from .sources import readers, writers

POLICIES = {"annual": ANNUAL, "quarter": QUARTER}


def _fiscal(a) -> FiscalSpec:
    return FiscalSpec.as_of(dt.date.fromisoformat(a.as_of), start_year=a.start_year)


def _paths(base: str, policy: str, kind: str) -> dict[str, str]:
    return writers.level_paths(base, policy, kind, reference_names=True)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="rankloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("all", "summarise", "merge", "export"):
        p = sub.add_parser(name)
        p.add_argument("--out", required=True)
        p.add_argument("--policy", choices=sorted(POLICIES), default="annual")
        p.add_argument("--as-of", default=None, help="a date inside the fiscal year to process (YYYY-MM-DD)")
        p.add_argument("--start-year", type=int, default=START_YEAR)
        if name in ("all", "summarise"):
            p.add_argument("--detail", required=True, help="sales detail CSV (cp932, Japanese headers)")
        if name in ("all", "merge"):
            p.add_argument("--past-dir", required=True, help="folder of the past wide tables")
            p.add_argument("--master", required=True, help="corporation master CSV (cp932)")
        if name == "merge":
            p.add_argument("--summary-dir", required=True)
        if name == "export":
            p.add_argument("--result-dir", required=True)
            p.add_argument("--flavour", choices=sorted(jobs.EXPORT_FLAVOURS), default=None,
                           help="rules for missing levels, nulls and empty tables; by default those of the policy")
    a = ap.parse_args(argv)
    if not a.as_of:
        ap.error("--as-of is required")

    from pyspark.sql import SparkSession

    spark = prepare(SparkSession.builder.appName(f"rankloom-{a.cmd}").getOrCreate())
    policy = POLICIES[a.policy]
    out: dict = {"command": a.cmd}
    if a.cmd == "all":
        res = jobs.run_reference_job(spark, a.detail, _paths(a.past_dir, a.policy, "past"), a.master, a.out, _fiscal(a), policy)
        out.update({k: v for k, v in res.items() if k not in ("totals", "run")})
        if "run" in res:
            out["findings"] = res["run"].lines()
    elif a.cmd == "summarise":
        fiscal = _fiscal(a)
        detail = readers.read_detail_csv(spark, a.detail, required=False)
        if detail is None:
            out["status"] = "no detail"
        else:
            paths = _paths(a.out, a.policy, "summary")
            jobs.summarise_to_files(detail, fiscal, paths, LEVELS)
            out.update(status="ok", summary=paths)
    elif a.cmd == "merge":
        fiscal = _fiscal(a)
        cur = readers.read_levels(spark, _paths(a.summary_dir, a.policy, "summary"), required=True)
        cur = {k: from_reference(v, fiscal) for k, v in cur.items()}
        past = readers.read_past(spark, _paths(a.past_dir, a.policy, "past"), fiscal, policy)
        master = readers.read_master_csv(spark, a.master, required=policy.missing_master == "error")
        paths = _paths(a.out, a.policy, "result")
        run = jobs.run_merge_years(cur, past, master, fiscal, policy, paths, reference_names=True)
        out.update(status="ok", result=paths, totals=[r.asDict() for r in reconcile.as_double(run.totals).collect()], findings=run.lines())
    else:
        paths = _paths(a.result_dir, a.policy, "result")
        out.update(status="ok", exported=jobs.export_levels(
            spark, paths, a.out, _fiscal(a), policy, **jobs.EXPORT_FLAVOURS[a.flavour or a.policy]))
    print(json.dumps(out, ensure_ascii=False, default=str))
    return 0 if out.get("status") == "ok" else 1


if __name__ == "__main__":
    sys.exit(main())
