"""Readers for the job's inputs: detail CSV, corporation master, level tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import (
    LEGACY_CUSTOMER_RENAMES,
    LEGACY_PRODUCT_RENAMES,
    REFERENCE_KEY_NAMES,
    from_reference,
    from_reference_detail,
)
from ..plans.spec import LEVELS, FiscalSpec, LevelSpec, MergePolicy
from .csvio import read_csv

DETAIL_METRICS = ("qty", "area", "sales", "profit")


#: cp932 files need 'windows-31j' (MS932), since plain Shift_JIS cannot decode
#: such characters as the square-metre sign.  Spark 4 rejects vendor charsets
#: unless ``spark.sql.legacy.javaCharsets`` is on (see ``session.prepare``).
CP932 = "windows-31j"


def rejected_rows(spark: SparkSession, path: str, encoding: str = CP932) -> DataFrame:
    """(file, record, reason) of the records that :func:`read_detail_csv` and
    :func:`read_master_csv` leave out."""
    return read_csv(spark, path, encoding).rejected


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists.  Creating a file-source DataFrame lists the
    path eagerly (no data is read) and raises PATH_NOT_FOUND if absent; any
    other failure (access, file system) is raised, not taken for absence."""
    try:
        spark.read.format("text").load(path)
        return True
    except AnalysisException as e:
        if _missing(e):
            return False
        raise


def read_detail_csv(
    spark: SparkSession,
    path: str,
    encoding: str = CP932,
    reference_names: bool = True,
    usecols: list[str] | None = None,
    required: bool = False,
    metric_type: str = "double",
) -> DataFrame | None:
    """Sales-detail CSV (R-1, R-2).

    All columns are read as strings (no inference pass over the data); the
    four metrics are cast to double, so codes keep their leading zeros.
    Quoted cells may hold anything (``csvio``); a short or long record is
    left out and reported by :func:`rejected_rows`.
    A missing file returns ``None`` unless ``required``.  ``usecols`` keeps
    only those (English) columns, in that order.  ``metric_type`` may be an
    exact decimal type instead of the original's double."""
    if not path_exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return None
    df = read_csv(spark, path, encoding).rows
    if reference_names:
        df = from_reference_detail(df)
    casts = [F.col(c).cast(metric_type).alias(c) if c in DETAIL_METRICS else F.col(c) for c in df.columns]
    df = df.select(*casts)
    if usecols is not None:
        df = df.select(*[c for c in usecols if c in df.columns])
    return df


def read_master_csv(
    spark: SparkSession,
    path: str,
    encoding: str = CP932,
    reference_names: bool = True,
    required: bool = True,
) -> DataFrame | None:
    """Corporation master (R-3 strict / R-4 lenient): (corp_code, corp_name),
    both strings.  Missing file: error if ``required`` else ``None``."""
    if not path_exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return None
    df = read_csv(spark, path, encoding).rows
    if reference_names:
        df = df.withColumnsRenamed(
            {REFERENCE_KEY_NAMES["corp_code"]: "corp_code", REFERENCE_KEY_NAMES["corp_name"]: "corp_name"}
        )
    return df.select(F.col("corp_code").cast("string"), F.col("corp_name").cast("string"))


def optional_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table or ``None`` when the path is missing (R-7).  A table
    that exists and can't be read is an error, never an empty history."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def read_levels(
    spark: SparkSession,
    paths: dict[str, str],
    required: bool = True,
    levels: tuple[LevelSpec, ...] = LEVELS,
) -> dict[str, DataFrame | None]:
    """One parquet table per level (R-5, R-6, R-8).  With ``required`` every
    path is checked first and all missing ones are reported together."""
    if required:
        missing = [p for lv in levels for p in [paths[lv.name]] if not path_exists(spark, p)]
        if missing:
            raise FileNotFoundError(", ".join(missing))
        return {lv.name: spark.read.parquet(paths[lv.name]) for lv in levels}
    return {lv.name: optional_parquet(spark, paths[lv.name]) for lv in levels}


def rename_legacy_coupled(cust_past: DataFrame | None, prod_past: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Legacy rename of reference-named past tables, annual style (P-4):
    skipped for both tables if either is absent; the customer code and name
    are renamed together, keyed on the presence of the code column."""
    if cust_past is None or prod_past is None:
        return cust_past, prod_past
    if next(iter(LEGACY_CUSTOMER_RENAMES)) in cust_past.columns:
        cust_past = cust_past.withColumnsRenamed(LEGACY_CUSTOMER_RENAMES)
    return cust_past, prod_past.withColumnsRenamed(LEGACY_PRODUCT_RENAMES)


def rename_legacy_independent(cust_past: DataFrame | None, prod_past: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Legacy rename, quarter style (P-5): each name on its own presence
    (``withColumnsRenamed`` ignores absent names)."""
    return (None if cust_past is None else cust_past.withColumnsRenamed(LEGACY_CUSTOMER_RENAMES),
            None if prod_past is None else prod_past.withColumnsRenamed(LEGACY_PRODUCT_RENAMES))


def read_past(spark: SparkSession, paths: dict[str, str], fiscal: FiscalSpec, policy: MergePolicy,
              levels: tuple[LevelSpec, ...] = LEVELS) -> dict[str, DataFrame | None]:
    """Reference-named past tables with English names: legacy names are
    renamed first, while the columns still have their Japanese names."""
    past = read_levels(spark, paths, required=policy.missing_past == "error", levels=levels)
    rename = rename_legacy_coupled if policy.name == "annual" else rename_legacy_independent
    past["customer"], past["customer_product"] = rename(past.get("customer"), past.get("customer_product"))
    return {k: None if v is None else from_reference(v, fiscal) for k, v in past.items()}
