"""Sinks: level tables as parquet, ordered per-level export files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.naming import past_file, result_file, summary_file, to_reference
from ..plans.spec import EXPORT_DEFAULT_CHUNK, EXPORT_TIERS, FiscalSpec
from .csvio import manifest, read_csv, write_csv

MANIFEST = "_manifest"  # hidden from readers by its first letter


def write_summary(df: DataFrame, out_dir: str, partition_col: str = "level", mode: str = "overwrite") -> None:
    """All levels in one job, partitioned by level (W-1 in one pass)."""
    df.write.mode(mode).partitionBy(partition_col).option("compression", "snappy").parquet(out_dir)


def level_paths(base: str, term: str = "annual", kind: str = "summary", reference_names: bool = False,
                levels: tuple[str, ...] = ("corp", "customer", "customer_product")) -> dict[str, str]:
    """File naming (W-4): one path per level under ``base``.  ``kind`` is
    'summary' (current tables), 'past' (their terms have labels of their
    own) or 'result'."""
    out = {}
    for lv in levels:
        if reference_names:
            name = {"summary": summary_file, "past": past_file}.get(kind, lambda _, level: result_file(level))(term, lv)
        else:
            name = f"result/level={lv}" if kind == "result" else f"term={term}/level={lv}"
        out[lv] = f"{base.rstrip('/')}/{name}"
    return out


def write_levels(
    dfs: dict[str, DataFrame],
    paths: dict[str, str],
    fiscal: FiscalSpec | None = None,
    reference_names: bool = False,
    mode: str = "overwrite",
) -> None:
    """W-1/W-2/W-3: one parquet table per level (snappy), in the frame's row
    order (a sorted frame is range-partitioned, so part files are in order)."""
    for name, df in dfs.items():
        if df is None:
            continue
        out = to_reference(df, fiscal) if reference_names and fiscal is not None else df
        out.write.mode(mode).option("compression", "snappy").parquet(paths[name])


def export_chunk_size(rows: int) -> int:
    """W-6 size tiers (``EXPORT_TIERS``): the chunk of the first tier whose
    row threshold is exceeded, else ``EXPORT_DEFAULT_CHUNK``."""
    for threshold, chunk in EXPORT_TIERS:
        if rows > threshold:
            return chunk
    return EXPORT_DEFAULT_CHUNK


def export_ready(df: DataFrame, on_null: str = "zero") -> DataFrame:
    """P-16: numeric nulls -> 0 (strings untouched) when ``on_null='zero'``."""
    if on_null != "zero":
        return df
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.na.fill(0, subset=numeric) if numeric else df


def export_level(
    df: DataFrame,
    path: str,
    on_null: str = "zero",
    header_if_empty: bool = True,
    max_records_per_file: int | None = None,
    encoding: str = "UTF-8",
) -> bool:
    """W-5: one ordered CSV table with a header row, and beside its files a
    manifest of their bytes, checksums and records (``_manifest``).

    ``on_null``: 'zero' fills numeric nulls, 'blank' leaves them empty.
    Texts come back as they are: blanks at either end, quotes, line breaks,
    and the difference between an empty text and none.
    ``header_if_empty=False`` writes nothing at all for an empty table.
    Returns whether anything was written."""
    out = export_ready(df, on_null)
    if not header_if_empty and out.isEmpty():
        return False
    write_csv(out, path, encoding, max_records_per_file)
    manifest(df.sparkSession, path, encoding).repartition(1).write.mode("overwrite").json(f"{path.rstrip('/')}/{MANIFEST}")
    return True


def check_export(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, expected, found) of every file that is not as its export wrote
    it: changed, missing or added.  Empty for a whole export."""
    schema = "file string, length long, sha256 string, rows long"
    said = spark.read.schema(schema).json(f"{path.rstrip('/')}/{MANIFEST}")
    as_one = lambda t, name: t.select("file", F.struct("length", "sha256", "rows").alias(name))
    both = as_one(said, "expected").join(as_one(manifest(spark, path, encoding), "found"), "file", "full")
    return both.filter(~F.col("expected").eqNullSafe(F.col("found")))


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An exported table with ``position``, its row's place in the export:
    part files in the order of their names, lines in file order.

    Records are numbered within their file (at most one chunk of rows each)
    and moved by the number of records in the files before; only the list of
    files is ordered as a whole."""
    rows = read_csv(spark, path, place=("_file", "_block", "_id")).rows
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_lines"))
    before = files.select("_file", F.coalesce(F.sum("_lines").over(
        Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_line", F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_id")))
    return numbered.join(before, "_file").withColumn("position", F.col("_before") + F.col("_line")).drop(
        "_file", "_block", "_id", "_line", "_before")


def available_levels(spark, paths: dict[str, str], policy: str = "all") -> tuple[list[str], list[str]]:
    """W-7 ('all': any missing input stops the run) and W-8 ('available':
    run the levels that exist, fail only if none).  Returns (present, missing)."""
    from .readers import path_exists

    present = [lv for lv, p in paths.items() if path_exists(spark, p)]
    missing = [lv for lv in paths if lv not in present]
    if policy == "all" and missing:
        raise FileNotFoundError(", ".join(paths[m] for m in missing))
    if policy == "available" and not present:
        raise FileNotFoundError("no level table found")
    return present, missing
