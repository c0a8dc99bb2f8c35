"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the contracts: ASCII white space, and the class of what is no white space.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, as one file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z become a-z; other letters stay as they are."""
    return F.translate(col, UPPER, LOWER)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def require(df: DataFrame, names: Iterable[str]) -> None:
    """Fail early and by name when an input column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
