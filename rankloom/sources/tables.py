"""Level tables that later jobs build on: bucketed and sorted by their keys,
so that a merge needs no exchange; and generations, which readers see whole or
not at all."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import _fs

LAYOUT = "_layout"      # hidden from readers by its first letter
COMMITS = "_commits"


# ------------------------------------------------------------------ bucketed
def write_bucketed(df: DataFrame, path: str, keys: list[str] | tuple[str, ...], buckets: int) -> None:
    """W-1..W-3 as a table of ``buckets`` files by hash of the keys, each
    sorted by them, with its layout beside it.

    Two tables that are to be merged need the same keys in the same order and
    the same number of buckets; take it so that a bucket of the largest table
    fits a task.  The files belong to the path: no catalog has to keep them."""
    spark = df.sparkSession
    name = f"rankloom_{uuid.uuid4().hex}"
    try:
        df.repartition(buckets, *[F.col(f"`{k}`") for k in keys]).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option(
            "path", path).option("compression", "snappy").saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
    _put(spark, f"{path.rstrip('/')}/{LAYOUT}", {"keys": list(keys), "buckets": buckets, "schema": json.loads(df.schema.json())})


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its buckets known to the planner.  Its
    entry in the session's catalog is named by its place and layout."""
    text = _get(spark, f"{path.rstrip('/')}/{LAYOUT}")
    if text is None:
        raise FileNotFoundError(f"{path} is not a bucketed table")
    layout = json.loads(text)
    name = "rankloom_" + hashlib.sha256(f"{path}\n{text}".encode()).hexdigest()[:32]
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    keys = ", ".join(quoted(k) for k in layout["keys"])
    cols = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in StructType.fromJson(layout["schema"]).fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(layout['buckets'])} BUCKETS LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


# --------------------------------------------------------------- generations
@dataclass(frozen=True)
class Generation:
    """One set of tables that belong together, below ``base``."""

    base: str
    name: str
    paths: dict[str, str]


def new_generation(base: str, names: list[str]) -> Generation:
    """Places for the tables of a generation that nobody reads yet."""
    base, name = base.rstrip("/"), f"generation-{uuid.uuid4().hex}"
    return Generation(base, name, {n: f"{base}/{name}/{n}" for n in names})


def commit(spark: SparkSession, generation: Generation, rows: dict[str, int]) -> int:
    """Makes a generation the one that readers take, and returns its number.

    Every table must hold as many rows as were written (from the file
    footers).  The commit is a file with the next free number, renamed to its
    place when it is whole: until then, and after any failure, readers find
    the generation before.  Where the file system's rename replaces nothing
    (HDFS), the second of two writers fails; others need one writer at a time."""
    for n, path in generation.paths.items():
        found = spark.read.parquet(path).count()
        if found != rows[n]:
            raise RuntimeError(f"{path} holds {found} rows; {rows[n]} were written")
    number = max(_numbers(spark, generation.base), default=0) + 1
    folder = f"{generation.base}/{COMMITS}"
    draft, final = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/{number:08d}"
    _put(spark, draft, {"generation": generation.name, "tables": {n: int(rows[n]) for n in generation.paths}})
    fs, target = _fs(spark, final)
    if fs.exists(target) or not fs.rename(_fs(spark, draft)[1], target):
        raise RuntimeError(f"another writer has committed generation {number} of {generation.base}")
    return number


def write_generation(base: str, tables: dict[str, DataFrame]) -> Generation:
    """W-2, W-3: all tables or none.  Their rows are counted while they are written."""
    generation, rows = new_generation(base, list(tables)), {}
    spark = next(iter(tables.values())).sparkSession
    for n, df in tables.items():
        seen = Observation(f"{generation.name} {n}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy").parquet(generation.paths[n])
        rows[n] = int(seen.get["rows"])
    commit(spark, generation, rows)
    return generation


def committed(spark: SparkSession, base: str) -> Generation | None:
    """The newest complete generation (W-7), or None."""
    base = base.rstrip("/")
    number = max(_numbers(spark, base), default=0)
    if not number:
        return None
    said = json.loads(_get(spark, f"{base}/{COMMITS}/{number:08d}"))
    return Generation(base, said["generation"], {n: f"{base}/{said['generation']}/{n}" for n in said["tables"]})


def forget_generations(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Deletes the commits and tables of all but the newest ``keep``
    generations, and names them.  What was never committed stays: it may
    belong to a writer at work."""
    base, gone = base.rstrip("/"), []
    for number in sorted(_numbers(spark, base))[:-max(keep, 1)]:
        place = f"{base}/{COMMITS}/{number:08d}"
        gone.append(json.loads(_get(spark, place))["generation"])
        for path in (place, f"{base}/{gone[-1]}"):  # first the commit: no reader is sent to half a generation
            fs, p = _fs(spark, path)
            fs.delete(p, True)
    return gone


def _numbers(spark: SparkSession, base: str) -> list[int]:
    fs, p = _fs(spark, f"{base}/{COMMITS}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [int(n) for n in names if n.isdigit()]


def _put(spark: SparkSession, path: str, content: dict) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(content, ensure_ascii=False, sort_keys=True).encode()))
    finally:
        out.close()


def _get(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
