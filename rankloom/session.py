"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "rankloom") -> SparkSession:
    """Local session for tests, benchmarks and the command line (UI off, AQE
    on, UTC).  Constraint propagation is off: the merged tables carry one
    column per (metric, year) and every step re-aliases them, which makes
    that optimizer rule grow combinatorially.  It is set here, once, and by
    no operator; operators state the not-null filters on their inner-join
    keys themselves, so no plan depends on the setting.  The legacy charset
    list is on for cp932 (``windows-31j``) files."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.sql.legacy.javaCharsets", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Read from the session.  Where it is unset, a single-process session
    (master ``local`` or ``local[n]``, as in tests) gets a temporary folder
    of its own; on a cluster a machine-local folder would lose data, so that
    is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: a folder shared by the driver and all "
                f"executors is needed on {master}")
        # the setting itself is the cluster's and can't be changed in a session
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rankloom-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, kind: str = "mat") -> str:
    """A new path in the shared folder, deleted when the application ends
    (or earlier by :func:`release`)."""
    path = f"{shared_dir(spark)}/rankloom-{kind}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)
    return path


def release(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once as a parquet table in the shared folder
    and read it back.

    Used where one intermediate feeds many branches: the branches read the
    written data instead of recomputing it, and a lost executor no longer
    forces recomputation from the raw input.  (A reliable ``checkpoint()``
    would compute its input twice -- once for the action, once for the write
    -- unless cached; a written table is a single job.)"""
    spark = df.sparkSession
    path = path or scratch_path(spark)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)  # read by Spark alone, and soon gone
    return spark.read.schema(df.schema).parquet(path)


#: How many parts a shuffle is cut into before AQE joins small ones, and how many bytes it joins them to.
SHUFFLE_PARTS, PART_BYTES = 1000, "16m"

#: A join key's Bloom filter is made of a side of at most FILTER_FROM bytes where the other side is a scan of at least
#: FILTERED_FROM bytes; it is made for so many keys and has so many bits.
FILTERED_FROM, FILTER_FROM, FILTER_KEYS, FILTER_BITS = "32m", "100g", 4_000_000, 1 << 25


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session built elsewhere the settings of :func:`local_session`
    that the job needs.  Called where a job or a registered query starts,
    always and before anything is planned, so that no plan depends on what
    ran before; operators and readers never change the session.

    A merged row has a sum for every metric and year, many times its size in
    a shuffle; so what one task takes from a shuffle is kept small, whatever
    the size of the tables: many parts, joined by AQE to a few megabytes.

    Rows of a large side that meet none of the other, filtered one (line items
    of other years) are left out before a shuffle by Spark's runtime Bloom
    filter; by its own size rules it makes none for tables of this kind.

    Shuffle files go when the query that made them ends: a job of several
    steps needs the disk of its largest one (an action on the same frame
    again makes them anew).  Two tables that lie by one of their join keys are
    joined as they lie; where that leaves one part far above the others, AQE
    splits it, at the price of another exchange."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                   str(max(SHUFFLE_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", PART_BYTES)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    bloom = "spark.sql.optimizer.runtime.bloomFilter."
    for name, value in (("applicationSideScanSizeThreshold", FILTERED_FROM), ("creationSideThreshold", FILTER_FROM),
                        ("expectedNumItems", FILTER_KEYS), ("numBits", FILTER_BITS)):
        spark.conf.set(bloom + name, str(value))
    return spark
