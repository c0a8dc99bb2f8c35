import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from rankloom.session import prepare

    prepare(s)  # as every job does; the wide merge plans need it
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rankloom-test-"))
    yield s


@pytest.fixture()
def tmp_out(spark):
    from rankloom.session import shared_dir
    import uuid

    return f"{shared_dir(spark)}/rankloom-test-{uuid.uuid4().hex}"
