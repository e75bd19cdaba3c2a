"""Session settings, and the shared folder that staged tables are written to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Runtime settings only, so they also apply to a
# session somebody else created.
RUNTIME_CONF = {
    # Dates and hours are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Quantile sketches use object hash aggregation, which starts to sort its
    # input at 128 groups per task. A task sees thousands of station-days.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster, use the one submitted."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ridelake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Call sites of single column expressions; costs more than small queries take.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # The models compile to several hundred classes; 100 are kept by default.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def stage_root(spark: SparkSession) -> str:
    """Folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; executors on
    other machines could not read that.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if root is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            own = tempfile.mkdtemp(prefix="ridelake-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            context.setCheckpointDir(own)
            root = context.getCheckpointDir()
    return root.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner a real
    file size, so a later join is broadcast only when the table is small.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A staged table that is deleted at the end of the block."""
    table = stage(df, name)
    path = _STAGED.pop()
    try:
        yield table
    finally:
        fs, folder = filesystem(df.sparkSession, path)
        fs.delete(folder, True)


_STAGED: list[str] = []


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables this driver has staged, once nothing reads them any more."""
    count = len(_STAGED)
    while _STAGED:
        fs, path = filesystem(spark, _STAGED.pop())
        fs.delete(path, True)
    return count


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system of ``path`` and the path object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path
