"""Writing partitioned tables, reading them back, and dropping old partitions.

Files of a partitioned table lie in ``<column>=<value>/part=<id>``, and count once a small
manifest names their folder. A manifest is a file of its own, written last and under the
next number, so a job that dies at any step leaves the table as it was, a reader sees one
state or the next, and a change may be worked out from the partitions it replaces. Folders
that a change takes out stay until the change after it, for those still reading them. A
table has one writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.session import filesystem

MANIFESTS, PART = "_manifest", "part"


@dataclass(frozen=True)
class Manifest:
    """State of a table: its columns, the folders that count, those the last change took
    out, and the last batch of each stream written to it."""

    number: int = -1
    columns: str = ""
    partition_by: str = ""
    folders: list[str] = field(default_factory=list)
    gone: list[str] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))

    def value(self, folder: str) -> str:
        """Partition value of a folder."""
        return folder.split("/")[0].partition("=")[2] if self.partition_by else ""

    def of(self, values) -> list[str]:
        """Folders of the given partition values."""
        wanted = set(values)
        return [f for f in self.folders if self.value(f) in wanted]


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The table's last complete state; none for a folder that is no such table."""
    fs, folder = filesystem(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return None
    numbers = [n[:-5] for n in _names(fs, folder) if n.endswith(".json")]
    if not numbers:
        return None
    last = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{max(numbers)}.json")
    stream = fs.open(last)
    try:
        return Manifest(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _names(fs, folder) -> list[str]:
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def commit(spark: SparkSession, path: str, state: Manifest) -> None:
    """Make ``state`` the table's: from here on its folders count. Then delete what the
    change before took out."""
    fs, folder = filesystem(spark, f"{path}/{MANIFESTS}")
    before = manifest(spark, path)
    if state.number != (before.number if before else -1) + 1:
        raise RuntimeError(f"{path} was changed by another job")
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    draft, final = new_path(folder, f".{uuid.uuid4().hex}"), new_path(folder, f"{state.number:012d}.json")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(asdict(state)), "utf-8"))
    out.close()
    if not fs.rename(draft, final):
        raise RuntimeError(f"{path} was changed by another job")
    for old in sorted(n for n in _names(fs, folder) if n.endswith(".json"))[:-2]:
        fs.delete(new_path(folder, old), False)
    _delete(spark, path, before.gone if before else [])


def _delete(spark: SparkSession, path: str, folders: list[str]) -> None:
    for name in folders:
        fs, folder = filesystem(spark, f"{path}/{name}")
        fs.delete(folder, True)
        if "/" in name and fs.exists(folder.getParent()) and not fs.listStatus(folder.getParent()):
            fs.delete(folder.getParent(), False)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: list[str] = (),
    mode: str = "overwrite",
    drop: list[str] = (),
    whole: bool = False,
    batch: tuple[str, int] | None = None,
) -> list[str]:
    """Write Parquet, one folder per partition value, sorted by the cluster keys; returns
    the partition values written.

    The rows of a partition value are brought together in one shuffle. Adaptive
    execution then splits a hot day over as many tasks as its size asks for and puts
    small days together, so files come out even without a sampling pass over the data.
    Inside a file the sort gives row groups narrow ranges on the cluster keys. With mode
    'overwrite' a partitioned table only replaces the partitions present in ``df`` and those
    listed in ``drop``, or, with ``whole``, all. ``batch`` names a stream and its batch:
    a batch that has been written before is not written again.
    """
    if partition_by is None and batch is None:
        df.write.mode(mode).parquet(path)
        return []
    spark, state = df.sparkSession, manifest(df.sparkSession, path) or Manifest()
    if batch and state.batches.get(batch[0], -1) >= batch[1]:
        return []
    part, layers = uuid.uuid4().hex, [partition_by, PART] if partition_by else [PART]
    if partition_by and mode == "overwrite":
        balanced = df.hint("rebalance", F.col(partition_by))
        df = balanced.sortWithinPartitions(partition_by, *cluster_by)
    df.withColumn(PART, F.lit(part)).write.mode("append").partitionBy(*layers).parquet(path)
    new = _folders(spark, path, partition_by, part)
    values = sorted({Manifest(partition_by=partition_by or "").value(f) for f in new})
    gone = [] if mode == "append" else state.folders if whole else state.of({*values, *drop})
    commit(
        spark,
        path,
        Manifest(
            number=state.number + 1,
            columns=df.schema.json(),
            partition_by=partition_by or "",
            folders=sorted({*state.folders, *new}.difference(gone)),
            gone=gone,
            batches={**state.batches, **({batch[0]: batch[1]} if batch else {})},
        ),
    )
    return values


def _folders(spark: SparkSession, path: str, partition_by: str | None, part: str) -> list[str]:
    """Folders that hold files of a part."""
    pattern = f"{path}/{f'{partition_by}=*/' if partition_by else ''}{PART}={part}"
    fs, glob = filesystem(spark, pattern)
    found = [status.getPath() for status in fs.globStatus(glob) or []]
    return [f"{p.getParent().getName()}/{p.getName()}" if partition_by else p.getName() for p in found]


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """Read a written table, with the columns, order and types of ``like`` if that is given."""
    state = manifest(spark, path)
    if state is None:
        read = spark.read.schema(like.schema) if like is not None else spark.read
        found = read.parquet(path)
        return found.select(*like.columns) if like is not None else found
    schema = like.schema if like is not None else state.schema
    if not state.folders:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())])).option("basePath", path)
    return read.parquet(*[f"{path}/{folder}" for folder in state.folders]).select(*schema.names)


def compact(spark: SparkSession, path: str, values: list[str]) -> None:
    """Bring the files of the given partition values together; the rows stay the same."""
    state = manifest(spark, path)
    split = [v for v in values if len(state.of([v])) > 1]
    if not split:
        return
    kind = state.schema[state.partition_by].dataType
    rows = read_table(spark, path)
    rows = rows.where(F.col(state.partition_by).isin([F.lit(v).cast(kind) for v in split]))
    write_table(rows, path, state.partition_by)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete folders that no state of the table names: what interrupted jobs have left. Not
    while a job writes to the table. Returns their number."""
    state = manifest(spark, path)
    fs, glob = filesystem(spark, f"{path}/{f'{state.partition_by}=*/' if state.partition_by else ''}{PART}=*")
    found = [status.getPath() for status in fs.globStatus(glob) or []]
    names = [f"{p.getParent().getName()}/{p.getName()}" if state.partition_by else p.getName() for p in found]
    left = [n for n in names if n not in {*state.folders, *state.gone}]
    _delete(spark, path, left)
    return len(left)


ROW_GROUPS = "value string, file string, row_group int, n_rows long, lowest string, highest string"


def row_groups(spark: SparkSession, path: str, column: str, values: list[str] | None = None) -> DataFrame:
    """Rows and range of a column in each row group of a table's files, from the Parquet
    footers alone: shows how well the files are clustered. Footers are read on the driver, a
    few KB a file; name partition ``values`` to look at some of a large table."""
    state = manifest(spark, path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for folder in state.folders if values is None else state.of(values):
        fs, where = filesystem(spark, f"{path}/{folder}")
        for status in fs.listStatus(where):
            name = status.getPath().getName()
            if not name.endswith(".parquet"):
                continue
            source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromStatus(status, conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
            try:
                for i, block in enumerate(reader.getFooter().getBlocks()):
                    chunks = [c for c in block.getColumns() if c.getPath().toDotString() == column]
                    stats = chunks[0].getStatistics()
                    known = stats.hasNonNullValue()
                    ends = (stats.minAsString(), stats.maxAsString()) if known else (None, None)
                    found.append((state.value(folder), name, i, block.getRowCount(), *ends))
            finally:
                reader.close()
    return spark.createDataFrame(found, ROW_GROUPS)


def overlapping(groups: DataFrame) -> DataFrame:
    """(value, n_rows, lowest, highest, overlaps): for each partition value its rows, range,
    and how many row groups begin below the end of the one before them in their file."""
    in_file = Window.partitionBy("value", "file").orderBy("row_group")
    apart = groups.withColumn("below", F.col("lowest") < F.lag("highest").over(in_file))
    return apart.groupBy("value").agg(
        F.sum("n_rows").alias("n_rows"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"), F.count_if("below").alias("overlaps")
    )


def replace_table(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table as a whole, or not at all.

    A new folder ``version=N`` is written beside the old one and counts once it is
    complete, so a failed job leaves the table as it was. The version before the new one
    stays for those who are still reading it. ``df`` may be worked out from the table.
    """
    spark = df.sparkSession
    versions = _versions(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/version={versions[-1] + 1 if versions else 0}")
    for version in versions[:-1]:
        fs, folder = filesystem(spark, f"{path}/version={version}")
        fs.delete(folder, True)


def current_path(spark: SparkSession, path: str) -> str:
    """Folder of the last complete version of a table, or ``path`` if it has none."""
    versions = _versions(spark, path)
    return f"{path}/version={versions[-1]}" if versions else path


def _versions(spark: SparkSession, path: str) -> list[int]:
    found = []
    for value in partition_values(spark, path, "version"):
        fs, done = filesystem(spark, f"{path}/version={value}/_SUCCESS")
        if fs.exists(done):
            found.append(int(value))
    return sorted(found)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values of a table, from its manifest or, for other tables, its folders."""
    state = manifest(spark, path)
    if state is not None:
        return sorted({state.value(f) for f in state.folders})
    fs, root = filesystem(spark, path)
    if not fs.exists(root):
        return []
    prefix = f"{column}="
    return sorted(n[len(prefix):] for n in _names(fs, root) if n.startswith(prefix))


def drop_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    """Take partitions out of a table, and delete their files."""
    state = manifest(spark, path)
    if state is None:
        _delete(spark, path, [f"{column}={value}" for value in values])
        return
    gone = state.of(values)
    if gone:
        kept = [f for f in state.folders if f not in set(gone)]
        commit(spark, path, replace(state, number=state.number + 1, folders=kept, gone=gone))
        _delete(spark, path, gone)


def expire_partitions(
    spark: SparkSession, path: str, column: str, as_of: dt.date, keep_days: int
) -> list[str]:
    """Drop day partitions older than ``keep_days``; returns the days dropped."""
    oldest = (as_of - dt.timedelta(days=keep_days)).isoformat()
    expired = [day for day in partition_values(spark, path, column) if day < oldest]
    drop_partitions(spark, path, column, expired)
    return expired


def within_retention(df: DataFrame, day: str, as_of: dt.date, keep_days: int) -> DataFrame:
    """Rows that retention keeps."""
    return df.where(F.col(day) >= F.date_sub(F.lit(as_of), keep_days))
