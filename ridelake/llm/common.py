"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

# Rows, and bytes, that go to a Python worker at once. Texts may be long.
BATCH_ROWS, BATCH_BYTES = 2000, "8m"


def prepare_workers(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory a worker needs for one Arrow batch, and let Spark bring this
    package to executors that may not have it installed."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))


_SHIPPED: set[str] = set()


_HELD: dict[object, object] = {}


def held(key: object, build: Callable[[], T]) -> T:
    """An object that a worker process keeps for its next tasks: one at a time, so what an
    earlier job has left gives way."""
    if key not in _HELD:
        release()
        _HELD[key] = build()
    return _HELD[key]


def release() -> None:
    """Drop what the worker process holds, and give the room back to the system, as the
    worker lives on for other jobs."""
    if _HELD:
        _HELD.clear()
        give_back()


def give_back() -> None:
    """Return freed room to the system: workers wait for other tasks beside those at work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text; a longer text is a run."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends, a = np.cumsum(sizes, dtype=np.int64), 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - sizes[a] + most, side="right")))
        yield batch.slice(a, b - a)
        a = b


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, holds: bool = False, most: int | None = None
) -> DataFrame:
    """``fn`` for every Arrow batch of ``df``, or for its ``slices``. ``holds``: whether ``fn``
    uses ``held``; if not, what the worker holds is dropped. Freed room goes back to the system
    at the end of a task, with ``most`` after each batch."""
    prepare_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holds:
            release()
        for batch in batches:
            if batch.num_rows:
                yield from map(fn, slices(batch, most) if most else [batch])
            del batch
            if most:
                give_back()
        give_back()

    return df.mapInArrow(run, schema)


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only: other columns, whatever their names, stay out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_value(value, use):
    """``use(value)`` with ``value`` evaluated once: within a lambda, a column expression
    would be evaluated for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def in_fold(doc_id, modulus: int, remainder: int):
    """Whether crc32 of the id's decimal digits leaves ``remainder``; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


class Words:
    """The words of a batch of texts, each distinct word once.

    ``distinct``: the words; ``codes``: for each word of the texts its place there;
    ``offsets``: where each text's words begin in ``codes`` (and the last's end).
    """

    def __init__(self, texts: pa.Array, between: str, lower: bool = False):
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        if lower:
            texts = pc.utf8_lower(texts)
        lists = pc.split_pattern_regex(texts, between)
        table = lists.values.dictionary_encode()
        distinct = table.dictionary.to_numpy(zero_copy_only=False)
        codes = table.indices.to_numpy()
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        empty = np.flatnonzero(distinct == "")
        if len(empty):  # separators at the ends of a text
            real = codes != empty[0]
            offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
            codes = codes[real] - (codes[real] > empty[0])
            distinct = np.delete(distinct, empty[0])
        self.distinct, self.codes, self.offsets = distinct, codes, offsets

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum of ``values``, one row for each of its words."""
        total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def sampled(labels: DataFrame, column: str, most: int) -> DataFrame:
    """About ``most`` rows at the most of each value of ``column``, chosen by a hash of all
    columns; all rows where there are fewer."""
    share = free_name(labels, "share")
    labels = labels.where(F.col(column).isNotNull())
    counts = labels.groupBy(F.col(column).alias(f"{share}_of")).agg((F.lit(float(most)) / F.count(F.lit(1))).alias(share))
    chance = F.pmod(F.xxhash64(F.lit("sample"), *labels.columns), F.lit(1 << 30)) / float(1 << 30)
    # A row for each value, of which the models keep a list as well; the texts stay in place.
    joined = labels.join(F.broadcast(counts), F.col(column) == F.col(f"{share}_of"))
    return joined.where(chance < F.least(F.col(share), F.lit(1.0))).select(*labels.columns)
