"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters.

``write_tokens`` deals whole texts out by ranges of ``doc_id``, encodes each range in
order and writes one file a range (slice), so file after file the ids run in ascending
``doc_id``. ORC encodes the ids of a stripe as runs of integers; every 1,000 rows have
their own minima, maxima and a Bloom filter on ``doc_id``, by which a reader skips row
groups, and stripes are read in parallel.

Columns of the files: ``doc_id``; ``ids`` (the end id appended); ``n_tokens``; ``slice``
and ``first``, the number of the slice and the ids before the document within it.

Defined cases: a null text counts as empty and holds the end id alone; null ``doc_id``
come first; rows of one ``doc_id`` follow each other ordered by a hash of their texts, and
may lie in several slices, so a frequent ``doc_id`` does not fill one; an empty table gives
files without rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridelake.llm.bpe import SLICE, encoder, id_lists, read_spec
from ridelake.llm.common import prepare_workers, id_and_text, map_batches, slices
from ridelake.session import stage_path

END_ID = 0
# Rows that share one set of minima, maxima and Bloom filter.
ROW_GROUP = 1000
SCHEMA = "doc_id long, ids array<int>, n_tokens long, slice int, first long"
OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": str(ROW_GROUP),
    # A writer holds a stripe in memory; a few MB of ids are enough for long runs.
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode whole texts and write them to ``path``, sorted by ``doc_id``."""
    spark = docs.sparkSession
    prepare_workers(spark)
    spec = spark.sparkContext.broadcast(read_spec(tokenizer))
    text_hash = F.xxhash64("text")
    # The last key spreads repeated rows, whose order is without meaning.
    rows = (
        id_and_text(docs)
        .withColumn("spread", F.monotonically_increasing_id())
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), text_hash, "spread")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), text_hash, "spread")
        .select("doc_id", "text")
    )

    def run(batches):
        from pyspark import TaskContext

        slice_no, first = TaskContext.get().partitionId(), 0
        for batch in (part for batch in batches for part in slices(batch, SLICE)):
            ids, offsets = encoder(spec.value).encode(batch.column("text"))
            ids, offsets = np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))
            numbers = np.full(batch.num_rows, slice_no, dtype=np.int32)
            columns = [batch.column("doc_id"), id_lists(ids, offsets), pa.array(np.diff(offsets)), pa.array(numbers), pa.array(first + offsets[:-1])]
            first += int(offsets[-1])
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_tokens", "slice", "first"])
            del batch, ids, offsets, numbers, columns
            pa.default_memory_pool().release_unused()

    rows.mapInArrow(run, SCHEMA).write.options(**OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as a table; filters on ``doc_id`` skip row groups and stripes."""
    return spark.read.schema(SCHEMA).orc(path)


def slice_starts(tokens: DataFrame) -> DataFrame:
    """(slice, before): ids in all earlier slices. One row for each file, read from the
    column of counts alone."""
    totals = tokens.groupBy("slice").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of each document's ids, from the files."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("ids")
        flat, offsets = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        sizes = np.diff(offsets)
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
        columns = [batch.column("doc_id"), batch.column("slice"), batch.column("first")]
        columns += [pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "slice", "first", "n_tokens", "ids_crc32"])

    rows = map_batches(tokens.select("doc_id", "slice", "first", "ids"), run, "doc_id long, slice int, first long, n_tokens long, ids_crc32 long")
    return rows.join(slice_starts(tokens), "slice").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def tokens_to_files(docs: DataFrame, tokenizer: str) -> str:
    """Write to a new folder among the session's staged tables; its path."""
    path = stage_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path)
    return path
