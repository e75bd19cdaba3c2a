"""Hard negatives: rows of another label that score nearly as high as a positive.

Anchors (rows whose id is divisible by ``every``) and candidates (all rows) are dealt into
tiles of bounded size. For each pair of tiles the table of inner products is worked out by
Strassen's recursion on 64-bit integers: matrices are padded with zeros to even sizes, cut
into quarters and multiplied with seven products instead of eight; integer additions are
exact, so the result is that of the plain product.

First every pair of tiles gives the best ``positives`` of each anchor within it, and these
heaps are merged to the best of all. Then the pairs are multiplied once more, and give for
each anchor and positive the best ``negatives`` whose score lies between the two shares of
the positive's; these are merged as well. A heap is at most that long, whatever the number
of rows, so a frequent label or thousands of copies burden no task.

Defined cases: rows whose id, label or vector is null, or whose vector holds a null, a
component that is not finite or one beyond 64 bits, take no part; vectors are compared with those of the
same number of components, and empty ones score 0; equal rows count once; rows that share
an id and differ otherwise are rows of their own, but no partners of each other; higher
scores come first, ties by smaller id; an anchor without positives, and a positive without
negatives, give no rows, as does an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import map_batches
from ridelake.session import stage

# Rows of a tile of candidates and of one of anchors.
TILE, ANCHORS = 2048, 1024
# Matrices with a side of at most this many rows or columns are multiplied plainly.
LEAF = 16
POSITIVES, NEGATIVES = 5, 3
# A negative's score is at least and at most these shares of the positive's, in hundredths.
LEAST, MOST = 50, 95
_LOWEST = np.iinfo(np.int64).min


def _even(x: np.ndarray) -> np.ndarray:
    """The matrix with a row and a column of zeros where it has odd sides."""
    return np.pad(x, ((0, x.shape[0] % 2), (0, x.shape[1] % 2)))


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, exact as long as its entries fit into 64 bits."""
    m, n = a.shape[0], b.shape[1]
    if min(m, n, a.shape[1]) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    out = np.empty((2 * i, 2 * k), dtype=np.int64)
    c11, c12, c21, c22 = out[:i, :k], out[:i, k:], out[i:, :k], out[i:, k:]
    c11[:] = c22[:] = strassen(a11 + a22, b11 + b22, leaf)
    c21[:] = p = strassen(a21 + a22, b11, leaf)
    c22 -= p
    c12[:] = p = strassen(a11, b12 - b22, leaf)
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest allowed scores of each row, highest first; of equal
    ones the earlier columns."""
    width = scores.shape[1]
    least = np.full(len(scores), _LOWEST)
    if width > k:
        least = np.partition(np.where(allowed, scores, _LOWEST), width - k, axis=1)[:, width - k]
    row, column = np.nonzero(allowed & (scores >= least[:, None]))
    order = np.lexsort((column, ~scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    kept = np.arange(len(row)) - first < k
    return row[kept], column[kept]


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v): rows that take part, components as floor(scale * x)."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: x.cast("double") * scale).alias("e"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL")
    # Also false for NaN, which Spark holds greater than any number.
    fits = F.forall("e", lambda x: x.isNotNull() & (F.abs(x) < float(1 << 63)))
    return rows.where(fits).select("vec_id", "label", F.transform("e", lambda x: F.floor(x)).alias("v"))


def _tiles(rows: DataFrame, size: int, columns: list[str]) -> DataFrame:
    """(dim, tile, columns as lists, v as one long list): about ``size`` rows a tile, dealt
    by a hash of the distinct row."""
    totals = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).alias("tiles"))
    dealt = rows.join(totals, "dim").withColumn("tile", F.pmod(F.xxhash64("vec_id", "mark"), F.col("tiles")))
    lists = [F.collect_list(c).alias(c) for c in columns]
    return dealt.groupBy("dim", "tile").agg(*lists, F.flatten(F.collect_list("v")).alias("v"))


def _matrix(values: pa.ListScalar, rows: int) -> np.ndarray:
    return values.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(rows, -1)


def _met(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every tile of anchors with every tile of candidates of its kind: anchors, the smaller
    set, travel to the candidates' tiles, which are partitioned by their numbers."""
    places = candidates.groupBy("dim").agg(F.max("tile").alias("last"))
    renamed = anchors.select("dim", *[F.col(c).alias(f"a_{c}") for c in anchors.columns if c != "dim"])
    sent = renamed.join(places, "dim").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")
    return candidates.join(sent, ["dim", "tile"])


class _Pair:
    """Two tiles that meet: ids, labels, marks and the scores of anchors (rows) with
    candidates (columns, by id)."""

    def __init__(self, row: dict):
        columns = {c: row[c].values.to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "mark", "a_vec_id", "a_label", "a_mark")}
        order = np.lexsort((columns["mark"], columns["vec_id"]))
        self.ids, self.labels, self.marks = (columns[c][order] for c in ("vec_id", "label", "mark"))
        self.anchors, self.anchor_labels, self.anchor_marks = (columns[f"a_{c}"] for c in ("vec_id", "label", "mark"))
        self.scores = strassen(_matrix(row["a_v"], len(self.anchors)), _matrix(row["v"], len(order))[order].T)
        self.same = self.anchor_labels[:, None] == self.labels[None, :]
        self.other = self.anchors[:, None] != self.ids[None, :]


def _pairs(batch: pa.RecordBatch):
    for i in range(batch.num_rows):
        yield _Pair({name: batch.column(name)[i] for name in batch.schema.names})


def _rows(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts)]) for i in range(len(names))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _merged(found: DataFrame, keys: list[str], by: str, mark: str, k: int) -> DataFrame:
    """The ``k`` best of each key; tasks keep ``k`` a key before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(f"{by}_score"), f"{by}_id", mark)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows``: vec_id, label and v, an array of integers. The score of two rows is the inner
    product of their ``v``. The positives of an anchor are the best other rows of its label,
    its negatives the best rows of other labels with a score of at least ``least`` and at
    most ``most`` hundredths of the positive's.
    """
    mark = F.xxhash64("label", "v")
    rows = stage(rows.distinct().select("vec_id", "label", mark.alias("mark"), F.size("v").alias("dim"), "v"), "rows")
    candidates = stage(_tiles(rows, TILE, ["vec_id", "label", "mark"]), "tiles")
    anchors = rows.where(is_anchor)

    def same(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for p in _pairs(batch):
            row, column = best(p.scores, p.same & p.other, positives)
            out.append((p.anchors[row], p.anchor_marks[row], p.ids[column], p.marks[column], p.scores[row, column]))
        return _rows(out, ["anchor_id", "anchor_mark", "positive_id", "positive_mark", "positive_score"])

    schema = "anchor_id long, anchor_mark long, positive_id long, positive_mark long, positive_score long"
    heaps = map_batches(_met(candidates, _tiles(anchors, ANCHORS, ["vec_id", "label", "mark"])), same, schema)
    chosen = stage(_merged(heaps, ["anchor_id", "anchor_mark"], "positive", "positive_mark", positives), "positives")

    # A few positives an anchor, by rank; fewer are filled up with scores that allow nothing.
    place = F.sort_array(F.collect_list(F.struct("rank", "positive_score")))
    wanted = chosen.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_mark").alias("mark")).agg(place.alias("p"))
    score = [F.coalesce(F.get("p", F.lit(i))["positive_score"], F.lit(-1)).alias(f"p{i}") for i in range(positives)]
    asked = anchors.join(wanted, ["vec_id", "mark"]).select(*anchors.columns, *score)
    names = [f"p{i}" for i in range(positives)]

    def different(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for i, p in enumerate(_pairs(batch)):
            apart = ~p.same & p.other
            for rank, name in enumerate(names, 1):
                # least * positive <= 100 * negative <= most * positive, within 64 bits
                limits = [divmod(s, 100) for s in batch.column(f"a_{name}")[i].as_py()]
                low = np.array([q * least - (-r * least // 100) for q, r in limits])
                high = np.array([q * most + r * most // 100 for q, r in limits])
                row, column = best(p.scores, apart & (p.scores >= low[:, None]) & (p.scores <= high[:, None]), negatives)
                out.append((p.anchors[row], p.anchor_marks[row], np.full(len(row), rank), p.ids[column], p.marks[column], p.scores[row, column]))
        return _rows(out, ["anchor_id", "anchor_mark", "place", "negative_id", "negative_mark", "negative_score"])

    schema = "anchor_id long, anchor_mark long, place long, negative_id long, negative_mark long, negative_score long"
    heaps = map_batches(_met(candidates, _tiles(asked, ANCHORS, ["vec_id", "label", "mark", *names])), different, schema)
    merged = _merged(heaps, ["anchor_id", "anchor_mark", "place"], "negative", "negative_mark", negatives)
    known = chosen.select("anchor_id", "anchor_mark", F.col("rank").cast("long").alias("place"), "positive_id", "positive_score")
    joined = merged.join(known, ["anchor_id", "anchor_mark", "place"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
