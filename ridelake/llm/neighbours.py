"""Nearest neighbours by cross-polytope hashing, reranked by exact distance.

Vectors scaled to length one are turned by pseudo-rotations - signs flipped at random and a
fast Hadamard transform, three times - and belong to the signed axis nearest to them. Each
of ``TABLES`` rotations makes a table, at any number of vectors alike, so recall does not
change with it. Every vector is filed under its own key; a query probes the ``PROBES`` keys
nearest to it in each table. (With ``rotations`` above one a key joins as many axes: shorter
lists, for vectors whose neighbours are much nearer than the rest, and more probes needed.)

Filed vectors and queries meet in packs of bounded size, split by a hash of the vector, and
every pair of packs gives only the best of each query, by exact Euclidean distance on the
original vectors. A query that has met too few candidates goes through all packs.

Of equal vectors the ``k`` + 1 with the smallest ids are filed; no others can be among the
nearest. So thousands of copies burden no list.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part, as query or candidate, nor do rows whose ``vec_id`` is null; vectors are
compared with those of the same number of components; rows of one repeated ``vec_id`` count
as one, as near as the nearest of them; a query never meets its own id; ties go to the
smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import map_batches
from ridelake.session import stage

TABLES, PROBES, SEED = 8, 16, 1000
# Vectors, and queries, that meet in one pack.
PACK = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), -1, 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Rows of length one after a pseudo-rotation, padded to a power of two."""
    size = 1 << max(0, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), size))
    y[:, : x.shape[1]] = x
    rng = np.random.default_rng([SEED, seed])
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], size))
    return y


def axes(y: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest signed axes of each row, nearest first, and how near they are."""
    order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :many]
    value = np.take_along_axis(y, order, axis=1)
    return 2 * order + (value < 0), np.abs(value)


def keys(x: np.ndarray, table: int, rotations: int, probes: int) -> np.ndarray:
    """For each row the ``probes`` nearest keys of a table, its own first."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near, value = axes(rotated(x, table * 8), min(probes, 2 * x.shape[1]))
    for r in range(1, rotations):
        more, worth = axes(rotated(x, table * 8 + r), min(probes, 2 * x.shape[1]))
        both = (near[:, :, None].astype(np.int64) << 16 | more[:, None, :]).reshape(len(x), -1)
        total = (value[:, :, None] + worth[:, None, :]).reshape(len(x), -1)
        best = np.argsort(-total, axis=1, kind="stable")[:, :probes]
        near, value = np.take_along_axis(both, best, axis=1), np.take_along_axis(total, best, axis=1)
    return near[:, :probes].astype(np.int64)


def _vectors(column) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and double vectors of a batch of binary vectors of one length each."""
    raw = column.to_pylist()
    return np.array([len(b) // 8 for b in raw], dtype=np.int64), raw


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, v): vectors that take part, as binary doubles."""
    embedding = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("e"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0))
    rows = rows.where(F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))).where(F.exists("e", lambda c: c != 0))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [np.array(x, dtype="<f8") for x in batch.column("e").to_pylist()]
        dims = pa.array([len(x) for x in lists], pa.int32())
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), dims, pa.array([x.tobytes() for x in lists], pa.binary())], names=["vec_id", "dim", "v"])

    return map_batches(rows, run, "vec_id long, dim int, v binary")


def filed(rows: DataFrame, rotations: int, probes: int) -> DataFrame:
    """``rows`` (vec_id, dim, v) once for each table and probed key."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        dims, raw = _vectors(batch.column("v"))
        at, table_no, key_no = [], [], []
        for dim in np.unique(dims).tolist():
            own = np.flatnonzero(dims == dim)
            x = np.frombuffer(b"".join(raw[i] for i in own), dtype="<f8").reshape(len(own), dim)
            for table in range(TABLES):
                found = keys(x, table, rotations, probes)
                at.append(np.repeat(own, found.shape[1]))
                table_no.append(np.full(found.size, table, dtype=np.int32))
                key_no.append(found.ravel())
        at = np.concatenate(at)
        rows = batch.take(pa.array(at))
        return rows.append_column("table", pa.array(np.concatenate(table_no))).append_column("key", pa.array(np.concatenate(key_no)))

    return map_batches(rows, run, "vec_id long, dim int, v binary, table int, key long")


def packed(rows: DataFrame, by: list[str], pack: int) -> DataFrame:
    """Rows of equal ``by`` in packs of about ``pack``, dealt by a hash of the row."""
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_of_key"))
    rows = rows.join(sizes, by)
    slot = F.pmod(F.xxhash64("vec_id", "v"), F.ceil(F.col("rows_of_key") / pack).cast("long"))
    return rows.groupBy(*by, slot.alias("slot")).agg(F.collect_list("vec_id").alias("ids"), F.collect_list("v").alias("vs"))


def best_of_packs(met: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the ``k`` best of each query in each pair of packs.

    ``met``: dim, ids and vs of a pack of vectors, query_ids and query_vs of a pack of queries.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple[np.ndarray, ...]] = []
        for row in range(batch.num_rows):
            ids, vs, qids, qvs, dim = (batch.column(c)[row].as_py() for c in ("ids", "vs", "query_ids", "query_vs", "dim"))
            ids, qids = np.array(ids), np.array(qids)
            x = np.frombuffer(b"".join(vs), dtype="<f8").reshape(-1, dim)
            q = np.frombuffer(b"".join(qvs), dtype="<f8").reshape(-1, dim)
            # A few more than k by the quick formula, then the exact measure for those.
            squares_q, squares_x = (q**2).sum(axis=1), (x**2).sum(axis=1)
            near = squares_q[:, None] + squares_x[None, :] - 2 * (q @ x.T)
            margin = 1e-9 * (squares_q.max() + squares_x.max())
            if not np.isfinite(margin):
                near = np.zeros_like(near)  # too long for the formula: measure all
            near[qids[:, None] == ids[None, :]] = np.inf
            for i in range(len(qids)):
                limit = np.partition(near[i], k - 1)[k - 1] if len(ids) > k else np.inf
                own = np.flatnonzero((near[i] <= limit + margin) & (qids[i] != ids))
                score = np.sqrt(((x[own] - q[i]) ** 2).sum(axis=1))
                order = np.lexsort((ids[own], score))[:k]
                out.append((np.full(len(order), qids[i]), ids[own][order], score[order]))
        columns = [np.concatenate([o[c] for o in out]).astype(t) for c, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return map_batches(met, run, "query_id long, vec_id long, score double")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, rotations: int = 1, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of each vector whose id is
    divisible by ``every``, among all others."""
    rows = stage(usable(vectors).distinct(), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    copies = Window.partitionBy("dim", "v").orderBy("vec_id")
    kept = stage(rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "distinct-vectors")
    lists = packed(filed(kept, rotations, 1), ["dim", "table", "key"], PACK)
    asked = packed(filed(queries, rotations, probes), ["dim", "table", "key"], PACK)
    asked = asked.select("dim", "table", "key", F.col("ids").alias("query_ids"), F.col("vs").alias("query_vs"))
    found = stage(ranked(best_of_packs(lists.join(asked, ["dim", "table", "key"]), k), k), "found")
    # Queries that met fewer than k candidates are compared with all vectors of their kind.
    enough = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id")).distinct()
    few = stage(queries.join(enough, "vec_id", "left_anti"), "few")
    slots = packed(kept, ["dim"], PACK)
    counts = kept.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / PACK).cast("long").alias("packs"))
    asked = few.join(counts, "dim").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("packs") - 1)))
    asked = packed(asked.select("vec_id", "dim", "v", F.col("slot").alias("at")), ["dim", "at"], PACK)
    asked = asked.select("dim", F.col("at").alias("slot"), F.col("ids").alias("query_ids"), F.col("vs").alias("query_vs"))
    rest = ranked(best_of_packs(slots.join(asked, ["dim", "slot"]), k), k)
    done = found.join(few.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti")
    return done.unionByName(rest)
