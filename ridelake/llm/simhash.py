"""Near-duplicates by SimHash, found by the generalised pigeonhole principle.

A text's fingerprint has 64 bits: words are runs of other than ASCII white space with A-Z
lower-cased, shingles are three words joined by a blank (repeats included; fewer words: all
of them), and a bit is set if it is set in more than half of the shingles' XXH64 values.
Two texts are linked when their fingerprints differ in at most ``distance`` bits.

Links are searched between distinct fingerprints:

* Bits that go together are grouped into the same part, so that a common value burdens one
  part and leaves the others selective.
* Thresholds t_i of the parts add up to distance - parts + 1 (-1: part not searched). Then
  two fingerprints within the distance have a part in which they differ in at most t_i bits.
  Each fingerprint takes the thresholds with the fewest candidates, by dynamic programming
  over the exact number of fingerprints with each value of each part. These counts have a
  fixed size (parts x 2^width), whatever the number of texts.
* A fingerprint probes the values within t_i of its own in each part; what it meets is
  compared over all 64 bits at once.
* Fingerprints whose best thresholds still give more than ``crowded`` candidates need not
  search: they are found by all others, and among themselves they meet at bit patterns:
  two within three bits share a pattern within two bits of the one and one of the other.
  All that lie within two bits of a pattern are linked to the smallest within one bit of
  it. These links are true, join what is within the distance, and grow with the number of
  fingerprints, not with its square.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any
other; equal texts have equal fingerprints; repeated rows come out as often as they come
in; a null ``doc_id`` stays, its component has the smallest non-null id, or null if there
is none; other columns, whatever their names, are ignored by ``near_duplicates`` and
returned unchanged by ``keep_one``, which keeps one of several equal rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import free_name, id_and_text, map_batches, prepare_workers
from ridelake.llm.components import components
from ridelake.session import stage

BITS, SEED = 64, 42
DISTANCE = 3
# Candidates beyond which a fingerprint leaves the probing to others.
CROWDED = 20_000
# More distinct fingerprints than this are searched in three parts instead of four.
FOUR_PARTS = 1 << 22
# Shingles hashed at once, so that memory does not grow with a text.
BLOCK = 1 << 16

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set. Eight bits are counted at once in the bytes of a
    word, in groups that no byte overflows."""
    padded = np.zeros(-(-len(hashes) // 255) * 255, dtype=np.uint64)
    padded[: len(hashes)] = hashes
    counts = np.zeros(BITS, dtype=np.int64)
    for j in range(8):
        sums = ((padded >> np.uint64(j)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[j::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, words_each: int = 3) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    total = max(1, len(words) - words_each + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, total, BLOCK):
        part = words[at : at + BLOCK + words_each - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(words_each)))) if len(words) >= words_each else [b" ".join(words)]
        counts += bit_counts(np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), dtype=np.uint64))
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, a, b, fp): a and b stand for the row, fp is the fingerprint as a long."""
    rows = id_and_text(docs).select("doc_id", *_row_key(F.col("doc_id"), F.col("text")), "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], dtype=np.uint64)
        columns = [batch.column(c) for c in ("doc_id", "a", "b")] + [pa.array(found.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "a", "b", "fp"])

    return map_batches(rows, run, "doc_id long, a long, b long, fp long")


def _row_key(doc_id, text, a: str = "a", b: str = "b"):
    """128 bits that stand for an id and a text."""
    return (
        F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text).alias(a),
        F.xxhash64(F.lit("row"), doc_id.isNull(), doc_id, F.length(text), text).alias(b),
    )


def bits_together(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How often each bit is set, and each two bits both, over all fingerprints: sums of
    each task, then of all; 64 x 64 numbers."""

    prepare_workers(classes.sparkSession)

    def run(batches):
        total = np.zeros((BITS, BITS))
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            x = ((fp[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            total += x.T @ x
        cells = [pa.array(np.arange(BITS * BITS, dtype=np.int32)), pa.array(total.ravel().astype(np.int64))]
        yield pa.RecordBatch.from_arrays(cells, names=["cell", "n"])

    sums = classes.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS)
    for cell, n in sums.collect():
        both[cell] = n
    both = both.reshape(BITS, BITS)
    return np.diag(both).copy(), both


def group_bits(ones: np.ndarray, both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size; each group gathers the free bits that
    correlate most with those it has."""
    p = ones / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    together = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(together, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda i: (together[i, free].max(), -i))]
        free.remove(group[0])
        while len(group) < width:
            best = max(free, key=lambda i: (together[i, group].sum(), -i))
            free.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def part_values(fp: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group``, packed."""
    out = np.zeros(len(fp), dtype=np.int64)
    for k, bit in enumerate(group):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def ball(width: int, radius: int) -> np.ndarray:
    """All patterns of ``width`` bits with at most ``radius`` set."""
    found = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]
    return np.array(found, dtype=np.uint64)


def thresholds(costs: list[list[np.ndarray]], total: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint the threshold of each part, and the cost of all.

    ``costs[i][e + 1]``: cost of threshold e in part i, for each fingerprint. Dynamic
    programming over parts and the sum of thresholds so far; sums above ``total`` are needless.
    """
    parts, n = len(costs), len(costs[0][0])
    best = {0: np.zeros(n)}
    choices = []
    for i in range(parts):
        after: dict[int, np.ndarray] = {}
        chosen: dict[int, np.ndarray] = {}
        for s, cost in best.items():
            for e in range(-1, len(costs[i]) - 1):
                if s + e > total + (parts - i - 1):
                    continue
                value = cost + costs[i][e + 1]
                if s + e not in after:
                    after[s + e], chosen[s + e] = value, np.full(n, e, dtype=np.int8)
                else:
                    better = value < after[s + e]
                    after[s + e] = np.where(better, value, after[s + e])
                    chosen[s + e] = np.where(better, np.int8(e), chosen[s + e])
        best = after
        choices.append(chosen)
    out = np.zeros((n, parts), dtype=np.int8)
    at = np.full(n, total)
    for i in reversed(range(parts)):
        for s, chosen in choices[i].items():
            here = at == s
            out[here, i] = chosen[here]
        at = at - out[:, i]
    return out, best[total]


def part_counts(classes: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """Fingerprints with each value of each part: 2^width numbers a part."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        values = np.concatenate([part_values(fp, g) for g in groups])
        parts = np.repeat(np.arange(len(groups), dtype=np.int32), len(fp))
        return pa.RecordBatch.from_arrays([pa.array(parts), pa.array(values)], names=["part", "value"])

    counted = map_batches(classes.select("fp"), run, "part int, value long").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = [np.zeros(1 << len(g), dtype=np.int64) for g in groups]
    table = counted.toArrow()
    part, value, n = (table.column(c).to_numpy() for c in ("part", "value", "n"))
    for i, own in enumerate(counts):
        own[value[part == i]] = n[part == i]
    return counts


def links(classes: DataFrame, n: int, distance: int = DISTANCE, crowded: int = CROWDED, parts: int | None = None) -> DataFrame:
    """(u, v): links between the ``n`` distinct fingerprints of ``classes`` (fp). All
    pairs within ``distance`` are joined by them, directly or over links as close."""
    if distance != 3:
        raise ValueError("the meeting of crowded fingerprints is worked out for a distance of 3")
    spark = classes.sparkSession
    parts = parts or (4 if n <= FOUR_PARTS else 3)
    groups = group_bits(*bits_together(classes), n, parts)
    most = min(distance, 2)
    counts = part_counts(classes, groups)
    near = []
    for group, own in zip(groups, counts):
        values, sums, total = np.arange(len(own)), [], np.zeros(len(own), dtype=np.int64)
        for r in range(most + 1):
            for c in combinations(range(len(group)), r):
                total = total + own[values ^ sum(1 << i for i in c)]
            sums.append(total)
        near.append(sums)
    shared = spark.sparkContext.broadcast((groups, near))

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        groups, near = shared.value
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        values = [part_values(fp.view(np.uint64), g) for g in groups]
        balls = [[ball(len(g), r).astype(np.int64) for r in range(most + 1)] for g in groups]
        costs = [[np.zeros(len(fp))] + [sums[e][v] + len(b[e]) for e in range(most + 1)] for sums, v, b in zip(near, values, balls)]
        chosen, cost = thresholds(costs, distance - len(groups) + 1)
        cold = cost <= crowded
        out = [(fp[~cold], np.full((~cold).sum(), -1), np.zeros((~cold).sum(), dtype=np.int64))]
        for i, (v, b) in enumerate(zip(values, balls)):
            for e in range(most + 1):
                rows = cold & (chosen[:, i] == e)
                keys = (v[rows][:, None] ^ b[e][None, :]).ravel()
                out.append((np.repeat(fp[rows], len(b[e])), np.full(len(keys), i), keys))
        columns = [np.concatenate([x[k] for x in out]).astype(t) for k, t in enumerate((np.int64, np.int32, np.int64))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["u", "part", "value"])

    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        groups, near = shared.value
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        out = []
        for i, g in enumerate(groups):
            v = part_values(fp.view(np.uint64), g)
            rows = near[i][0][v] <= crowded  # nobody probes the others
            out.append((fp[rows], np.full(rows.sum(), i), v[rows]))
        columns = [np.concatenate([x[k] for x in out]).astype(t) for k, t in enumerate((np.int64, np.int32, np.int64))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["v", "part", "value"])

    own = classes.select("fp")
    probes = stage(map_batches(own, probe, "u long, part int, value long"), "probes")
    indexed = map_batches(own, index, "v long, part int, value long")
    near_enough = (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance) & (F.col("u") != F.col("v"))
    met = probes.where("part >= 0").join(indexed, ["part", "value"]).where(near_enough).select("u", "v")
    return met.union(_crowded_links(probes.where("part < 0").select(F.col("u").alias("fp"))))


def _crowded_links(fps: DataFrame) -> DataFrame:
    """Links among crowded fingerprints, over patterns within one and two bits."""

    def around(radius: int):
        flips = ball(BITS, radius)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            at = (fp.view(np.uint64)[:, None] ^ flips[None, :]).ravel().view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.repeat(fp, len(flips)))], names=["at", "fp"])

        return map_batches(fps, run, "at long, fp long")

    one = around(1).groupBy("at").agg(F.min("fp").alias("u"))
    return around(2).join(one, "at").where("u != fp").select("u", F.col("fp").alias("v")).distinct()


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """doc_id, fingerprint, component_id, and a, b (the row) and root (the component)."""
    rows = stage(fingerprints(docs), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(links(classes, classes.count(), distance, crowded))
    found = stage(found, "components")
    rooted = classes.join(found, classes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(rooted.select("fp", "root").join(ids, "root"), "named")
    return rows.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "a",
        "b",
        "root",
    )


def keep_one(docs: DataFrame, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest ``doc_id`` (null: last)."""
    found = near_duplicates(docs, distance, crowded)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "a", "b")
    kept = found.groupBy("root").agg(F.min(order).alias("one")).select("one.a", "one.b")
    a, b = free_name(docs, "row_a"), free_name(docs, "row_b")
    kept = stage(kept.toDF(a, b), "kept")
    keyed = docs.select("*", *_row_key(F.col("doc_id").cast("long"), F.col("text").cast("string"), a, b))
    return keyed.join(kept, [a, b], "left_semi").dropDuplicates([a, b]).select(*docs.columns)
