"""Passages of benchmark items in documents, by spaced seeds.

Words are runs of letters and digits in lower case. A spaced seed is a fixed mask over
``SPAN`` consecutive words that ignores some positions; its hash covers the others, so
words that were replaced at ignored positions do not hide a passage. Every place of every
item and document is hashed under each mask; where hashes of an item and a document meet,
the item is laid along the document at that shift, and the stretch with the most equal words
among those in a share of ``SHARE`` or more is measured: an item is found when it has at
least ``LEAST`` of them (all words of a shorter item). Besides, ``LEAST`` words in a row are
hashed with nothing ignored, so a passage whose ends alone are equal is met as well.

Document places first pass a bitmap of all item hashes, whose size is fixed whatever the
number of items. Places that pass are joined with the items' hashes by Spark; neighbouring
places make one region, which carries its words for the measurement. So a passage in a third
of all documents costs each of them one region, and no task meets more than its share.

Items of fewer than ``LEAST`` words are found as a whole only: their words, with nothing
ignored, are one hash of their own length.

Defined cases: null and empty texts and items have no places; equal items count each; rows
equal in ``doc_id`` and text fare alike; of stretches with equally many words the first counts;
very long texts are searched whole; null ``doc_id`` are searched like others; other
columns are returned unchanged by ``without_benchmark``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import Words, free_name, map_batches
from ridelake.session import stage

# Masks over 11 words, of 7 that count each.
MASKS = ("11101001011", "11010011101", "10111100101")
SPAN = len(MASKS[0])
LEAST, SHARE = 10, 0.75
# Equal words that make up for one other.
_COST = SHARE / (1 - SHARE)
# Bits of the map that document places pass first; 2 MB.
MAP_BITS = 1 << 24
# Words a region carries on both sides of its places, and gaps it bridges.
AROUND = 64
BETWEEN = r"[^\p{L}\p{N}]+"

_FACTORS = np.random.default_rng(20).integers(1, 1 << 63, SPAN, dtype=np.uint64) | np.uint64(1)


def word_hashes(words: Words) -> np.ndarray:
    """64 bits for each word of the batch's texts."""
    from xxhash import xxh64_intdigest

    own = np.array([xxh64_intdigest(w) for w in words.distinct.tolist()], dtype=np.uint64)
    return own[words.codes] if len(own) else np.zeros(0, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def seed_hashes(h: np.ndarray, mask: int) -> np.ndarray:
    """The hash under a mask of each place with ``SPAN`` words from there on."""
    n = len(h) - SPAN + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, mask + 1, dtype=np.uint64)
    for k, bit in enumerate(MASKS[mask]):
        if bit == "1":
            total = total + h[k : k + n] * _FACTORS[k]
    return _mixed(total)


def short_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """The hash of each place with ``length`` < SPAN words from there on."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, 1000 + length, dtype=np.uint64)
    for k in range(length):
        total = total + h[k : k + n] * _FACTORS[k]
    return _mixed(total)


def item_seeds(items: DataFrame) -> DataFrame:
    """(item, words array<long>, seed, at): every place of every item under every mask."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("text").cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column("text"), BETWEEN, lower=True)
        h = word_hashes(words)
        lists = [h[a:b].view(np.int64).tolist() for a, b in zip(words.offsets, words.offsets[1:])]
        return pa.RecordBatch.from_arrays([batch.column("item"), pa.array(lists, pa.list_(pa.int64()))], names=["item", "words"])

    known = stage(map_batches(rows, run, "item long, words array<long>").where(F.size("words") > 0), "items")

    def seeds(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for item, words in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist()):
            h = np.array(words, dtype=np.int64).view(np.uint64)
            found = [short_hashes(h, min(len(h), LEAST)), *(seed_hashes(h, m) for m in range(len(MASKS)))]
            out += [(item, f, np.arange(len(f))) for f in found]
        item = np.concatenate([np.full(len(f), i, dtype=np.int64) for i, f, _ in out])
        seed = np.concatenate([f for _, f, _ in out]).view(np.int64)
        at = np.concatenate([a for _, _, a in out]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(item), pa.array(seed), pa.array(at)], names=["item", "seed", "at"])

    return known, stage(map_batches(known, seeds, "item long, seed long, at int"), "item-seeds")


def bitmap(seeds: DataFrame) -> np.ndarray:
    """A bit for each value the seeds have modulo ``MAP_BITS``: at most 2^18 words of 64
    bits, put together by Spark."""
    bit = F.pmod("seed", F.lit(MAP_BITS))
    words = seeds.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, int(pmod(seed, {MAP_BITS}) & 63))").alias("bit"))
    out = np.zeros(MAP_BITS // 64, dtype=np.uint64)
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def _passes(bits: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    at = seeds & np.uint64(MAP_BITS - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def best_stretch(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(begin, end, equal words) in the document's words of the item laid from ``shift`` on:
    of the stretches in which a share of ``SHARE`` is equal, the one with the most."""
    lo, hi = max(0, shift), min(len(doc), shift + len(item))
    if lo >= hi:
        return 0, 0, 0
    same = doc[lo:hi] == item[lo - shift : hi - shift]
    # The share is met where the sum of these is not below 0.
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -_COST))])
    equal = np.concatenate([[0], np.cumsum(same)])
    # For each end the earliest begin with a sum as low: one of the places of a new minimum.
    low = np.minimum.accumulate(total)
    places = np.flatnonzero(np.concatenate([[True], low[1:] < low[:-1]]))
    begins = places[np.searchsorted(-total[places], -total, side="left")]
    end = int(np.argmax(equal - equal[begins]))
    begin = int(begins[end])
    return lo + begin, lo + end, int(equal[end] - equal[begin])


def found_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(ka, kb, item, begin, end, same): stretches of items in documents, in words; ka and
    kb stand for the document's row."""
    known, seeds = item_seeds(items)
    lengths = sorted(r[0] for r in known.select(F.size("words").alias("n")).where(F.col("n") < LEAST).distinct().collect())
    lengths.append(LEAST)
    shared = docs.sparkSession.sparkContext.broadcast((bitmap(seeds), lengths))
    ka, kb = _row_key()
    rows = docs.select(ka.alias("ka"), kb.alias("kb"), F.col("text").cast("string").alias("text"))

    def regions(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits, lengths = shared.value
        words = Words(batch.column("text"), BETWEEN, lower=True)
        h = word_hashes(words)
        own, start, stretch, seed, at = [], [], [], [], []
        every = [seed_hashes(h, m) for m in range(len(MASKS))] + [short_hashes(h, n) for n in lengths]
        size = [SPAN] * len(MASKS) + lengths
        hits = [np.flatnonzero(_passes(bits, e)) for e in every]
        where = np.concatenate(hits) if hits else np.zeros(0, np.int64)
        value = np.concatenate([e[x] for e, x in zip(every, hits)]).view(np.int64)
        length = np.concatenate([np.full(len(x), n) for x, n in zip(hits, size)])
        text = np.searchsorted(words.offsets, where, side="right") - 1
        inside = where + length <= words.offsets[text + 1]  # not across two texts
        where, value, text = where[inside], value[inside], text[inside]
        order = np.lexsort((where, text))
        where, value, text = where[order], value[order], text[order]
        fresh = np.ones(len(where), dtype=bool)
        fresh[1:] = (text[1:] != text[:-1]) | (where[1:] - where[:-1] > AROUND)
        begins = np.flatnonzero(fresh)
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(where)]):
            t = int(text[a])
            lo = max(int(words.offsets[t]), int(where[a]) - AROUND)
            hi = min(int(words.offsets[t + 1]), int(where[b - 1]) + SPAN + AROUND)
            own.append(t)
            start.append(lo - int(words.offsets[t]))
            stretch.append(h[lo:hi].view(np.int64).tolist())
            seed.append(value[a:b].tolist())
            at.append((where[a:b] - lo).tolist())
        ids = pa.array(own, pa.int64())
        columns = [batch.column(c).take(ids) for c in ("ka", "kb")] + [pa.array(start, pa.int64())]
        columns += [pa.array(stretch, pa.list_(pa.int64())), pa.array(seed, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, names=["ka", "kb", "start", "stretch", "seed", "at"])

    schema = "ka long, kb long, start long, stretch array<long>, seed array<long>, at array<int>"
    found = stage(map_batches(rows, regions, schema), "regions")
    places = found.select("ka", "kb", "start", F.explode(F.arrays_zip("seed", "at")).alias("p"))
    places = places.select("ka", "kb", "start", F.col("p.seed").alias("seed"), F.col("p.at").alias("at"))
    met = places.join(seeds.withColumnRenamed("at", "item_at"), "seed")
    shifts = met.select("ka", "kb", "start", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    pairs = shifts.join(found.select("ka", "kb", "start", "stretch"), ["ka", "kb", "start"]).join(known, "item")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for stretch, words, shift, start in zip(*(batch.column(c).to_pylist() for c in ("stretch", "words", "shift", "start"))):
            begin, end, same = best_stretch(np.array(stretch), np.array(words), shift)
            out.append((start + begin, start + end, same if same >= min(LEAST, len(words)) else 0))
        columns = [batch.column(c) for c in ("ka", "kb", "item")]
        columns += [pa.array([o[i] for o in out], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(columns, names=["ka", "kb", "item", "begin", "end", "same"])

    measured = map_batches(pairs, measure, "ka long, kb long, item long, begin long, end long, same long")
    return measured.where("same > 0").distinct()


def _row_key():
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return F.xxhash64(doc_id.isNull(), doc_id, text), F.xxhash64(F.lit("row"), doc_id, F.length(text), text)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(ka, kb, n_items, n_same): rows with a passage; the items found in it, and the most
    words equal to one of them."""
    return found_passages(docs, items).groupBy("ka", "kb").agg(F.count_distinct("item").alias("n_items"), F.max("same").alias("n_same"))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items and n_same of every row."""
    ka, kb = _row_key()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ka.alias("ka"), kb.alias("kb"))
    found = rows.join(stage(contaminated(docs, items), "contaminated"), ["ka", "kb"], "left")
    n_items, n_same = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_items", "n_same"))
    return found.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), n_items, n_same)


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found."""
    a, b = free_name(docs, "row_a"), free_name(docs, "row_b")
    ka, kb = _row_key()
    found = stage(contaminated(docs, items).select(F.col("ka").alias(a), F.col("kb").alias(b)), "contaminated")
    return docs.select("*", ka.alias(a), kb.alias(b)).join(found, [a, b], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
