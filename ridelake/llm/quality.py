"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

A text becomes some twenty statistics of its characters and words, standardised over the
learned rows and cut at four deviations. Random Fourier features cos(w x + b) approximate a
Gaussian kernel on them; a ridge regression on the label comes from the normal equations,
which every task sums for its own rows and Spark then adds up, whatever the number of rows.
Raw scores become probabilities by isotonic regression: rows and labels are counted in 2,000
equal bins of the raw score, and neighbours are pooled until the rates never fall.

The regression is learned on four fifths of the rows that may be learned from (chosen by a
hash of ``doc_id``), the calibration on the fifth left out.

Defined cases: null and empty texts have the statistics of a text without words and are
scored like any other; without learnable rows of both labels every score is the mean label,
or 0.5 without any; a label that is null or neither 0 nor 1 is not learned from; of several
labels of one ``doc_id`` the smallest counts; repeated rows come out as often as they come
in; a null ``doc_id`` is not learned from and not held out; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import Words, id_and_text, in_fold, map_batches, prepare_workers
from ridelake.session import stage

FEATURES, WIDTH, RIDGE, SEED = 256, 0.15, 1e-3, 7
CUT, BINS = 4.0, 2000
THRESHOLD = 0.3

# Classes of bytes: other, lower case, upper case, digit, blank, line end, mark (.,;:'"-),
# loud mark (!?), symbol, beyond ASCII.
_CLASSES = 10
_CLASS = np.zeros(256, dtype=np.uint8)
for _i, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:'\"-", "!?", "#$%&*+/<=>@[\\]^_`{|}~()"), 1):
    _CLASS[list(_chars.encode())] = _i
_CLASS[128:] = 9
NAMES = [
    *("other", "lower", "upper", "digit", "blank", "line", "mark", "loud", "symbol", "beyond"),
    *("log_chars", "log_words", "word_length", "distinct", "same_as_last", "top_share", "caps_words", "symbol_end", "bare_symbol", "stop_end"),
]


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each text."""
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "").cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    kinds = _CLASS[data]
    n = len(texts)
    out = np.zeros((n, len(NAMES)))
    for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        out[i, :_CLASSES] = np.bincount(kinds[a:b], minlength=_CLASSES)
    chars = np.diff(offsets)
    out[:, :_CLASSES] /= np.maximum(chars, 1)[:, None]

    words = Words(texts, r"\s+")
    names = words.distinct.tolist()
    each = np.zeros((len(names), 5))
    for i, w in enumerate(names):
        bare = w.strip("!?.,;:'\"")
        each[i] = len(w), len(bare) > 1 and bare.isupper(), w[-1] in "#$%&*+=@^~|!", not any(c.isalnum() for c in w), w[-1] == "."
    count = np.diff(words.offsets)
    many = np.maximum(count, 1)
    sums = words.sums(each[words.codes])
    text_of = words.text_of()
    pairs, times = np.unique(text_of * max(1, len(names)) + words.codes, return_counts=True)
    own = pairs // max(1, len(names))
    distinct = np.bincount(own, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, own, times)
    again = (words.codes[1:] == words.codes[:-1]) & (text_of[1:] == text_of[:-1])
    at = _CLASSES
    out[:, at] = np.log1p(chars)
    out[:, at + 1] = np.log1p(count)
    out[:, at + 2] = sums[:, 0] / many
    out[:, at + 3] = np.log1p(distinct) / np.log1p(many)
    out[:, at + 4] = np.bincount(text_of[1:][again], minlength=n) / many
    out[:, at + 5] = top / many
    out[:, at + 6 : at + 10] = sums[:, 1:5] / many[:, None]
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<float>) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(batch.column("text")).astype(np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "x"])

    return map_batches(id_and_text(docs), run, "doc_id long, x array<float>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    edges: np.ndarray
    rates: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CUT, CUT)
        return np.concatenate([np.cos(z @ self.w + self.b) * np.sqrt(2 / FEATURES), z / np.sqrt(FEATURES), np.ones((len(z), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.edges, self.rates)


def _summed(rows: DataFrame, fn, cells: int) -> np.ndarray:
    """The sum over all rows of ``fn(x, y)``, an array of ``cells`` numbers: added up within
    each task, then by Spark."""
    prepare_workers(rows.sparkSession)

    def run(batches):
        total = np.zeros(cells)
        for batch in batches:
            if batch.num_rows:
                total += fn(_matrix(batch.column("x")), batch.column("y").to_numpy(zero_copy_only=False).astype(float)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], names=["cell", "n"])

    out = np.zeros(cells)
    for cell, n in rows.select("x", "y").mapInArrow(run, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[cell] = n
    return out


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def pooled(rows: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Isotonic rates of neighbouring bins: pooled until they never fall."""
    blocks: list[list[float]] = []  # hits, rows, bins
    for n, h in zip(rows.tolist(), hits.tolist()):
        blocks.append([h, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            h2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + h2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    # Half a row of either label keeps the rates off 0 and 1.
    return np.concatenate([np.full(int(k), (h + 0.5) / (n + 1.0)) for h, n, k in blocks])


def fit(rows: DataFrame, label: DataFrame) -> Model | float:
    """A model from statistics (doc_id, x) and labels (doc_id, y); the mean label if it is
    the same for all."""
    known = stage(rows.join(label, "doc_id").select("doc_id", "x", "y"), "labelled")
    d = len(NAMES)
    n, ones, *moments = _summed(known, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(axis=0), (x**2).sum(axis=0)]), 2 + 2 * d)
    if n == 0 or ones in (0, n):
        return 0.5 if n == 0 else float(ones / n)
    mean = np.array(moments[:d]) / n
    scale = np.sqrt(np.maximum(np.array(moments[d:]) / n - mean**2, 0)) + 1e-3
    rng = np.random.default_rng(SEED)
    model = Model(mean, scale, rng.normal(0, WIDTH, (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(0), np.zeros(0), np.zeros(0))
    size = FEATURES + d + 1
    fifth = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(5)) == 0
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def normal(x, y):
        f = shared.value.features(x)
        return np.concatenate([f.T @ f, (f.T @ y)[:, None]], axis=1)

    equations = _summed(known.where(~fifth), normal, size * (size + 1)).reshape(size, size + 1)
    model.beta = np.linalg.solve(equations[:, :size] + RIDGE * max(1.0, n) * np.eye(size) / size, equations[:, size])
    shared = rows.sparkSession.sparkContext.broadcast(model)
    edges = np.linspace(-0.5, 1.5, BINS + 1)

    def binned(x, y):
        at = np.clip(np.searchsorted(edges, shared.value.raw(x)) - 1, 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    counted = _summed(known.where(fifth), binned, 2 * BINS)
    if not 0 < counted[BINS:].sum() < counted[:BINS].sum():  # too few rows: calibrate on all
        counted = _summed(known, binned, 2 * BINS)
    filled = counted[:BINS] > 0
    model.edges = ((edges[1:] + edges[:-1]) / 2)[filled]
    model.rates = pooled(counted[:BINS][filled], counted[BINS:][filled])
    return model


def labels_of(labels: DataFrame, column: str, modulus: int, remainder: int) -> DataFrame:
    """(doc_id, y): labels that may be learned from, one for each id."""
    doc_id, y = F.col("doc_id").cast("long"), F.col(column).cast("int")
    own = labels.select(doc_id.alias("doc_id"), y.alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    return own.where(~in_fold(F.col("doc_id"), modulus, remainder)).groupBy("doc_id").agg(F.min("y").alias("y"))


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    rows = stage(document_statistics(docs), "statistics")
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows, labels_of(labels, "quality", modulus, remainder)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        score = np.full(batch.num_rows, model) if isinstance(model, float) else model.score(_matrix(batch.column("x")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(score, 0, 1))], names=["doc_id", "score"])

    scored = map_batches(rows, run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        in_fold(F.col("doc_id"), modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
