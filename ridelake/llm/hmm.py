"""Hidden Markov language model: latent states trained by Baum-Welch, exact likelihoods.

A text is its words and one end mark. In each step the model moves between ``states``
latent states, the state emits a word class, and the class emits the word by its smoothed
count. A word's class is a hash of it, so frequent words mostly have one of their own and no
word is left out; the end mark is a class of itself. Counts of all words of all training
texts are kept, in a table that grows with the corpus; what the states learn - transitions,
starts, and how often each emits each class - has a fixed size.

1. Texts are read once and written as blocks: the words of a block once each, texts as codes.
2. Counts of words are summed over the blocks' distinct words.
3. In each Baum-Welch step every task runs the scaled forward and backward recursions over its
   blocks, all texts of a block side by side, and sums expected counts; Spark adds up those of
   all tasks, and the driver divides. A text longer than ``STRETCH`` is learned from in stretches
   of that length, each a sequence with starts of its own kind.
4. Blocks meet the counts of their words, and the scaled forward recursion over whole texts,
   however long, gives the exact probability of each.

Defined cases: a null text counts as empty, and an empty one is the end mark alone; a null
``doc_id`` is never held out; repeated rows are scored, and counted, as often as they come;
an empty table gives no rows; without training texts every word scores alike (0 in the base
score, whose vocabulary is then one unknown word); words that training texts lack share the
count 0; other columns are ignored. Sums do not depend on ties or on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import Words, id_and_text, prepare_workers
from ridelake.session import stage

STATES, CLASSES, STEPS, SEED = 12, 1 << 14, 6, 11
BETWEEN = "[\x20\x09-\x0d]+"
# Texts of a block, in bytes and rows; tokens that go through the recursions together.
BLOCK_BYTES, BLOCK_ROWS, TOGETHER = 16 << 20, 8000, 400_000
STRETCH = 512
# Pseudo-tokens that each state emits by the classes' overall shares.
SMOOTH = 100.0
_BLOCKS = "block long, ids array<long>, held array<boolean>, offsets array<int>, codes binary, classes binary, words array<string>, seen array<long>"


@dataclass(frozen=True)
class Model:
    """starts: of texts and of later stretches (2 x states); moves: states x states;
    emits: classes and the end mark x states."""

    starts: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


def _packed(codes: np.ndarray) -> bytes:
    """32-bit codes, byte by byte of equal weight, compressed."""
    planes = np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=4 * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, size).T).view("<i4").ravel()


def _block(number: int, table: pa.Table) -> pa.RecordBatch:
    import zlib

    import pyarrow.compute as pc

    texts = pc.ascii_lower(pc.fill_null(table.column("text").combine_chunks(), ""))
    words = Words(texts, BETWEEN)
    # Frequent words get small codes, which pack well.
    order = np.argsort(-np.bincount(words.codes, minlength=len(words.distinct)), kind="stable")
    code_of = np.empty(len(order), dtype=np.int32)
    code_of[order] = np.arange(len(order), dtype=np.int32)
    codes, distinct = code_of[words.codes], words.distinct[order].tolist()
    held = table.column("held").to_numpy(zero_copy_only=False).astype(bool)
    seen = np.bincount(codes[~held[words.text_of()]], minlength=len(distinct))
    classes = np.array([zlib.crc32(w.encode()) % CLASSES for w in distinct], dtype="<i4")
    row = {
        "block": number,
        "ids": table.column("doc_id").to_pylist(),
        "held": held.tolist(),
        "offsets": pa.array(words.offsets.astype(np.int32)),
        "codes": _packed(codes),
        "classes": classes.tobytes(),
        "words": pa.array(distinct, pa.string()),
        "seen": pa.array(seen),
    }
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], names=list(row))


def blocks(docs: DataFrame, held_out: Column) -> DataFrame:
    """The texts as blocks, written once. ``held_out``: whether a row is not learned from."""
    prepare_workers(docs.sparkSession)
    rows = id_and_text(docs).withColumn("held", F.coalesce(held_out, F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, waiting = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            waiting.append(batch)
            if sum(b.nbytes for b in waiting) >= BLOCK_BYTES or sum(b.num_rows for b in waiting) >= BLOCK_ROWS:
                yield _block(number, pa.Table.from_batches(waiting))
                number, waiting = number + 1, []
        if sum(b.num_rows for b in waiting):
            yield _block(number, pa.Table.from_batches(waiting))

    return stage(rows.mapInArrow(run, _BLOCKS), "blocks")


def vocabulary(cut: DataFrame) -> DataFrame:
    """(word, c): how often each word is in training texts; words of theirs only."""
    each = cut.select(F.explode(F.arrays_zip("words", "seen")).alias("x")).where("x.seen > 0")
    return stage(each.groupBy(F.col("x.words").alias("word")).agg(F.sum("x.seen").alias("c")), "vocabulary")


@dataclass(frozen=True)
class Totals:
    """Of the training texts: their number, and tokens and distinct words of each class."""

    texts: int
    tokens_of: np.ndarray
    words_of: np.ndarray

    @property
    def tokens(self) -> int:
        return int(self.tokens_of.sum()) + self.texts

    @property
    def distinct(self) -> int:
        return int(self.words_of.sum()) + (self.texts > 0)


def totals(cut: DataFrame, vocab: DataFrame) -> Totals:
    """One row a class goes to the driver."""
    trained = F.size(F.filter("held", lambda h: ~h))
    texts = cut.agg(F.coalesce(F.sum(trained), F.lit(0))).first()[0]
    rows = vocab.groupBy((F.crc32(F.col("word").cast("binary")) % CLASSES).alias("class")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    tokens_of, words_of = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in rows:
        tokens_of[r[0]], words_of[r[0]] = r[1], r[2]
    return Totals(texts, tokens_of, words_of)


def first_model(known: Totals, states: int) -> Model:
    """States that tend to stay, and emit classes by their shares, unevenly by chance."""
    rng = np.random.default_rng(SEED)
    share = _shares(known)
    emits = share[:, None] * rng.exponential(size=(len(share), states))
    moves = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full((2, states), 1 / states), moves, emits / emits.sum(axis=0))


def _shares(known: Totals) -> np.ndarray:
    """Smoothed share of each class, and of the end mark, among all tokens."""
    counts = np.append(known.tokens_of, known.texts) + 1.0
    return counts / counts.sum()


def _sequences(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of a block's texts, each with the end mark (-1) behind it, their offsets, and the
    class of each code."""
    offsets = np.array(row["offsets"], dtype=np.int64)
    codes = _unpacked(row["codes"], int(offsets[-1]))
    whole = np.insert(codes, offsets[1:], -1)
    return whole, offsets + np.arange(len(offsets)), np.append(np.frombuffer(row["classes"], "<i4"), CLASSES)


def _stretches(offsets: np.ndarray, keep: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, whether a text begins there) of stretches of the kept texts, longest
    first."""
    starts, lengths = offsets[:-1][keep], np.diff(offsets)[keep]
    pieces = -(-lengths // most)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(starts, pieces) + number * most
    length = np.minimum(most, np.repeat(starts + lengths, pieces) - start)
    order = np.argsort(-length, kind="stable")
    return start[order], length[order], (number == 0)[order]


class Counts:
    """Expected counts of a task."""

    def __init__(self, model: Model):
        self.model = model
        self.emits, self.moves, self.starts = (np.zeros_like(x) for x in (model.emits, model.moves, model.starts))
        self.log10 = 0.0

    def add(self, classes: np.ndarray, start: np.ndarray, length: np.ndarray, opens: np.ndarray) -> None:
        """Forward and backward over stretches, longest first, ``classes`` of all tokens."""
        model, states = self.model, len(self.model.moves)
        # Step by step: rows of step t are those of at[t] : at[t + 1], in the order of stretches.
        active = np.searchsorted(-length, -np.arange(length[0] + 1), side="left")
        active = active[:-1]
        at = np.concatenate([[0], np.cumsum(active)])
        step = np.repeat(np.arange(len(active)), active)
        tokens = start[np.arange(at[-1]) - at[step]] + step
        seen = classes[tokens]
        emitted = model.emits[seen]
        alpha, scale = np.empty((at[-1], states)), np.empty(at[-1])
        now = np.where(opens[:, None], model.starts[0], model.starts[1])
        for t, n in enumerate(active.tolist()):
            here = slice(at[t], at[t + 1])
            now = (now[:n] @ model.moves if t else now) * emitted[here]
            total = now.sum(axis=1)
            now /= total[:, None]
            alpha[here], scale[here] = now, total
        self.log10 += float(np.log10(scale).sum())
        emitted /= scale[:, None]
        crossed = np.zeros((states, states))
        beta = np.ones((active[-1], states))
        for t in range(len(active) - 1, 0, -1):
            after = emitted[at[t] : at[t + 1]] * beta
            crossed += alpha[at[t - 1] : at[t - 1] + active[t]].T @ after
            alpha[at[t] : at[t + 1]] *= beta
            beta = np.ones((active[t - 1], states))
            beta[: active[t]] = after @ model.moves.T
        alpha[: at[1]] *= beta
        self.moves += crossed * model.moves
        self.starts[0] += alpha[: at[1]][opens].sum(axis=0)
        self.starts[1] += alpha[: at[1]][~opens].sum(axis=0)
        for k in range(states):
            self.emits[:, k] += np.bincount(seen, weights=alpha[:, k], minlength=len(self.emits))

    def rows(self) -> np.ndarray:
        """Emissions, moves, starts and the log-likelihood, one below the other."""
        last = np.zeros((1, self.emits.shape[1]))
        last[0, 0] = self.log10
        return np.concatenate([self.emits, self.moves, self.starts, last])


def expected(cut: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts (emits, moves, starts) and log10-likelihood over all training texts.
    Each task sums its own; a row for each class goes to the driver."""
    context, states = cut.sparkSession.sparkContext, len(model.moves)
    shared = context.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, any_rows = Counts(shared.value), False
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                keep = ~np.array(row["held"], dtype=bool)
                if not keep.any():
                    continue
                any_rows = True
                codes, offsets, classes = _sequences(row)
                start, length, opens = _stretches(offsets, keep, STRETCH)
                part = np.cumsum(length) // TOGETHER
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
                classes = classes[codes]
                for a, b in zip(cuts, cuts[1:]):
                    counts.add(classes, start[a:b], length[a:b], opens[a:b])
        if any_rows:
            out = counts.rows()
            columns = [pa.array(np.arange(len(out), dtype=np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in out.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", *names])

    names = [f"s{k}" for k in range(states)]
    parts = cut.select("held", "offsets", "codes", "classes").mapInArrow(run, "cell int, " + ", ".join(f"{n} double" for n in names))
    sums = parts.groupBy("cell").agg(*[F.sum(n).alias(n) for n in names]).orderBy("cell").toArrow()
    shared.unpersist()
    cells = np.zeros((len(model.emits) + states + 3, states))
    if sums.num_rows:
        cells[:] = np.column_stack([sums.column(n).to_numpy() for n in names])
    n = len(model.emits)
    return cells[:n], cells[n : n + states], cells[n + states : -1], float(cells[-1, 0])


def train(cut: DataFrame, known: Totals, states: int = STATES, steps: int = STEPS, trace: list[float] | None = None) -> Model:
    """Baum-Welch from chance. ``trace`` gets the log10-likelihood before each step."""
    prepare_workers(cut.sparkSession, rows=8)
    model, share = first_model(known, states), _shares(known)
    for _ in range(steps if known.texts else 0):
        emits, moves, starts, log10 = expected(cut, model)
        if trace is not None:
            trace.append(log10)
        emits = emits + SMOOTH * share[:, None]
        moves, starts = moves + 1.0, starts + 1.0
        model = Model(starts / starts.sum(axis=1, keepdims=True), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))
    return model


def log10_forward(model: Model, classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 probability of each whole sequence of classes, by the scaled forward recursion."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    start, out = offsets[:-1][order], np.zeros(len(order))
    active = np.searchsorted(-lengths[order], -np.arange(lengths.max() + 1), side="left")[:-1]
    now = np.repeat(model.starts[:1], len(order), axis=0)
    for t, n in enumerate(active.tolist()):
        now = (now[:n] @ model.moves if t else now) * model.emits[classes[start[:n] + t]]
        total = now.sum(axis=1)
        now /= total[:, None]
        out[:n] += np.log10(total)
    result = np.empty(len(order))
    result[order] = out
    return result


def score(cut: DataFrame, vocab: DataFrame, known: Totals, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row."""
    prepare_workers(cut.sparkSession)
    shared = cut.sparkSession.sparkContext.broadcast((model, known))
    words = cut.select(F.col("block").alias("home"), F.posexplode("words").alias("code", "word"))
    counts = words.join(vocab, "word").select("home", "code", "c")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model, known = shared.value
        parts = []
        for i in range(left.num_rows):  # one row: a block
            row = {c: left.column(c)[i].as_py() for c in ("ids", "held", "offsets", "codes", "classes")}
            codes, offsets, classes = _sequences(row)
            c = np.zeros(len(classes), dtype=np.int64)
            c[right.column("code").to_numpy()] = right.column("c").to_numpy()
            c[-1] = known.texts
            base = np.log10((c + 1) / (known.tokens + known.distinct + 1))
            size = np.append(known.tokens_of + known.words_of + 1, known.texts + 1)
            within = np.log10((c + 1) / size[classes])  # the end mark is alone in its class
            at = offsets[:-1]
            sums = [np.add.reduceat(x[codes], at) for x in ((c > 0).astype(np.int64), base, within)]
            score = sums[2] + log10_forward(model, classes[codes], offsets)
            columns = [pa.array(row["ids"], pa.int64()), pa.array(row["held"]), pa.array(np.diff(offsets)), pa.array(sums[0]), pa.array(sums[1]), pa.array(score)]
            parts.append(pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]))
        empty = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        return pa.Table.from_batches(parts, schema=parts[0].schema if parts else empty)

    texts = cut.select("block", "ids", "held", "offsets", "codes", "classes")
    scored = texts.groupBy("block").cogroup(counts.groupBy("home")).applyInArrow(run, schema)
    return scored.withColumn("train_tokens", F.lit(known.tokens).cast("long")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def score_texts(docs: DataFrame, held_out: Column, states: int = STATES, steps: int = STEPS) -> DataFrame:
    """Train on the rows that are not held out, and score all."""
    cut = blocks(docs, held_out)
    vocab = vocabulary(cut)
    known = totals(cut, vocab)
    return score(cut, vocab, known, train(cut, known, states, steps))
