"""The hidden Markov model against plain recursions."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import awkward, docs, empty
from pyspark.sql import functions as F

from ridelake.llm import hmm
from ridelake.llm.common import in_fold


def fold():
    return in_fold(F.col("doc_id"), 7, 2)


def held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text) -> list:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w] + [None]


def base_scores(rows) -> list:
    train = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(train.values()), len(train)
    out = []
    for i, text in rows:
        ts = tokens(text)
        base = sum(math.log10((train[t] + 1) / (n + 1 * (v + 1))) for t in ts)
        out.append((i, held(i), len(ts), sum(train[t] > 0 for t in ts), n, round(base, 6)))
    return out


def by_id(rows) -> list:
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))


def small_model(states: int, seed: int = 0) -> hmm.Model:
    r = np.random.default_rng(seed)
    starts, moves = r.random((2, states)), r.random((states, states))
    emits = r.random((hmm.CLASSES + 1, states))
    return hmm.Model(starts / starts.sum(axis=1, keepdims=True), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def paths(model, classes, opens=True):
    """Every path of states with its probability."""
    first = model.starts[0 if opens else 1]
    for path in itertools.product(range(len(model.moves)), repeat=len(classes)):
        p = first[path[0]]
        for t, (k, c) in enumerate(zip(path, classes)):
            p *= model.emits[c, k] * (model.moves[path[t - 1], k] if t else 1)
        yield path, p


def test_forward_is_the_sum_over_all_paths():
    model, r = small_model(3), np.random.default_rng(1)
    texts = [r.integers(0, 50, n).tolist() for n in (1, 4, 2, 6)]
    offsets = np.cumsum([0, *map(len, texts)])
    got = hmm.log10_forward(model, np.concatenate(texts), offsets)
    assert np.allclose(got, [math.log10(sum(p for _, p in paths(model, t))) for t in texts])


def test_expected_counts_are_those_of_all_paths():
    model, r = small_model(2, 3), np.random.default_rng(2)
    texts = [r.integers(0, 9, n).tolist() for n in (5, 1, 3, 7)]
    offsets = np.cumsum([0, *map(len, texts)])
    start, length, opens = hmm._stretches(offsets, np.array([True, True, False, True]), 4)
    counts = hmm.Counts(model)
    counts.add(np.concatenate(texts), start, length, opens)
    emits, moves, starts, log10 = np.zeros_like(model.emits), np.zeros((2, 2)), np.zeros((2, 2)), 0.0
    pieces = [(texts[0][:4], True), (texts[0][4:], False), (texts[1], True), (texts[3][:4], True), (texts[3][4:], False)]
    for piece, is_first in pieces:
        every = list(paths(model, piece, is_first))
        total = sum(p for _, p in every)
        log10 += math.log10(total)
        for path, p in every:
            starts[0 if is_first else 1, path[0]] += p / total
            for t, k in enumerate(path):
                emits[piece[t], k] += p / total
                if t:
                    moves[path[t - 1], k] += p / total
    assert np.allclose(counts.emits, emits) and np.allclose(counts.moves, moves)
    assert np.allclose(counts.starts, starts) and math.isclose(counts.log10, log10)


def test_base_scores_and_fixed_columns(spark):
    rows = [(i, f"The {'cat' if i % 3 else 'dog'} SAT\x0bon mat{i % 5}\n\xa0x " * (1 + i % 4)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "İ Ünseen ÄÖ"), (7, "cat"), (7, "cat")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = hmm.score_texts(table, fold(), states=3, steps=2).collect()
    fixed = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert by_id(fixed) == by_id(base_scores(rows))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_whole_score_by_a_plain_recursion(spark):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 11}" for j in range(3 + i % 5))) for i in range(30)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    cut = hmm.blocks(table, fold())
    vocab = hmm.vocabulary(cut)
    known = hmm.totals(cut, vocab)
    model = hmm.train(cut, known, 2, 3)
    got = {r.doc_id: r.score for r in hmm.score(cut, vocab, known, model).collect()}
    train = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    size = Counter()
    for w, c in train.items():
        if w is not None:
            size[zlib.crc32(w.encode()) % hmm.CLASSES] += c + 1
    for i, text in rows:
        alpha, log = model.starts[0], 0.0
        for t, w in enumerate(tokens(text)):
            c = hmm.CLASSES if w is None else zlib.crc32(w.encode()) % hmm.CLASSES
            alpha = (alpha @ model.moves if t else alpha) * model.emits[c]
            log += math.log10(alpha.sum()) + (0 if w is None else math.log10((train[w] + 1) / (size[c] + 1)))
            alpha = alpha / alpha.sum()
        assert math.isclose(got[i], log, rel_tol=1e-9)


def test_training_raises_the_likelihood_and_tells_two_languages(spark):
    r = np.random.default_rng(4)
    words = {0: [f"de{i}" for i in range(40)], 1: [f"en{i}" for i in range(40)]}
    texts = {i: " ".join(r.choice(words[i % 2], 30)) for i in range(400)}
    cut = hmm.blocks(docs(spark, texts), fold())
    vocab = hmm.vocabulary(cut)
    known = hmm.totals(cut, vocab)
    trace: list[float] = []
    model = hmm.train(cut, known, 2, 12, trace)
    assert all(b > a for a, b in zip(trace[1:], trace[2:]))
    got = [x for x in hmm.score(cut, vocab, known, model).collect() if x.held_out]
    assert got and all(x.score > x.base_score + 2 for x in got)


def test_defined_cases(spark):
    got = hmm.score_texts(awkward(spark), fold(), states=2, steps=1).collect()
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    assert by_id([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got]) == by_id([(*x[:5], round(x[5], 5)) for x in base_scores(rows)])
    assert hmm.score_texts(empty(spark), fold()).collect() == []
    alone = next(i for i in range(100) if held(i))
    only = hmm.score_texts(docs(spark, {alone: "no training text"}), fold()).collect()
    assert [(x.n_tokens, x.n_known, x.train_tokens, x.base_score) for x in only] == [(4, 0, 0, 0.0)]


def test_codes_round_trip():
    codes = np.array([0, 5, 1 << 20, 7, 300], dtype=np.int32)
    assert (hmm._unpacked(hmm._packed(codes), 5) == codes).all()
    assert len(hmm._unpacked(hmm._packed(codes[:0]), 0)) == 0


def test_blocks_hold_words_once():
    table = pa.table({"doc_id": [1, None], "text": ["b a b", None], "held": [False, True]})
    block = hmm._block(3, table).to_pylist()[0]
    assert block["words"] == ["b", "a"] and block["seen"] == [2, 1] and block["offsets"] == [0, 3, 3]
