"""Hard negatives and the trie of conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import CLASHING
from pyspark.sql import functions as F

from ridelake.llm import hard_negatives as hn
from ridelake.llm import prefix_trie as pt
from ridelake.llm.queries import QUERIES, op13_prefix_trie

VECTORS = "vec_id long, embedding array<double>, label int" + "".join(f", {c} string" for c in CLASHING)


@pytest.mark.parametrize("m,k,n", [(1, 1, 1), (5, 3, 7), (17, 33, 18), (64, 64, 64), (70, 37, 101), (0, 5, 3), (3, 0, 4)])
def test_strassen_is_the_plain_product(m, k, n):
    r = np.random.default_rng(m + k + n)
    a, b = r.integers(-(1 << 28), 1 << 28, (m, k)), r.integers(-(1 << 28), 1 << 28, (k, n))
    assert (hn.strassen(a, b, 4) == a @ b).all() and hn.strassen(a, b, 4).shape == (m, n)


def test_best_with_ties_and_gaps():
    scores = np.array([[5, 5, 1, 5, -3], [2, 9, 9, 0, 4]])
    allowed = np.array([[True, False, True, True, True], [False] * 4 + [True]])
    row, column = hn.best(scores, allowed, 3)
    assert list(zip(row.tolist(), column.tolist())) == [(0, 0), (0, 3), (0, 2), (1, 4)]


def mined(rows, every=50, positives=5, negatives=3):
    """Brute force over (id, vector, label)."""
    fine = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) or abs(x) * 256 >= 2.0**63 for x in v):
            continue
        row = (i, [int(np.floor(256 * x)) for x in v], label)
        if row not in fine:
            fine.append(row)
    out = []
    for a, va, la in fine:
        if a % every:
            continue
        near = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in fine if i != a and len(v) == len(va))
        for s, p, _ in [x for x in near if x[2] == la][:positives]:
            fit = [(t, i) for t, i, label in near if label != la and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], VECTORS)


def _mined(spark, rows):
    found = hn.hard_negatives(hn.quantised(_vectors(spark, rows)), F.col("vec_id") % 50 == 0)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.select(*columns).collect())


def test_hard_negatives_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hn, "TILE", 64)
    monkeypatch.setattr(hn, "ANCHORS", 4)
    r = np.random.default_rng(5)
    centres = r.normal(size=(3, 9))
    rows = [(i, (centres[i % 3] + r.normal(scale=0.8, size=9)).tolist(), int(r.integers(0, 3))) for i in range(600)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(150)]  # copies
    assert _mined(spark, rows) == mined(rows) != []


def test_hard_negatives_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 2), (1, [1.0, 0.0], 1), (2, [0.75, 0.0], 2), (3, [0.75, 1.0], 2)]
    rows += [(4, None, 1), (5, [1.0, None], 2), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [1.0, 0.0], None), (None, [1.0, 0.0], 2)]
    rows += [(9, [], 1), (50, [], 1), (51, [], 2), (10, [1e300, 0.0], 2), (100, [0.0, 0.0], 1), (12, [1.0], 1), (150, [2.0], 1), (13, [1.0], 3)]
    assert _mined(spark, rows) == mined(rows) != []
    assert _mined(spark, []) == []


TURNS = "conv_id long, turn long, role string, text string" + "".join(f", {c} string" for c in CLASHING)


def trie_of(convs: dict) -> list:
    """Brute force over {conv_id: [(role, text)]}, already rebuilt."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for prefix, held in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].split()) for p in below if p)
        ended = ",".join(map(str, sorted(c for c in held if len(convs[c]) == len(prefix))))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(held), len(prefix), parent, len(held), len(children), len(leaves), saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def by_contract(rows) -> dict:
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def _tried(spark, rows, tmp_path):
    path = str(tmp_path / "sf")
    spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], TURNS).write.parquet(f"{path}/conversations.parquet")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in op13_prefix_trie(spark, path).select(*columns).collect()), key=lambda x: (x[1], x[0]))


def test_trie_against_brute_force(spark, tmp_path):
    r = random.Random(3)
    rows = []
    for c in range(90):
        n = r.choice([1, 2, 3, 4, 5, 8, 21])
        rows += [(c, t, "user" if t % 2 else "bot", r.choice(["a", "a b", "c  d\te", "a"]) if t < 6 or r.random() < 0.1 else "so on") for t in range(n)]
    rows += [(200 + c, t, "user", "the same") for c in range(40) for t in range(3)]
    assert _tried(spark, rows, tmp_path) == trie_of(by_contract(rows))


def test_trie_of_odd_turns(spark, tmp_path):
    rows = [(1, None, None, None), (1, 0, "u", "x y"), (2, 0, "u", None), (3, 0, "", ""), (5, 7, "u", "long " * 5000), (20, 0, "u", "x")]
    rows += [(None, 0, "u", "x"), (4, 1, "u:", "x"), (6, 1, "u", ":x"), (7, 2, "u", "x\x0by"), (7, 3, "ü", "\xa0")]
    assert _tried(spark, rows, tmp_path) == trie_of(by_contract(rows))


def test_trie_without_conversations(spark, tmp_path):
    assert _tried(spark, [], tmp_path) == []
    assert _tried(spark, [(None, 1, "u", "x")], tmp_path / "null") == []


def test_repeated_rows_are_turns(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a")]
    turns = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], TURNS)
    got = pt.trie(pt.conversations(turns)).collect()
    assert sorted((r.depth, r.n_convs, r.n_leaves) for r in got) == [(0, 2, 1), (1, 2, 1), (2, 1, 1)]


def test_names_agree_with_the_recursion(spark):
    seq = [f"{'0' * pt.NAME}{i}" for i in range(23)]
    every = pt.names(pt.ROOT, seq)
    assert len(set(every)) == 23 and pt.end_name(seq) == every[-1]
    assert [pt.end_name(seq[:n]) for n in range(1, 24)] == every
    convs = spark.createDataFrame([(1, seq), (2, seq[:9]), (3, [])], "conv_id long, seq array<string>")
    nodes = {r.tail: (r.root, r.base, r.n) for r in pt.levels(convs)[0].collect()}
    assert list(nodes) and set(nodes) == set(every)
    assert all(nodes[every[i]] == (every[i - 1] if i else pt.ROOT, i, 2 if i < 9 else 1) for i in range(23))


def test_ids_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 4)
    ids = list(range(-9, 30))
    convs = spark.createDataFrame([(i, ["0" * pt.NAME + "1"] * (i % 2)) for i in ids], "conv_id long, seq array<string>")
    want = {d: hashlib.sha256(",".join(str(i) for i in ids if i % 2 == d).encode()).hexdigest() for d in (0, 1)}
    assert {r.depth: r.ends_sha256 for r in pt.trie(convs).collect()} == want


def test_registered():
    assert {"op11_hidden_markov", "op12_hard_negatives", "op13_prefix_trie"} <= set(QUERIES)
