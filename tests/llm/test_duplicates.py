"""SimHash near-duplicates, components and line windows, against brute force."""

import random

import numpy as np
import pytest
import xxhash
from compare import connect, differences
from helpers import ALL_IDS, AWKWARD, awkward, docs, empty, ids

from ridelake.llm import lines, queries, simhash
from ridelake.llm.components import components
from ridelake.session import stage


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def near(fps, distance=3):
    u = np.array(sorted(fps), dtype=np.uint64)
    return [(int(u[i]), int(u[j])) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= distance) if j > i]


def clustered(seed, centres, members, flips):
    r = np.random.default_rng(seed)
    out = set()
    for c in r.integers(0, 1 << 63, centres, dtype=np.uint64):
        for _ in range(members):
            y = int(c)
            for b in r.integers(0, 64, int(r.integers(0, flips + 1))):
                y ^= 1 << int(b)
            out.add(y)
    return out


def signed(x):
    return int(np.uint64(x).view(np.int64))


@pytest.mark.parametrize("crowded", [20_000, 40, 0])
@pytest.mark.parametrize("parts", [3, 4])
def test_links_join_all_fingerprints_within_three_bits(spark, crowded, parts):
    fps = clustered(1, 12, 14, 5)
    classes = stage(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), "fps")
    found = [tuple(np.array(r, dtype=np.int64).view(np.uint64).tolist()) for r in simhash.links(classes, len(fps), 3, crowded, parts).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    assert roots(found, fps) == roots(near(fps), fps)


def test_thresholds_are_the_cheapest_of_their_sum():
    from itertools import product

    r = np.random.default_rng(4)
    costs = [[np.zeros(50)] + [r.integers(0, 100, 50).astype(float) + 50 * e for e in range(3)] for _ in range(4)]
    chosen, cost = simhash.thresholds(costs, 0)
    for i in range(50):
        ways = [t for t in product(range(-1, 3), repeat=4) if sum(t) == 0]
        best = min(sum(costs[p][e + 1][i] for p, e in enumerate(t)) for t in ways)
        assert chosen[i].sum() == 0 and cost[i] == best
        assert sum(costs[p][e + 1][i] for p, e in enumerate(chosen[i].tolist())) == best


def test_correlated_bits_share_a_part():
    r = np.random.default_rng(5)
    x = r.integers(0, 2, (500, 64)).astype(float)
    x[:, 40:48] = x[:, :1]  # nine bits that go together
    groups = simhash.group_bits(x.sum(axis=0), x.T @ x, 500, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({0, *range(40, 48)} <= set(g) for g in groups)


def test_near_duplicates_of_awkward_rows(spark):
    got = simhash.near_duplicates(awkward(spark)).collect()
    assert ids(spark.createDataFrame([(r.doc_id,) for r in got], "doc_id long")) == ALL_IDS
    fps = {r[0]: plain_fingerprint(r[1]) for r in AWKWARD}
    assert {r.doc_id: r.fingerprint for r in got} == {k: f"{v:016x}" for k, v in fps.items()}
    by = {r.doc_id: r.component_id for r in got}
    assert by[1] == by[2] == by[3] == 1 and by[5] == by[6] == 5 and by[8] == 8 and by[None] is None
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_keep_one_keeps_the_first_of_each_group_and_its_columns(spark):
    rows = awkward(spark)
    kept = simhash.keep_one(rows)
    assert kept.columns == rows.columns
    assert ids(kept) == [1, 4, 5, 7, 8, 9, 10, None]
    assert simhash.keep_one(empty(spark)).count() == 0


def test_many_copies_of_one_text(spark):
    rows = docs(spark, {i: "same words here again" if i % 3 else f"other text number {i} of {i * 7}" for i in range(300)})
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows).collect()}
    assert all(got[i] == 1 for i in range(300) if i % 3)


def test_components_against_union_find(spark):
    r = random.Random(6)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, k) for k in range(501, 560)]
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    got = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {n: c for n, c in got} == roots([p for p in pairs if p[0] != p[1]], nodes)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- lines -----------------------------------------------------------------------------------------


def plain_lines(rows):
    """The texts left, for unique ids in ascending order."""
    first, gone = {}, {}
    for doc, text in sorted(rows.items()):
        own = (text or "").split("\n")
        for at in range(len(own) - 2):
            key = tuple(own[at : at + 3])
            if key in first:
                at_first = first[key][1] if first[key][0] == doc else -9
                gone.setdefault(doc, set()).update(range(max(at, at_first + 3), at + 3))
            else:
                first[key] = (doc, at)
    return {d: t if d not in gone else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in rows.items()}


def test_lines_against_brute_force(spark):
    r = random.Random(7)
    rows = {i: "\n".join(r.choice("abcd") for _ in range(r.randrange(12))) for i in range(60)} | {99: None, 98: "a\na\na\na\na\na\na"}
    got = lines.remove_repeated_lines(docs(spark, rows))
    assert {x.doc_id: x.text for x in got.collect()} == plain_lines(rows)
    assert all(x.n_chars == len(x.text or "") for x in got.collect())


def test_lines_of_awkward_rows(spark):
    rows = awkward(spark)
    got = lines.remove_repeated_lines(rows)
    assert got.columns == rows.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, rows.collect()))
    assert lines.remove_repeated_lines(empty(spark)).count() == 0
    passage = "\n".join(["first line", "second line", "third line", "fourth line"])
    three = docs(spark, {1: passage, 2: f"own\n{passage}\nend"}).unionByName(docs(spark, {2: f"own\n{passage}\nend"}))
    assert sorted(x.text for x in lines.remove_repeated_lines(three).collect()) == [passage, "own\nend", "own\nend"]


def test_line_query_equals_its_sql(spark, sf_dir):
    assert differences(queries.QUERIES["op3_lines"](spark, sf_dir), connect(sf_dir), queries.SQL["op3_lines"]) == []
