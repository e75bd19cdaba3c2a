"""Trie of conversation prefixes, built by van Emde Boas recursion.

A node is a distinct sequence of first turns. The trie of sequences of up to 2^k turns is
cut at half depth: the first halves make an upper trie, and every distinct full first half
is a cut prefix with a name, under which the second halves that follow it make a lower trie. Upper and
lower tries are half as high and of one kind, so one table holds all of them, grouped to
distinct pieces with the number of conversations behind each, and one Spark job cuts all
pieces of a height at once; after k cuts a piece is one turn, that is, a node.

Totals of subtrees are grafted upward through the same heights: a node knows the total of
its subtree down to the next cut; the totals of the lower tries' first nodes are summed for
the cut prefix they hang from, and added to all nodes between it and the cut above. Each node
meets each height once, so all of it takes as many rows as nodes times heights.

A name is 128 bits of SHA-256 of the name before the piece and of the piece, so the same
prefix has the same name wherever it is worked out.

Groups are summed in each task before they are shuffled; a prefix that a third of all
conversations share is one piece. A conversation, with some 40 bytes a turn, is the largest
thing one task holds.

Defined cases: rows with a null ``conv_id`` take no part; turns are ordered by ``turn``, null
first, and ties by a hash of role and text; repeated rows are turns of their own; null role
and text are empty; a conversation without turns after rebuilding is a member of the root;
an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import map_batches, prepare_workers
from ridelake.session import stage

# Hex digits of a name, and conversation ids that are put together before the last hash.
NAME, CHUNK = 32, 4096
ROOT = ""
WORD = r"[^\x20\x09-\x0D]+"
VALUES = ["n_leaves", "saved_tokens"]


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): each conversation as an array of turns; a turn is the name of its role
    and text, followed by its number of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    name = F.substring(F.sha2(content.cast("binary"), 256), 1, NAME)
    element = F.concat(name, F.regexp_count(text, F.lit(WORD)).cast("string"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", element.alias("t")).alias("x"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x"))["t"].alias("seq"))


def rebuilt(convs: DataFrame, donor: Column, heads: Column, most: int) -> DataFrame:
    """Conversations whose first ``heads`` (up to ``most``) turns are replaced by those of the
    conversation ``donor``."""
    first = convs.select(F.col("conv_id").alias("_donor"), F.slice("seq", 1, most).alias("_head"))
    joined = convs.withColumns({"_donor": donor, "_h": heads.cast("int")}).join(first, "_donor", "left")
    head = F.slice(F.coalesce("_head", F.array().cast("array<string>")), F.lit(1), F.col("_h"))
    return joined.select("conv_id", F.concat(head, F.slice("seq", F.col("_h") + 1, F.size("seq"))).alias("seq"))


def name_of(root: str, seq: list[str]) -> str:
    return hashlib.sha256(f"{root}:{','.join(seq)}".encode()).hexdigest()[:NAME]


def _name(root: str | Column, seq: str | Column) -> Column:
    """``name_of`` as a column."""
    return F.substring(F.sha2(F.concat(root, F.lit(":"), F.array_join(seq, ",")).cast("binary"), 256), 1, NAME)


def names(root: str, seq: list[str]) -> list[str]:
    """Names of all prefixes of a piece behind ``root``: each follows from the cut before it,
    which lies as many turns up as the lowest bit of its length says."""
    out = [root]
    for j in range(1, len(seq) + 1):
        low = j & -j
        out.append(name_of(out[j - low], seq[j - low : j]))
    return out[1:]


def end_name(seq: list[str]) -> str:
    """Name of the whole sequence: its cuts are the bits of its length, highest first."""
    root, at = ROOT, 0
    while at < len(seq):
        step = 1 << ((len(seq) - at).bit_length() - 1)
        root, at = name_of(root, seq[at : at + step]), at + step
    return root


def _cut(pieces: DataFrame, half: int) -> DataFrame:
    """Pieces of up to twice ``half`` turns as distinct pieces of up to ``half``.

    root: name of the prefix a piece follows; base: its depth; tail: name of the prefix that
    a full piece ends with; n, conv: conversations that hold the piece, and their least id.
    """
    upper = F.slice("seq", 1, half)
    named = pieces.withColumn("cut", F.when(F.size("seq") >= half, _name("root", upper)))
    above = F.struct("root", upper.alias("seq"), F.col("cut").alias("tail"), "base")
    lower = F.slice("seq", F.lit(half + 1), F.greatest(F.size("seq") - half, F.lit(0)))
    below = F.struct(F.col("cut").alias("root"), lower.alias("seq"), "tail", (F.col("base") + half).alias("base"))
    parts = F.when(F.size("seq") > half, F.array(above, below)).otherwise(F.array(above))
    return _distinct(named.select("n", "conv", F.explode(parts).alias("p")).select("n", "conv", "p.*"))


def _distinct(pieces: DataFrame) -> DataFrame:
    sums = [F.sum("n").alias("n"), F.min("conv").alias("conv")]
    return pieces.groupBy("root", "seq", "tail", "base").agg(*sums)


def levels(convs: DataFrame) -> list[DataFrame]:
    """Tables of distinct pieces: the k-th holds those of up to 2^k turns."""
    whole = convs.where(F.size("seq") > 0)
    longest = whole.agg(F.max(F.size("seq"))).first()[0] or 1
    height = (longest - 1).bit_length()
    tail = F.when(F.size("seq") == 1 << height, _name(F.lit(ROOT), "seq"))
    pieces = whole.select(F.lit(ROOT).alias("root"), "seq", tail.alias("tail"), F.lit(0).cast("long").alias("base"), F.lit(1).cast("long").alias("n"), F.col("conv_id").alias("conv"))
    tables = [stage(_distinct(pieces), f"pieces-{height}")]
    for k in reversed(range(height)):
        tables.append(stage(_cut(tables[-1], 1 << k), f"pieces-{k}"))
    return tables[::-1]


def _spread(spines: DataFrame) -> DataFrame:
    """(node, values): the values of a piece's end, for each of its prefixes."""
    schema = "node string, n_leaves long, saved_tokens long"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.to_pylist()
        out = [(name, r["n_leaves"], r["saved_tokens"]) for r in rows for name in names(r["root"], r["seq"])]
        types = [("node", pa.string()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, (_, t) in enumerate(types)], names=[n for n, _ in types])

    return map_batches(spines.select("root", "seq", *VALUES), run, schema)


def _sums(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in VALUES])


def _grafted(nodes: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``nodes`` (node, parent, depth, their own values) with the totals of their subtrees."""
    for k, pieces in enumerate(tables[:-1]):
        half = 1 << k
        below = nodes.where(F.pmod(F.col("depth") - 1, F.lit(2 * half)) == half)
        spines = pieces.where((F.size("seq") == half) & (F.pmod("base", F.lit(2 * half)) == 0))
        hung = spines.join(_sums(below, "parent").withColumnRenamed("parent", "tail"), "tail")
        more = _sums(_spread(hung), "node").select("node", *[F.col(c).alias(f"_{c}") for c in VALUES])
        added = [(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in VALUES]
        nodes = stage(nodes.join(more, "node", "left").select("node", "parent", "depth", *added), f"grafted-{k}")
    return nodes


def ends(convs: DataFrame) -> DataFrame:
    """(node, ends_sha256): the hash of the ids of the conversations that end at a node.

    Ids are put together in chunks by their range, and a node's chunks, in order, run
    through one hash state; so a node where many end needs no room for all of them.
    """

    def end(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([end_name(seq) for seq in batch.column("seq").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([batch.column("conv_id"), found], names=["conv_id", "node"])

    at = map_batches(convs, end, "conv_id long, node string")
    chunk = F.floor(F.col("conv_id") / CHUNK).alias("chunk")
    text = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    chunks = at.groupBy("node", chunk).agg(text.alias("ids"))
    prepare_workers(convs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if name != node:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield _hashes(done)
        if state:
            yield _hashes([(node, state.hexdigest())])

    in_order = chunks.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids")
    return in_order.mapInArrow(hashed, "node string, ends_sha256 string")


def _hashes(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["node", "ends_sha256"])


def trie(convs: DataFrame) -> DataFrame:
    """One row for each node of ``convs`` (conv_id, seq): its least member and depth, its
    parent's least member, members, children, leaves below it, the words its subtree saves
    when shared prefixes are kept once, and the hash of the members that end there."""
    convs = stage(convs, "conversations")
    tables = levels(convs)
    words = F.substring(F.element_at("seq", 1), F.lit(NAME + 1), F.lit(20)).cast("long")
    nodes = tables[0].select(F.col("tail").alias("node"), F.col("root").alias("parent"), (F.col("base") + 1).alias("depth"), "n", "conv", ((F.col("n") - 1) * words).alias("saved_tokens"))
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stage(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "nodes")
    totals = _grafted(nodes.select("node", "parent", "depth", *VALUES), tables)

    # The root, from one row of its own and one of its children's sums.
    first = totals.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), *[F.sum(c).alias(c) for c in VALUES])
    members = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
    merged = members.unionByName(first, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("n", "conv", "n_children", *VALUES)])
    top = merged.where("n > 0").select(
        F.lit(ROOT).alias("node"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("long").alias("depth"),
        "n",
        "conv",
        "n_children",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),  # a childless root is a leaf
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
    )
    rest = nodes.drop(*VALUES).join(totals.select("node", *VALUES), "node").select(*top.columns)
    every = stage(top.unionByName(rest), "trie")
    parents = every.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        every.join(parents, "parent", "left")
        .join(ends(convs), "node", "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            F.col("n").alias("n_convs"),
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
