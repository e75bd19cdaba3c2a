"""Encoding by tree concatenation, and token files, against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import ALL_IDS, AWKWARD, awkward, docs, empty, ids
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ridelake.llm import bpe, token_files
from ridelake.llm.bpe import digests
from ridelake.llm.common import slices

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(bpe.read_spec(PATH))


def reference(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


PARTS = ["a", "the", " ", "  ", "\n", " \n ", "'s", "don't", "<|endoftext|>", "é", "日本", "😀", "123", "!!", "\xa0", "\t", "Anti", "\n\n", "end.\nNew", "\nx.", ".", ",", "x,", "end.", "\x1c", " ", "᠎ "]
texts = st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_words_of_the_table_give_what_the_library_gives(text):
    flat, offsets = ENCODER.encode(pa.array(["x y", text, None, text]))
    for i, t in enumerate(["x y", text, "", text]):
        assert flat[offsets[i] : offsets[i + 1]].tolist() == reference(t)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 40))
def test_joined_halves_give_what_the_library_gives(text, most):
    pieces = bpe.halves(text, most)
    assert "".join(pieces) == text
    coded = [(p.encode(), x) for p, x in zip(pieces, ENCODER.whole(pieces))]
    assert bpe.join_tree(ENCODER, coded).tolist() == reference(text)


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghij", "the "])
def test_long_unsplit_runs(alphabet):
    r = random.Random(alphabet)
    text = "".join(r.choice(alphabet) for _ in range(5000))
    pieces = bpe.halves(text, 700)
    coded = [(p.encode(), x) for p, x in zip(pieces, ENCODER.whole(pieces))]
    assert bpe.join_tree(ENCODER, coded).tolist() == reference(text)


def test_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_WORDS", 50)
    enc = bpe.Encoder(bpe.read_spec(PATH))
    for k in range(6):
        text = " ".join(f"w{k}x{i} common" for i in range(60))
        flat, _ = enc.encode(pa.array([text]))
        assert flat.tolist() == reference(text)
        assert len(enc.rows) <= 50 // 2 + 62


def test_encode_and_decode_awkward_rows(spark):
    got = bpe.encode(awkward(spark), PATH, piece_chars=3000, decoded=True).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=key) == sorted(((r[0], reference(r[1]), r[1] or "") for r in AWKWARD), key=key)
    back = bpe.decode(bpe.encode(awkward(spark), PATH), PATH)
    assert {(r.doc_id, r.decoded) for r in back.collect()} == {(r[0], r[1] or "") for r in AWKWARD}
    assert bpe.digests(empty(spark), PATH).collect() == []


def test_token_files_hold_all_ids_in_order(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(awkward(spark), PATH, path)
    tokens = token_files.read_tokens(spark, path)
    got = token_files.token_digests(tokens).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] + [i for i in ALL_IDS if i is not None]
    start = 0
    texts = {r[0]: r[1] for r in AWKWARD}
    for r in got:
        own = np.array([*reference(texts[r.doc_id]), token_files.END_ID], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)


def test_token_files_of_an_empty_table(spark, tmp_path):
    token_files.write_tokens(empty(spark), PATH, str(tmp_path / "none"))
    assert token_files.token_digests(token_files.read_tokens(spark, str(tmp_path / "none"))).collect() == []


def test_a_frequent_doc_id_is_spread_and_lookups_push_the_id_down(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = docs(spark, {7: "one two"}).crossJoin(spark.range(500).select())
    token_files.write_tokens(rows, PATH, path)
    tokens = token_files.read_tokens(spark, path)
    assert tokens.count() == 500 and ids(tokens) == [7] * 500
    plan = tokens.where("doc_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan


def test_slices_hold_all_rows_in_order_and_little_text():
    texts = ["", None, "ab", "c" * 50, "d", "é" * 3, "", "e" * 8, "f" * 9]
    batch = pa.RecordBatch.from_pydict({"no": list(range(9)), "text": pa.array(texts, pa.string())})
    found = list(slices(batch.slice(1), 10))
    assert [n for part in found for n in part.column("no").to_pylist()] == list(range(1, 9))
    sizes = [[len((t or "").encode()) for t in part.column("text").to_pylist()] for part in found]
    assert all(sum(s) <= 10 or len(s) == 1 for s in sizes) and len(found) == 5
    assert list(slices(batch.slice(0, 0), 10)) == []


def test_results_do_not_depend_on_slices(spark, monkeypatch):
    rows = [(i, ("word " * (i % 7) + f"x{i}\n") * (1 + i % 5)) for i in range(60)] + [(60, None), (61, ""), (62, "long " * 9000)]
    given_docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(digests(given_docs, PATH).collect())
    monkeypatch.setattr(bpe, "SLICE", 40)
    assert sorted(digests(given_docs, PATH).collect()) == whole and len(whole) == 63
