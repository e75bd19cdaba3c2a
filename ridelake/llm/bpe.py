"""Byte-pair encoding and decoding of whole texts, by tree concatenation.

A text is encoded as the tokenizers library encodes it in one call. Texts of more than
``piece_chars`` are cut into halves, and those again, until every piece is short; pieces
are encoded in parallel, and neighbours are joined up a tree: a window around the join is
encoded anew and grows until both sides agree with it, at places where agreement settles
everything beyond:

* at a blank behind a visible ASCII character, where the tokenizer's word pattern always
  ends a word, whatever surrounds it; or
* within a long run of ASCII letters, at tokens that the window and the side share: a
  row of tokens is the encoding of such a run when each two neighbours are.

A window that has reached both ends is the whole encoding itself, so a join always ends.

Within a piece, words are cut at blanks of the first kind, and at line ends behind visible
characters, and looked up in a bounded table of words the library has encoded before.

Defined cases: a null text counts as empty; an empty text has no ids; repeated rows come
out as often as they come in; a null ``doc_id`` stays null; other columns are ignored; the
special token's literal text becomes its id, as in the library.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import held, id_and_text, map_batches

PIECE_CHARS = 32768
# Words a worker remembers; when there are more, the half it met most often stays.
TABLE_WORDS = 600_000
# Words the library is given in one string, and strings in one call.
TOGETHER, AT_ONCE = 64, 512
# Bytes of texts whose words are looked up together.
SLICE = 2 << 20
# Lists of ids that are decoded in one call: as Python numbers they take ten times the room.
DECODED = 64
# Letters on both sides of a place within a run, and tokens that have to agree there.
RUN, AGREE = 64, 4
WINDOW = 32

# White space of any notion; a blank behind one of these needs its neighbours.
WHITE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u180e" + "".join(map(chr, range(0x2000, 0x200C))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
_STOPS = (".", ",")
# Texts in which a blank has white space beside it, and texts with white space before a
# line end: there a cut needs a closer look.
_NOT_CUT = f"[{WHITE}] | \n"
_NOT_CUT_AT_LINES = f"[{WHITE}]\n"
_CUT = re.compile(f"(?<=[^{WHITE}])(?= )")


class Encoder:
    """The library's tokenizer with a bounded table of words."""

    def __init__(self, spec: str, table_words: int | None = None):
        self.table_words = table_words or TABLE_WORDS
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._lengths: np.ndarray | None = None
        self.stops = {c: int(self.whole([c])[0][0]) for c in _STOPS}
        self._start_table({}, np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32))

    def _start_table(self, rows, starts, sizes, ids, seen) -> None:
        # Word -> row; a row's ids are ids[starts[row] :][: sizes[row]]; seen: how often met.
        # The arrays have room for more than the ``used`` ids and the rows there are.
        self.rows, self.starts, self.sizes, self.ids, self.seen, self.used = rows, starts, sizes, ids, seen, len(ids)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, straight from the library, some texts at a time: what it returns
        takes many times the room of the ids."""
        out: list[np.ndarray] = []
        for i in range(0, len(texts), AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False)
            out += [np.array(e.ids, dtype=np.int32) for e in found]
        return out

    def _add(self, words: list[str]) -> None:
        """Encode words that follow a blank, or begin with a line end, and remember them. A full stop or comma behind
        a letter is a word of its own for the tokenizer: there the word before it counts."""
        stopped = [w for w in words if w[-1:] in _STOPS and w[-2:-1].isalpha()]
        rest = [w for w in words if not (w[-1:] in _STOPS and w[-2:-1].isalpha())]
        before = {w[:-1] for w in stopped}.difference(self.rows, rest)
        self._encode_words([*rest, *before])
        if stopped:
            row = np.array([self.rows[w[:-1]] for w in stopped], dtype=np.int64)
            starts, sizes = self.starts[row].astype(np.int64), self.sizes[row] + 1
            ends = np.cumsum(sizes)
            at = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])
            ids = self.ids[np.minimum(at, self.used - 1)]
            ids[ends - 1] = [self.stops[w[-1]] for w in stopped]
            self._remember(stopped, sizes, ids)

    def _encode_words(self, words: list[str]) -> None:
        """Give the library many words in one string, cut the ids by their lengths."""
        alone = [w for w in words if not w or w[-1] in WHITE]
        joined = [w for w in words if w and w[-1] not in WHITE]
        parts = [joined[i : i + TOGETHER] for i in range(0, len(joined), TOGETHER)]
        found = self.whole(["".join(w if w[0] == "\n" else " " + w for w in p) for p in parts])
        ids = np.concatenate([np.zeros(0, np.int32), *found])
        ends = np.cumsum([len(w.encode()) + (w[0] != "\n") for w in joined])
        after = np.searchsorted(np.cumsum(self.lengths()[ids]), ends) + 1 if joined else np.zeros(0, np.int64)
        sizes = np.diff(after, prepend=0)
        single = self.whole([w if w[:1] == "\n" else " " + w for w in alone])
        sizes = np.concatenate([sizes, np.array([len(x) for x in single], dtype=np.int64)])
        self._remember(joined + alone, sizes, np.concatenate([ids, *single]))

    def _remember(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, m, used = len(self.rows), len(self.rows) + len(words), self.used + len(ids)
        self.rows.update(zip(words, range(n, m)))
        self.starts, self.sizes, self.seen = (_room(x, m) for x in (self.starts, self.sizes, self.seen))
        self.ids = _room(self.ids, used)
        self.starts[n:m] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n:m] = sizes
        self.seen[n:m] = 0
        self.ids[self.used : used] = ids
        self.used = used

    def _shrink(self) -> None:
        """Keep the half of the words that were met most often."""
        n = len(self.rows)
        keep = np.zeros(n, dtype=bool)
        half = self.table_words // 2
        keep[np.argpartition(-self.seen[:n], half)[:half]] = True
        words = [w for w, k in zip(self.rows, keep.tolist()) if k]  # in the order of rows
        sizes = self.sizes[:n][keep]
        ids = self.ids[: self.used][np.repeat(keep, self.sizes[:n])]
        self._start_table(dict(zip(words, range(len(words)))), (np.cumsum(sizes) - sizes).astype(np.int32), sizes, ids, self.seen[:n][keep] // 2)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and where each text's begin (and the last's end)."""
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _NOT_CUT).to_numpy(zero_copy_only=False)
        even = pc.if_else(pa.array(odd), "", texts)
        # A line end behind something visible ends a word as a blank does, but belongs to no
        # word: a mark in front of it makes a word of what follows, known by the line end.
        whole_lines = pc.match_substring_regex(even, _NOT_CUT_AT_LINES)
        even = pc.if_else(whole_lines, even, pc.replace_substring(even, "\n", " \n"))
        lists = pc.split_pattern(even, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.dictionary_encode()
        codes = words.indices.to_numpy()
        first = np.zeros(len(codes), dtype=bool)
        first[offsets[:-1]] = True
        needed = np.zeros(len(words.dictionary), dtype=bool)
        needed[codes[~first]] = True
        distinct = words.dictionary.filter(pa.array(needed)).to_numpy(zero_copy_only=False).tolist()
        if len(self.rows) > self.table_words:
            self._shrink()
        rows = list(map(self.rows.get, distinct))
        missing = [i for i, row in enumerate(rows) if row is None]
        if missing:
            self._add([distinct[i] for i in missing])
            for i in missing:
                rows[i] = self.rows[distinct[i]]
        row_of = np.zeros(len(needed), dtype=np.int64)
        row_of[needed] = rows
        row = row_of[codes]
        if not self.rows:
            self._add([""])  # so that every row can be looked up
        self.seen[np.array(rows, dtype=np.int64)] += 1
        # The first word of a text follows no blank: its ids, or those of an odd text, come
        # behind the table's.
        starts_of = words.dictionary.take(words.indices.filter(pa.array(first))).to_pylist()
        cuts = [_CUT.split(text) if is_odd else [start] for start, text, is_odd in zip(starts_of, _odd_texts(texts, odd), odd.tolist())]
        pieces = iter(self.whole([x for cut in cuts for x in cut]))
        heads = [np.concatenate([next(pieces) for _ in cut]) for cut in cuts]
        head_ids = np.concatenate([np.zeros(0, np.int32), *heads])
        head_sizes = np.array([len(h) for h in heads], dtype=np.int64)
        self.ids = _room(self.ids, self.used + len(head_ids))
        self.ids[self.used : self.used + len(head_ids)] = head_ids  # until the next words come
        sizes, starts = self.sizes[row].astype(np.int64), self.starts[row].astype(np.int64)
        sizes[first], starts[first] = head_sizes, self.used + np.cumsum(head_sizes) - head_sizes
        ends = np.cumsum(sizes)
        at = np.repeat((starts - ends + sizes).astype(np.int32), sizes)
        at += np.arange(len(at), dtype=np.int32)
        out = self.ids.take(at)
        return out, np.concatenate([[0], ends])[offsets]

    def lengths(self) -> np.ndarray:
        """Bytes of text that each id stands for."""
        if self._lengths is None:
            size = self.tokenizer.get_vocab_size(with_added_tokens=True)
            lengths = np.zeros(size, dtype=np.int64)
            for word, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
                lengths[i] = len(word)  # one character stands for one byte
            for i, token in self.tokenizer.get_added_tokens_decoder().items():
                lengths[i] = len(token.content.encode())
            self._lengths = lengths
        return self._lengths


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, a quarter longer than ``size`` where that does not fit."""
    if size <= len(array):
        return array
    out = np.zeros(size + size // 4, dtype=array.dtype)
    out[: len(array)] = array
    return out


def _odd_texts(texts: pa.Array, odd: np.ndarray) -> list[str | None]:
    """The odd texts, and None for the others."""
    out: list[str | None] = [None] * len(odd)
    for i in np.flatnonzero(odd).tolist():
        out[i] = texts[i].as_py()
    return out


def encoder(spec: str, table_words: int | None = None) -> Encoder:
    """One encoder per worker process and tokenizer."""
    return held(("tokenizer", spec, table_words), lambda: Encoder(spec, table_words))


def halves(text: str, most: int) -> list[str]:
    """``text`` cut in the middle, and so on, until no piece has more than ``most``."""
    if len(text) <= most:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], most) + halves(text[middle:], most)


def _blank_cut(data: bytes, p: int) -> bool:
    return 0 < p < len(data) and data[p] == 0x20 and 0x21 <= data[p - 1] <= 0x7E


def _in_run(data: bytes, p: int) -> bool:
    around = data[max(0, p - RUN) : p + RUN]
    return len(around) == 2 * RUN and around.isascii() and around.isalpha()


def join_two(enc: Encoder, left: tuple[bytes, np.ndarray], right: tuple[bytes, np.ndarray], window: int = WINDOW):
    """(text bytes, ids) of two neighbours, from theirs."""
    (text_l, ids_l), (text_r, ids_r) = left, right
    if not text_l or not text_r:
        return (text_l or text_r), (ids_l if text_l else ids_r)
    data, cut, lengths = text_l + text_r, len(text_l), enc.lengths()
    starts_l = np.concatenate([[0], np.cumsum(lengths[ids_l])])
    starts_r = cut + np.concatenate([[0], np.cumsum(lengths[ids_r])])
    while True:
        a, b = max(0, len(ids_l) - window), min(len(ids_r), window)
        while a and data[starts_l[a]] & 0xC0 == 0x80:
            a -= 1
        while b < len(ids_r) and data[starts_r[b]] & 0xC0 == 0x80:
            b += 1
        lo, hi = int(starts_l[a]), int(starts_r[b])
        ids_w = enc.whole([data[lo:hi].decode()])[0]
        starts_w = lo + np.concatenate([[0], np.cumsum(lengths[ids_w])])
        at_l = _settled(data, starts_l, ids_l, starts_w, ids_w, 0, cut) if a else (0, 0)
        at_r = _settled(data, starts_r, ids_r, starts_w, ids_w, cut, hi) if b < len(ids_r) else (len(ids_r), len(ids_w))
        if at_l and at_r and at_l[1] <= at_r[1]:
            return data, np.concatenate([ids_l[: at_l[0]], ids_w[at_l[1] : at_r[1]], ids_r[at_r[0] :]])
        window *= 2


def _settled(data, starts, ids, starts_w, ids_w, lo: int, hi: int):
    """A place that settles one side: (token of the side, token of the window)."""
    _, side, own = np.intersect1d(starts[:-1], starts_w[:-1], assume_unique=False, return_indices=True)
    for i, j in zip(side.tolist(), own.tolist()):
        p = int(starts[i])
        if not lo < p < hi:
            continue
        if _blank_cut(data, p):
            return i, j
        same = min(AGREE, len(ids) - i, len(ids_w) - j)
        if same == AGREE and lo <= p - RUN and p + RUN <= hi and _in_run(data, p):
            if starts_w[0] <= p - RUN and np.array_equal(ids[i : i + AGREE], ids_w[j : j + AGREE]):
                return i, j
    return None


def join_tree(enc: Encoder, pieces: list[tuple[bytes, np.ndarray]]) -> np.ndarray:
    """Ids of the whole text from its encoded pieces, in order."""
    if not pieces:
        return np.zeros(0, dtype=np.int32)
    while len(pieces) > 1:
        paired = [join_two(enc, pieces[i], pieces[i + 1]) for i in range(0, len(pieces) - 1, 2)]
        pieces = paired + pieces[len(pieces) - len(pieces) % 2 :]
    return pieces[0][1]


def read_spec(path: str) -> str:
    """The tokenizer's file, read once on the driver; a fixed vocabulary, whatever the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def id_lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow lists of 32-bit ids."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, tokenizer: str, piece_chars: int = PIECE_CHARS, decoded: bool = False, table_words: int | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of whole texts. ``tokenizer``: path of the library's file.

    With ``decoded`` the ids' text comes as a third column, as from ``decode``, but made by
    the worker that has the ids. ``table_words``: words a worker remembers (``TABLE_WORDS``);
    fewer take less memory and more time.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer))
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    is_long = F.length("text") > piece_chars
    schema = "doc_id long, ids array<int>" + ", decoded string" * decoded

    def short(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = id_lists(*encoder(spec.value, table_words).encode(batch.column("text")))
        out = pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])
        return _with_text(out, encoder(spec.value, table_words)) if decoded else out

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [
            (doc, a, b, no, piece)
            for doc, a, b, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "a", "b", "text")))
            for no, piece in enumerate(halves(text, piece_chars))
        ]
        names = [("doc_id", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("no", pa.int32()), ("text", pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, (_, t) in enumerate(names)], names=[n for n, _ in names])

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.append_column("ids", id_lists(*encoder(spec.value, table_words).encode(batch.column("text"))))

    def whole(table: pa.Table) -> pa.Table:
        rows = table.sort_by("no").combine_chunks()
        texts, lists = rows.column("text").to_pylist(), rows.column("ids").combine_chunks()
        pieces = [(text.encode(), lists[i].values.to_numpy().astype(np.int32)) for i, text in enumerate(texts)]
        ids = join_tree(encoder(spec.value, table_words), pieces)
        copies = rows.column("copies")[0].as_py()
        doc = pa.array(table.column("doc_id").to_pylist()[:1] * copies, pa.int64())
        lists = id_lists(np.tile(ids, copies), np.arange(copies + 1) * len(ids))
        out = pa.RecordBatch.from_arrays([doc, lists], names=["doc_id", "ids"])
        return pa.Table.from_batches([_with_text(out, encoder(spec.value, table_words)) if decoded else out])

    few = map_batches(rows.where(~is_long), short, schema, holds=True, most=SLICE)
    key = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit("key"), F.col("text")).alias("b")]
    pieces = map_batches(rows.where(is_long).select("doc_id", *key, "text"), cut, "doc_id long, a long, b long, no int, text string")
    # Equal rows meet as one; their number is kept.
    pieces = pieces.groupBy("doc_id", "a", "b", "no").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    encoded = map_batches(pieces, each, "doc_id long, a long, b long, no int, text string, copies long, ids array<int>", holds=True, most=SLICE)
    many = encoded.groupBy("doc_id", "a", "b").applyInArrow(whole, schema)
    return few.unionByName(many)


def _with_text(batch: pa.RecordBatch, enc: Encoder) -> pa.RecordBatch:
    tokenizer, texts = enc.tokenizer, []
    for i in range(0, batch.num_rows, DECODED):
        ids = [x or [] for x in batch.column("ids").slice(i, DECODED).to_pylist()]
        texts.append(pa.array(tokenizer.decode_batch(ids, skip_special_tokens=False), pa.string()))
    return batch.append_column("decoded", pa.concat_arrays(texts) if texts else pa.array([], pa.string()))


def decode(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with their text as ``decoded``: special tokens are kept."""
    spark = tokens.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _with_text(batch, encoder(spec.value))

    return map_batches(tokens.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded string", holds=True)


def digests(docs: DataFrame, tokenizer: str, piece_chars: int = PIECE_CHARS, table_words: int | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids and of the decoded text."""
    both = encode(docs, tokenizer, piece_chars, decoded=True, table_words=table_words)
    decimal = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
