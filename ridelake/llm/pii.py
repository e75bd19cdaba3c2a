"""Personal data: fixed patterns, and a character-level BiLSTM-CRF that adds spans.

The patterns find e-mail addresses, IP addresses, card and phone numbers in whole texts in
time linear in the text. The tagger learns from labelled spans: those of the patterns in a
bounded sample of texts, and the same spans written in ways the patterns miss (phones
without ``+``, cards with dots, spaced dots and at-signs), with windows of other digits as
counter-examples. It is a bidirectional LSTM over classes of characters with a CRF on top,
trained and run in numpy.

A text is cut into windows of ``WINDOW`` characters that overlap by half. Windows with no
digit and no ``@`` are skipped, as no span of any kind can lie in them without one. Spans
of all windows of a text are reconciled at once: of overlapping ones the set with the
largest sum of scores stays. A tagged span is added if it touches no span of the patterns,
scores ``SURE`` or more against being no span, and has the digits its kind needs.

Defined cases: null and empty texts have no spans; offsets count code points, the end is
exclusive; repeated rows come out as often as they come in; a null ``doc_id`` stays null;
without any pattern match in the sample the tagger learns from written examples alone;
other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import id_and_text, map_batches
from ridelake.session import stage

KINDS = ("email", "ip", "card", "phone")
WINDOW, SURE = 128, 5.0
# Texts looked at for training, and windows learned from, at most.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 20_000, 1_200
HIDDEN, EPOCHS, BATCH, RATE = 16, 14, 48, 0.03

_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _bytes_at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def pattern_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind, then start."""
    out: list[Span] = []
    end = 0
    for m in _AT.finditer(text) if "@" in text else ():
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((0, start, m.end()))
            end = m.end()
    if not _DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_bytes_at_most_255, m.groups()))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_DIGIT.findall(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# Classes of characters: padding, other, lower case, upper case, digit, letter beyond ASCII,
# line end, and each of these signs.
_SIGNS = "@.-+()_% :/=,;\"'#"
CLASSES = 7 + len(_SIGNS)
_CLASS = np.ones(128, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[10, 13]] = 2, 3, 4, 6
_CLASS[[ord(c) for c in _SIGNS]] = np.arange(7, CLASSES)
TAGS = 1 + 2 * len(KINDS)  # none; beginning and inside of each kind


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    out = _CLASS[np.minimum(codes, 127)]
    far = np.flatnonzero(codes > 127)
    out[far] = [5 if text[i].isalpha() else 1 for i in far.tolist()]
    return out


def _allowed() -> np.ndarray:
    """Large negative scores for an inside tag that does not continue its own kind."""
    out = np.zeros((TAGS, TAGS))
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        out[[t for t in range(TAGS) if t not in (inside - 1, inside)], inside] = -1e4
    return out


_ALLOWED = _allowed()
_FIRST = np.where(np.arange(TAGS) % 2 == 0, -1e4, 0.0) * (np.arange(TAGS) > 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tagger:
    """Bidirectional LSTM and CRF; ``p`` holds the weights."""

    def __init__(self, seed: int = 5, dtype: type = np.float32):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.name = uuid.uuid4().hex
        self.p = {"out": rng.normal(0, 0.2, (2 * h, TAGS)), "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS))}
        for side in "fb":
            self.p[f"x{side}"] = rng.normal(0, 0.4, (CLASSES, 4 * h))
            self.p[f"x{side}"][:, h : 2 * h] += 1.0  # remember at first
            self.p[f"h{side}"] = rng.normal(0, 0.3, (h, 4 * h))
        self.p = {k: w.astype(dtype) for k, w in self.p.items()}

    def _run(self, x: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        h_size, (n, steps) = HIDDEN, x.shape
        wx, wh = self.p[f"x{side}"], self.p[f"h{side}"]
        h, c = np.zeros((n, h_size), wh.dtype), np.zeros((n, h_size), wh.dtype)
        out = np.empty((steps, n, h_size), wh.dtype)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = wx[x[:, t]] + h @ wh
            i, f, o = np.split(_sigmoid(z[:, : 3 * h_size]), 3, axis=1)
            g = np.tanh(z[:, 3 * h_size :])
            before, h_before = c, h
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, g, o, before, squashed, h_before))
        return out

    def emissions(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.concatenate([self._run(x, side, keep and keep[k]) for k, side in enumerate("fb")], axis=2)
        return hidden @ self.p["out"] + self.p["bias"], hidden

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags ``y``, and its gradients."""
        n, steps = x.shape
        keep: tuple[list, list] = ([], [])
        e, hidden = self.emissions(x, keep)
        trans = self.p["trans"] + _ALLOWED
        alpha = np.empty((steps, n, TAGS))
        beta = np.zeros((steps, n, TAGS))
        alpha[0] = e[0] + _FIRST
        for t in range(1, steps):
            alpha[t] = e[t] + _log_sum(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _log_sum(trans[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _log_sum(alpha[-1], 1)
        d_e = np.exp(alpha + beta - total[:, None])
        rows = np.arange(n)
        gold = _FIRST[y[:, 0]] + e[0][rows, y[:, 0]]
        d_trans = np.zeros((TAGS, TAGS))
        for t in range(steps):
            d_e[t, rows, y[:, t]] -= 1
            if t:
                pair = alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - total[:, None, None]
                d_trans += np.exp(pair).sum(axis=0)
                np.add.at(d_trans, (y[:, t - 1], y[:, t]), -1)
                gold = gold + trans[y[:, t - 1], y[:, t]] + e[t][rows, y[:, t]]
        d_e /= n
        flat = d_e.reshape(-1, TAGS)
        grads = {"out": hidden.reshape(-1, 2 * HIDDEN).T @ flat, "bias": flat.sum(axis=0), "trans": d_trans / n}
        d_hidden = d_e.astype(hidden.dtype) @ self.p["out"].T
        for k, side in enumerate("fb"):
            d_out = d_hidden[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            wh = self.p[f"h{side}"]
            d_wh, d_zs = np.zeros_like(wh), np.zeros((steps, n, 4 * HIDDEN), dtype=wh.dtype)
            d_h, d_c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for t, i, f, g, o, before, squashed, h_before in reversed(keep[k]):
                d_h = d_h + d_out[t]
                d_c = d_c + d_h * o * (1 - squashed**2)
                d_z = d_zs[t]
                np.concatenate([d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - g**2)], axis=1, out=d_z)
                d_wh += h_before.T @ d_z
                d_h, d_c = d_z @ wh.T, d_c * f
            one_hot = (x.T[:, :, None] == np.arange(CLASSES)).reshape(-1, CLASSES).astype(wh.dtype)
            grads[f"x{side}"], grads[f"h{side}"] = one_hot.T @ d_zs.reshape(-1, 4 * HIDDEN), d_wh
        return float((total - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 6) -> float:
        """Adam over the windows, in an order fixed by the seed; the last mean loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step, loss = 0, 0.0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / (EPOCHS + 1))
            order = rng.permutation(len(x))
            losses = []
            for at in range(0, len(x), BATCH):
                loss, grads = self.gradients(x[order[at : at + BATCH]], y[order[at : at + BATCH]])
                losses.append(loss)
                norm = np.sqrt(sum((g**2).sum() for g in grads.values()))
                step += 1
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - np.asarray(rate, g.dtype) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
            loss = float(np.mean(losses))
        return loss

    def decode(self, x: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """(kind, start, end, score) of the best tags of each window; the score is what the
        span's tags add over none."""
        e, _ = self.emissions(x)
        trans = self.p["trans"] + _ALLOWED
        steps, n, _ = e.shape
        score = e[0] + _FIRST
        back = np.zeros((steps, n, TAGS), dtype=np.int8)
        for t in range(1, steps):
            ways = score[:, :, None] + trans
            back[t] = ways.argmax(axis=1)
            score = ways.max(axis=1) + e[t]
        tags = np.zeros((steps, n), dtype=np.int64)
        tags[-1] = score.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][rows, tags[t]]
        out: list[list[tuple[int, int, int, float]]] = [[] for _ in range(n)]
        for row in np.flatnonzero((tags > 0).any(axis=0)).tolist():
            own = tags[:, row]
            begins = np.flatnonzero((own > 0) & (own % 2 == 1))
            for a in begins.tolist():
                b = a + 1
                while b < steps and own[b] == own[a] + 1:
                    b += 1
                path = [0, *own[a:b].tolist()] + [0] * (b < steps)
                gain = float((e[np.arange(a, b), row, own[a:b]] - e[a:b, row, 0]).sum())
                gain += sum(trans[i, j] for i, j in zip(path, path[1:])) - trans[0, 0] * (len(path) - 1)
                out[row].append((int(own[a] - 1) // 2, a, b, gain))
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def window_starts(x: np.ndarray) -> list[int]:
    """Starts of the overlapping windows that hold a digit or an at-sign."""
    trigger = (x == 4) | (x == 7)
    half = WINDOW // 2
    blocks = np.add.reduceat(trigger, np.arange(0, len(x), half)) > 0 if len(x) else np.zeros(0, bool)
    wanted = blocks.copy()
    wanted[:-1] |= blocks[1:]
    return (np.flatnonzero(wanted) * half).tolist()


def _window(x: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WINDOW, dtype=np.int64)
    part = x[start : start + WINDOW]
    out[: len(part)] = part
    return out


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Of all spans of a text the non-overlapping ones with the largest sum of scores."""
    spans = sorted(set(spans), key=lambda s: (s[2], s[1], s[0], -s[3]))
    ends = [s[2] for s in spans]
    best: list[float] = [0.0]
    taken: list[bool] = []
    before = np.searchsorted(ends, [s[1] for s in spans], side="right").tolist() if spans else []
    for s, b in zip(spans, before):
        b = min(b, len(taken))
        take = best[b] + s[3]
        taken.append(take > best[-1])
        best.append(max(take, best[-1]))
    out, i = [], len(spans)
    while i:
        if taken[i - 1]:
            out.append(spans[i - 1])
            i = min(before[i - 1], i - 1)
        else:
            i -= 1
    return out[::-1]


def plausible(kind: int, text: str) -> bool:
    """Whether a tagged span has the digits, or the signs, that its kind needs."""
    digits = "".join(_DIGIT.findall(text))
    if KINDS[kind] == "email":
        return "@" in text.strip("@") and "." in text.partition("@")[2]
    if KINDS[kind] == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(_bytes_at_most_255, parts))
    if KINDS[kind] == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and len(digits) * 2 >= len(text)


def joined_pieces(whole: list[tuple[int, int, int, float]], pieces: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Spans put together from the pieces that windows have cut: those of one kind that
    overlap or touch are one span, as sure as the surest. Pieces within a whole span go."""
    out: list[tuple[int, int, int, float]] = []
    for kind, a, b, score in sorted(pieces):
        if any(k == kind and x <= a and b <= y for k, x, y, _ in whole):
            continue
        if out and out[-1][0] == kind and a <= out[-1][2]:
            out[-1] = (kind, out[-1][1], max(b, out[-1][2]), max(score, out[-1][3]))
        else:
            out.append((kind, a, b, score))
    return out


def added_spans(tagger: Tagger, texts: list[str], known: list[list[Span]]) -> list[list[Span]]:
    """Spans the tagger adds to those of the patterns, for each text."""
    coded = [classes(t) for t in texts]
    places = [(i, start) for i, x in enumerate(coded) for start in window_starts(x)]
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    parts: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]  # cut by a window's edge
    for at in range(0, len(places), 1024):
        part = places[at : at + 1024]
        tagged = tagger.decode(np.stack([_window(coded[i], start) for i, start in part]))
        for (i, start), spans in zip(part, tagged):
            length = len(coded[i])
            for kind, a, b, score in spans:
                cut = (a == 0 and start > 0, b == WINDOW and start + WINDOW < length)
                if start + b <= length:
                    pieces = parts if any(cut) else found
                    pieces[i].append((kind, start + a, start + b, round(score, 6)))
    out = []
    for text, spans, cut_spans, base in zip(texts, found, parts, known):
        spans = spans + joined_pieces(spans, cut_spans)
        free = [s for s in spans if s[3] >= SURE and not any(s[1] < e and b < s[2] for _, b, e in base)]
        out.append([(k, a, b) for k, a, b, _ in reconcile(free) if plausible(k, text[a:b])])
    return out


def variants(rng: np.random.Generator, kind: int, span: str) -> str:
    """The span as it is, or written in a way the patterns miss."""
    if rng.random() < 0.6:
        return span
    digits = "".join(_DIGIT.findall(span))
    if KINDS[kind] == "email":
        return span.replace("@", " @ ") if rng.random() < 0.5 else span.replace("@", "(@)")
    if KINDS[kind] == "ip":
        return span.replace(".", " . ") if rng.random() < 0.5 else span.replace(".", "-")
    if KINDS[kind] == "card":
        return str(rng.choice([".", "/", "_"])).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return str(rng.choice(["", "00"])) + str(rng.choice(["-", " ", "."])).join([digits[:-7], digits[-7:-4], digits[-4:]])


def _written(rng: np.random.Generator) -> list[tuple[str, int, str, str]]:
    """Examples for each kind that need no corpus: (before, kind, span, after)."""
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))
    number = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    out = []
    for _ in range(40):
        card = number(15)
        spans = [f"{word()}.{word()}@{word()}.com", ".".join(str(x) for x in rng.integers(1, 256, 4)), "", f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}"]
        spans[2] = next(card + str(d) for d in range(10) if luhn(card + str(d)))
        for kind, span in enumerate(spans):
            out.append((f"{word()} {word()} ", kind, span, f" {word()}, {word()}."))
        for other in (number(5), f"{word()}={number(12)}{word()}", f"{number(1)}.{number(1)}.{number(1)}", f"AK{number(14)}Z"):
            out.append((f"{word()} {word()} ", -1, other, f" {word()} {word()}."))
    return out


def examples(docs: DataFrame) -> list[tuple[str, int, str, str]]:
    """(before, kind, span, after) from a bounded sample of texts; kind -1: other digits."""
    n = max(1, docs.count())
    part = max(1, -(-n // SAMPLE_TEXTS))
    sample = docs.where(F.pmod(F.xxhash64(F.lit("pii"), "doc_id", "text"), F.lit(part)) == 0)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column("text").to_pylist():
            if not text or not (_DIGIT.search(text) or "@" in text):
                continue
            spans = pattern_spans(text)
            others = [(-1, m.start(), m.end()) for m in re.finditer(r"[^\s]*[0-9][^\s]*", text[: 1 << 20])]
            others = [o for o in others if not any(o[1] < e and b < o[2] for _, b, e in spans)][:3]
            for kind, a, b in spans[:6] + others:
                if b - a < WINDOW // 2:
                    out.append((text[max(0, a - 40) : a], kind, text[a:b], text[b : b + 40]))
        types = (pa.string(), pa.int32(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=["before", "kind", "span", "after"])

    found = stage(map_batches(sample, run, "before string, kind int, span string, after string"), "pii-examples")
    chosen = []
    for kind in range(-1, len(KINDS)):
        rows = found.where(F.col("kind") == kind).distinct().orderBy(F.xxhash64("span", "before"), "span", "before", "after")
        chosen += [tuple(r) for r in rows.limit(SAMPLE_WINDOWS // (len(KINDS) + 1)).collect()]
    return chosen


def train(docs: DataFrame, seed: int = 8) -> Tagger:
    """A tagger from the labelled spans of a bounded sample of ``docs``."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for before, kind, span, after in examples(docs) + _written(rng):
        # Neighbours of the example may hold digits of their own, which nobody has labelled.
        before, after = re.sub(r"[^\s]*[0-9@][^\s]*", "", before), re.sub(r"[^\s]*[0-9@][^\s]*", "", after)
        if kind >= 0:
            span = variants(rng, kind, span)
        before = before[int(rng.integers(0, max(1, len(before)))) :]
        text = before + span + after
        x, y = classes(text), np.zeros(len(text), dtype=np.int64)
        if kind >= 0:
            y[len(before) : len(before) + len(span)] = 2 + 2 * kind
            y[len(before)] -= 1
        xs.append(_window(x, 0))
        ys.append(_window(y, 0))
    tagger = Tagger()
    tagger.fit(np.stack(xs), np.stack(ys))
    return tagger


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): for each row the spans of the patterns and those the tagger
    adds, each as an array of (kind, start, end) by kind and start."""
    rows = id_and_text(docs)
    shared = docs.sparkSession.sparkContext.broadcast(train(rows))
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        import pyarrow.compute as pc

        column = pc.fill_null(batch.column("text"), "")
        at = np.flatnonzero(pc.match_substring_regex(column, "[0-9@]").to_numpy(zero_copy_only=False))
        texts = column.take(pa.array(at)).to_pylist()
        base = [pattern_spans(t) for t in texts]
        added = added_spans(shared.value, texts, base)
        columns = []
        for spans in (base, added):
            all_rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, own in zip(at.tolist(), spans):
                all_rows[i] = [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(own)]
            columns.append(pa.array(all_rows, span_type))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "base", "added"])

    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    return map_batches(rows, run, f"doc_id long, base {spans}, added {spans}")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, pattern matches of each kind, their SHA-256, and all spans as text."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind: str):
        return lambda span: span["kind"] == kind

    every = F.flatten(F.array(*(F.array_sort(F.filter(F.concat("base", "added"), of_kind(k))) for k in KINDS)))
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    added = F.size("added").cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(every).alias("spans"), added)


def sha256_of(spans: list[Span]) -> str:
    """The digest of spans in plain Python, as a check."""
    return sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)).encode()).hexdigest()
