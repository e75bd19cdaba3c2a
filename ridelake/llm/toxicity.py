"""Toxicity: misspelled terms by Levenshtein automata, abuse told from quotation by context.

The lexicon is learned: words, and beginnings of words of ``STEMS`` letters, that toxic
texts have and next to no others, in more texts than chance would bring. It is kept in a trie, which is intersected with the
automata of up to one error (insertion, deletion, other letter, two swapped) for terms of
``FUZZY`` letters or more. Stems match when spelled out; a term whose stem is learned too
stays a term, so it may be misspelled. The product is built lazily: a state is the set of
(trie node, errors) that the letters so far allow, so a word is read letter by letter and
dropped once no term is left. Inexact spellings that harmless texts use count as harmless words.

Every hit is looked at in its window of characters: quotation marks around it, or words of
reporting before it, make it a quotation. Quoted words do not count when the lexicon is
learned, so a term may be quoted in harmless texts. The score of a text is the calibrated
sum over its plain hits, by how exact they are and how sure their terms. Texts with quoted
hits only have a curve of their own, which keeps a lone quoted hit below the threshold
unless labelled texts speak for more.

The model is fitted on at most about ``MOST`` labelled texts of each label (a bounded
sample, chosen by hash).

Defined cases: null and empty texts, and texts without a hit, get the rate of toxic texts
among learned texts without a hit; without learnable rows of both labels the score is the
mean label, or 0 without any; labels other than 0 and 1 are not learned from; of several
labels of one ``doc_id`` the smallest counts; repeated rows come out as often as they come
in; a null ``doc_id`` is not learned from and not held out; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import Words, held, id_and_text, in_fold, map_batches, sampled, with_value
from ridelake.llm.quality import labels_of
from ridelake.session import stage

MOST = 20_000
STEMS, FUZZY = (4, 5, 6), 4
# Toxic texts a term is in at least (near copies count once); its rate in harmless texts at
# most, as a share of that in toxic ones; terms and stems at most, the surest first.
LEAST, IMPURE, TERMS = 5, 0.02, 20_000
# Log-likelihood ratio of a term at least: chance passes it once in ten thousand words. A
# word that no harmless text has needs 11 toxic ones, however large the sample.
SURE = 15.13
THRESHOLD = 0.7
BETWEEN = r"[^\p{L}\p{N}@$]+"
# Characters around a hit that are looked at; harmless texts, with one quoted hit of the
# heaviest term, that are added to the labelled ones.
WINDOW, QUOTING = 40, 4.0
# How much a misspelled hit counts.
INEXACT = 0.3
REMEMBERED = 300_000

# Digits and signs written in place of letters.
_SWAPS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_OPEN, _CLOSE = "\"'«“‘„‹`", "\"'»”’“›`"
WORD = re.compile(r"(?:[^\W_]|[@$])+")
_REPORTS = r"\b(quot\w*|said|says|saying|called|calls|the word|the term|wrote|cit\w+|genannt|sagte|zitat|das wort|le mot|a dit|palabra|dijo|llam\w+)"
_REPORTING = re.compile(_REPORTS + r"\W*$")
# What may make the words after it quoted.
_MARKS = re.compile(f"[{re.escape(_OPEN)}]|{_REPORTS}")


class Automaton:
    """Lexicon trie and Levenshtein automata, multiplied as words ask for it."""

    def __init__(self, terms: list[str], stems: list[str], fuzzy: int = FUZZY):
        self.children: list[dict[str, int]] = [{}]
        # Where a term, or a stem, or both of the same letters end: (its name, is it a stem).
        self.term: list[list[tuple[str, bool]]] = [[]]
        for term, is_stem in [(t, False) for t in terms] + [(s, True) for s in stems]:
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append([])
                node = self.children[node][c]
            self.term[node].append((stem_name(term) if is_stem else term, is_stem))
        self.fuzzy = fuzzy
        self.depth = [0] * len(self.children)
        for node, children in enumerate(self.children):
            for child in children.values():
                self.depth[child] = self.depth[node] + 1
        # A state: frozenset of (node, errors, letter owed by a swap).
        start = self._closed({(0, 0, "")})
        self.states: list[frozenset] = [start]
        self.number = {start: 0}
        self.steps: list[dict[str, int]] = [{}]

    def _closed(self, found: set) -> frozenset:
        """With letters of the term left out in the word."""
        more = {(child, 1, "") for node, errors, owed in found if errors == 0 and not owed for child in self.children[node].values()}
        return frozenset(found | more)

    def _step(self, state: int, c: str) -> int:
        found: set = set()
        for node, errors, owed in self.states[state]:
            children = self.children[node]
            if owed:
                if c == owed:
                    found.add((node, errors, ""))
                continue
            if c in children:
                found.add((children[c], errors, ""))
            if errors == 0:
                found.add((node, 1, ""))  # a letter too many
                for letter, child in children.items():
                    if letter != c:
                        found.add((child, 1, ""))  # another letter
                        if c in self.children[child]:
                            found.add((self.children[child][c], 1, letter))  # two swapped
        closed = self._closed(found)
        if closed not in self.number:
            self.number[closed] = len(self.states)
            self.states.append(closed)
            self.steps.append({})
        return self.number[closed]

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, errors) of the best match: of as few errors, a whole word rather than a stem
        it begins with, and a long one rather than a short one."""
        if len(self.states) > 50_000:
            self.states, self.steps = self.states[:1], [{}]
            self.number = {self.states[0]: 0}
        state, best, rank = 0, None, None
        for i, c in enumerate(word):
            after = self.steps[state].get(c)
            if after is None:
                after = self.steps[state][c] = self._step(state, c)
            state = after
            if not self.states[state]:
                return best
            last = i + 1 == len(word)
            for node, errors, owed in self.states[state]:
                if owed or (errors and self.depth[node] < self.fuzzy):
                    continue
                for name, is_stem in self.term[node]:
                    # Stems count when spelled out, whole terms at the end of the word.
                    if (is_stem and errors == 0) or (last and not is_stem):
                        this = (errors, is_stem, -self.depth[node], name)
                        if best is None or this < rank:
                            best, rank = (name, errors), this
        return best


def stem_name(stem: str) -> str:
    """What a stem is called among terms, which may have the same letters."""
    return stem + "*"


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    harmless: list[str] = field(default_factory=list)
    weight: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    slope: float = 1.0
    base: float = 0.0
    quoted_bias: float = -3.0
    quoted_slope: float = 0.0
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.automaton = Automaton(model.terms, model.stems)
        self.harmless = frozenset(model.harmless)
        self.known: dict[str, tuple[str, int] | None] = {}

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, errors) of a word in lower case; signs for letters are read as letters."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > REMEMBERED:
            self.known = {}
        hit = self.automaton.match(word)
        plain = word.translate(_SWAPS)
        if hit is None and plain != word and not word.isdigit():
            hit = self.automaton.match(plain)
            hit = hit and (hit[0], max(1, hit[1]))
        if hit and hit[1] and word in self.harmless:
            hit = None
        self.known[word] = hit
        return hit

    def hits(self, texts: pa.Array) -> tuple[list[list[tuple[str, str, int]]], list[str]]:
        """For each text its (word, term, errors), and the texts in lower case."""
        import pyarrow.compute as pc

        lowered = pc.utf8_lower(pc.fill_null(texts, ""))
        words = Words(lowered, BETWEEN)
        found = [self.match(w) for w in words.distinct.tolist()]
        is_hit = np.array([f is not None for f in found], dtype=bool)
        at = np.flatnonzero(is_hit[words.codes]) if len(words.codes) else np.zeros(0, np.int64)
        out: list[list[tuple[str, str, int]]] = [[] for _ in range(len(texts))]
        for i, text_no in zip(at.tolist(), words.text_of()[at].tolist()):
            code = words.codes[i]
            out[text_no].append((words.distinct[code], *found[code]))
        return out, [lowered[i].as_py() if out[i] else "" for i in range(len(texts))]

    def evidence(self, hits: list[tuple[str, str, int]], text: str) -> tuple[float, float]:
        """The weights of all plain hits, and of all quoted ones."""
        sums, at = [0.0, 0.0], 0
        for word, term, errors in hits:
            at = place(text, word, at)
            context = quoted(text, at, at + len(word)) if at >= 0 else 0.0
            at = max(at, 0) + len(word)
            sums[context > 0] += self.model.weight.get(term, 1.0) * (1.0 if errors == 0 else INEXACT)
        return sums[0], sums[1]

    def score(self, texts: pa.Array) -> np.ndarray:
        found, lowered = self.hits(texts)
        sums = np.array([self.evidence(h, t) for h, t in zip(found, lowered)]).reshape(-1, 2)
        m, (plain, quotes) = self.model, np.minimum(sums, 50.0).T
        only_quoted = np.where(quotes > 0, 1 / (1 + np.exp(-(m.quoted_bias + m.quoted_slope * quotes))), m.base)
        return np.where(plain > 0, 1 / (1 + np.exp(-(m.bias + m.slope * plain))), only_quoted)


def place(text: str, word: str, start: int) -> int:
    """Where ``word`` next stands as a whole word, or -1."""
    at = text.find(word, start)
    while at >= 0 and ((at and WORD.match(text[at - 1])) or WORD.match(text, at + len(word))):
        at = text.find(word, at + 1)
    return at


def unquoted(text: str) -> str:
    """The text with its quoted words blanked; quotation is looked for behind marks only."""
    parts, kept, looked = [], 0, 0
    for mark in _MARKS.finditer(text):
        for word in WORD.finditer(text, max(looked, mark.end())):
            if word.start() > mark.start() + WINDOW:
                break
            looked, whole = word.end(), not WORD.match(text[word.start() - 1])
            if whole and quoted(text, word.start(), looked):
                parts += [text[kept : word.start()], " " * (looked - word.start())]
                kept = looked
            if mark[1]:  # a word of reporting stands right before
                break
    return "".join([*parts, text[kept:]])


def quoted(text: str, start: int, end: int) -> float:
    """1 where a hit stands in quotation marks or is reported, else 0. Marks count when one
    opens in the window before the hit and one closes in the window after it."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    opening = max((before.rfind(c) for c in _OPEN), default=-1)
    if opening >= 0 and (opening == 0 or not before[opening - 1].isalnum()):
        closing = min((i for c in _CLOSE if (i := after.find(c)) >= 0), default=-1)
        if closing >= 0 and (closing + 1 == len(after) or not after[closing + 1].isalnum()):
            return 1.0
    return 1.0 if _REPORTING.search(before) else 0.0


def _scorer(model: Model) -> Scorer:
    return held(("toxicity", model.name), lambda: Scorer(model))


def _without_copies(sample: DataFrame) -> DataFrame:
    """One text of each label and smallest hash of three words in a row: near copies share
    that hash, and one text's rare words would else count as often as it has copies."""

    def smallest(words):
        triples = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(3))))
        return F.when(F.size(words) >= 3, F.array_min(triples)).otherwise(F.xxhash64("text"))

    least = with_value(F.split("text", " "), smallest)
    return sample.withColumn("least", least).dropDuplicates(["y", "least"]).drop("least")


def _item_counts(sample: DataFrame) -> DataFrame:
    """(item, stem, toxic, harmless, seen): texts of the sample with each word and word
    beginning outside quotations; seen: the harmless ones in the first half of the sample."""
    import pyarrow.compute as pc

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.utf8_lower(batch.column("text")).to_pylist()
        words = Words(pa.array([unquoted(t) for t in texts], pa.string()), BETWEEN)
        names = words.distinct.tolist()
        toxic = batch.column("y").to_pylist()
        found: dict[tuple[str, bool], list[int]] = {}
        for y, half, a, b in zip(toxic, batch.column("half").to_pylist(), words.offsets, words.offsets[1:]):
            own = [names[c] for c in np.unique(words.codes[a:b]).tolist()]
            for item in [(w, False) for w in own] + [(s, True) for s in {w[:k] for w in own for k in STEMS if len(w) > k}]:
                counts = found.setdefault(item, [0, 0, 0])
                counts[1 - y] += 1
                counts[2] += not y and half
        columns = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.bool_())]
        columns += [pa.array([v[i] for v in found.values()], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(columns, names=["item", "stem", "toxic", "harmless", "seen"])

    counted = map_batches(sample, run, "item string, stem boolean, toxic long, harmless long, seen long")
    return counted.groupBy("item", "stem").agg(*(F.sum(c).alias(c) for c in ("toxic", "harmless", "seen")))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model:
    """A model from texts (doc_id, text) and labels (doc_id, y)."""
    chosen = stage(sampled(labels, "y", most), "toxic-sample")
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    # At most about 2 x ``most`` rows of two numbers, whatever the number of labels.
    sample = stage(docs.join(F.broadcast(chosen), "doc_id").select("text", "y", half.alias("half")).where("text IS NOT NULL"), "toxic-copies")
    sample = stage(_without_copies(sample), "toxic-texts")
    n = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        share = n.get(1, 0) / max(1, sum(n.values()))
        return Model(bias=-30.0, slope=0.0, base=share)
    counts = stage(_item_counts(sample), "toxic-items")
    # Rates allow for unequal numbers of toxic and harmless texts in the sample.
    rate = F.col("toxic") / n[1]
    other = F.col("harmless") / n[0]
    sure = counts.withColumn("ratio", _ratio(F.col("toxic"), F.col("harmless"), n[1], n[0]))
    sure = sure.where((F.col("toxic") >= LEAST) & (other <= IMPURE * rate) & (F.col("ratio") >= SURE))
    top = sure.orderBy(F.desc("ratio"), "item", "stem").limit(TERMS).collect()
    stems = {r.item for r in top if r.stem}
    stems = sorted(x for x in stems if not any(x[:k] in stems for k in range(1, len(x))))
    terms = [r.item for r in top if not r.stem]
    weight = {stem_name(r.item) if r.stem else r.item: float(np.log((r.toxic / n[1] + 1e-4) / (r.harmless / n[0] + 1e-4))) for r in top}
    model = Model(terms=terms, stems=stems, weight=weight)
    # Calibrated on texts whose harmless words the model has not been told; then told all.
    half_told = Model(terms, stems, _harmless(counts.where("NOT stem AND seen > 0"), model), weight)
    fitted = _calibrated(sample.where("NOT half"), half_told)
    return Model(terms, stems, _harmless(counts.where("NOT stem AND harmless > 0"), model), weight, *fitted)


def _ratio(toxic: Column, harmless: Column, n_toxic: int, n_harmless: int) -> Column:
    """Log-likelihood ratio (G) of texts with and without an item, toxic and harmless."""
    n, have = n_toxic + n_harmless, toxic + harmless
    cells = [(toxic, have, n_toxic), (harmless, have, n_harmless), (n_toxic - toxic, n - have, n_toxic), (n_harmless - harmless, n - have, n_harmless)]
    return 2 * sum(F.when(seen > 0, seen * F.ln(seen * n / (row * column))).otherwise(0.0) for seen, row, column in cells)


def _harmless(words: DataFrame, model: Model) -> list[str]:
    """Words of harmless texts that an inexact match would take for a term; all of them, as
    the sample of texts bounds them."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = _scorer(shared.value)
        hit = [(m := scorer.match(w)) is not None and m[1] > 0 for w in batch.column("item").to_pylist()]
        return batch.filter(pa.array(hit, pa.bool_()))

    found = map_batches(words.select("item", "harmless"), run, "item string, harmless long", holds=True)
    return [r.item for r in found.orderBy("item").collect()]


def _calibrated(sample: DataFrame, model: Model) -> tuple[float, float, float, float, float]:
    """Bias and slope of a logistic curve over the evidence of plain hits, the rate of texts
    without hits, and bias and slope over that of quoted hits, from counts in bins."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = _scorer(shared.value)
        found, lowered = scorer.hits(batch.column("text"))
        plain, quotes = np.array([scorer.evidence(h, t) for h, t in zip(found, lowered)]).reshape(-1, 2).T
        only_quoted = (plain == 0) & (quotes > 0)
        bins = np.minimum(np.ceil(np.where(only_quoted, quotes, plain) * 2), 100).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(only_quoted), pa.array(bins), batch.column("y")], names=["only_quoted", "bin", "y"])

    counts = np.zeros((2, 101, 2))
    for q, b, y, k in map_batches(sample, run, "only_quoted boolean, bin int, y int", holds=True).groupBy("only_quoted", "bin", "y").count().collect():
        counts[int(q), b, y] = k
    base = float((counts[0, 0, 1] + 0.5) / (counts[0, 0].sum() + 1))
    # Two texts that nobody has seen hold the curve where all have one label.
    plain = _curve(counts[0], [0.0, 5.0], [0.5, 1.0], [1.0, 1.0])
    quotes = _curve(counts[1], [max(model.weight.values(), default=1.0)], [0.0], [QUOTING])
    return *plain, base, *quotes


def _curve(counts: np.ndarray, at: list[float], toxic: list[float], texts: list[float]) -> tuple[float, float]:
    """Bias and slope, not below 0, fitted to bins of evidence and the given texts beside."""
    x = np.append((np.arange(1, 101) - 0.5) / 2, at)
    hits, rows = np.append(counts[1:, 1] + 1e-3, toxic), np.append(counts[1:].sum(axis=1) + 2e-3, texts)
    for features in (np.stack([np.ones_like(x), x], axis=1), np.ones((len(x), 1))):
        beta = np.zeros(features.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
            hessian = (features * (rows * p * (1 - p))[:, None]).T @ features + 1e-2 * np.eye(len(beta))
            beta += np.clip(np.linalg.solve(hessian, features.T @ (hits - rows * p) - 1e-2 * beta), -2, 2)
        if beta[-1] >= 0 and len(beta) == 2:
            return float(beta[0]), float(beta[1])
    return float(beta[0]), 0.0


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    rows = id_and_text(docs)
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows, labels_of(labels, "toxic", modulus, remainder)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = _scorer(shared.value).score(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(score, 0, 1))], names=["doc_id", "score"])

    return map_batches(rows, run, "doc_id long, score double", holds=True).select(
        "doc_id",
        in_fold(F.col("doc_id"), modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
