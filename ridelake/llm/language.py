"""Language of whole texts: words first, shorter and shorter character n-grams after.

Words are runs of letters in lower case. For each language the model has the relative
frequency of words, and of n-grams of 5 to 1 characters within words (their ends marked). A
known word scores its log frequency in each language; an unknown word scores the mean of
its n-grams of the longest length of which the model knows any. The scores of all words of
the text and the log share of the language add up; their normalised exponents are the
languages' scores.

The model is fitted on at most about ``per_language`` documents of each language (a bounded
sample, chosen by hash), however many languages there are; it keeps the ``WORDS`` most
frequent words and ``GRAMS`` n-grams, or ``CELLS`` scores.

Defined cases: null texts and texts without a letter are ``und`` with score 0; a text whose
letters the model has never seen gets the most frequent language and its share; without
any labelled row every text is ``und``; repeated rows come out as often as they come in; a
null ``doc_id`` is never learned from and not held out; other columns are ignored, or
returned unchanged by ``accepted``. Of languages with equal scores the one with more labelled
rows is chosen, then the first by name. Very long texts are scored whole, a batch of words at
a time.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import Words, free_name, held, in_fold, map_batches, sampled

PER_LANGUAGE = 3000
WORDS, GRAMS = 200_000, 200_000
# Scores (an item in a language) of either table at most, 64 MB: with more than 80 languages
# there are fewer items, and words beyond them are scored by their n-grams.
CELLS = 1 << 24
ORDERS = (5, 4, 3, 2, 1)
BETWEEN = r"[^\p{L}]+"
UNKNOWN = "und"
# Unknown words a worker remembers the scores of.
REMEMBERED = 200_000


def grams_of(word: str, order: int) -> list[str]:
    marked = f"<{word}>" if order > 1 else word
    return [marked[i : i + order] for i in range(max(1, len(marked) - order + 1))] if len(marked) >= order else []


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    words: list[str]
    word_scores: np.ndarray
    grams: list[str]
    gram_scores: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class Scorer:
    """A model made ready for look-ups within a worker."""

    def __init__(self, model: Model):
        self.model = model
        self.word_row = dict(zip(model.words, range(len(model.words))))
        self.gram_row = dict(zip(model.grams, range(len(model.grams))))
        self.unknown: dict[str, np.ndarray] = {}

    def backoff(self, word: str) -> np.ndarray:
        for order in ORDERS:
            rows = [r for g in grams_of(word, order) if (r := self.gram_row.get(g)) is not None]
            if rows:
                return self.model.gram_scores[rows].mean(axis=0)
        return np.zeros(len(self.model.languages), dtype=np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        """A row for each word, a column for each language."""
        if len(self.unknown) > REMEMBERED:
            self.unknown = {}
        rows = np.array([self.word_row.get(w, -1) for w in words], dtype=np.int64)
        out = np.zeros((len(words), len(self.model.languages)), dtype=np.float32)
        known = rows >= 0
        out[known] = self.model.word_scores[rows[known]]
        for i in np.flatnonzero(~known).tolist():
            word = words[i]
            found = self.unknown.get(word)
            if found is None:
                found = self.unknown[word] = self.backoff(word)
            out[i] = found
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words = Words(texts, BETWEEN, lower=True)
        per_word = self.scores(words.distinct.tolist())
        total = words.sums(per_word[words.codes]) + self.model.prior
        total -= total.max(axis=1, keepdims=True)
        share = np.exp(total)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        some = np.diff(words.offsets) > 0
        names = [self.model.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
        return names, np.where(some, share[np.arange(len(best)), best], 0.0)


def _scorer(model: Model) -> Scorer:
    return held(("language", model.name), lambda: Scorer(model))


def learnable(docs: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """(text, lang) of the rows that may be learned from: all but the held-out fold."""
    doc_id = F.col("doc_id").cast("long")
    own = docs.where(doc_id.isNotNull() & ~in_fold(doc_id, modulus, remainder))
    return own.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")


def _counts(rows: DataFrame, of: str) -> DataFrame:
    """(lang, item, n): sums of each batch, then of all. ``of``: words of texts, or
    n-grams of counted words."""

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        texts, langs = batch.column("text"), batch.column("lang").to_pylist()
        split = Words(texts, BETWEEN, lower=True)
        names = split.distinct
        for lang, a, b in zip(langs, split.offsets, split.offsets[1:]):
            code, n = np.unique(split.codes[a:b], return_counts=True)
            for c, k in zip(code.tolist(), n.tolist()):
                found[lang, names[c]] += k
        return _counted(found)

    def grams(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "item", "n"))):
            for order in ORDERS:
                for gram in grams_of(word, order):
                    found[lang, gram] += n
        return _counted(found)

    counted = map_batches(rows, {"words": words, "grams": grams}[of], "lang string, item string, n long")
    return counted.groupBy("lang", "item").agg(F.sum("n").alias("n"))


def _counted(found: Counter) -> pa.RecordBatch:
    columns = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "item", "n"])


def _table(counts: DataFrame, languages: list[str], most: int) -> tuple[list[str], np.ndarray]:
    """The ``most`` most frequent items, and their log frequency in each language."""
    cells = counts.groupBy("item").agg(F.sum("n").alias("n"), F.collect_list(F.struct("lang", "n")).alias("by"))
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}
    top = cells.where("n > 1").orderBy(F.desc("n"), "item").limit(most).select("item", F.col("by.lang").alias("lang"), F.col("by.n").alias("k")).toArrow()
    n = np.zeros((top.num_rows, len(languages)))
    place = dict(zip(languages, range(len(languages))))
    if top.num_rows:
        langs, k = (top.column(c).combine_chunks() for c in ("lang", "k"))
        row = np.repeat(np.arange(top.num_rows), np.diff(langs.offsets.to_numpy()))
        n[row, [place[x] for x in langs.flatten().to_pylist()]] = k.flatten().to_numpy()
    total = np.array([totals.get(lang, 0) for lang in languages], dtype=np.float64)
    scores = np.log((n + 0.5) / (total + 0.5 * max(1, top.num_rows)))
    return top.column("item").to_pylist(), scores.astype(np.float32)


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model from (text, lang)."""
    from ridelake.session import stage

    shares = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # one row a language
    languages = [r[0] for r in shares]
    prior = np.log(np.array([r[1] for r in shares], dtype=np.float64) / max(1, sum(r[1] for r in shares)))
    sample = sampled(labelled.withColumn("kind", F.col("lang")), "kind", per_language).select("text", "lang")
    words = stage(_counts(sample, "words"), "language-words")
    most = CELLS // max(1, len(languages))
    word_list, word_scores = _table(words, languages, min(WORDS, most))
    gram_list, gram_scores = _table(_counts(words, "grams"), languages, min(GRAMS, most))
    return Model(languages, prior, word_list, word_scores, gram_list, gram_scores)


def _predicted(docs: DataFrame, model: Model, columns: list[str], names: tuple[str, str]) -> DataFrame:
    """``columns`` of ``docs`` with the prediction as two columns of the given names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.string())
        if shared.value.languages:
            found, score = _scorer(shared.value).predict(texts)
        else:
            found, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
        out = batch.append_column(names[0], pa.array(found, pa.string()))
        return out.append_column(names[1], pa.array(score, pa.float64()))

    kept = docs.select(*(F.col(f"`{c}`") for c in columns))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_batches(kept, run, f"{schema}, `{names[0]}` string, `{names[1]}` double", holds=True)


def identify(docs: DataFrame, modulus: int = 4, remainder: int = 2, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    model = fit(learnable(docs, modulus, remainder), per_language)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _predicted(rows, model, ["doc_id", "text"], ("lang_pred", "score"))
    return found.select("doc_id", in_fold(F.col("doc_id"), modulus, remainder).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` in a language: not ``und``, and scored ``least`` or more."""
    names = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = _predicted(docs, fit(learnable(docs)), docs.columns, names)
    return found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).select(*(F.col(f"`{c}`") for c in docs.columns))
