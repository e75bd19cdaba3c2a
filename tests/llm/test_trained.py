"""Trained operators: held-out accuracy on the test tables, and awkward rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import ALL_IDS, awkward, docs, empty, ids
from pyspark.sql import functions as F

from ridelake.llm import language, pii, quality, queries, toxicity

SMALL = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def held_out(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


@pytest.mark.parametrize("name, label, fold, least", [("op4_quality", "quality", (5, 0), 0.95), ("op8_toxicity", "toxic", (3, 1), 0.9)])
def test_scores_of_held_out_rows(spark, name, label, fold, least):
    got = queries.QUERIES[name](spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").toPandas()
    assert (rows.held_out == rows.doc_id.map(lambda i: held_out(i, *fold))).all()
    assert rows.score.between(0, 1).all()
    test = rows[rows.held_out]
    assert (test.predicted == test[label]).mean() >= least


def test_language_of_held_out_rows(spark):
    got = queries.QUERIES["op6_language"](spark, SMALL)
    rows = got.join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    test = rows[rows.held_out & rows.lang.notna()]
    assert len(test) > 100 and (test.lang == test.lang_pred).mean() > 0.98


def test_language_of_awkward_rows(spark):
    rows = awkward(spark)
    got = language.identify(rows)
    assert ids(got) == ALL_IDS
    by = {r.doc_id: r for r in got.collect()}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 10))
    assert all(0 < by[i].score <= 1 for i in (4, 5, 7, 8, 9, None))
    kept = language.accepted(rows, least=0.0)
    assert kept.columns == rows.columns and ids(kept) == [i for i in ALL_IDS if i not in (1, 2, 3, 10)]
    assert language.identify(empty(spark)).count() == 0
    unlabelled = rows.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


def test_unknown_words_fall_back_to_shorter_grams():
    model = language.Model(["x", "y"], np.zeros(2), ["cat"], np.log([[0.9, 0.1]]).astype("f4"), ["og", "z"], np.log([[0.2, 0.8], [0.7, 0.3]]).astype("f4"))
    scorer = language.Scorer(model)
    scores = scorer.scores(["cat", "dog", "z9", "??"])
    assert np.allclose(np.exp(scores), [[0.9, 0.1], [0.2, 0.8], [0.7, 0.3], [1, 1]], atol=1e-6)


def labelled(spark, rows):
    return spark.createDataFrame(rows, LABELS)


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_scorers_take_awkward_rows_and_labels(spark, score):
    rows, none = awkward(spark), labelled(spark, [])
    for labels in (none, labelled(spark, [(5, 1, 1), (None, 0, 0), (6, None, None), (7, 3, 3)]), labelled(spark, [(i, i % 2, i % 2) for i in range(12)] + [(5, 0, 0)])):
        got = score(rows, labels)
        assert ids(got) == ALL_IDS
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in got.collect())
    assert score(empty(spark), none).count() == 0


def test_isotonic_rates_never_fall():
    r = np.random.default_rng(1)
    rows = r.integers(1, 20, 50)
    rates = quality.pooled(rows.astype(float), r.binomial(rows, np.linspace(0.1, 0.9, 50)).astype(float))
    assert len(rates) == 50 and (np.diff(rates) >= -1e-2).all() and rates[0] < 0.4 < rates[-1]


def test_statistics_of_repeated_and_loud_words():
    x = dict(zip(quality.NAMES, quality.statistics(pa.array(["", "go go go GO!!", None])).T))
    assert x["same_as_last"].tolist() == [0, 0.5, 0] and x["log_words"][0] == 0
    assert x["caps_words"][1] == 0.25 and x["loud"][1] > 0


def distance_one(a, b):
    """At most one letter inserted, left out, other, or two neighbours swapped."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        diff = [i for i in range(len(a)) if a[i] != b[i]]
        return len(diff) <= 1 or (len(diff) == 2 and diff[1] == diff[0] + 1 and a[diff[0]] == b[diff[1]] and a[diff[1]] == b[diff[0]])
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def test_automaton_against_brute_force():
    import random

    r = random.Random(3)
    terms = ["abcde", "bbacde", "eadcb", "aaaaa"]
    automaton = toxicity.Automaton(terms, [])
    words = ["".join(r.choice("abcde") for _ in range(r.randrange(3, 8))) for _ in range(4000)]
    for t in terms:
        words += [t, t[1:], t[0] + "x" + t[1:], t[1] + t[0] + t[2:], t[:-1] + "q"]
    for word in words:
        want = 0 if word in terms else 1 if any(distance_one(word, t) for t in terms) else None
        got = automaton.match(word)
        assert (got and got[1]) == want, word


def test_quotation_counts_less_than_abuse():
    scorer = toxicity.Scorer(toxicity.Model(["idiot"], [], [], {"idiot": 4.0}, -4.0, 2.0, 0.0))
    plain, quoted, said, wrong, clean = scorer.score(pa.array(["you idiot you", 'the word "idiot" is rude', "they said idiot twice", "you idoit you", "nothing here"]))
    assert plain > 0.9 and quoted < 0.5 and said < 0.5 and 0 < wrong < plain and clean == 0


ABUSE = ["trash", "pathetic", "idiot", "worthless", "disgusting", "clown", "stupid", "moron", "scum", "loser"]


def prose(r, *more):
    """Some 30 harmless words, and ``more`` among them."""
    words = ["".join(r.choice("bcdfghjklnpqrtvwxz") + r.choice("aeiou") for _ in range(r.randrange(3, 5))) for _ in range(30)]
    for m in more:
        words.insert(r.randrange(2, len(words) - 2), m)
    return " ".join(words)


def fitted(spark, toxic, harmless):
    texts = dict(enumerate([*toxic, *harmless]))
    labels = spark.createDataFrame([(i, int(i < len(toxic))) for i in texts], "doc_id long, y int")
    return toxicity.Scorer(toxicity.fit(docs(spark, texts), labels))


def abuse_and_prose(quoting=0):
    """150 toxic texts with three terms each, 300 harmless ones of which some quote a term."""
    import random

    r = random.Random(5)
    toxic = [prose(r, *r.sample(ABUSE, 3), *(r.choice(["trashy", "idiotic", "clownish", "moronic", "stupidly"]) for _ in range(2))) for _ in range(150)]
    return r, toxic, [prose(r, f'the word "{r.choice(ABUSE)}" is') if i < quoting else prose(r) for i in range(300)]


def test_misspellings_of_terms_that_have_stems(spark):
    r, toxic, harmless = abuse_and_prose()
    scorer = fitted(spark, toxic, harmless)
    wrong = ["trahs", "ptahetic", "idoit", "idot", "worhtless", "dsigusting", "clwon", "stpuid", "mroon", "scmu", "losser"]
    assert [w for w in wrong if scorer.match(w) is None] == []
    assert (scorer.score(pa.array([prose(r, w) for w in wrong])) >= toxicity.THRESHOLD).all()
    assert scorer.match("trash")[1] == 0 and scorer.match("trashes")[1] == 0


def test_a_term_and_a_stem_of_the_same_letters():
    automaton = toxicity.Automaton(["trash"], ["trash"])
    assert [automaton.match(w)[1] for w in ("trash", "trashy", "trahs")] == [0, 0, 1]


def test_terms_that_few_toxic_texts_have(spark):
    import random

    r = random.Random(6)
    terms = [f"{a}x{b}k{a}" for a in "qwzhjkmcsy" for b in "abcdefghijklmnopqrst"]
    toxic = [prose(r, terms[i % 200], terms[(i * 7 + 1) % 200]) for i in range(1200)]
    scorer = fitted(spark, toxic, [prose(r) for _ in range(1200)])
    assert set(terms) <= set(scorer.model.terms)
    assert (scorer.score(pa.array([prose(r, t) for t in terms])) >= toxicity.THRESHOLD).all()
    assert (scorer.score(pa.array([prose(r) for _ in range(200)])) < toxicity.THRESHOLD).mean() > 0.98


@pytest.mark.parametrize("quoting", [0, 100])
def test_fitted_model_tells_quotation_from_abuse(spark, quoting):
    r, toxic, harmless = abuse_and_prose(quoting)
    scorer = fitted(spark, toxic, harmless)
    assert set(ABUSE) <= set(scorer.model.terms)
    plain = scorer.score(pa.array([prose(r, t) for t in ABUSE]))
    quoted = scorer.score(pa.array([prose(r, f'"{t}"') for t in ABUSE]))
    wrong = scorer.score(pa.array([prose(r, f"they said {t}") for t in ("idoit", "mroon", "trahs")]))
    both = scorer.score(pa.array([prose(r, f'"{t}"', f"you {t}") for t in ABUSE]))
    assert (plain >= toxicity.THRESHOLD).all() and (both >= toxicity.THRESHOLD).all()
    assert (quoted < toxicity.THRESHOLD).all() and (wrong < toxicity.THRESHOLD).all()


def test_unquoted_words_are_those_that_no_window_marks():
    import random

    r = random.Random(7)
    parts = ["said", "the word", "idiot", '"', "'", "«", "»", "don't", "city", "é", ", ", "\n", "x" * 45, "@b"]
    for _ in range(3000):
        text = "".join(r.choice(parts) + r.choice(["", " "]) for _ in range(r.randrange(30)))
        want = [m[0] for m in toxicity.WORD.finditer(text) if not toxicity.quoted(text, m.start(), m.end())]
        assert toxicity.WORD.findall(toxicity.unquoted(text)) == want, text


# --- personal data ----------------------------------------------------------------------------------


def test_patterns_against_plain_ones():
    import random
    import re

    forms = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]

    def plain(text):
        for kind, form in enumerate(forms):
            for m in re.finditer(form, text):
                digits = re.sub("[^0-9]", "", m[0])
                good = (True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else False, 16 <= len(digits) <= 19 and pii.luhn(digits), 8 <= len(digits) <= 15)
                if good[kind]:
                    yield kind, m.start(), m.end()

    r = random.Random(4)
    for _ in range(5000):
        text = "".join(r.choice("ab1.2@+ ()-é90\n") for _ in range(r.randrange(40)))
        assert pii.pattern_spans(text) == list(plain(text)), text
    card = "4111 1111 1111 1111"
    assert pii.pattern_spans(f"é {card} x") == [(2, 2, 21)]
    assert pii.pattern_spans("1" * 200_000 + "a" * 200_000 + "+" + " " * 100_000 + "@") == []


def test_tagger_gradients():
    tagger = pii.Tagger(dtype=float)
    r = np.random.default_rng(1)
    x, y = r.integers(0, pii.CLASSES, (3, 7)), np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [5, 6, 6, 0, 7, 8, 0]])
    _, grads = tagger.gradients(x, y)
    for name, weights in tagger.p.items():
        at = tuple(int(r.integers(0, s)) for s in weights.shape)
        own = weights[at]
        losses = []
        for step in (1e-5, -1e-5):
            weights[at] = own + step
            losses.append(tagger.gradients(x, y)[0])
        weights[at] = own
        assert abs((losses[0] - losses[1]) / 2e-5 - grads[name][at]) < 1e-6


def test_reconciled_spans_do_not_overlap_and_score_most():
    spans = [(0, 0, 10, 5.0), (1, 8, 20, 6.0), (2, 20, 25, 1.0), (3, 0, 25, 9.0)]
    assert sum(s[3] for s in pii.reconcile(spans)) == 9.0
    assert pii.reconcile(spans[:3]) == [(1, 8, 20, 6.0), (2, 20, 25, 1.0)]
    assert pii.reconcile([]) == []


def test_personal_data_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(pii, "EPOCHS", 2)
    rows = awkward(spark).unionByName(awkward(spark, [(20, "mail a.b@c.de or +1 (555) 123-4567, 10.0.0.1", None, None, None), (21, "+" + "7" * 60_000 + "@x", None, None, None)]))
    got = {r.doc_id: r for r in pii.digests(pii.find(rows)).collect()}
    assert len(got) == len({*ALL_IDS, 20, 21})
    assert (got[20].n_email, got[20].n_ip, got[20].n_card, got[20].n_phone) == (1, 1, 0, 1)
    assert got[20].spans.startswith("email:5:13") and "phone:17:34" in got[20].spans
    assert got[1].spans == got[2].spans == "" and got[1].base_sha256 == pii.sha256_of([])
    assert pii.digests(pii.find(empty(spark))).count() == 0


def test_tagger_finds_spans_it_was_shown(spark):
    texts = docs(spark, {i: f"the and hello {i % 10}41.22.{i % 100}.7 there, mail bo{i}@site{i % 7}.org and so on" for i in range(150)})
    tagger = pii.train(texts)
    text = "then 80.14.200.31 went to al.x@host.net again"
    found = pii.added_spans(tagger, [text], [[]])[0]
    assert {text[a:b] for _, a, b in found} & {"80.14.200.31", "al.x@host.net"}


class _Runs:
    """A tagger that takes every run without white space for an address."""

    def decode(self, windows):
        blank, out = pii.classes(" ")[0], []
        for x in windows:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], (x != blank) & (x != 0), [0]])))
            out.append([(0, int(a), int(b), 9.0) for a, b in zip(edges[::2], edges[1::2])])
        return out


def test_spans_longer_than_a_window_are_put_together():
    address = "q1" * 60 + "@" + "w2" * 70 + ".com"
    for before in ("", "at ", "z " * 50):
        text = f"{before}{address} 1 and on"
        found = pii.added_spans(_Runs(), [text], [[]])[0]
        assert (0, len(before), len(before) + len(address)) in found
        assert len(found) == 1
    assert pii.joined_pieces([(0, 0, 50, 1.0)], [(0, 10, 50, 2.0), (1, 60, 70, 1.0), (1, 70, 90, 3.0), (1, 95, 99, 1.0)]) == [(1, 60, 90, 3.0), (1, 95, 99, 1.0)]


def test_more_than_two_hundred_languages(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:03d}": [f"{letters[i % 26]}{letters[i // 26]}{c}" for c in letters[:12]] for i in range(205)}
    rows = [(j * 205 + i, " ".join(w[j % 4 :]), lang, "s", 0) for i, (lang, w) in enumerate(words.items()) for j in range(4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = language.identify(table).collect()
    assert len({r.lang_pred for r in got}) == 205
    right = {r[0]: r[2] for r in rows}
    assert sum(r.lang_pred == right[r.doc_id] for r in got) >= 0.99 * len(got)


def test_language_ties_go_to_the_more_frequent(spark):
    rows = [(i, "same words", "b" if i % 3 else "a", "s", 0) for i in range(30)] + [(100 + i, "other", "d" if i % 2 else "c", "s", 0) for i in range(8)]
    learned = [r for r in rows if r[0] % 1 == 0]
    table = spark.createDataFrame(learned, "doc_id long, text string, lang string, source string, n_chars long")
    model = language.fit(table.select("text", "lang"))
    assert model.languages[0] == "b"
    found = {r.text: r.lang_pred for r in language._predicted(table.select("text"), model, ["text"], ("lang_pred", "score")).collect()}
    assert found == {"same words": "b", "other": "c"}
