"""Analyses, classifiers and evaluation against plain Python and stored results."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wordloom.functions.phrases import normalize_emotion, sentiment_code
from wordloom.operators import analytics as an
from wordloom.operators import bayes as nb
from wordloom.operators.bayes_ledger import BayesLedger
from wordloom.operators import evaluate as ev
from wordloom.operators import features, skew
from wordloom.operators.features import binary_terms, fit_tfidf
from wordloom.operators import tagging
from wordloom.operators import textprep as tp
from wordloom.operators.tagging import vote_in_texts, vote_per_sentence
from wordloom.plans.classify_queries import clean_evaluation
from wordloom.sources.schemas import LEXICON

# Stored results: words per length, mean and most frequent length.
STORED_WORDS = (
    {2: 3, 3: 29, 4: 139, 5: 348, 6: 213, 7: 164, 8: 143, 9: 97, 10: 71, 11: 44, 12: 31, 13: 11, 14: 9,
     15: 5, 16: 4, 17: 1, 18: 3, 22: 1}, 6.7621580547112465, 5)
STORED_LEMMAS = (
    {2: 3, 3: 14, 4: 56, 5: 117, 6: 69, 7: 38, 8: 26, 9: 13, 10: 9, 11: 3, 12: 4, 14: 2, 15: 1, 16: 1},
    5.876404494382022, 5)


def words(spark, *lengths):
    return spark.createDataFrame([("x" * n,) for n in lengths], "word STRING")


def test_length_ties_and_empty(spark):
    row = an.length_stats(words(spark, 3, 3, 5, 5, 8)).first()
    assert (row.words, row.avg_word_length, row.most_freq_length) == (5, 4.8, 3)
    row = an.length_stats(words(spark, 1).limit(0)).first()
    assert (row.words, row.avg_word_length, row.most_freq_length) == (0, None, None)


@pytest.mark.parametrize("counts, mean, mode", [STORED_WORDS, STORED_LEMMAS])
def test_stored_lengths(spark, counts, mean, mode):
    lengths = [n for n, k in counts.items() for _ in range(k)]
    row = an.length_stats(words(spark, *lengths)).first()
    assert (row.words, row.most_freq_length) == (len(lengths), mode)
    assert row.avg_word_length == pytest.approx(mean, abs=1e-12)


def test_histogram(spark):
    got = [tuple(r) for r in an.length_histogram(words(spark, 2, 3, 3, 4, 5)).orderBy("bin").collect()]
    assert got == [(0, 2.0, 3.0, 1), (1, 3.0, 4.0, 2), (2, 4.0, 5.0, 2)]
    assert [tuple(r) for r in an.length_histogram(words(spark, 4, 4)).collect()] == [(0, 4.0, 5.0, 2)]


def test_density(spark):
    lengths = [2, 3, 3, 7]
    mean = sum(lengths) / 4
    h = math.sqrt(sum((n - mean) ** 2 for n in lengths) / 3) * 4 ** -0.2
    for row in an.length_density(words(spark, *lengths), points=11).collect():
        assert row.x == pytest.approx(2 + 5 * row.point / 10)
        want = sum(math.exp(-(((row.x - n) / h) ** 2) / 2) for n in lengths) / (4 * h * math.sqrt(2 * math.pi))
        assert row.density == pytest.approx(want)


def lexicon(spark, *rows):
    return spark.createDataFrame(list(rows), LEXICON)


def test_totals_and_shares(spark):
    lex = lexicon(spark, ("a", [], 1, "N", "p"), ("b", [], 1, "N", None), ("c", [], 1, "V", "p"))
    none = spark.createDataFrame([], "peribahasa STRING")
    assert tuple(an.totals(lex, none).first()) == (3, 0)
    assert [tuple(r) for r in an.value_counts(lex, "Label").collect()] == [("p", 2), (None, 1)]
    assert {(r.POS, r.percent) for r in an.shares(lex, "POS").collect()} == {("N", 66.7), ("V", 33.3)}
    assert {(r.POS, r.weight) for r in an.cloud_weights(lex, "POS").collect()} == {("N", 1.0), ("V", 0.5)}


def test_stop_words_come_out_of_the_pool_only(spark):
    lex = lexicon(spark, *[(w, [], n, "", "") for w, n in (("a", 9), ("b", 8), ("c", 8), ("d", 1))])
    stop = spark.createDataFrame([("a",), ("c",), ("c",)], "word STRING")
    assert [r.word for r in an.top_words(lex, 3).collect()] == ["a", "b", "c"]
    assert [r.word for r in an.top_words_without(lex, stop, pool=3, n=15).collect()] == ["b"]


def test_morphology(spark):
    df = spark.createDataFrame(
        [("berlayar", "layar"), ("layar", "layar"), ("menyapu", "sapu"), ("buku-buku", "buku"), ("pinjaman", "pinjam ")],
        "word STRING, stem STRING")
    m = an.morphology(df)
    got = {r.word: (r.prefix, r.suffix, r.core_word) for r in m.collect()}
    assert got == {"berlayar": ("ber", "", "layar"), "layar": (None, None, "layar"), "menyapu": (None, None, "sapu"),
                   "buku-buku": ("", "-buku", "buku"), "pinjaman": (None, None, "pinjam")}
    assert [tuple(r) for r in an.prefix_counts(m).collect()] == [("ber", 1)]
    assert an.suffix_counts(m).isEmpty()


def test_overlap_and_coverage(spark):
    own = lexicon(spark, ("a", ["Satu, dua.", "tiga"], 1, "", ""), ("b", [" "], 3, "", ""), ("c", None, 2, "", ""))
    other = spark.createDataFrame([("a", ["dua dua empat"]), ("b", ["!"])], "word STRING, definitions ARRAY<STRING>")
    assert {(r.word, r.overlap) for r in an.definition_overlap(own, other).collect()} == {("a", 0.5), ("b", None)}
    assert tuple(an.coverage(own).first()) == (3, 1, pytest.approx(100 / 3))
    assert tuple(an.coverage(own.limit(0)).first()) == (0, 0, 0.0)
    assert [r.word for r in an.uncovered(own).collect()] == ["b", "c"]


def test_sentence_votes(spark):
    sentences = spark.createDataFrame([(1,), (2,), (3,)], "id INT")
    tokens = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "y"), (2, "y")], "id INT, word STRING")
    table = spark.createDataFrame([("x", "Happy"), ("y", "Fear")], "word STRING, label STRING")
    got = vote_per_sentence(tokens, table, ["id"], sentences)
    assert {(r.id, r.label) for r in got.collect()} == {(1, "fear"), (2, "fear"), (3, "neutral")}


VOTED = [
    (1, "Sad glad sad. glad!  -GLAD-sad? so-so"), (2, ""), (3, None), (4, " . a. - x. \u212aid \u00e9glad\u0130sad. --sad-- --"),
    (5, "glad glad... sad sad\nsad.\u00a0glad"), (7, ". ! ?  x"), (8, "kid kid kid glad"),
]
REPEATED = [(6, "glad glad. kid"), (6, "sad sad sad. glad glad"), (None, "glad"), (None, "kid. sad")]
MOODS = [("sad", "Low"), ("glad", "High"), ("kid", "high"), ("so-so", "Low"), ("glad-sad", "odd"), ("-sad-", "odd"), (None, "odd")]


def by_tokens(texts, table):
    keys = ["id", "sent_pos"]
    sentences = tp.sentence_rows(texts, "text", ["id"])
    return vote_per_sentence(tp.sentence_tokens(sentences, keys), table, keys, sentences)


@pytest.mark.parametrize("more", [[], [("sad", "High"), ("sad", None)]])  # one label for each word, or several
@pytest.mark.parametrize("rows", [VOTED, VOTED + REPEATED, []])
def test_votes_in_texts_are_those_of_tokens(spark, monkeypatch, rows, more):
    monkeypatch.setattr(tagging, "STRETCH", 40)
    texts = spark.createDataFrame(rows, "id INT, text STRING").coalesce(2)
    table = spark.createDataFrame(MOODS + more, "word STRING, label STRING")
    want = sorted(map(str, by_tokens(texts, table).collect()))
    got = vote_in_texts(texts, "text", "id", table)
    assert sorted(map(str, got.collect())) == want and bool(want) == bool(rows)
    assert got.columns == ["id", "sent_pos", "label"]
    monkeypatch.setattr(tagging, "TASK_WORDS", 2)
    assert sorted(map(str, vote_in_texts(texts, "text", "id", table).collect())) == want


def test_votes_in_texts_shuffle_nothing(spark):
    """Tokens of all texts went through two exchanges to be voted on."""
    texts = spark.createDataFrame(VOTED, "id INT, text STRING")
    table = spark.createDataFrame(MOODS, "word STRING, label STRING")
    plan = vote_in_texts(texts, "text", "id", table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_labels(spark):
    df = spark.createDataFrame([("positive",), ("negative",), ("neutral",), ("x",), (None,)], "v STRING")
    assert [r[0] for r in df.select(sentiment_code(F.col("v"))).collect()] == [1, -1, 0, None, None]
    emo = spark.createDataFrame([("sad",), ("angry",), ("love",)], "v STRING")
    assert [r[0] for r in emo.select(normalize_emotion(F.col("v"))).collect()] == ["sadness", "anger", "love"]
    rows = [("a", "1"), ("b", None), ("c", "n/a"), ("d", "-1.0"), (None, "1")]
    clean = clean_evaluation(spark.createDataFrame(rows, "word STRING, sentiment STRING"))
    assert {tuple(r) for r in clean.collect()} == {("a", 1), ("d", -1)}


TRAIN = [(1, "b", "x x y"), (2, "a", "y Z"), (3, "b", "x w"), (4, "c", "")]
TEST = [(10, "x y"), (11, "q q"), (12, "Z z y"), (13, None)]


def plain_bayes(vectors, labels, tests):
    classes = sorted(set(labels.values()))
    vocabulary = {t for v in vectors.values() for t in v}
    weight = {c: defaultdict(float) for c in classes}
    for doc, vector in vectors.items():
        for t, x in vector.items():
            weight[labels[doc]][t] += x
    result = {}
    for doc, vector in tests.items():
        scores = {}
        for c in classes:
            total = sum(weight[c].values()) + len(vocabulary)
            score = math.log(sum(v == c for v in labels.values()) / len(labels))
            score += sum(x * math.log((weight[c][t] + 1) / total) for t, x in vector.items() if t in vocabulary)
            scores[c] = round(score, 6)
        best = max(scores.values())
        result[doc] = (min(c for c in classes if scores[c] == best), pytest.approx(best, abs=2e-6))
    return result


def test_bayes_on_binary_terms(spark, folder):
    train = spark.createDataFrame(TRAIN, "id INT, label STRING, text STRING")
    docs = spark.createDataFrame(TEST, "id INT, text STRING")
    model = nb.train(train, binary_terms(train, "id", "text", "label"), "label", ["c", "b", "a"])
    model.save(folder)
    loaded = nb.BayesModel.load(spark, folder, ["a", "b", "c"])

    def bag(text):
        return {t: 1.0 for t in (text or "").lower().split()}

    want = plain_bayes({i: bag(t) for i, _, t in TRAIN}, {i: c for i, c, _ in TRAIN}, {i: bag(t) for i, t in TEST})
    for m in (model, loaded):
        got = nb.predict(m, docs, binary_terms(docs, "id", "text"), "id")
        assert {r.id: (r.predicted, r.score) for r in got.collect()} == want
    table = {(r.term, r.label): r.weight for r in nb.term_table(loaded).collect()}
    assert table[("x", "b")] == 2.0 and table[("x", "a")] == 0.0 and len(table) == 12


def test_tfidf(spark):
    texts = {1: "Aa bb aa, c", 2: "bb éa bb", 3: "", 4: None}
    docs = spark.createDataFrame(list(texts.items()), "id INT, text STRING")
    grams = {}
    for i, text in texts.items():
        tokens = re.findall(r"(?u)\b\w\w+\b", (text or "").lower())
        grams[i] = Counter(tokens + [" ".join(p) for p in zip(tokens, tokens[1:])])
    total = sum(grams.values(), Counter())
    chosen = sorted(total, key=lambda t: (-total[t], t))[:4]
    idf = {t: math.log((1 + len(texts)) / (1 + sum(t in g for g in grams.values()))) + 1 for t in chosen}
    want = {}
    for i, g in grams.items():
        raw = {t: g[t] * idf[t] for t in chosen if t in g}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        want |= {(i, t): pytest.approx(w / norm) for t, w in raw.items()}
    model = fit_tfidf(docs, "text", 4)
    got = {(r.id, r.term): r.x for r in model.weights(docs, "id", "text").collect()}
    assert got == want


def test_report(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] + [("b", "d")]
    df = spark.createDataFrame(pairs, "actual STRING, predicted STRING")
    counts = ev.confusion_counts(df, "actual", "predicted")
    assert tuple(ev.accuracy(counts).first()) == (8, 0.625)
    report = {r.label: (r.precision, r.recall, r.f1, r.support) for r in ev.class_report(counts).collect()}
    assert report["a"] == (0.75, 0.75, 0.75, 4)
    assert report["b"] == (pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert report["c"] == (0.0, 0.0, 0.0, 1) and report["d"] == (0.0, 0.0, 0.0, 0)
    assert report["macro avg"][0] == pytest.approx((0.75 + 2 / 3) / 4)
    assert report["weighted avg"][1] == pytest.approx(5 / 8)
    matrix = [tuple(r) for r in ev.confusion_matrix(counts, ["a", "b", "c", "d"]).collect()]
    assert matrix == [("a", 3, 1, 0, 0), ("b", 0, 2, 0, 1), ("c", 1, 0, 0, 0), ("d", 0, 0, 0, 0)]


def test_bayes_in_batches_is_bayes_on_all(spark, folder):
    """Three folded batches give the model of all documents; a replaced or withdrawn batch changes exactly its part."""
    rows = [(i, f"w{i % 7} w{i % 3} common", "abc"[i % 3] if i % 11 else "other") for i in range(60)]

    def learned(docs):
        return nb.train(docs, binary_terms(docs, "id", "text", "label"), "label", "abc")

    def told(model):
        table = {(r.term, r.label): (r.weight, round(r.log_prob, 9)) for r in nb.term_table(model).collect()}
        return table, {r.label_no: (r.docs, r.weight, r.vocabulary) for r in model.classes.collect()}

    frame = lambda keep: spark.createDataFrame([r for r in rows if keep(r[0])], "id INT, text STRING, label STRING")
    ledger = BayesLedger(spark, folder, "abc")

    def learn(batch, docs):
        ledger.learn(batch, docs, binary_terms(docs, "id", "text", "label"), "label")

    assert told(ledger.model()) == ({}, {})
    for batch in (2, 0, 1):
        learn(batch, frame(lambda i, b=batch: i % 3 == b))
    assert told(ledger.model()) == told(learned(frame(lambda i: True)))
    learn(1, frame(lambda i: i % 3 == 1 and i > 30))
    assert told(ledger.model()) == told(learned(frame(lambda i: i % 3 != 1 or i > 30)))
    ledger.withdraw(1)
    ledger.withdraw("never")
    want = learned(frame(lambda i: i % 3 != 1))
    assert told(ledger.model()) == told(want)
    docs = frame(lambda i: True)
    got = nb.predict(ledger.model(), docs, binary_terms(docs, "id", "text"), "id").collect()
    assert sorted(got) == sorted(nb.predict(want, docs, binary_terms(docs, "id", "text"), "id").collect())


def test_tfidf_is_counted_by_the_slice_and_weighed_without_a_shuffle(spark, monkeypatch):
    """Texts over the ends of slices give the counts of ``counted_terms``; nothing is gathered by document."""
    monkeypatch.setattr(features, "SLICE", 5)
    texts = ["aa bb aa bb cc", "bb", None, "", "x y", "cc dd " * 9, "Äö äö bb äö aa", "aa bb"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    counted = [tuple(r) for r in features.counted_terms(docs, "text", "id").collect()]
    n, df = Counter(), Counter()
    for _, term, tf in counted:
        n[term] += tf
        df[term] += 1
    top = sorted(n, key=lambda t: (-n[t], t))[:7]
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in top}
    want = {(i, t): tf * idf[t] for i, t, tf in counted if t in idf}
    weights = fit_tfidf(docs, "text", 7).weights(docs, "id", "text")
    assert "Exchange" not in weights._jdf.queryExecution().executedPlan().toString()
    got = {(r.id, r.term): r.x for r in weights.collect()}
    assert got.keys() == want.keys()
    for (i, t), x in got.items():
        assert abs(x - want[i, t] / math.sqrt(sum(w * w for (j, _), w in want.items() if j == i))) < 1e-12


def test_join_with_many_keys_sorts_no_left_rows(spark, folder, monkeypatch):
    """A right side of many keys is hashed; hot keys still meet all their rows, unknown ones none."""
    rows = [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)] + [(9999, "unknown"), (9998, None)]
    left = spark.createDataFrame(rows, "id INT, k STRING")
    left.where("k like 'k%' or k = 'hot'").groupBy("k").count().write.parquet(f"{folder}/right")
    right = spark.read.parquet(f"{folder}/right")
    want = sorted((i, k, n) for i, k in rows for n in [Counter(k for _, k in rows)[k]] if k and k != "unknown")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" not in plan(skew.hot_join(left, right, "k", "count", "id"))
    monkeypatch.setattr(skew, "MANY_KEYS", 10)
    got = skew.hot_join(left, right, "k", "count", "id")
    assert "ShuffledHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)
    assert sorted((r.id, r.k, r["count"]) for r in got.collect()) == want
