"""Lexicon tables, edges, the construction cycle and its replays."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.operators import edges as eg
from wordloom.operators import lexicon as lx
from wordloom.operators import records as rc
from wordloom.operators.numbering import number_rows, page_rows
from wordloom.operators.skew import hot_join
from wordloom.operators.tagging import tag_by_table, tag_words
from wordloom.plans import analyses
from wordloom.plans import cycle
from wordloom.sources.schemas import ARTICLE, DICTIONARY, LEXICON


def lex(spark, *rows):
    return spark.createDataFrame([(w, [], n, p, "") for w, n, p in rows], LEXICON)


def as_map(df):
    return {r.word: (r.word_count, r.POS) for r in df.collect()}


def test_upsert_adds_counts_and_keeps_attributes(spark):
    old, new = lex(spark, ("a", 2, "N"), ("b", 0, "V")), lex(spark, ("a", 3, "X"), ("c", 4, "Y"))
    assert as_map(lx.upsert_counts(old, new)) == {"a": (5, "N"), "b": (0, "V"), "c": (4, "Y")}
    assert as_map(lx.insert_if_absent(old, new, "word")) == {"a": (2, "N"), "b": (0, "V"), "c": (4, "Y")}
    assert lx.append_nodes(old, new).count() == 4


def test_dedup_and_history(spark):
    rows = [(1, "u"), (2, "u"), (3, None), (4, None), (5, "w")]
    df = spark.createDataFrame(rows, "id INT, url STRING")
    kept = rc.first_per_key(df, "url", F.col("id"))
    assert sorted(r.id for r in kept.collect()) == [1, 3, 5]
    history = spark.createDataFrame([("w",), (None,)], "url STRING")
    assert sorted(r.id for r in rc.not_yet_processed(kept, history, "url").collect()) == [1, 3]


def test_majority(spark):
    votes = {
        "same": ["neutral", "neutral"], "odd": ["unknown"], "more": ["positive", "positive", "negative"],
        "less": ["negative", "neutral"], "tie": ["positive", "negative"], "calm": ["neutral", "unknown"],
    }
    df = spark.createDataFrame([(w, v) for w, vs in votes.items() for v in vs], "word STRING, label STRING")
    got = {r.word: r.label for r in lx.majority_label(df).collect()}
    assert got == {"same": "neutral", "odd": "unknown", "more": "positive", "less": "negative",
                   "tie": "negative", "calm": "neutral"}


def test_update_and_clear(spark):
    df = lex(spark, ("a", 1, "N"), ("b", 2, "V"))
    changed = lx.update_where(df, "word", "a", {"POS": "Z", "note": "seen"})
    assert {(r.word, r.POS, r.note) for r in changed.collect()} == {("a", "Z", "seen"), ("b", "V", None)}
    empty = lx.emptied(df)
    assert empty.schema == df.schema and empty.isEmpty()


def test_edge_sets_and_multisets(spark):
    node = spark.createDataFrame([("WORD", "a"), ("WORD", "b"), ("WORD", "b")], "type STRING, id STRING")
    row = ("R", "WORD", "a", "WORD", "b")
    asked = spark.createDataFrame([row, row, ("R", "WORD", "a", "WORD", "zz")],
                                  "rel STRING, src_type STRING, src STRING, dst_type STRING, dst STRING")
    assert [tuple(r) for r in eg.valid_edges(asked, node).collect()] == [row]
    assert [tuple(r) for r in eg.multiset_edges(asked, node).collect()] == [row + (4,)]


def test_hot_join_keeps_every_row(spark):
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 2000)).alias("key")
    )
    right = left.groupBy("key").agg(F.count("*").alias("n")).withColumn("v", F.length("key"))
    plain = left.join(right, "key").select("id", "key", "n", "v")
    spread = hot_join(left, right, "key", "n", "id").select("id", "key", "n", "v")
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))
    assert spread.count() == 3000


@pytest.mark.parametrize("rows", [1, 10, 1000])
def test_numbering(spark, rows):
    df = spark.range(rows).select((F.col("id") * F.col("id")).alias("k")).repartition(5)
    got = number_rows(df, "k").orderBy("k").collect()
    assert [r.no for r in got] == list(range(1, rows + 1))
    assert number_rows(df.limit(0), "k").count() == 0
    crowded = df.select(F.when(F.col("k") < 100, F.col("k")).otherwise(F.col("k") + 2**52).alias("k"))
    got = number_rows(crowded, "k", first=0).orderBy("k").collect()
    assert [r.no for r in got] == list(range(rows))


def test_page_rows(spark):
    got = page_rows(spark.range(100).repartition(4), "id", 60, 30).collect()
    assert [r.id for r in got] == list(range(60, 90))


def test_tagger_runs_once_per_task(spark):
    words = spark.createDataFrame([("a",), ("bb",)], "word STRING")

    def make():
        return lambda batch: batch.assign(n=batch["word"].str.len())

    got = tag_words(words, make, "word STRING, n LONG")
    assert {(r.word, r.n) for r in got.collect()} == {("a", 1), ("bb", 2)}
    tags = spark.createDataFrame([("a", "X")], "word STRING, tag STRING")
    assert {(r.word, r.tag) for r in tag_by_table(words, tags).collect()} == {("a", "X"), ("bb", None)}


def article(url, body, title="T"):
    return (title, ("A", "/a", "e"), "Dis 1, 2024 @ 1:00am", "brief - Foto x", [body], url)


def counts_of(store):
    return {r.word: r["count"] for r in store.word_counts().collect()}


BATCHES = {
    "1": [article("/1", "kapal besar. kapal"), article("/1", "kapal besar. kapal"), article("/2", "ombak")],
    "2": [article("/2", "ombak"), article("/3", "kapal-kapal layar!")],
}


def test_replays_change_nothing(spark, folder):
    store = cycle.Store(spark, folder)
    frames = {b: spark.createDataFrame(rows, ARTICLE) for b, rows in BATCHES.items()}
    assert counts_of(store) == {}
    for batch, df in frames.items():
        assert cycle.load_batch(store, df, batch)
    first = counts_of(store)
    assert first == {"kapal": 2, "besar": 1, "ombak": 1, "kapal-kapal": 1, "layar": 1, "brief": 3}
    for batch in ("2", "1", "2"):
        cycle.load_batch(store, frames[batch], batch)
    assert counts_of(store) == first
    assert store.articles().count() == 3
    assert not cycle.load_batch(store, frames["1"].limit(0), "9")
    assert not cycle.load_batch(store, frames["1"], "8")
    assert counts_of(store) == first
    one = cycle.Store(spark, folder + "/one")
    cycle.load_batch(one, frames["1"].unionByName(frames["2"]), "all")
    assert counts_of(one) == first
    store.clear()
    assert counts_of(store) == {} and store.articles().isEmpty()


def test_lexicon_and_analyses(spark):
    counts = spark.createDataFrame([("berlayar", 4), ("layar", 2), ("zz", 9)], "word STRING, count BIGINT")
    dictionary = spark.createDataFrame(
        [("berlayar", ["belayar"], ["belayar", "belayar", "qq"], []), ("layar", ["kain"], [], ["berlayar"]),
         ("belayar", [" "], [], []), ("angin", ["udara"], [], [])], DICTIONARY)
    tags = spark.createDataFrame(
        [("berlayar", "layar", "Verb", "neutral"), ("layar", "layar", "Noun", "positive")],
        "word STRING, base STRING, POS STRING, Label STRING")
    proverbs = spark.createDataFrame(
        [("layar tak berangin", "m2", 2), ("layar tak berangin", "m1", 1), ("angin angin", "m3", 3)],
        "peribahasa STRING, meaning STRING, ord INT")
    lexicon = cycle.build_lexicon(counts, dictionary, tags, proverbs)
    assert as_map(lexicon.words) == {"berlayar": (4, "Verb"), "layar": (2, "Noun"), "belayar": (0, ""), "angin": (0, "")}
    assert {tuple(r) for r in lexicon.proverbs.collect()} == {("layar tak berangin", "m1"), ("angin angin", "m3")}
    assert Counter((r.rel, r.src, r.dst) for r in lexicon.edges.collect()) == Counter([
        ("LEMMATIZED", "berlayar", "layar"), ("LEMMATIZED", "layar", "layar"),
        ("SYNONYM_OF", "berlayar", "belayar"), ("ANTONYM_OF", "layar", "berlayar"),
        ("HAS_WORD", "layar tak berangin", "layar"), ("HAS_WORD", "angin angin", "angin"),
    ])
    stems = lexicon.words.select("word", F.lit("layar").alias("stem"))
    stop = spark.createDataFrame([("layar",)], "word STRING")
    tables = analyses.analysis_tables(lexicon, stems, stop)
    messages = {}
    for row in analyses.analysis_messages(tables).collect():
        messages.setdefault(row.topic, []).append(row.value)
    assert messages.pop("intrinsic_uncovered")
    assert len(messages) == 9
    assert messages["lexicon_analysis"] == ['{"totalWords":4,"totalPeri":2}']
    assert messages["lemma_length_analysis"] == [
        '{"words":1,"avg_word_length":5.0,"most_freq_length":5,"word_lengths":[{"length":5,"n":1}]}'
    ]
    assert messages["word_freq_without_stopwords"][0] == '{"word":"berlayar","count":4}'
    assert messages["intrinsic_coverage"] == ['{"TotalWords":4,"CoveredWords":3,"CoverPercentage":75.0}']
