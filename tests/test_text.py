"""Text expressions and word counting: article chain and edge cases."""

import re
import time
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.operators import textprep as tp
from wordloom.operators.features import counted_terms
from wordloom.sources import schemas


def one(spark, column, value, schema="v STRING"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("r")).first().r


def words_of(spark, df):
    return Counter(r.word for r in tp.text_tokens(df, "text").collect())


def test_caption_cut(spark):
    text = "a - Foto x tergesa-gesa\nkini baik-baik"
    assert one(spark, tx.strip_caption(F.col("v")), text) == "a\nkini baik"
    assert one(spark, tx.strip_caption(F.col("v"), strict=True), "baik-baik - Foto x\ny") == "baik-baik"


def test_flatten_skips_nulls(spark):
    assert one(spark, tx.flatten(F.col("v")), ["a", None, "b"], "v ARRAY<STRING>") == "a b"
    assert one(spark, tx.flatten(F.col("v")), None, "v ARRAY<STRING>") == ""


def test_clean_sentence(spark):
    assert one(spark, tx.clean_sentence(F.col("v")), " PRU-14 (Éa), x2  y. ") == "PRU- a x y"
    assert one(spark, tx.clean_sentence(F.col("v"), keep_unicode=True), "Éa, b2") == "Éa b"
    assert one(spark, tx.clean_sentence(F.col("v")), "12. !") == ""


def test_hyphens(spark):
    df = spark.createDataFrame([("--a -ab cd- - -- --- x kupu-kupu --xy",)], "text STRING")
    assert words_of(spark, df) == Counter(["-a", "ab", "cd", "kupu-kupu", "-xy"])


def test_null_and_empty_text(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "...")], "id INT, text STRING")
    assert tp.sentence_rows(df, "text", ["id"]).count() == 0
    assert tp.text_tokens(df, "text").count() == 0


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab -.!?É1\n", max_size=40), min_size=1, max_size=5))
def test_tokens_follow_the_plain_rule(spark, texts):
    """Sentence by sentence in plain Python, whole texts at once in Spark."""
    want = Counter()
    for text in texts:
        for sentence in re.split(r"(?<=[.!?]) +", text):
            clean = re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z-]", " ", sentence).strip())
            for word in clean.split():
                word = re.sub(r"(^-|-$)", "", word).lower()
                if len(word) > 1:
                    want[word] += 1
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    assert words_of(spark, df) == want
    stepwise = tp.sentence_tokens(tp.sentence_rows(df, "text", []), [])
    assert Counter(r.word for r in stepwise.collect()) == want


def test_token_multiset_ignores_partitioning(spark):
    df = spark.range(200).select(F.concat(F.lit("aa b"), F.col("id"), F.lit(". cc-dd ee")).alias("text"))
    assert words_of(spark, df.repartition(1)) == words_of(spark, df.repartition(7))


def test_content_words(spark):
    r = one(spark, tp.content_words(F.col("v"), ["the"]), "The  cat's, the\nmat 9!")
    assert r == ["cats", "mat"]


ARTICLE = (
    "Harga naik? Kerajaan jawab - 'tidak'",
    ("Ali", "/ali", "ali@x.my"),
    "Disember 21, 2024 @ 7:24pm",
    "Menteri di sidang media. - Foto fail",
    ["KUALA: Harga beras naik 5%. Kenapa?  ", "\"Kes PRU-14 itu tergesa-gesa!\" katanya -- di sini. "],
    "/berita/1",
)


def test_article_to_words(spark):
    articles = spark.createDataFrame([ARTICLE], schemas.ARTICLE)
    rows = tp.sentence_rows(tp.article_texts(articles), "text", ["url", "part"])
    assert [r.sentence for r in rows.orderBy("part", "sent_pos").collect()] == [
        "KUALA Harga beras naik", "Kenapa", "Kes PRU- itu tergesa-gesa katanya -- di sini",
        "Menteri di sidang media", "Harga naik", "Kerajaan jawab - tidak",
    ]
    counted = {r.word: r["count"] for r in tp.word_count(tp.text_tokens(rows, "sentence")).collect()}
    assert counted == {
        "kuala": 1, "harga": 2, "beras": 1, "naik": 2, "kenapa": 1, "kes": 1, "pru": 1, "itu": 1,
        "tergesa-gesa": 1, "katanya": 1, "di": 2, "sini": 1, "menteri": 1, "sidang": 1, "media": 1,
        "kerajaan": 1, "jawab": 1, "tidak": 1,
    }
    in_order = tp.sentence_tokens(rows, ["url", "part", "sent_pos"]).where("part = 'title'")
    assert [r.word for r in in_order.orderBy("sent_pos", "word_pos").collect()] == [
        "harga", "naik", "kerajaan", "jawab", "tidak"]


def test_terms_of_a_long_text_take_linear_time(spark):
    """20,000 different words; the work of a text once grew with the cube of its length."""
    words = [f"w{i:05d}" for i in range(20_000)] + ["w00000", "w00001"]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, ""), (3, None), (4, "one"), (5, "ab ab ab")], "id INT, text STRING")
    start = time.perf_counter()
    rows = counted_terms(docs, "text", "id").collect()
    assert time.perf_counter() - start < 60
    long = {r.term: r.tf for r in rows if r.id == 1}
    assert len(long) == 20_000 + 20_000 and long["w00000"] == 2 and long["w00000 w00001"] == 2
    assert {(r.id, r.term, r.tf) for r in rows if r.id > 1} == {(4, "one", 1), (5, "ab", 3), (5, "ab ab", 2)}
