"""Extraction from pages, times, senses and phrases."""

import random
import re
import time
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from wordloom.functions import html as hx
from wordloom.functions.phrases import expand_abbreviations, normalize_phrase, short_description
from wordloom.functions.senses import numbered_senses
from wordloom.functions.times import parse_publish_time
from wordloom.operators import pages as pg
from wordloom.operators.records import newer_prefix
from wordloom.operators import spelling
from wordloom.operators.spelling import correct_texts, correct_words


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v STRING").select(column.alias("r")).first().r


ARTICLE = """<html><script>var t="<p>no</p>";</script>
<span class="d-inline-block mr-1">Judul &amp; berita</span>
<div class="article-meta mb-2 mb-lg-0 d-flex align-items-center">
 <span>oleh</span> <a href="/authors/ali">Ali Abu</a> - <a href="mailto:x">ali@x.my</a> Disember 21, 2024 @ 7:24pm </div>
<figcaption class="p-2">Gambar <b>hias</b></figcaption>
<div class="dable-content-wrapper"><div><p>Satu&nbsp;dua</p></div><p> </p>
 <div class="google-anno-skip google-anno-sc"><p>iklan</p></div><p>Tiga<br>empat</p></div>
<div><p>luar</p></div></html>"""


def test_article_fields(spark):
    rows = pg.extract_articles(
        spark.createDataFrame([("/a", ARTICLE), ("/b", "<html><p>x</p></html>")], "url STRING, html STRING")
    ).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.title, row.articleBrief, row.url) == ("Judul & berita", "Gambar hias", "/a")
    assert tuple(row.authorDetails) == ("Ali Abu", "/authors/ali", "ali@x.my")
    assert row.publishTime == "- Disember 21, 2024 @ 7:24pm"
    assert row.contents == ["Satu dua", "Tiga empat"]


def test_missing_fields_are_empty(spark):
    html = '<div class="article-meta mb-2 mb-lg-0 d-flex align-items-center">Dis 1, 2024 @ 1:00am</div>'
    row = pg.extract_articles(spark.createDataFrame([("/a", html)], "url STRING, html STRING")).first()
    assert (row.title, row.articleBrief, row.contents) == ("", "", [])
    assert tuple(row.authorDetails) == ("", "", "")
    assert row.publishTime == "Dis 1, 2024 @ 1:00am"


def test_unclosed_paragraphs_and_entities(spark):
    html = "<article><p>a<p><i>b</i> &#233;&#x;<script>x</p></script></article><footer>f</footer>"
    assert one(spark, hx.paragraphs(F.col("v")), html) == ["a", "b é&#x;"]
    assert one(spark, hx.text_of(F.col("v")), "&amp;lt; &lt;b&gt;") == "&lt; <b>"


def test_listing(spark):
    teaser = ('<div class="article-teaser x"><a class="d-flex article listing mb-3 pb-3" href="/{0}">t</a>'
              '<span class="created-ago"> {0} jam lalu </span></div>')
    hidden = '<div class="article-teaser d-block"><a href="/no">t</a></div>'
    rows = [(0, teaser.format(1) + hidden + teaser.format(2)), (1, teaser.format(2) + teaser.format(3)),
            (20, teaser.format(9))]
    got = pg.listing_items(spark.createDataFrame(rows, "page_no INT, html STRING")).orderBy("page_no", "pos")
    assert [(r.page_no, r.url, r.time_text) for r in got.collect()] == [
        (0, "/1", "1 jam lalu"), (0, "/2", "2 jam lalu"), (1, "/3", "3 jam lalu"), (20, "/9", "9 jam lalu")
    ]


def test_prefix_stops_at_first_older_item(spark):
    items = spark.createDataFrame(
        [("x", 1, 9), ("x", 2, 5), ("x", 3, 8), ("y", 1, 7), ("z", 1, 5)], "l STRING, rank INT, t INT"
    )
    got = newer_prefix(items, "l", "rank", "t", 5).orderBy("l", "rank").collect()
    assert [(r.l, r.rank) for r in got] == [("x", 1), ("y", 1)]


def test_publish_times(spark):
    cases = {
        "Dis 21, 2024 @ 7:24pm": datetime(2024, 12, 21, 19, 24),
        "Ogs 3, 2024 @ 12:05am": datetime(2024, 8, 3, 0, 5),
        "Disember 1, 2023 @ 11:59am": datetime(2023, 12, 1, 11, 59),
        "Foo 1, 2023 @ 11:59am": None,
        "sejam lalu": datetime(2024, 12, 21, 11, 30),
        "3 jam lalu": datetime(2024, 12, 21, 9, 30),
        "seminit lalu": datetime(2024, 12, 21, 12, 29),
        "12 minit lalu": datetime(2024, 12, 21, 12, 18),
        "tadi": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v STRING")
    parsed = parse_publish_time(F.col("v"), F.lit("2024-12-21 12:30:00").cast("timestamp"))
    got = df.select("v", parsed.cast("timestamp_ntz").alias("t")).collect()
    assert {r.v: r.t for r in got} == cases


def test_numbered_senses(spark):
    def senses(text):
        return one(spark, numbered_senses(F.col("v")), text)

    assert senses("Definisi : satu; dua") == ["satu"]
    assert senses("tiada") == []
    assert senses("x 1. a: b 2. c 1. d 4. e 3. f; g") == ["a", "c", "f"]
    assert senses("2. a 1. b 2. c") == []
    assert senses("1. a 1. b 2. c") == ["a", "c"]


DICTIONARY = """<div class="tab-pane fade">Definisi : yg baik; x</div>
<div class="active tab-pane">1. elok utk 2. molek: y</div>
<b>Bersinonim dengan</b> <a href="#"> indah </a>, <a>cantik</a> <b>Berantonim dengan</b><a>hodoh</a><b>z</b><a>no</a>"""


def test_dictionary_page(spark):
    pages = spark.createDataFrame([("elok", DICTIONARY), ("qq", "<b>tiada</b>")], "word STRING, html STRING")
    rows = pg.extract_dictionary(pages).collect()
    assert len(rows) == 1
    assert rows[0].meanings == ["yang baik", "elok untuk", "molek"]
    assert rows[0].synonym == ["indah", "cantik"]
    assert rows[0].antonym == ["hodoh"]


def test_wiki_page(spark):
    html = ("<h2>English</h2><ol><li>no</li></ol><h2><span>Bahasa Melayu</span></h2><p>x</p>"
            "<ol><li> satu <b>dua</b></li><li>tiga</li></ol><ol><li>no</li></ol>")
    pages = spark.createDataFrame([("a", html), ("b", "<h2>English</h2><ol><li>x</li></ol>")],
                                  "word STRING, html STRING")
    rows = pg.extract_wiki_senses(pages).collect()
    assert [(r.word, r.definitions) for r in rows] == [("a", ["satu dua", "tiga"])]


def test_proverb_tables(spark):
    html = ("<table><tr><th>P</th><th>M</th></tr><tr><td>Ada <b>gula</b>, ada-semut.</td><td> Di mana <i>ada</i> </td></tr>"
            "<tr><td>x</td></tr></table><table><tr><td>head</td><td>h</td></tr>"
            "<tr><td>Bagai\n aur</td><td>a&amp;b</td><td>c</td></tr></table>")
    rows = pg.extract_proverbs(spark.createDataFrame([(0, html)], "page_no INT, html STRING")).collect()
    assert [(r.peribahasa, r.meaning) for r in rows] == [
        ("ada gula adasemut", "Di manaada"), ("bagai aur", "a&b")
    ]


def test_phrases(spark):
    assert one(spark, normalize_phrase(F.col("v")), " Éa, ÉB!  c_1 ") == "éa éb c_1"
    assert one(spark, expand_abbreviations(F.col("v")), "Yg  yg ayg drpd, dll. dlm") == (
        "yang yang ayg daripada, dan lain-lain. dalam"
    )
    chained = expand_abbreviations(F.col("v"), {"a": "b", "b": "c"})
    assert one(spark, chained, "a b") == "c c"
    assert one(spark, short_description(F.col("v")), "Noun, thing, x") == "Noun"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_abbreviations_see_what_earlier_rules_wrote(spark):
    table = {"a": "b c", "b": "c$1", "c": "é x", "x_1": ""}
    made = random.Random(3)
    parts = ["a", "B", "c", "x", "x_1", "  ", "-", "é", ".", "9"]
    texts = ["".join(made.choices(parts, k=made.randint(0, 12))) for _ in range(500)] + [None]

    def plain(text):
        text = re.sub(r"\s+", " ", text.lower()).strip()
        for short, full in table.items():
            text = re.sub(rf"(?<!\w){short}(?!\w)", lambda _: full, text)
        return text

    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    for row in df.select("text", expand_abbreviations(F.col("text"), table).alias("got")).collect():
        assert row.got == (None if row.text is None else plain(row.text))
    with pytest.raises(ValueError, match="not a word"):
        expand_abbreviations(F.col("text"), {"k.p": "x"})


def test_deep_elements_take_linear_time(spark):
    n = 20_000
    page = '<div class="m">x' + "<div>y" * n + "</div>" * n + "z</div>w"
    df = spark.createDataFrame([(page,), ('<div class="m">a<div>b',), ("<p>",), (None,)], "html STRING")
    start = time.monotonic()
    got = [r[0] for r in df.select(hx.element(F.col("html"), "div", "m")).collect()]
    assert got == ["x" + "<div>y" * n + "</div>" * n + "z", "a<div>b", "", ""]
    assert time.monotonic() - start < 10


def test_spelling_against_brute_force(spark):
    import random

    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(400)}
    words |= {"", "x" * 40, "x" * 33, "x" * 31, "ab" * 16, "kapal", "kapla", "kpl"}
    for n in range(20, 62, 3):  # across the border between the two ways, up to three edits off
        long = "".join(rng.choice("abcdefgh") for _ in range(n))
        words.add(long)
        for _ in range(6):
            other = list(long)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(other))
                other[at : at + rng.randint(0, 1)] = rng.choice([[], ["q"], ["q", "r"]])
            words.add("".join(other))
    dictionary = {w: rng.randint(1, 5) for w in sorted(words) if w and rng.random() < 0.12}
    dictionary |= {w: rng.randint(1, 5) for w in sorted(words) if len(w) >= 20 and rng.random() < 0.3}
    dictionary |= {"kapal": 9, "x" * 32: 1, "y" * 40: 3}
    got = {
        r.word: (r.corrected, r.distance)
        for r in correct_words(
            spark.createDataFrame([(w,) for w in words], "word STRING"),
            spark.createDataFrame(list(dictionary.items()), "word STRING, count BIGINT"),
        ).collect()
    }
    assert set(got) == words
    for word in words:
        near = [t for t in dictionary if abs(len(t) - len(word)) <= 2]
        best = min(((edits(word, t), -dictionary[t], t) for t in near), default=(3,))
        want = (best[2], best[0]) if best[0] <= 2 else (word, None)
        assert got[word] == want, word


def test_texts_are_corrected_word_by_word(spark):
    texts = [(1, "Kapal kapla  besar"), (2, None), (3, " "), (4, "zzzzzz kpal")]
    dictionary = spark.createDataFrame([("kapal", 9), ("besar", 5)], "word STRING, count BIGINT")
    got = {r.id: r.text for r in correct_texts(spark.createDataFrame(texts, "id INT, text STRING"), "id", "text", dictionary).collect()}
    assert got == {1: "Kapal kapal besar", 2: None, 3: "", 4: "zzzzzz kapal"}


def test_skeletons_are_made_by_all_tasks_and_joined_without_sorting(spark):
    """A stored dictionary is one small file, its skeletons are not; the asked ones are probed, not sorted."""
    words = spark.createDataFrame([(f"w{i:03d}rd",) for i in range(200)], "word string").coalesce(1)
    dictionary = words.withColumn("rank", F.lit(1).cast("bigint"))
    met = spelling._nearest(words, dictionary, 2)
    assert spelling._spread(words).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert met.count() == 200
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortAggregate" not in plan


def test_nearest_words_by_distance_then_frequency_then_name(spark):
    """Matches are numbers; they order words as distance, frequency and name do, words without a count first."""
    dictionary = spark.createDataFrame([("abcde", 5), ("abcdf", 9), ("abcdg", 9), ("abxyf", 99), ("zzzzz", None), ("zzzzy", 7)], "word string, count bigint")
    words = spark.createDataFrame([("abcdh",), ("abxdf",), ("zzzzx",), ("abcde",), ("qqqqqqq",)], "word string")
    got = {r.word: (r.corrected, r.distance) for r in correct_words(words, dictionary).collect()}
    assert got == {"abcdh": ("abcdf", 1), "abxdf": ("abxyf", 1), "zzzzx": ("zzzzz", 1), "abcde": ("abcde", 0), "qqqqqqq": ("qqqqqqq", None)}
