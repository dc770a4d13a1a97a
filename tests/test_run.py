"""Runs of the whole cycle: failures at every step, replays, buckets and the url history."""

import glob
import os
from collections import Counter
from datetime import datetime

import pytest

from wordloom.operators import lexicon as lx
from wordloom.operators.buckets import BucketTable
from wordloom.plans import run as rn
from wordloom.sources.history import History
from wordloom.sources.manifest import Manifest
from wordloom.sources.schemas import DICTIONARY, LEXICON

FIRST, SECOND, THIRD = (datetime(2024, 12, d, 6, 0) for d in (20, 22, 24))
STEPS = ["articles", "urls", "sentences", "ledger", "words", "proverbs", "derived", "edges", "article_nodes", "author_nodes",
         "mentions", "messages"]


def page(url, title, body, day=21, author="Ali"):
    html = (
        f'<span class="d-inline-block mr-1">{title}</span><div class="article-meta mb-2 mb-lg-0 d-flex align-items-center">'
        f'<a href="/a/{author}">{author}</a> <a href="m">{author}@x</a><span>-</span> Disember {day}, 2024 @ 7:24pm</div>'
        f'<figcaption class="p-2">brief kapal</figcaption><div class="dable-content-wrapper"><p>{body}</p></div>')
    return url, html


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "url STRING, html STRING")


@pytest.fixture(scope="module")
def known(spark):
    return rn.Knowledge(
        spark.createDataFrame([("kapal", ["vessel"], ["bahtera", "qq"], []), ("berlayar", ["sail"], [], ["layar"]), ("layar", ["cloth"], [], []),
                               ("bahtera", ["ark"], [], []), ("angin", ["wind"], [], []), ("ombak", ["wave"], [], [])], DICTIONARY),
        spark.createDataFrame([("berlayar", "layar", "Verb", "neutral"), ("kapal", "kapal", "Noun", "positive")],
                              "word STRING, base STRING, POS STRING, Label STRING"),
        spark.createDataFrame([(f"layar angin {i}", f"m{i}", i) for i in range(5)], "peribahasa STRING, meaning STRING, ord INT"),
        spark.createDataFrame([("kapal",)], "word STRING"))


def crawls(spark):
    return {
        FIRST: pages(spark, page("/1", "T1", "kapal berlayar. kapal", 19), page("/1", "T1", "kapal berlayar. kapal", 19)),
        SECOND: pages(spark, page("/1", "T1", "kapal berlayar. kapal", 21), page("/2", "T2", "ombak besar dan kapal", 21, "Abu"),
                      page("/0", "T0", "ombak lama", 1)),
    }


def content(snapshot):
    """Everything a reader sees."""
    flat = lambda df: Counter(str(r) for r in df.select(*sorted(df.columns)).collect())
    return {**{n: flat(snapshot.grows(n)) for n in rn.GROWING}, **{n: flat(snapshot.table(n).read()) for n in rn.BUCKETED},
            "messages": flat(snapshot.messages()), "mark": (snapshot.run, snapshot.since, snapshot.proverbs_done)}


class Broken(Exception):
    pass


def take(spark, root, known, at, **options):
    return rn.run_cycle(spark, root, crawls(spark)[at], at, known, 2, 8, **options)


@pytest.fixture(scope="module")
def plain(spark, known, tmp_path_factory):
    """A store after two unbroken runs, and the steps the first one told of."""
    root, seen = str(tmp_path_factory.mktemp("plain")), []
    assert content(rn.open_store(spark, root))["mark"] == (-1, None, 0)
    assert take(spark, root, known, FIRST, watch=seen.append) and take(spark, root, known, SECOND)
    return rn.open_store(spark, root), seen


@pytest.mark.parametrize("steps", [STEPS[:5], STEPS[5:8], STEPS[8:10], STEPS[10:]], ids=["first", "second", "third", "fourth"])
def test_runs_survive_a_failure_after_every_step(spark, folder, known, plain, steps):
    """Readers see the run before until the manifest is replaced; the repeated run ends as an unbroken one."""
    assert take(spark, folder, known, FIRST)
    before = content(rn.open_store(spark, folder))
    for step in steps:
        def fail(name, step=step):
            if name == step:
                raise Broken

        with pytest.raises(Broken):
            take(spark, folder, known, SECOND, watch=fail)
    assert content(rn.open_store(spark, folder)) == before
    assert take(spark, folder, known, SECOND)
    after = content(plain[0])
    assert content(rn.open_store(spark, folder)) == after
    assert not take(spark, folder, known, SECOND) and rn.open_store(spark, folder).run == 1


def test_a_run_fills_all_tables(plain):
    store, seen = plain
    assert seen == [*STEPS, "manifest"]
    assert (store.run, store.since, store.proverbs_done) == (1, SECOND.isoformat(), 4)
    assert {r.url for r in store.grows("articles").collect()} == {"/1", "/2"}  # /0 is older than the mark
    words = {r.word: r.word_count for r in store.table("words").read().collect()}
    assert words == {"kapal": 5, "berlayar": 1, "layar": 0, "bahtera": 0, "ombak": 1, "angin": 0}
    assert {(r.src, r.dst) for r in store.grows("mentions").collect()} == {
        ("kapal", "/1"), ("berlayar", "/1"), ("kapal", "/2"), ("ombak", "/2")}
    edges = {(r.rel, r.src, r.dst) for r in store.table("edges").read().collect()}
    assert {("LEMMATIZED", "berlayar", "layar"), ("SYNONYM_OF", "kapal", "bahtera"), ("ANTONYM_OF", "berlayar", "layar"),
            ("HAS_WORD", "layar angin 3", "angin")} <= edges
    assert {r.name for r in store.table("author_nodes").read().collect()} == {"Ali", "Abu"}
    topics = {r.topic: r.value for r in store.messages().collect()}
    assert topics["lexicon_analysis"] == '{"totalWords":6,"totalPeri":4}'


def test_a_crawl_without_news_keeps_the_mark(spark, folder, known):
    assert rn.run_cycle(spark, folder, crawls(spark)[FIRST], FIRST, known)
    assert not rn.run_cycle(spark, folder, crawls(spark)[FIRST], THIRD, known)
    assert not rn.run_cycle(spark, folder, crawls(spark)[FIRST].limit(0), THIRD, known)
    assert rn.open_store(spark, folder).since == FIRST.isoformat()


def test_an_abandoned_run_hides_no_urls(spark, folder, known):
    """A run that failed after its urls were noted, followed by another crawl, loses none of them."""
    def fail(name):
        if name == "urls":
            raise Broken

    with pytest.raises(Broken):
        rn.run_cycle(spark, folder, crawls(spark)[FIRST], FIRST, known, watch=fail)
    assert rn.run_cycle(spark, folder, crawls(spark)[SECOND], SECOND, known)
    assert {r.url for r in rn.open_store(spark, folder).grows("articles").collect()} == {"/0", "/1", "/2"}


def files(folder):
    return {os.path.relpath(f, folder) for f in glob.glob(f"{folder}/**/part-*", recursive=True)}


def test_upsert_touches_the_buckets_that_are_hit(spark, folder):
    table = BucketTable(spark, LEXICON, ("word",), 16)
    rows = [(f"w{i}", [], 1, "N", "") for i in range(200)]
    first = table.upsert(spark.createDataFrame(rows, LEXICON), lx.upsert_counts, f"{folder}/run-0")
    assert set(first.paths) == {str(b) for b in range(16)} and first.read().count() == 200
    before = files(f"{folder}/run-0")
    new = spark.createDataFrame([("w3", [], 5, "X", ""), ("zz", [], 2, "V", "")], LEXICON)
    hit = {r[0] for r in new.select(first.bucket()).collect()}
    second = first.upsert(new, lx.upsert_counts, f"{folder}/run-1")
    assert {b for b in second.paths if second.paths[b] != first.paths[b]} == hit
    assert {f.split("/")[0] for f in files(f"{folder}/run-1")} == {f"_bucket={b}" for b in hit}
    assert files(f"{folder}/run-0") == before
    got = {r.word: (r.word_count, r.POS) for r in second.read().collect()}
    assert got == {**{f"w{i}": (1, "N") for i in range(200)}, "w3": (6, "N"), "zz": (2, "V")}
    again = first.upsert(new, lx.upsert_counts, f"{folder}/run-1")  # said again: the same table
    assert {r.word: (r.word_count, r.POS) for r in again.read().collect()} == got
    assert first.read().count() == 200  # who has the old table reads the old rows
    assert table.upsert(new.limit(0), lx.upsert_counts, f"{folder}/run-2") == table


def test_history_is_not_shuffled(spark, folder):
    history = History(spark, folder, "urls_of_a_test", buckets=8)
    keys = lambda *urls: spark.createDataFrame([(u, 1) for u in urls], "url STRING, n INT")
    assert {r.url for r in history.unseen(keys("a", None), []).collect()} == {"a", None}
    for batch in range(3):
        history.record(keys(*[f"/{batch}/{i}" for i in range(50)], None), str(batch))
    history.record(keys(*[f"/1/{i}" for i in range(50)]), "1")  # replaced by the same
    fresh = history.unseen(keys("/0/7", "/1/3", "/2/9", "/3/0", None), ["0", "1"])
    assert {r.url for r in fresh.collect()} == {"/2/9", "/3/0", None}
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 8 out of 8" in plan and " IN (0,1)" in plan
    spark.sql("DROP TABLE urls_of_a_test")
    assert History(spark, folder, "urls_of_a_test", buckets=8).keys().count() == 150  # another session finds the batches
    spark.sql("DROP TABLE urls_of_a_test")


def test_manifest_is_replaced_as_a_whole(spark, folder):
    manifest = Manifest(spark, f"{folder}/m.json")
    assert manifest.read() is None
    manifest.replace({"a": 1})
    manifest.replace({"a": 2, "é": [1]})
    assert manifest.read() == {"a": 2, "é": [1]}
    assert [f for f in os.listdir(folder) if not f.startswith(".")] == ["m.json"]
