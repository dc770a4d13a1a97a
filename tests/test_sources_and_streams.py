"""Files, message logs, run state, look-ups and streaming jobs."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wordloom.functions.lists import small_list
from wordloom.operators import lookup as lk
from wordloom.operators import textprep as tp
from wordloom.session import shared_folder, work_folder
from wordloom.sources import files as fs
from wordloom.sources import messages as ms
from wordloom.sources.schemas import EMOTION_SAMPLE, MESSAGE, QUERY_CATALOG, WORD_COUNT, WORD_SAMPLE
from wordloom.sources.state import RunMark, newer_than
from wordloom.streaming import jobs


def test_articles_and_counts(spark, folder):
    record = {"title": "t", "authorDetails": {"authName": "n", "relLink": "/n", "email": "e"}, "url": "/u",
              "publishTime": "x", "articleBrief": "b", "contents": ["p1", "p2"]}
    with open(f"{folder}/a.json", "w") as file:
        json.dump([record, {"url": "/v"}], file, indent=1)
    rows = fs.read_articles(spark, f"{folder}/a.json").orderBy("url").collect()
    assert rows[0].authorDetails.email == "e" and rows[0].contents == ["p1", "p2"]
    assert rows[1].title is None
    counts = spark.createDataFrame([("b", 2), ("a", 1)], WORD_COUNT)
    fs.write_word_counts(counts, f"{folder}/wc")
    assert [r.value for r in fs.read_text_parts(spark, f"{folder}/wc").collect()] == ["a\t1", "b\t2"]
    assert sorted(tuple(r) for r in fs.read_word_counts(spark, f"{folder}/wc").collect()) == [("a", 1), ("b", 2)]


def test_text_parts(spark, folder):
    df = spark.createDataFrame([("x",), ("y",)], "s STRING")
    fs.write_text(df, "s", f"{folder}/t", "overwrite")
    fs.write_text(df, "s", f"{folder}/t")
    with open(f"{folder}/t/other.txt", "w") as file:
        file.write("no\n")
    assert fs.read_text_parts(spark, f"{folder}/t").count() == 4
    names = [os.path.basename(r.path) for r in fs.part_files(spark, f"{folder}/t").collect()]
    assert names and all(n.startswith("part") for n in names)


def test_csv_checks(spark, folder):
    with open(f"{folder}/w.csv", "w") as file:
        file.write('word,sentiment,extra\n"a, b",1,z\nc,,z\n')
    rows = fs.read_csv(spark, f"{folder}/w.csv", WORD_SAMPLE, ("word", "sentiment")).collect()
    assert [tuple(r) for r in rows] == [("a, b", "1"), ("c", None)]
    with pytest.raises(ValueError, match="emotion"):
        fs.read_csv(spark, f"{folder}/w.csv", EMOTION_SAMPLE, ("emotion",))


def test_folder_of_csvs(spark, folder):
    os.mkdir(f"{folder}/c")
    with pytest.raises(ValueError):
        fs.read_labelled_csvs(spark, f"{folder}/c")
    with open(f"{folder}/c/A.csv", "w") as file:
        file.write("x,y\n1,2\n1,2\n")
    with open(f"{folder}/c/B.csv", "w") as file:
        file.write("y,z\n3,4\n")
    rows = fs.read_labelled_csvs(spark, f"{folder}/c").select("node_label", "x", "y", "z").collect()
    assert sorted(map(tuple, rows), key=str) == [("A", "1", "2", None), ("A", "1", "2", None), ("B", None, "3", "4")]
    assert {r.node_label for r in fs.read_labelled_csvs(spark, f"{folder}/c", "L").collect()} == {"L"}


def test_labelled_sentences(spark, folder):
    df = spark.createDataFrame([('say "a", b', "happy")], "cleaned_text STRING, label STRING")
    fs.write_labelled_sentences(df, f"{folder}/out")
    assert [tuple(r) for r in fs.read_labelled_sentences(spark, f"{folder}/out").collect()] == [('say "a", b', "happy")]


def test_missing_history_is_empty(spark, folder):
    df = fs.read_or_empty(spark, f"{folder}/none", WORD_COUNT)
    assert df.isEmpty() and df.columns == ["word", "count"]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == shared_folder(spark)
    assert named is None or folder == named.rstrip("/")
    assert work_folder(spark, "x").startswith(f"{folder}/x-")
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_small_list(spark):
    assert sorted(small_list(spark.range(3), "id", 3)) == [0, 1, 2]
    with pytest.raises(ValueError):
        small_list(spark.range(4), "id", 3)


def test_run_mark(spark, folder):
    mark = RunMark(spark, f"{folder}/mark")
    assert mark.current() is None
    mark.advance(datetime(2024, 1, 1), 60)
    mark.advance(datetime(2024, 2, 1), 60)
    last = mark.current()
    assert (last.since, last.proverbs_done) == (datetime(2024, 2, 1), 120)
    items = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-02-01'), (TIMESTAMP '2024-02-02') AS t(ts)")
    assert newer_than(items, "ts", F.lit("2024-02-01").cast("timestamp")).count() == 1


def log(spark, *rows):
    when = datetime(2024, 1, 1)
    return spark.createDataFrame([(t, 0, o, when, v) for t, o, v in rows], MESSAGE)


def test_log(spark, folder):
    ms.write_log(log(spark, ("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")), "json", f"{folder}/log")
    back = ms.read_log(spark, "json", f"{folder}/log")
    assert {(r.topic, r.value) for r in ms.latest_per_topic(back).collect()} == {("a", "z"), ("b", "q")}
    assert ms.latest_per_topic(back, ["topic", "partition"]).count() == 2
    assert ms.latest_per_topic(back.limit(0)).isEmpty()
    assert {(r.topic, r.value) for r in ms.first_n_per_topic(back, 2).collect()} == {
        ("a", "x"), ("a", "y"), ("b", "q")}
    row = ms.as_messages(spark.createDataFrame([(1, None)], "a INT, b STRING"), "t").first()
    assert tuple(row) == ("t", 0, '{"a":1}')


def test_latest_stream_resumes_and_replays(spark, folder):
    source, table = f"{folder}/log", f"{folder}/latest"

    def run(checkpoint):
        stream = ms.stream_log(spark, "json", source, maxFilesPerTrigger="1")
        jobs.keep_latest(stream, table, checkpoint).awaitTermination()
        return {(r.topic, r.value) for r in jobs.read_latest(spark, table, MESSAGE).collect()}

    log(spark, ("a", 1, "x"), ("b", 1, "q")).coalesce(1).write.mode("append").json(source)
    assert run(f"{folder}/cp") == {("a", "x"), ("b", "q")}
    log(spark, ("a", 2, '{"k":null}')).coalesce(1).write.mode("append").json(source)
    assert run(f"{folder}/cp") == {("a", '{"k":null}'), ("b", "q")}
    assert run(f"{folder}/cp") == {("a", '{"k":null}'), ("b", "q")}
    assert run(f"{folder}/cp-lost") == {("a", '{"k":null}'), ("b", "q")}


def test_stream_counts_equal_batch_counts(spark, folder):
    texts = [f"satu dua. {'tiga ' * n}" for n in range(12)]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    df.repartition(4).write.parquet(f"{folder}/in")

    def run(checkpoint):
        stream = spark.readStream.schema("text STRING").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        jobs.count_words(stream, "text", f"{folder}/ledger", checkpoint).awaitTermination()
        return {(r.word, r["count"]) for r in jobs.read_counts(spark, f"{folder}/ledger").collect()}

    batch = {(r.word, r["count"]) for r in tp.word_count(tp.text_tokens(df, "text")).collect()}
    assert run(f"{folder}/cp") == batch
    assert run(f"{folder}/cp") == batch
    assert run(f"{folder}/cp-lost") == batch


def test_stream_counts_survive_a_lost_checkpoint_and_other_batches(spark, folder):
    rows = [(f"u{n % 9}", f"satu dua. {'tiga ' * (n % 9)}") for n in range(12)]
    df = spark.createDataFrame(rows, "url STRING, text STRING")
    df.repartition(4).write.parquet(f"{folder}/in")

    def run(checkpoint, files):
        stream = spark.readStream.schema("url STRING, text STRING").option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
        jobs.count_words(stream, "text", f"{folder}/ledger", checkpoint, key="url").awaitTermination()
        return {(r.word, r["count"]) for r in jobs.read_counts(spark, f"{folder}/ledger").collect()}

    once = df.dropDuplicates(["url"])
    batch = {(r.word, r["count"]) for r in tp.word_count(tp.text_tokens(once, "text")).collect()}
    assert run(f"{folder}/cp", 1) == batch
    assert run(f"{folder}/cp-lost", 10) == batch
    assert run(f"{folder}/cp-lost-again", 2) == batch
    jobs.fold_counts(spark, f"{folder}/ledger")
    assert {(r.word, r["count"]) for r in jobs.read_counts(spark, f"{folder}/ledger").collect()} == batch
    df.limit(3).write.mode("append").parquet(f"{folder}/in")
    assert run(f"{folder}/cp-lost-again", 1) == batch
    jobs.fold_counts(spark, f"{folder}/ledger")
    assert run(f"{folder}/cp-lost-again", 1) == batch


def test_a_running_stream_is_stopped(spark, folder):
    spark.createDataFrame([("satu dua",)], "text STRING").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("text STRING").parquet(f"{folder}/in")
    query = jobs.count_words(stream, "text", f"{folder}/ledger", f"{folder}/cp", every="1 second")
    query.processAllAvailable()
    query.stop()
    assert jobs.read_counts(spark, f"{folder}/ledger").count() == 2


def test_the_mark_can_be_set_again(spark, folder):
    mark = RunMark(spark, f"{folder}/mark")
    mark.advance(datetime(2024, 1, 1), 5)
    mark.advance(datetime(2024, 2, 1), 7)
    mark.advance(datetime(2024, 2, 1), 7)
    assert (mark.current().run, mark.current().proverbs_done) == (1, 12)


def test_quoted_line_breaks(spark, folder):

    os.makedirs(f"{folder}/csv")
    with open(f"{folder}/csv/x.csv", "w") as out:
        out.write('word,note\na,"one\ntwo"\nb,three\n')
    got = {(r.word, r.note, r.node_label) for r in fs.read_labelled_csvs(spark, f"{folder}/csv").collect()}
    assert got == {("a", "one\ntwo", "x"), ("b", "three", "x")}


def test_many_csvs_are_one_scan_for_each_header(spark, folder):
    os.makedirs(f"{folder}/csv")
    for i in range(120):
        with open(f"{folder}/csv/f +{i}{' [x]' * (i == 2)}.csv", "w") as out:
            out.write(("a,b\n", "\n b,c\r\n", "a,b,d\n")[i % 3] + f"{i},1\n{i},1\n")
    with open(f"{folder}/csv/wrapped.csv", "w") as out:
        out.write('a,b\n7,"x ""y""\nz\n\n"\n8,w\n')
    with open(f"{folder}/csv/header.csv", "w") as out:
        out.write('a,"b\nc"\n5,6\n')
    open(f"{folder}/csv/empty.csv", "w").close()
    with open(f"{folder}/csv/broken.csv", "w") as out:
        out.write("a,b\n1,2\n")
    with open(f"{folder}/csv/.broken.csv.crc", "wb") as out:
        out.write(b"crc\x00\x00\x00\x02\x00" + b"\x01" * 4)  # a check sum that does not fit
    df = fs.read_labelled_csvs(spark, f"{folder}/csv")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 5
    rows = df.collect()
    assert len(rows) == 243 and len({r.node_label for r in rows}) == 122
    assert {(r.a, r.b) for r in rows if r.node_label == "wrapped"} == {("7", 'x "y"\nz\n\n'), ("8", "w")}
    assert [(r["a"], r["b\nc"]) for r in rows if r.node_label == "header"] == [("5", "6")]
    assert [r["d"] for r in rows if r.node_label == "f +2 [x]"] == [None, None]
    assert [path.rsplit("/", 1)[1] for path in fs.skipped_csvs(spark, f"{folder}/csv")] == ["broken.csv", "empty.csv"]


def test_a_large_csv_is_split(spark, folder):
    os.makedirs(f"{folder}/csv")
    with open(f"{folder}/csv/x.csv", "w") as out:
        out.write("word,note\n" + 'kata,"a ""b"", c"\n' * 20_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = fs.read_csv(spark, f"{folder}/csv", "word STRING, note STRING", ("word",))
        assert df.rdd.getNumPartitions() > 3
        assert [tuple(r) for r in df.groupBy("word", "note").count().collect()] == [("kata", 'a "b", c', 20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_search_and_proverbs(spark):
    lexicon = spark.createDataFrame([("kapal", ["d"], 3, "N", "p")],
                                    "word STRING, definitions ARRAY<STRING>, word_count BIGINT, POS STRING, Label STRING")
    proverbs = spark.createDataFrame([("ada gula", "m1"), ("nasi", "m2")], "peribahasa STRING, meaning STRING")
    terms = spark.createDataFrame([("\tKAPAL \n",), ("kapal",), ("Ada Gula",), ("zz",)], "term STRING")
    got = {(r.term, r.type, r.word_count, r.meaning) for r in lk.search(terms, lexicon, proverbs).collect()}
    assert got == {("kapal", "WORD", 3, None), ("ada gula", "PERIBAHASA", None, "m1")}
    asked = spark.createDataFrame([("ada gula",), ("nasi",), ("zz",), ("9x",)], "peribahasa STRING")
    assert {tuple(r) for r in lk.find_proverbs(asked, proverbs).collect()} == {
        ("ada gula", "m1"), ("nasi", "m2"), ("zz", lk.NOT_FOUND), ("9x", lk.BAD_LETTER)}


def test_query_catalogue(spark):
    old, use = datetime(2024, 1, 31), datetime(2024, 2, 1)
    catalog = spark.createDataFrame(
        [("a", "SELECT 1 AS n", old, old), ("b", "SELECT count(*) AS n FROM {words}", old, use),
         ("c", "SELECT 3", old, None), ("d", "SELECT 4", old, None)], QUERY_CATALOG)
    assert [r.name for r in lk.recent_first(catalog).collect()] == ["b", "a", "d", "c"]
    new = spark.createDataFrame([("a", "select 9"), ("x", "drop"), (" ", "SELECT 1")], "name STRING, query STRING")
    valid = lk.valid_queries(new)
    assert [r.name for r in valid.collect()] == ["a"]
    stored = {r.name: (r.query, r.last_used) for r in lk.store_queries(catalog, valid, "2024-03-01 00:00:00").collect()}
    assert stored["a"] == ("select 9", None) and len(stored) == 4
    rows, stamped = lk.run_stored(spark, catalog, 1, "2024-03-02 00:00:00", words=spark.range(7))
    assert rows.first().n == 7
    assert {r.name: r.last_used for r in stamped.collect()}["b"] == datetime(2024, 3, 2)
    with pytest.raises(IndexError):
        lk.run_stored(spark, catalog, 5, "2024-03-02 00:00:00")


def test_numbered_entries(spark):
    existing = spark.createDataFrame([(0, "q0"), (1, "q1")], "no BIGINT, query STRING")
    new = spark.createDataFrame([(5, "q1"), (6, "q7"), (7, "q"), (8, "q7")], "ord INT, query STRING")
    added = lk.append_numbered(existing, new, "ord")
    assert sorted(tuple(r) for r in added.collect()) == [(2, "q7"), (3, "q")]
    full = existing.unionByName(added)
    left = lk.remove_number(full, 1)
    assert sorted(tuple(r) for r in lk.numbered_list(left).collect()) == [(1, "q0"), (2, "q7"), (3, "q")]
    assert [r.query for r in lk.entry_at(left, 2).collect()] == ["q7"]
    assert lk.entry_at(left, 9).isEmpty()


def test_pages_of_ten(spark):
    df = spark.range(25).select(F.col("id"), F.col("id").cast("string").alias("name"),
                                F.repeat(F.lit("x"), (F.col("id") * 10).cast("int")).alias("query"))
    rows = lk.list_pages(df, "id").orderBy("no").collect()
    assert [r.page for r in rows] == [1] * 10 + [2] * 10 + [3] * 5
    empty = df.withColumn("id", F.when(F.col("id") < 8, F.col("id")))
    assert sorted(r.no for r in lk.list_pages(empty, "id").collect()) == list(range(1, 26))
    assert len(rows[10].query) == 100 and rows[11].query == "x" * 100 + "..."


def test_a_stream_ends_by_itself(spark, folder):
    """After so many messages, exactly, and after a time without any; each can be gone on from."""
    def send(first, last):
        rows = [("t", 0, i, datetime(2024, 1, 1), f"v{i}") for i in range(first, last)]
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").json(f"{folder}/log")

    def offsets(records=None):
        return [r.offset for r in jobs.read_consumed(spark, f"{folder}/rows", MESSAGE, records).orderBy("offset").collect()]

    def take(**ends):
        log = ms.stream_log(spark, "json", f"{folder}/log", maxFilesPerTrigger="1")
        return jobs.consume(log, f"{folder}/rows", f"{folder}/checkpoint", every="0 seconds", **ends)

    for first in (0, 10, 20, 30):
        send(first, first + 10)
    assert offsets() == []
    assert take(records=15) == 15 and offsets(15) == list(range(15))
    assert len(offsets()) >= 20  # the batch that was cut is kept whole
    assert take(records=15) == 15  # nothing is left to do
    assert take(records=33) == 33 and offsets(33) == list(range(33))
    assert take(idle=2) == 40 and offsets() == list(range(40))
    send(40, 45)
    assert take(records=1000, idle=2) == 45 and offsets(1000) == list(range(45))
    with pytest.raises(ValueError):
        take()


def test_stored_proverbs_are_read_by_half(spark, folder):
    proverbs = spark.createDataFrame([("ada gula", "m1"), ("nasi", "m2"), ("9x", "m3"), ("Buah", "m4")], "peribahasa STRING, meaning STRING")
    lk.store_proverbs(proverbs, f"{folder}/p")
    ask = lambda *names: spark.createDataFrame([(n,) for n in names], "peribahasa STRING")
    early = lk.stored_proverbs(spark, f"{folder}/p", ask("ada gula", "cuba", "9x"))
    assert sorted(r.peribahasa for r in early.collect()) == ["Buah", "ada gula"]
    plan = early._jdf.queryExecution().executedPlan().toString()
    assert "A-M" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "N-Z" not in plan
    for names in (("ada gula", "nasi", "zz", "9x"), ("zz",), ("9x",), ()):
        asked = ask(*names)
        got = lk.find_proverbs(asked, lk.stored_proverbs(spark, f"{folder}/p", asked)).collect()
        assert sorted(got) == sorted(lk.find_proverbs(asked, proverbs).collect())
