"""Lexical search, hard negatives and repeated bytes against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import documents, edges, prose
from oracle_check import compare, connect
from pyspark.sql import functions as F

from wordloom.llm import hard_negatives, lexical_search, oracles, queries, repeated_bytes

SF = "/root/testdata/sf0.001"
PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.mark.parametrize("name", ["op11_stratum_search", "op12_box_negatives"])
def test_matches_sql(spark, name):
    assert compare(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLES[name])[0] == ""


# -- repeated bytes -------------------------------------------------------------------------

def plain_removal(rows, span=100):
    """Kept bytes and number of removed runs of each document, by a table of all strings."""
    seen, out = set(), []
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - span + 1):
            string = data[at : at + span]
            if string in seen:
                gone[at : at + span] = True
            seen.add(string)
        runs = int(np.sum(gone[1:] & ~gone[:-1]) + gone[:1].sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((i, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def removed(docs):
    cut = repeated_bytes.remove_repeated(docs).collect()
    return sorted((r.doc_id, r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans),
                   hashlib.sha256(r.kept).hexdigest()) for r in cut)


def corpus(seed):
    """Texts with shared passages of many lengths, near copies, periods and copies."""
    rng = random.Random(seed)
    passages = [prose(900 + i, n) for i, n in enumerate((8, 13, 14, 15, 20, 60))]
    texts = [None, "", "short", "a" * 99, "a" * 100, "a" * 101, "a" * 450, "ab" * 300, "abc" * 120 + "abd" * 120, "é漢😀" * 60]
    for i in range(40):
        parts = [prose(rng.randrange(10**6), rng.randint(0, 30)) for _ in range(3)]
        texts.append(rng.choice(passages).join(parts))
    base = prose(5, 150)
    for _ in range(25):
        at, size = rng.randrange(len(base)), rng.randint(0, 3)
        texts.append(base[:at] + "#" * size + base[at + rng.randint(0, 2):])
    texts += [base] * 3 + [base[50:], base[:-40], base[30:130], base[31:131] + base[200:500] + base[31:131]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("parts", [1, 8, 150])
def test_repeated_bytes_are_those_of_all_strings(spark, parts):
    """Also with so many partitions that most groups cross a boundary."""
    texts = corpus(parts)
    before, adaptive = spark.conf.get(PARTITIONS), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(PARTITIONS, parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert removed(documents(spark, texts)) == plain_removal(list(enumerate(texts)))
    finally:
        spark.conf.set(PARTITIONS, before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


def test_repeated_bytes_with_small_batches(spark):
    """Groups of contexts that go on over many batches."""
    texts = corpus(77)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert removed(documents(spark, texts)) == plain_removal(list(enumerate(texts)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_only_strings_that_may_cross_a_boundary_are_handed_on():
    rng = np.random.default_rng(3)
    n, span = 60, repeated_bytes.SPAN
    rights = sorted(b"z" * repeated_bytes.LEAD + rng.bytes(span - repeated_bytes.LEAD) for _ in range(n))
    rights[1] = rights[0][:50] + rights[1][50:]
    rows = pa.RecordBatch.from_pydict({
        "lead": [1] * n, "next": [2] * n, "left": [rng.bytes(repeated_bytes.BEFORE) for _ in range(n)], "right": sorted(rights),
        "doc": list(range(n)), "text_id": list(range(n)), "at": pa.array([500] * n, pa.int32())})
    said = pa.Table.from_batches(repeated_bytes._second_sort(iter([rows])))
    found = collections.Counter(said["doc"].to_pylist())
    assert found[0] == found[n - 1] == repeated_bytes.BEFORE + 1 and found[1] >= repeated_bytes.BEFORE + 1 - 50
    assert sum(found.values()) < 5 * n  # 85 * n strings in all


def test_repeated_bytes_of_odd_rows(spark):
    """Null keys come first, equal keys by a digest of the text, equal rows are one document."""
    got = [(r.doc_id, sum(s.end - s.begin for s in r.spans)) for r in repeated_bytes.remove_repeated(edges(spark)).collect()]
    long = len(prose(3, 30_000))
    assert sorted(got, key=lambda r: (r[0] is not None, r)) == [
        (None, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, long), (6, 0), (6, 0), (7, 0), (8, 0), (9, 19_999), (10, len(prose(9, 12)) * 2 + 1)]
    assert repeated_bytes.remove_repeated(edges(spark).limit(0)).collect() == []
    twice = spark.createDataFrame([(1, prose(1, 40)), (1, prose(1, 40) + "!")], "doc_id int, text string")
    assert sorted(sum(s.end - s.begin for s in r.spans) for r in repeated_bytes.remove_repeated(twice).collect())[0] == 0


def test_multikey_order_is_that_of_sorting(spark):
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, (500, 5)).astype(np.uint64)
    order, shared = repeated_bytes.multikey_order(words)
    rows = [tuple(words[i]) for i in order]
    assert rows == sorted(map(tuple, words))
    for i in range(1, 500):
        equal = next((k for k in range(5) if rows[i][k] != rows[i - 1][k]), 5)
        assert shared[i] == equal


def test_every_string_picks_a_position(spark):
    rng = random.Random(8)
    data = bytes(rng.choice(b"ab ") for _ in range(3000))
    starts, ends = np.array([0, 50, 50, 1000]), np.array([50, 50, 1000, 3000])
    at, *_ = repeated_bytes.picked(np.frombuffer(data, np.uint8), starts, ends)
    for a, b in ((50, 1000), (1000, 3000)):
        for i in range(a, b - 99):
            assert any(i <= x <= i + 84 for x in at)
    assert not any(x < 50 for x in at)


# -- lexical search -------------------------------------------------------------------------

def plain_search(docs, items, k=50):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, terms(t)) for i, t in docs]
    n_docs, length = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in asked.items():
        scores = []
        for i, t in held:
            if t:
                m = 50 + (50 * len(t) * n_docs) // length
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * t.count(w) // (1000 * t.count(w) + 20 * m))
                        for w in words if w in t)
                if s:
                    scores.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def search_rows(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, 1.0) for i, t in docs], "doc_id bigint, text string, item int, score double")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, rank int")
    return sorted(map(tuple, lexical_search.search_documents(d, b, **options).collect()), key=str)


def test_search_is_that_of_all_pairs(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Straße", "漢字", "É", "x_y", "A1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 10, 80, 900])))) for i in range(300)]
    docs += [(1000 + i, "same words here") for i in range(80)] + [(2000, None), (2001, ""), (2002, "?!\n"), (None, "w1 w2"), (7, docs[7][1])]
    items = [("a", "w1 W2, w3"), ("b", "same"), ("c", None), ("d", ""), ("e", "unknown"), (None, "w5 w6"), ("a", "w9"), ("f", "Straße É x_y")]
    assert search_rows(spark, docs, items) == plain_search(docs, items)
    assert search_rows(spark, docs, items, k=7) == plain_search(docs, items, 7)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 8)  # several passes
    assert search_rows(spark, docs, items, k=3) == plain_search(docs, items, 3)


def test_search_visits_strata_by_bound():
    """All hits are found, and a stratum whose bound is below the k-th score is not looked at."""
    rng = np.random.default_rng(1)
    m, owner = rng.integers(50, 400, 4000), np.arange(4000)
    index = lexical_search.LengthIndex(m, owner, np.zeros(4000, np.int64), rng.integers(1, 4, 4000), 1)
    seen, visits = 0, index.visit([0], [1000], 10, 1)
    hits, scores = next(visits)
    seen += len(hits)
    least = int(np.sort(scores)[-10])
    while True:
        try:
            hits, scores = visits.send(least)
        except StopIteration:
            break
        seen += len(hits)
        assert (scores >= least).all()
    assert seen < 4000


def test_search_of_nothing(spark):
    assert search_rows(spark, [], [("a", "w1")]) == []
    assert search_rows(spark, [(1, "w1")], []) == []
    assert search_rows(spark, [(1, None)], [("a", "w1")]) == []
    assert search_rows(spark, [(1, "w1 " * 60_000), (2, "w1 w2")], [("a", "w1 w2")], k=1)[0][2] == 2


# -- hard negatives -------------------------------------------------------------------------

def plain_negatives(rows, is_anchor, dims=None):
    fit = [(i, c, [math.floor(256 * float(x)) for x in v]) for i, c, v in rows
           if i is not None and c is not None and v and all(x is not None and math.isfinite(x) and abs(x) < 1e6 for x in v)]
    out = []
    for i, c, v in {(i, c, tuple(v)) for i, c, v in fit if is_anchor(i)}:
        scored = sorted((-sum(a * b for a, b in zip(v, u)), j, d) for j, d, u in fit if j != i and len(u) == len(v))
        for s, p, _ in [r for r in scored if r[2] == c][:5]:
            hit = [r for r in scored if r[2] != c and 30 * -s <= 100 * -r[0] <= 90 * -s][:10]
            out += [(i, p, k, n, -s, -t) for k, (t, n, _) in enumerate(hit, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id bigint, label int, embedding array<float>, rank int, score int")
    return sorted(map(tuple, hard_negatives.mine_negatives(df, F.col("vec_id") % 10 == 0, **options).collect()))


def test_negatives_are_those_of_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 0.4, (6, 12))
    rows = [(i, int(c), (centres[c] + rng.normal(0, 0.1, 12)).astype(np.float32).tolist())
            for i, c in enumerate(rng.integers(0, 6, 1500))]
    rows += [(2000 + i, int(i % 3), [0.5] * 12) for i in range(120)]  # a hot vector
    rows += [(3000 + i, i % 2, [0.1 * i, 1.0]) for i in range(30)]  # another dimension
    odd = [(4000, 1, None), (4010, None, [0.5] * 12), (None, 1, [0.5] * 12), (4020, 1, []), (4030, 1, [None] + [0.1] * 11),
           (4040, 1, [float("nan")] + [0.1] * 11), (4050, 1, [float("inf")] * 12), (4060, 1, [3e38] * 12), (4070, 1, [0.0] * 12), (20, 1, rows[20][2])]
    rows += odd
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    assert mined(spark, rows) == want and len(want) > 1000
    monkeypatch.setattr(hard_negatives, "ANCHORS", 40)
    assert mined(spark, rows) == want


def test_tree_opens_few_boxes_of_separate_groups(spark, monkeypatch):
    """With groups far apart, the search leaves most leaves closed."""
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    rng = np.random.default_rng(5)
    codes = (rng.integers(-8, 9, (4096, 2)) * 1000 + rng.integers(-20, 21, (4096, 2))).astype(np.int32)
    rows = []
    for tile in hard_negatives.tiles(codes, np.arange(4096), [0, 1]):
        box = codes[tile]
        rows.append({"ids": tile.astype(np.int64).tobytes(), "labels": np.zeros(len(tile), np.int64).tobytes(), "codes": box.tobytes(),
                     "low": box.min(0).tobytes(), "high": box.max(0).tobytes()})
    tree, opened = hard_negatives.BoxTree(2, rows), []
    window = hard_negatives.Window(-math.inf, 30_000_000, 10)
    offer = window.offer
    window.offer = lambda s, i: (opened.append(len(s)), offer(s, i))
    query = np.array([3000, 5000])
    tree.search(query, -1, 0, True, [window])
    scores = codes.astype(np.int64) @ query
    best = sorted((-s, i) for i, s in enumerate(scores) if s <= 30_000_000)[:10]
    assert list(zip((-window.scores).tolist(), window.ids.tolist())) == best
    assert len(opened) < len(rows) // 4


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 0, [0.5])]) == []
    assert mined(spark, [(10, 0, [0.5]), (11, 1, [0.5])]) == []
