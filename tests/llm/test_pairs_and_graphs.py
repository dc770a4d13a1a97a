"""Near-duplicates, lines, pages, vectors, hosts and the pipeline against brute force."""

import collections
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import SCHEMA, documents, edges, prose
from oracle_check import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from wordloom.llm import components, dartminhash, hamming_index, host_trust, html_cut, line_dedup, line_words, queries, shingles

SF = "/root/testdata/sf0.001"


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else {}
    return {(s, k) for s, n in found.items() for k in range(n)}


def plain_classes(rows):
    """doc_id to the least doc_id of its class, by comparing all pairs."""
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, t or "", plain_shingles(t)) for i, t in rows]
    for k, (i, t, s) in enumerate(sets):
        for j, u, r in sets[:k]:
            if t == u or (s and r and len(s & r) >= 0.8 * len(s | r)):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in parent}


def edited(text, rng, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def test_near_duplicates_are_those_of_all_pairs(spark):
    rng = random.Random(1)
    texts = [None, "", "one", "one", "a b c d", "a b c d"]
    for i in range(12):
        base = prose(i, rng.choice([6, 30, 200, 900]))
        texts += [base, base, *[edited(base, rng, rng.randint(1, max(1, len(base.split()) // 60))) for _ in range(6)]]
    texts += [prose(77, 60) + " " + prose(500 + i, 100) for i in range(20)]  # a shared passage
    rng.shuffle(texts)
    docs = documents(spark, texts)
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicates(docs).collect()}
    want = plain_classes(list(enumerate(texts)))
    assert got == want
    kept = dartminhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_a_shared_passage_does_not_become_all_pairs(spark):
    rng = random.Random(5)
    passage = prose(9, 150)
    texts = [passage + " " + prose(1000 + i, rng.randint(20, 300)) for i in range(400)]
    texts += [edited(t, rng, 2) for t in texts[:60]] + [passage]
    docs = documents(spark, texts)
    elements = dartminhash._elements(docs)
    sought = elements.select("doc_id", F.col("doc_id").alias("class"), F.lit(True).alias("aside"), "elements")
    met = {(r["a"], r["b"]) for r in dartminhash._meeting(sought).collect()}
    held = {r["doc_id"]: set(r["elements"]) for r in elements.collect()}
    similar = {(i, j) for i in held for j in held if i < j
               and len(held[i] & held[j]) >= 0.8 * len(held[i] | held[j])}
    assert similar and similar <= met
    assert len(met) < 10 * len(texts)  # all pairs would be 106,030
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicates(docs).collect()}
    assert got == plain_classes(list(enumerate(texts)))


def test_a_chain_of_edits_is_one_class(spark):
    rng, text, texts = random.Random(2), prose(1, 300), []
    for _ in range(15):
        texts.append(text)
        text = edited(text, rng, 4)
    got = {r["class_id"] for r in dartminhash.near_duplicates(documents(spark, texts)).collect()}
    assert got == {0}


def test_signatures_estimate_weighted_similarity():
    repeats = pa.array(["And " * 300, "And " * 450, prose(1, 400), edited(prose(1, 400), random.Random(1), 8)])
    signature, known = dartminhash.signatures(*dartminhash._weighted(repeats), 4)
    assert known.all()
    sets = [plain_shingles(t.as_py()) for t in repeats]
    for a, b in ((0, 1), (2, 3)):
        true = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        assert (signature[a] == signature[b]).mean() == pytest.approx(true, abs=0.13)


def test_signatures_do_not_depend_on_what_is_worked_on_together():
    texts = [prose(i, 20 + 150 * i) for i in range(6)]
    together, _ = dartminhash.signatures(*dartminhash._weighted(pa.array(texts)), 6)
    for i, t in enumerate(texts):
        assert (dartminhash.signatures(*dartminhash._weighted(pa.array([t])), 1)[0][0] == together[i]).all()


def test_shingles_of_short_and_empty_texts():
    hashes, rows = shingles.shingles(pa.array(["", None, " \n", "a", "a b c d", "a b c d e f"]))
    assert rows.tolist() == [3, 4, 5, 5]


def test_components(spark):
    edges_ = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components.connected(edges_).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def plain_removed(rows):
    seen, out = [], set()
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for k, line in enumerate((text or "").split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            s = frozenset(words)
            if len(words) < line_dedup.MIN_WORDS:
                continue
            if any((d, n) != (doc, k) and 5 * len(s & t) >= 4 * len(s | t) for d, n, t in seen):
                out.add((doc, k))
            seen.append((doc, k, s))
    return out


def test_removed_lines_are_those_of_all_pairs(spark):
    rng, texts = random.Random(3), [None, "", "\n\n", "Of.\nOf.\nOf."]
    base = [prose(i, rng.choice([5, 8, 20, 60, 250])) for i in range(25)]
    small = ["a b c d e", "a b c d f", "b c d e f", "a b c d e f", "e d c b a", "a a a a a"]
    for _ in range(60):
        lines = [rng.choice(base + small) for _ in range(rng.randint(1, 6))]
        lines = [edited(x, rng, rng.randint(1, 3)) if rng.random() < 0.5 else x for x in lines]
        texts.append("\n".join(lines))
    docs = documents(spark, texts)
    got = line_dedup.find_similar_lines(docs).collect()
    assert len(got) == len(texts)
    removed = {(r["doc_id"], k) for r in got for k in r["removed_lines"]}
    assert removed == plain_removed(list(enumerate(texts)))
    cleaned = line_dedup.remove_similar_lines(docs)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        text = texts[r["doc_id"]]
        kept = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (r["doc_id"], k) not in removed)
        assert r["text"] == kept


@pytest.mark.parametrize("table", ["edges", "empty"])
def test_edges_of_pair_operators(spark, table):
    docs = edges(spark) if table == "edges" else edges(spark).limit(0)
    found = dartminhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    if found:
        by = {r["doc_id"]: r["class_id"] for r in found}
        assert by[1] == by[2] == 1 and by[3] == 3 and by[4] == by[5] == 4 and by[6] == 6
    assert dartminhash.keep_one_each(docs).columns == docs.columns
    assert line_dedup.find_similar_lines(docs).count() == docs.select("doc_id").dropna().distinct().count()
    assert line_dedup.remove_similar_lines(docs).count() == docs.count()


PAGE = (
    '<body><header><a href=/>Home</a> Site</header><div class="cookie-notice">We use cookies, please accept them all.</div>'
    '<div id="content"><h1>Title  here</h1><p>Short.</p><p>A longer paragraph, with several words &amp; marks. It goes on.'
    "<p>Caf&eacute; &#x27;q&#39;&nbsp;x<br>y, and so on. More text.</p><script>var a='<p>no</p>'</script><ul><li>Item one, text.</li></ul></div>"
    "<div class=comments><p>Nice article, I liked it very much. Thanks!</p></div><form><p>Subscribe</p></form>"
    "<aside>Related <a href=a>foo</a></aside><footer>&copy; 2020</footer>"
)


def test_main_text():
    want = "Title here\nShort.\nA longer paragraph, with several words & marks. It goes on.\nCafé 'q' x y, and so on. More text.\nItem one, text."
    assert html_cut.main_text(PAGE) == want
    assert html_cut.main_text(None) == html_cut.main_text("") == html_cut.main_text("<p") == ""


def test_minimum_cut_is_the_cheapest_labelling():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 9)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        ties = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        cost = lambda side: (
            sum(abs(o) for o, s in zip(odds, side) if (o > 0) != s) + sum(w for a, b, w in ties if side[a] != side[b]))
        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(2**n))
        assert cost(html_cut.minimum_cut(odds, ties)) == pytest.approx(best)


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "t"), (2, None, None, "t"), (3, "v", "", "t"), (1, "u", PAGE, "t"), (None, "w", "<article>" + "<p>A b c.</p>" * 3000, "t")],
        "page_id bigint, url string, html string, text string")
    got = html_cut.extract_pages(pages).collect()
    assert len(got) == 5
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"].count("\n") for r in got if r["page_id"] is None] == [2999]
    assert html_cut.extract_pages(pages.limit(0)).count() == 0


def vectors(spark, x, more=()):
    rows = [(i, [float(v) for v in r], 0.0) for i, r in enumerate(x)] + list(more)
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score double")


def test_codes_within_a_radius_are_all_found():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (3000, 8), dtype=np.uint8)
    codes[:50] = codes[0] ^ np.packbits(rng.random((50, 64)) < 0.1, axis=1)
    index = hamming_index.MultiIndex(codes)
    ones = np.unpackbits(codes ^ codes[0], axis=1).sum(axis=1)
    for radius in (0, 3, 7, 12, 25, 40, 64):
        assert index.within(codes[0], radius).tolist() == np.flatnonzero(ones <= radius).tolist()


def test_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20, 64))[rng.integers(0, 20, 1500)] + 0.6 * rng.normal(size=(1500, 64))
    x = x.astype(np.float32).astype(float)
    more = [(2000, None, 0.0), (2100, [0.0] * 64, 0.0), (2200, [float("nan")] * 64, 0.0), (2300, [None] * 64, 0.0), (2400, [1.0], 0.0), (None, [1.0] * 64, 0.0)]
    rows = hamming_index.search_nearest(vectors(spark, x, more), F.col("vec_id") % 100 == 0).collect()
    found = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append(r)
    assert sorted(found) == list(range(0, 1500, 100))
    hits = 0
    for q, got in found.items():
        far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        assert [r["rank"] for r in got] == list(range(1, 11))
        assert [r["score"] for r in got] == sorted(r["score"] for r in got)
        assert all(r["score"] == pytest.approx(far[r["vec_id"]], abs=1e-9) for r in got)
        hits += len({r["vec_id"] for r in got} & set(np.argsort(far)[:10].tolist()))
    assert hits >= 0.9 * 150


def test_few_equal_and_no_vectors(spark):
    same = vectors(spark, np.ones((4, 3)))
    got = hamming_index.search_nearest(same, F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0)]
    assert hamming_index.search_nearest(same.limit(0), F.col("vec_id") == 0).count() == 0


def test_hosts_and_rules(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">x</a>' for h in hosts)
    rows = [
        (1, "HTTP://A.Example.NET/en/x?q#f", None), (2, "http://b.net/x", ""), (3, "http://b.net", ""), (4, "x.example.com/de/", ""),
        (5, None, ""), (6, "http://x.example.com/de/1", ""), (7, "http://x.example.com/en/1", link("x.example.com")),
        (8, "http://bad.xyz/a", link("b.net", "x.example.com")), (9, "http://good.org/fr/a", link("other.xyz")), (10, "http://other.xyz/a#b", ""),
        (11, "http://notexample.com/de/1", ""), (10, "http://other.xyz/a#b", ""),
    ]
    pages = spark.createDataFrame([(*r, "t", "h") for r in rows], "page_id bigint, url string, html string, host string, verdict string")
    got = {r["page_id"]: r for r in host_trust.judge_pages(pages).collect()}
    assert host_trust.judge_pages(pages).count() == 12
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[2]["rule"], got[2]["verdict"]) == ("net/", "block")
    assert got[3]["rule"] is None and got[3]["verdict"] == "allow"  # no more than half of the host's pages are blocked
    assert got[8]["rule"] is None and got[8]["verdict"] == "block"  # it links to hosts with blocked pages
    assert got[4]["host"] == got[4]["path"] == "" and got[5]["host"] == ""
    assert got[6]["verdict"] == "block" and got[9]["verdict"] == "allow" and got[10]["verdict"] == "allow"
    assert got[11]["rule"] is None
    assert host_trust.judge_pages(pages.limit(0)).count() == 0


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, duck, name):
    problem, rows = compare(spark, duck, SF, queries.QUERIES[name], queries.ORACLES[name])
    assert not problem
    assert rows > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
    packed = corpus_pipeline.run(spark, SF)
    ids = {r["doc_id"] for r in packed.select("doc_id").distinct().collect()}
    assert ids <= {r["doc_id"] for r in docs.collect()} and len(ids) > 50


def test_pipeline_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


@pytest.mark.parametrize("head", [
    '<svg class="i"/>', '<math display="block" />', '<svg-icon name="x"></svg-icon>', "<video-js></video-js>", "<title-bar></title-bar>",
    "<button-group></button-group>", "<div><button>Menu</div>", "<div><select><option>One</div>", "<div><object data=x></div>",
    "<div><video src=x></div>", "<div><canvas></div>", '<svg><path d="M0"><title/></svg>', "<svg><path d='M0'><p>", "<script>var a = '<svg>'</script >",
])
def test_markup_before_an_article_leaves_its_text(head):
    text = "Body text, with some words. And more of them."
    assert html_cut.main_text(f"{head}<article><p>{text}</p></article>") == text


def test_silent_elements_inside_a_block_neither_show_nor_split_it():
    page = "<article><p>One, two. <button><div>No</div></button><svg><text>No</text><path d=a /></svg><template><p>No</p></template>Three, four.</p></article>"
    assert html_cut.main_text(page) == "One, two. Three, four."


def crawl(spark, rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")


def verdicts(spark, rows, rules):
    return {r["host"]: r["verdict"] for r in host_trust.judge_pages(crawl(spark, rows), rules).collect() if r["rule"] is None}


def test_scores_spread_to_the_fixed_point(spark):
    # A child of a parent of whose pages 17 % are blocked: 0.447 after 12 steps, 0.521 at the end.
    rows = [(f"http://p.xyz/{'bad' if i < 17 else 'fine'}/{i}", "") for i in range(100)] + [("http://c.p.xyz/", "")]
    assert verdicts(spark, rows, (("block", "p.xyz/bad"),))["c.p.xyz"] == "block"
    rows = [(f"http://p.xyz/{'bad' if i < 16 else 'fine'}/{i}", "") for i in range(100)] + [("http://c.p.xyz/", "")]
    assert verdicts(spark, rows, (("block", "p.xyz/bad"),))["c.p.xyz"] == "allow"


def test_linked_hosts_without_pages_take_part(spark):
    link = lambda *urls: "".join(f'<a href="{u}">x</a>' for u in urls)
    rules = (("block", "net/"), ("block", "mixed.org/bad"), ("allow", "good.org/"))
    rows = [
        ("http://a.xyz/", link("http://bad.net/x", "//worse.net/y")),  # links only to blocked hosts
        ("http://b.xyz/", link("https://fine.org/x")),
        ("http://good.org/1", link("http://t.xyz/", *[f"http://o{i}.xyz/" for i in range(99)])),  # 1 of 100 links
        ("http://t.xyz/", link("http://bad2.net/")),
        ("http://c.xyz/", link("http://mixed.org/good?bad")),
    ]
    got = verdicts(spark, rows, rules)
    assert got == {"a.xyz": "block", "b.xyz": "allow", "t.xyz": "block", "c.xyz": "allow"}
    assert host_trust.judge_pages(crawl(spark, rows), rules).count() == 5


def plain_links(texts):
    """doc_id to the number of earlier matches of all its lines, by comparing all pairs."""
    lines = [(d, k, frozenset(x.split())) for d, t in enumerate(texts) for k, x in enumerate(t.split("\n")) if len(x.split()) >= 5]
    out = collections.Counter()
    for i, (d, _, s) in enumerate(lines):
        out[d] += sum(5 * len(s & t) >= 4 * len(s | t) for _, _, t in lines[:i])
    return out


@pytest.mark.parametrize("block", [line_dedup.BLOCK, 3])
def test_links_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng = random.Random(5)
    base = [prose(i, rng.choice([8, 20, 60])) for i in range(4)]
    texts = []
    for _ in range(40):
        lines = [rng.choice(base) for _ in range(3)]
        texts.append("\n".join(edited(x, rng, 1) if rng.random() < 0.6 else x for x in lines))
    got = {r["doc_id"]: r["n_links"] for r in line_dedup.find_similar_lines(documents(spark, texts)).collect()}
    want = plain_links(texts)
    assert max(want.values()) > 20
    assert got == {d: want[d] for d in range(len(texts))}


def test_a_common_word_is_dealt_to_many_tasks():
    digests = np.arange(305, dtype=np.int64)
    words = np.array([1] * 300 + [2] * 5, np.uint64)
    held = np.array([300] * 300 + [5] * 5)
    cells = collections.defaultdict(list)
    for e, cell, side in zip(*(x.tolist() for x in line_dedup._cells(words, digests, held, 20))):
        cells[cell].append((side, e))
    assert max(map(len, cells.values())) < 4 * 20
    met = [tuple(sorted((x, y))) for c in cells.values() for i, (s, x) in enumerate(c) for t, y in c[:i] if s == 0 or s != t]
    assert len(met) == len(set(met)) == 300 * 299 // 2 + 5 * 4 // 2


def test_words_of_classes_are_numbers(spark):
    """They were lists of strings, which joins carried and compared for every pair."""
    text = "one two  three\tfour five five\nshort\nsix one two eight nine"
    docs = documents(spark, [text, "", text]).select("doc_id", "text")
    described = line_dedup.describe_lines(docs).where("line IS NOT NULL").select("doc_id", "line", "digest")
    wanted = described.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min("line").alias("line"))
    words = line_dedup._words_of(docs.unionByName(docs), wanted)
    assert words.dtypes == [("digest", "bigint"), ("words", "array<bigint>")]
    found = [set(r["words"]) for r in words.collect()]
    assert [len(w) for w in found] == [5, 5] and len(found[0] & found[1]) == 2


def test_words_of_lines_are_those_of_split():
    texts = ["", "a b\n\nb a\tc", "x", "\n", "é ü é\x0bz\n w ", "q" * 3000 + " " + "r" * 5]
    row, number, size, hashes, line = line_words.line_words(pa.array(texts).slice(0), 1)
    want = [(r, k, len(set(x.split()))) for r, t in enumerate(texts) for k, x in enumerate(t.split("\n")) if x.split()]
    assert list(zip(row.tolist(), number.tolist(), size.tolist())) == want
    words = [w for r, k, _ in want for w in sorted(set(texts[r].split("\n")[k].split()))]
    assert len(set(hashes.tolist())) == len(set(words)) and len(hashes) == len(words)
    assert set(hashes[line == 0].tolist()) < set(hashes[line == 1].tolist())
    rare = np.zeros(8, np.int64)
    rare[int(hashes[line == 0][0] % np.uint64(8))] = 5
    again = line_words.line_words(pa.array(["-", *texts]).slice(1), 1, rare)
    assert again[2].tolist() == size.tolist() and set(again[3].tolist()) == set(hashes.tolist())
    for n in range(len(size)):
        mine = rare[(again[3][again[4] == n] % np.uint64(8)).astype(int)]
        assert (np.diff(mine) >= 0).all()


def test_words_are_hashed_alike_in_spans(monkeypatch):
    texts = pa.array([" ".join(f"w{i % 90}" for i in range(700)), "v" * 400])
    whole = line_words.line_words(texts, 1)
    monkeypatch.setattr(line_words, "SPAN", 64)
    assert all(np.array_equal(x, y) for x, y in zip(whole, line_words.line_words(texts, 1)))


def test_a_group_of_near_copies_does_not_meet_in_pairs(spark, monkeypatch):
    rng = random.Random(8)
    base = prose(3, 60).split()
    texts = []
    for i in range(150):
        words = list(base)
        words[rng.randrange(len(words))] = f"other{i}"
        texts.append(" ".join(words))
    met = []
    meet = line_dedup._meet
    monkeypatch.setattr(line_dedup, "_meet", lambda *a: met.append(meet(*a)) or met[-1])
    got = {r["doc_id"]: r["n_links"] for r in line_dedup.find_similar_lines(documents(spark, texts)).collect()}
    want = plain_links(texts)
    assert got == {d: want[d] for d in range(150)} and sum(want.values()) > 10_000
    assert met[0].count() < 500


@pytest.mark.parametrize("star_block", [line_dedup.STAR_BLOCK, 7])
def test_far_copies_of_a_text_are_counted_by_their_edits(spark, monkeypatch, star_block):
    monkeypatch.setattr(line_dedup, "STAR_BLOCK", star_block)
    rng = random.Random(11)
    base, changes = [f"word{i}" for i in range(200)], [f"shared{i}" for i in range(40)]
    texts = [" ".join(base)] * 3
    for i in range(160):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randrange(1, 16)):
            words[at] = rng.choice(changes) if rng.random() < 0.2 else f"other{i}x{at}"
        texts += [" ".join(words)] * rng.choice([1, 1, 2])
    rng.shuffle(texts)
    alike = []
    similar = line_dedup._similar_classes
    monkeypatch.setattr(line_dedup, "_similar_classes", lambda *a: alike.append(similar(*a)) or alike[-1])
    got = {r["doc_id"]: r["n_links"] for r in line_dedup.find_similar_lines(documents(spark, texts)).collect()}
    want = plain_links(texts)
    classes = len(set(texts))
    assert got == {d: want[d] for d in range(len(texts))}
    assert sum(want.values()) > len(texts) ** 2 // 4
    assert alike[0][1].count() < classes ** 2 // 10  # pairs that are met; there are classes ** 2 // 2


def test_short_copies_of_a_text_are_one_star(spark, monkeypatch):
    base = prose(3, 60).split()[:10]
    texts = [" ".join([*base[:i % 10], f"other{i}", *base[i % 10 + 1:]]) for i in range(90)] + [" ".join(base)]
    met = []
    meet = line_dedup._meet
    monkeypatch.setattr(line_dedup, "_meet", lambda *a: met.append(meet(*a)) or met[-1])
    got = {r["doc_id"]: r["n_links"] for r in line_dedup.find_similar_lines(documents(spark, texts)).collect()}
    want = plain_links(texts)
    assert got == {d: want[d] for d in range(len(texts))} and want[90] == 90
    assert met[0].count() == 0


def test_earlier_lines_of_a_star_are_those_of_all_pairs():
    rng = np.random.default_rng(4)
    star, place = np.sort(rng.integers(0, 9, 400)), np.zeros(400, np.int64)
    for s in range(9):
        place[star == s] = np.sort(rng.integers(0, 30, (star == s).sum()))
    excess, weight = rng.integers(-40, 25, 400), rng.integers(1, 4, 400)
    excess[star == 3] = -5
    want = [sum(w for t, q, e, w in zip(star, place, excess, weight) if t == s and q < p and e + x <= 0)
            for s, p, x in zip(star, place, excess)]
    assert line_dedup._earlier_in_star(star, place, excess, weight).tolist() == want


def test_rows_with_one_key_and_different_texts(spark):
    line = prose(4, 20)
    docs = spark.createDataFrame([(1, line), (1, prose(5, 20) + "\n" + line), (2, line)], "doc_id long, text string")
    got = {r["doc_id"]: r["removed_lines"] for r in line_dedup.find_similar_lines(docs).collect()}
    assert got == {1: [1], 2: [0]}


def test_equal_lines_are_posted_once_by_a_task(spark):
    docs = documents(spark, ["a b c d e\ne d c b a a"] * 3000).coalesce(1)
    posted = line_dedup.post_prefixes(docs.select("doc_id", "text"), np.full(line_dedup.COUNTERS, 9))
    assert posted.count() == 2  # the rarest two words of one set of five


def test_posted_rows_of_a_group_are_handed_on_as_one(spark):
    """They were a row each in the exchange, 22.7 million of them over 0.5 GB."""
    lines = [" ".join(f"w{k}x{i}" for i in range(15)) for k in range(6000)]
    docs = documents(spark, ["\n".join(lines[k : k + 20]) for k in range(0, 6000, 20)]).coalesce(1)
    posted = line_dedup.post_prefixes(docs.select("doc_id", "text"), np.full(line_dedup.COUNTERS, 9)).toArrow()
    assert posted.num_rows <= line_dedup.GROUPS < 6000 * 4
    rows = pa.Table.from_batches(line_dedup._ungrouped(posted.to_batches()))
    assert len(rows) == 6000 * 4  # the rarest four words of 15
    assert sorted(np.unique(rows["digest"].to_numpy(), return_counts=True)[1].tolist()) == [4] * 6000
    groups = (rows["cell"].to_numpy().view(np.uint64) % np.uint64(line_dedup.GROUPS)).astype(np.int64)
    assert np.array_equal(groups, rows["group"].to_numpy())


def test_lines_are_stored_by_text(spark):
    """They were a row each, and were dealt out by document and line to be counted."""
    texts = ["a b c d e\nshort\nf g h i j", "", "a b c d e", None, "k l m n o\n" * 3]
    docs = documents(spark, texts)
    again = docs.where("doc_id = 0").selectExpr("doc_id", "'x\ny\np q r s t\nu v w x y' AS text")  # lines 2 and 3
    docs = docs.select("doc_id", "text").unionByName(again)
    described = line_dedup.describe_texts(docs.fillna("")).where("numbers IS NOT NULL")
    assert described.count() == 6
    assert {r["doc_id"]: r["n_lines"] for r in line_dedup._count_lines(described).collect()} == {0: 3, 1: 0, 2: 1, 3: 0, 4: 3}
    assert {r["doc_id"]: r["n_lines"] for r in line_dedup.find_similar_lines(docs).collect()} == {0: 3, 1: 0, 2: 1, 3: 0, 4: 3}


def test_texts_nothing_is_asked_of_stay_where_they_are(spark):
    """All texts were compressed and shuffled."""
    docs = documents(spark, [prose(k, 40) for k in range(200)]).select("doc_id", "text")
    wanted = line_dedup.describe_lines(docs.where("doc_id < 3")).groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min("line").alias("line"))
    assert line_dedup._asked_texts(docs, wanted).count() == 3
    assert line_dedup._words_of(docs, wanted).count() == wanted.count() == 3


def test_words_of_any_length_have_hashes_of_their_own():
    words = [c * n + e for n in (*range(1, 75), 200) for c in ("a", "b", "\0") for e in ("", "\0", "z")]
    words = list(dict.fromkeys(words))
    _, _, size, hashes, line = line_words.line_words(pa.array([" ".join(words), "\n".join(words), words[0]]), 1)
    assert size.tolist() == [len(words)] + [1] * (len(words) + 1)
    assert len(set(hashes[line > 0].tolist())) == len(words) and set(hashes[line > 0].tolist()) == set(hashes[line == 0].tolist())


ARTICLE = "<h1>A title, said.</h1><p>One sentence, and another. More of it here, of course.</p><p>The second part, which ends the text.</p>"
EXPECTED = "A title, said.\nOne sentence, and another. More of it here, of course.\nThe second part, which ends the text."
MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/x">All news</a></li></ul></nav>'
FOOT = "<footer><p>© 2024 All rights reserved</p></footer>"
LAYOUTS = {
    "layout with a sidebar": '<div class="layout has-sidebar"><article>{}</article></div>',
    "main without one": '<main class="content no-sidebar"><article>{}</article></main>',
    "page with a footer": '<div class="page with-footer"><div class="post">{}</div></div>',
    "social section": '<div class="section social"><article>{}</article></div>',
    "one form": '<form id="aspnetForm"><article>{}</article></form>',
    "form with fields": '<form method="post"><input type="hidden" name="v"><div class="content">{}</div></form>',
    "article alone": "<article>{}</article>",
    "main alone": "<main>{}</main>",
    "plain divs": "<div><div>{}</div></div>",
    "wide layout": '<div class="layoutWide hasFooter"><div class="entry">{}</div></div>',
    "camel case": '<div class="noSidebar"><div class="storyBody">{}</div></div>',
    "banner on top": '<div class="show-banner"><section class="story">{}</section></div>',
    "widget page": '<div class="widget-page"><div class="article-body">{}</div></div>',
    "promo site": '<div id="promo-site"><article>{}</article></div>',
    "related wrapper": '<div class="related"><article><header><p>By A. Writer, today.</p></header>{}</article></div>',
    "menu around all": '<div class="menu"><main>{}</main></div>',
    "form in main": "<main><form>{}</form></main>",
    "section role": '<div role="main">{}</div>',
    "modal page": '<div class="modal"><article>{}</article></div>',
    "header layout": '<div class="header-layout"><article>{}</article></div>',
}
NOISE = {
    "sidebar": '<div class="sidebar"><h3>More</h3><p>Read this too, it is good.</p></div>',
    "aside": "<aside><p>A note that stands aside, in words.</p></aside>",
    "comments": '<div class="comments"><article class="comment"><p>I liked it, thank you. So much, indeed.</p></article></div>',
    "cookies": '<div id="cookie-banner"><p>We use cookies. Accept them, please.</p></div>',
    "sign-up": '<form class="newsletter"><p>Get our letter, every week.</p><input></form>',
}


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("noise", [None, "sidebar", "comments", "sign-up"])
def test_layouts_keep_their_article(layout, noise):
    """Also with boilerplate beside it that has to go."""
    if noise and layout in ("menu around all",):
        return
    body = LAYOUTS[layout].format(ARTICLE)
    related = '<p>By A. Writer, today.</p>' in body
    got = html_cut.main_text(f"<html><body>{MENU}{body}{NOISE.get(noise, '')}{FOOT}</body></html>")
    assert got == EXPECTED or (related and got == "By A. Writer, today.\n" + EXPECTED)


@pytest.mark.parametrize("noise", NOISE)
def test_noise_goes_wherever_it_stands(noise):
    assert html_cut.main_text(f"<body>{MENU}<div class='wrap'><article>{ARTICLE}</article>{NOISE[noise]}</div>{FOOT}</body>") == EXPECTED
    long = NOISE["comments"].replace("So much, indeed.", "So much, indeed. " * 60)
    assert html_cut.main_text(f"<body><article>{ARTICLE}</article>{long}</body>") == EXPECTED


def test_long_and_deep_pages_take_linear_time():
    """100,000 alternating blocks, and end tags that close nothing below thousands of open elements."""
    start = time.perf_counter()
    page = "<article><p>One sentence, and another one. It goes on.</p></article><nav><a href='/'>Home of all</a></nav>" * 50_000
    assert html_cut.main_text(page).count("\n") == 49_999
    assert time.perf_counter() - start < 30
    start = time.perf_counter()
    deep = "<div>" * 20_000 + "</b>" * 20_000 + "Some text, at last. It is content, one would say."
    assert html_cut.main_text(deep).startswith("Some text")
    assert time.perf_counter() - start < 10


def test_links_of_a_sitemap_are_told_apart_in_linear_time(spark):
    """40,000 links of one page, each twice; hosts that differ in case are one."""
    links = "".join(f'<a href="http://H{i % 7}.org/p{i}?q">x</a>' for i in range(20_000)) * 2 + '<a href="https://h1.ORG">y</a>'
    pages = spark.createDataFrame([(1, "http://a.org/x", links), (2, "b", ""), (3, None, None)], "page_id bigint, url string, html string")
    start = time.perf_counter()
    (row,) = host_trust.linked_urls(pages).collect()
    assert time.perf_counter() - start < 60
    assert row["source"] == "a.org" and len(row["urls"]) == 20_001
    assert {(u.host, u.path) for u in row["urls"]} == {(f"h{i % 7}.org", f"/p{i}") for i in range(20_000)} | {("h1.org", "")}
