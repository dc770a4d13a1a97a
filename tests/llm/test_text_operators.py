"""Rules, classifiers, tokens and packing against plain versions on small tables."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from edge_cases import documents, edges, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm import byte_bpe, packing, quality_qda, quality_rules, text_stats, toxicity
from wordloom.llm.pieces import piece_starts, splitter

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    found = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_are_exact(spark):
    random.seed(2)
    texts = [None, "", " \x0b", "a b c d e a b c d e", "x " * 30, "l1 a\nl1 a\n\nl1 a\r\n", "# a|b <> $", prose(1, 5000) + " " + prose(1, 3000)]
    texts += [" ".join(random.choice("abc") for _ in range(random.randint(0, 60))) for _ in range(40)]
    got = text_stats.with_text_stats(documents(spark, texts)).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[n] for n in names) for r in got] == [plain_counts(t) for t in texts]


def test_rules_keep_clean_texts_and_reject_junk(spark):
    clean = [prose(i, 120) for i in range(60)]
    junk = [" ".join(f"{w}###" for w in prose(100 + i, 120).split()) for i in range(8)]
    repeated = ["same five words come again " * 20]
    docs = documents(spark, clean + junk + repeated)
    judged = {r["doc_id"]: r for r in quality_rules.judge_quality(docs).collect()}
    assert all(judged[i]["kept"] for i in range(60))
    assert not any(judged[i]["kept"] for i in range(60, 69))
    assert judged[68]["base_failed"] and not judged[60]["base_failed"]
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(60))


def test_more_reliable_rules_weigh_more(spark):
    model = quality_rules.first_model()
    assert model.good[0] > 0.9
    empty = spark.createDataFrame([], "votes array<int>, texts bigint")
    assert quality_rules.fit_votes(empty) == model


@pytest.mark.parametrize("table", ["edges", "empty"])
def test_edges_of_every_text_operator(spark, table):
    docs = edges(spark) if table == "edges" else edges(spark).limit(0)
    labels = spark.createDataFrame([(6, 1, 0), (4, 0, 1), (99, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    n = docs.count()
    assert quality_rules.judge_quality(docs).count() == n
    assert quality_rules.keep_good(docs).columns == docs.columns
    scored = quality_qda.score_quality(docs, labels).collect()
    assert len(scored) == n and all(0 <= r["score"] <= 1 for r in scored)
    scored = toxicity.score_toxicity(docs, labels).collect()
    assert len(scored) == n and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.keep_civil(docs, labels).columns == docs.columns
    assert byte_bpe.round_trip(docs, RANKS).count() == n
    pieces = packing.pack_documents(docs, VOCABULARY).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)


def test_held_out_rows(spark):
    got = spark.range(50).select("id", quality_qda.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = documents(spark, [prose(i, 60) for i in range(40)])
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    other = labels.withColumns({c: F.when(quality_qda.held_out(F.col("doc_id")), 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    for score in (quality_qda.score_quality, toxicity.score_toxicity):
        assert sorted(score(docs, labels).collect()) == sorted(score(docs, other).collect())


def test_classifiers_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_qda.score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) >= 0.9


def test_discriminant_matches_the_normal_density():
    rng = np.random.default_rng(1)
    x = [rng.normal(size=(400, 3)), rng.normal(1.0, 2.0, size=(300, 3))]
    sums = {c: (len(v), v.sum(axis=0), v.T @ v) for c, v in enumerate(x)}
    model = quality_qda.fit_discriminant(sums, 3)
    density = model.classes[0]
    covariance = np.linalg.inv(density.whiten.T @ density.whiten)
    point = rng.normal(size=(1, 3))
    d = point - density.mean
    want = density.log_prior - 0.5 * (d @ np.linalg.inv(covariance) @ d.T).item() - 0.5 * np.linalg.slogdet(covariance)[1]
    assert density.log_density(point)[0] == pytest.approx(want)
    assert model.score(x[1]).mean() > model.score(x[0]).mean() + 0.2


def test_calibration_never_falls():
    table = toxicity.calibrate(collections.Counter({0: 1, 5: 3, 9: 6}), collections.Counter({0: 50, 3: 6, 4: 2, 9: 1}), 0.1)
    assert len(table) == toxicity.MOST_GAIN + 1
    assert list(table) == sorted(table) and 0 <= table[0] < 0.5 < table[-1] <= 1


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_text(rng):
    parts = ["a", "b", "th", "e", "é", "ß", "  ", "\n", "1", "2", "!", "ing", "'s", "漢", "😀", "́", "\x1c", " ", "The", "<|endoftext|>"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_tokens_are_those_of_the_library(spark, reference):
    rng = random.Random(1)
    texts = [None, "", *[random_text(rng) for _ in range(300)], prose(5, 3000), "q" * 3000]
    got = byte_bpe.round_trip(documents(spark, texts), RANKS).orderBy("doc_id").collect()
    for text, row in zip(texts, got):
        ids = np.array(reference.encode_ordinary(text or ""), "<u4")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_edits_give_the_table_of_the_new_text():
    rng = random.Random(3)
    encoder = byte_bpe.PrefixEncoder(byte_bpe.load_ranks(RANKS))
    for _ in range(300):
        text = bytes(rng.choice(b"abcdefg hetion") for _ in range(rng.randint(0, 80)))
        piece = byte_bpe.EditablePiece(encoder, text[:30])
        piece.append(text[30:])
        assert piece.last == encoder.fill(text, [b""])
        a = rng.randint(0, len(text))
        b = rng.randint(a, len(text))
        piece.replace(a, b, b"the" * rng.randint(0, 3))
        assert piece.last == encoder.fill(piece.piece, [b""])
        assert piece.ids() == encoder.encode(piece.piece)


def test_pieces_cover_the_text():
    rng = random.Random(4)
    assert all("".join(splitter()(t)) == t for t in (random_text(rng) for _ in range(500)))


def test_pieces_of_many_texts_are_those_of_each():
    rng = random.Random(4)
    signs = [*"abstremvlldS''''", *"  \n\t \x85\x1c", *"é1२.,!?中́", "\U0001f600", "\U0001d49c", "\U0001d7d8", "'s", "'re", "'ll", " '"]
    for _ in range(3000):
        texts = ["".join(rng.choices(signs, k=rng.randrange(14))) for _ in range(4)]
        starts = [sum(map(len, texts[:i])) for i in range(4)]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        found = piece_starts(points, np.array([a for a, t in zip(starts, texts) if t], int))
        for a, text in zip(starts, texts):
            at = [*np.flatnonzero(found[a : a + len(text)]), len(text)]
            assert [text[x:y] for x, y in zip(at, at[1:])] == splitter()(text)


def test_a_piece_is_looked_up_once_for_all_texts(monkeypatch):
    """Each place of a piece had its own look-up, and a string of its own."""
    asked = []

    class Known(dict):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    tokenizer, added, _ = packing._tokenizer(VOCABULARY)
    kept = tokenizer, added, Known()
    monkeypatch.setattr(packing, "_tokenizer", lambda path: kept)
    texts = ["one two two one's", "", "<|endoftext|> two", " two one's" * 500, "\U0001f600 two\n\n two"]
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert packing._encode_batch(VOCABULARY, texts) == [np.array(i, "<u4").tobytes() for i in ids]
    assert len(asked) == len(set(asked))


def test_pieces_just_met_outlive_a_full_cache(monkeypatch):
    tokenizer, added, _ = packing._tokenizer(VOCABULARY)
    asked = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    kept = Counting(), added, {}
    monkeypatch.setattr(packing, "_tokenizer", lambda path: kept)
    monkeypatch.setattr(packing, "KEPT_PIECES", 6)
    for text in ("one two three four", "one two five six seven", "one two " + "x" * 300, "one three"):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert packing._encode_batch(VOCABULARY, [text]) == [np.array(ids, "<u4").tobytes()]
    assert asked.count(" two") == asked.count("one") == 1
    assert asked.count(" three") == 2 and len(kept[2]) <= 6


def test_packing_is_gapless_and_certified(spark):
    texts = [None, "", "<|endoftext|>", *[prose(i, 10 + 37 * i % 1700) for i in range(60)], prose(99, 9000)]
    rows = packing.pack_documents(documents(spark, texts), VOCABULARY).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert sum(p["length"] for p in pieces) == len(ids)
        assert all(p["length"] == 2048 for p in pieces[1:])
        for p in pieces:
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    assert len(by_sequence) == packing.lower_bound(np.array([r["length"] for r in rows]), 2048)


def test_partitions_exchange_pieces(spark):
    rng = random.Random(5)
    pieces = spark.createDataFrame(
        [(i, 0, 0, rng.randint(300, 1500), i) for i in range(400)], packing.PIECES.format(key="bigint"))
    alone = packing.best_fit_decreasing(np.array([r["length"] for r in pieces.collect()]), 2048)[2]
    packed = packing.pack_pieces(pieces, per_task=20).collect()
    assert len(packed) == 400
    used = collections.Counter()
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048
    assert len(used) <= alone * 1.1


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(6)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, offsets, count = packing.best_fit_decreasing(lengths, 100)
        assert packing.lower_bound(lengths, 100) <= count
    assert packing.lower_bound(np.array([60] * 7), 100) == 7


def test_rare_stretches_find_room_in_the_toxic_dictionary():
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(12)) for _ in range(20_000)})
    marking = {f" {w} "[i : i + toxicity.GRAM] for w in words for i in range(10)}
    content = toxicity._toxic_content(marking, [(w, 5 + i) for i, w in enumerate(words)])
    assert all(f" {w} ".encode() in content for w in words)
    ordinary = prose(1, 2500).encode()  # as large as a trained one
    model = toxicity.ToxicModel(ordinary, content, ordinary[-toxicity.CARRIER_BYTES :], ())
    # The passage lies at another offset in a larger dictionary, which may change a byte.
    assert toxicity.evidence(model, "nothing of the kind in here") <= 1
    assert all(toxicity.evidence(model, w) >= 5 for w in words[::400])


def test_added_tokens_are_those_of_the_file(spark):
    """Ids are the ones the tokenizer gives by default, also where a text holds the string of an added token."""
    from tokenizers import Tokenizer

    texts = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> x <|endoftext|><|endoftext|>", "<|endoftext", "plain text", "", None]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = packing.pack_documents(documents(spark, texts), VOCABULARY).collect()
    for r in rows:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [0]
        assert (r["length"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
