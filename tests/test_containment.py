"""Which texts stand inside others, and lists that take only entries of their own."""

import random

from pyspark.sql import functions as F

from wordloom.operators import containment
from wordloom.operators import lookup as lk
from wordloom.operators.containment import contained
from wordloom.session import staged


def plain_append(listed, new):
    """The list's own rule, entry by entry."""
    entries, added, taken = [t for t in listed if t is not None], [], set()
    for _, text in sorted(new):
        if text is None or text in taken:
            if text not in taken:  # null equals nothing, so it is new once
                taken.add(None)
                added.append(None)
            continue
        if not any(text in e for e in entries):
            entries.append(text)
            added.append(text)
            taken.add(text)
    return [(len(listed) + i, t) for i, t in enumerate(added)]


def appended(spark, listed, new):
    stored = spark.createDataFrame([(t, 1) for t in listed], "query string, no int")
    fresh = spark.createDataFrame([(i, t, "x") for i, t in new], "ord bigint, query string, text string")
    return sorted(tuple(r) for r in lk.append_numbered(stored, fresh, "ord", "contains").collect())


def test_contained_entries_are_those_of_all_pairs(spark):
    """2,000 entries over three letters, so that most are inside others, and texts shorter than a gram."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abß") for _ in range(n))
    listed = [word(rng.choice([0, 1, 3, 7, 8, 9, 30, 200])) for _ in range(400)] + ["line\nbreak and more", None]
    new = [(i, word(rng.choice([1, 2, 5, 7, 8, 9, 10, 12, 14, 25, 60]))) for i in range(1600)]
    new += [(5000, "k\nbreak an"), (5001, "k.break an"), (5002, "😀 clef 𝄞 x"), (5003, "clef 𝄞"), (5004, None), (5005, ""), (5006, "%_\\")]
    assert appended(spark, listed, new) == plain_append(listed, new)


def test_contained_in_an_empty_list(spark):
    assert appended(spark, [], [(1, ""), (2, "b"), (3, "ab"), (4, "a")]) == [(0, ""), (1, "b"), (2, "ab")]
    assert appended(spark, [], [(1, "ab"), (2, ""), (3, "b")]) == [(0, "ab")]
    assert appended(spark, ["ab"], []) == []
    assert appended(spark, [None], [(1, "x" * 9)]) == [(1, "x" * 9)]


def test_long_text_and_common_gram_stay_cheap(spark):
    """A gram that half of the entries hold is not the one they are looked up by; a long text posts in linear time."""
    rng = random.Random(7)
    long = "".join(rng.choice("abcdefghij ") for _ in range(100_000))
    listed = [long] + [f"a common opening of entry {i}" for i in range(3000)]
    new = [(i, f"a common opening of entry {i * 7}") for i in range(1000)] + [(2000, long[50_000:50_040]), (2001, long[3:30] + "!")]
    got = appended(spark, listed, new)
    assert [t for _, t in got] == [t for _, t in new[429:1000]] + [new[-1][1]]
    asked = spark.createDataFrame([(i, t) for i, t in new], "asked bigint, text string")
    holders = spark.createDataFrame(list(enumerate(listed)), "holder bigint, text string")
    pairs = contained(asked, holders)
    assert pairs.where(F.col("asked") == 2000).select("holder").collect() == [(0,)]


def test_entries_with_common_grams_make_no_pairs(spark, monkeypatch):
    """Entries whose every gram stands in all listed texts are found as wholes, not holder by holder."""
    rng = random.Random(8)
    listed = ["".join(rng.choice("ab") for _ in range(2000)) for _ in range(300)]
    new = [(i, listed[i % 300][i % 1900: i % 1900 + 12 + i % 60] + ("" if i % 3 else "c")) for i in range(3000)]
    posted = []
    monkeypatch.setattr(containment, "staged", lambda df, name: posted.append((name, staged(df, name))) or posted[-1][1])
    assert appended(spark, listed, new) == plain_append(listed, new)
    assert max(df.count() for _, df in posted) <= 3000


def test_asked_lengths_around_powers_of_two_and_stretches(spark, monkeypatch):
    """Texts over the ends of stretches, of lengths about 2 ** n, in one holder, and the lowest of several holders."""
    monkeypatch.setattr(containment, "STRETCH", 64)
    rng = random.Random(9)
    whole = "".join(rng.choice("xyzäö€😀") for _ in range(700))
    texts = {whole[i: i + n] for i in range(0, 640, 7) for n in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 60)}
    holders = [(whole, 5), (whole[100:300], 3), (whole[200:], None), (None, 1), ("", 0), ("y", 9)]
    got = containment.first_holders(spark.createDataFrame([(t,) for t in [*texts, "q" * 9, None, ""]], "text string"),
                                    spark.createDataFrame(holders, "text string, held bigint"))
    found = {bytes(r["text"]).decode(): r["first"]["held"] for r in got.collect()}
    low = lambda t: min((-1 if h is None else h) for w, h in holders if w and t in w)
    assert {t: -1 if h is None else h for t, h in found.items()} == {t: low(t) for t in texts}
