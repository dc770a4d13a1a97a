"""Base forms of Malay words."""

from wordloom.operators.stemming import base_forms

#: Words and the base form each derives from; None where the dictionary has none.
FORMS = dict(pair.split(":") for pair in """
menulis:tulis penulis:tulis tulisan:tulis ditulis:tulis menuliskan:tulis tertulis:tulis penulisan:tulis tulis:tulis
membaca:baca pembaca:baca bacaan:baca dibaca:baca membacakan:baca terbaca:baca pembacaan:baca bacalah:baca
memukul:pukul pemukul:pukul dipukul:pukul pukulan:pukul memukulnya:pukul dipukulnya:pukul
mengambil:ambil pengambilan:ambil diambil:ambil ambilkan:ambil mengambilnya:ambil
mengirim:kirim pengirim:kirim kiriman:kirim dikirimkan:kirim mengirimkannya:kirim
menyapu:sapu penyapu:sapu disapu:sapu sapuan:sapu menyapukan:sapu
mengecat:cat mencari:cari pencarian:cari dicarinya:cari melihat:lihat kelihatan:lihat penglihatan:lihat
berlari:lari berlari-lari:lari pelari:lari larian:lari belajar:ajar pelajar:ajar mengajar:ajar pengajaran:ajar mempelajari:ajar diperlihatkan:lihat
keindahan:indah seindah:indah indahnya:indah memperindah:indah rumah-rumah:rumah rumah-rumahnya:rumah rumahku:rumah perumahan:rumah
kemerah-merahan:merah tolong-menolong:tolong buku:buku bukukah:buku
""".split())
UNKNOWN = ["zaman", "meja", "di", "-", "a-", "-a", "x-y-z", ""]
BASES = sorted(set(FORMS.values()))


def test_sixty_words(spark):
    words = spark.createDataFrame([(w,) for w in [*FORMS, *UNKNOWN, "menulis", None]], "word STRING")
    dictionary = spark.createDataFrame([(b,) for b in [*BASES, "tulis"]], "word STRING")
    got = {r.word: r.base for r in base_forms(words, dictionary).collect()}
    assert len(FORMS) >= 60
    assert got == {**FORMS, **dict.fromkeys(UNKNOWN)}


def test_word_of_the_dictionary_is_its_own_base(spark):
    """Also where it looks like a derived one; of equal ways the longest stem wins; forbidden pairs part nothing."""
    rows = ["makan", "beri", "berikan", "dimakan", "dibacaan"]
    words = spark.createDataFrame([(w,) for w in rows], "word STRING")
    dictionary = spark.createDataFrame([(w,) for w in ("makan", "mak", "beri", "ikan", "baca")], "word STRING")
    got = {r.word: r.base for r in base_forms(words, dictionary).collect()}
    assert got == {"makan": "makan", "beri": "beri", "berikan": "beri", "dimakan": "makan", "dibacaan": None}
    assert base_forms(words.limit(0), dictionary).collect() == []
    assert all(r.base is None for r in base_forms(words, dictionary.limit(0)).collect())
