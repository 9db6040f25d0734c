import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import language, ppm

SMALL = {"en": [b"the cat sat on the mat.", b"a dog and the cat"], "de": ["der hund und die katze über".encode(), b"das ist die matte"], "xx": [b"zzz"], "yy": []}
MODEL = ppm.fit(SMALL)


@settings(deadline=None, max_examples=100)
@given(st.one_of(st.text(alphabet="the catdogüz.", min_size=1, max_size=40).map(str.encode), st.binary(min_size=1, max_size=20)))
def test_code_lengths_are_exact(text):
    got = ppm.stretch_bits(MODEL, np.frombuffer(text, np.uint8), np.array([0]))[0]
    want = ppm.plain_bits(SMALL, text)
    assert got == pytest.approx([want[x] for x in MODEL.languages], abs=(len(text) + 1) / ppm.UNIT)


def test_stretches_add_up():
    data = np.frombuffer(b"the cat and the dog " * 2000, np.uint8)
    whole = ppm.stretch_bits(MODEL, data, np.array([0]))[0]
    parts = ppm.stretch_bits(MODEL, data, np.arange(0, len(data), 37))
    assert parts.sum(0) == pytest.approx(whole)


def test_sentences():
    texts = ["One here. Two 3.5 there!", "", "   ", "no end", "A (b). “C.” D?\n\nE f\ng h", ". . ."]
    encoded = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(t) for t in encoded])]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    found = language.Sentences(data, offsets)
    got = [(int(d), data[b:e].tobytes().decode()) for d, b, e in zip(found.doc, found.begin, found.end, strict=True)]
    assert got == [(0, "One here."), (0, "Two 3.5 there!"), (3, "no end"), (4, "A (b)."), (4, "“C.”"), (4, "D?"), (4, "E f\ng h"), (5, "."), (5, "."), (5, ".")]


EN = "The children were seen again after two years. Parents filled in a form about the house. No clear difference was found between the groups. The risk was higher in the most exposed homes."
DE = "Die Kinder wurden nach zwei Jahren erneut untersucht. Die Eltern füllten einen Bogen über das Haus aus. Zwischen den Gruppen fand sich kein klarer Unterschied. Das Risiko war in stark belasteten Wohnungen höher."
RU = "Дети были осмотрены снова через два года. Родители заполнили анкету о доме. Между группами не найдено явной разницы. Риск был выше в самых загрязнённых домах."


@pytest.fixture(scope="module")
def documents(spark):
    r = random.Random(1)
    rows = []
    for code, text in (("en", EN), ("de", DE), ("ru", RU)):
        for i in range(30):
            own = text.split(". ")
            r.shuffle(own)
            rows.append((len(rows), ". ".join(s.rstrip(".") for s in own) + ".", code if i % 9 else "de"))
    rows += [(900, EN + " " + DE.split(". ")[0] + ".", "en"), (901, EN.upper(), "English"), (902, DE, "de-AT"), (903, DE, "xx"), (904, RU, None), (905, None, "en"), (906, " ", "en"), (907, RU, "  "), (902, DE, "de-AT"), (908, EN * 300, "EN")]
    return spark.createDataFrame(rows, "doc_id long, text string, label string")


def test_labels(spark):
    rows = ["en", " EN ", "eng", "English", "en-GB", "en_US", "Deutsch", "dut", "xx", "und", "-", "", None, "unknown", "fa", "nb", "bn", "th", "sr-Latn", "Norwegian (Bokmål)", "per", "العربية", "kat", "mul", "zxx"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "l string").select(language.label_code(F.col("l"))).collect()]
    assert got == ["en"] * 6 + ["de", "nl"] + [None] * 6 + ["fa", "no", "bn", "th", "sr", "no", "fa", "ar", "ka", None, None]
    assert 180 <= len({c for c in language.language_names().values()}) <= 190


def test_documents_and_stretches(spark, documents):
    model = language.fitted(documents, label="label")
    assert model.model.languages == ["de", "en", "ru"]
    labelled = language.identify(documents, model, keep=["label"]).cache()
    by = {r.doc_id: r for r in labelled.collect()}
    assert [by[i].lang for i in (900, 901, 902, 903, 904, 905, 906, 908)] == ["en", "en", "de", "de", "ru", None, None, "en"]
    assert labelled.count() == documents.count() and by[905].segments == [] and by[905].confidence is None
    first, second = by[900].segments
    text = EN + " " + DE.split(". ")[0] + "."
    assert (first.lang, second.lang) == ("en", "de") and text[second.start_char :][: second.n_chars] == DE.split(". ")[0] + "."
    assert first.n_sentences == 4 and 0.5 < second.confidence <= 1
    found = {(r.doc_id, r.lang) for r in language.mislabelled(labelled, "label").collect()}
    assert {x for x in found if x[0] >= 900} == {(900, "en"), (900, "de"), (903, "de"), (904, "ru"), (907, "ru")}
    wrong = {(r.doc_id, r.text[:3]) for r in documents.filter("doc_id < 90 and label = 'de' and (doc_id < 30 or doc_id >= 60)").collect()}
    assert {i for i, _ in wrong} == {i for i, _ in found if i < 90}


def test_a_wrong_language_is_not_learnt(spark, documents):
    odd = documents.filter("doc_id < 30").limit(6).withColumn("label", F.lit("pl"))
    assert language.fitted(documents.unionByName(odd), label="label").model.languages == ["de", "en", "ru"]


PL = "W badaniu oceniano związek między zanieczyszczeniem powietrza a astmą u dzieci mieszkających w dużych miastach. Wyniki wskazują na istotny wzrost ryzyka."
FA = "این مطالعه رابطه بین آلودگی هوا و آسم را در کودکان شهرهای بزرگ بررسی کرد. نتایج نشان داد که خطر افزایش یافته است."
NB = "Studien undersøkte sammenhengen mellom luftforurensning og astma hos barn som bor i store byer. Resultatene tyder på en økt risiko for sykdom."


@pytest.fixture(scope="module")
def corpus(spark, data):
    from pathlib import Path

    larger = Path(data).parent / "sf0.01" / "documents.parquet"
    return spark.read.parquet(str(larger if larger.exists() else Path(data) / "documents.parquet")).withColumnRenamed("lang", "label")


def test_texts_in_no_known_language(spark, corpus):
    fit = language.fitted(corpus, label="label")
    probes = [(1, PL, "pl"), (2, FA, "fa"), (3, NB, "nb"), (4, PL, None), (5, FA * 50, "fa"), (6, "xq zzkp wvvw qpl mmnt rrtx kkwq zpzp vxvx qqlm zzkp wvvw", "la")]
    got = language.identify(spark.createDataFrame(probes, "doc_id long, text string, label string"), fit, keep=["label"])
    assert {(r.lang, r.confidence) for r in got.collect()} == {("und", 0.0)}
    assert language.mislabelled(got, "label").count() == 0
    # a text of the corpus is never unknown, and one with a strange sentence keeps its language
    assert language.identify(corpus, fit).filter("lang = 'und'").count() == 0
    mixed = corpus.filter("label = 'en' and n_chars > 1500").limit(1).withColumn("text", F.concat("text", F.lit(" " + FA)))
    row = language.identify(mixed, fit).first()
    assert row.lang == "en" and {s.lang for s in row.segments} >= {"en", "und"}


def test_confidence_is_right_as_often_as_it_says(spark, corpus):
    """Held-out sentences, alone: by tenths of confidence, how often the language is that of the text around."""
    half = F.xxhash64("doc_id") % 2 == 0
    fit = language.fitted(corpus.filter(half), label="label")
    clean = language.identify(corpus.filter(~half), fit, keep=["text", "label"]).filter(language.label_code(F.col("label")) == F.col("lang")).filter("size(segments) = 1")
    alone = clean.select("doc_id", F.col("lang").alias("right"), F.explode(F.split("text", r"(?<=[.!?])\s+")).alias("text")).filter("length(text) between 4 and 200").withColumn("doc_id", F.monotonically_increasing_id())
    got = language.identify(alone, fit, keep=["right"]).filter("lang is not null and lang <> 'und'").select(F.floor(F.col("confidence") * 10).alias("b"), "confidence", (F.col("lang") == F.col("right")).cast("int").alias("ok"))
    bins = got.groupBy("b").agg(F.count("*").alias("n"), F.avg("confidence").alias("c"), F.avg("ok").alias("a")).collect()
    error = sum(r.n * abs(r.c - r.a) for r in bins) / sum(r.n for r in bins)
    print("expected calibration error", round(error, 4))
    assert error < 0.03


def test_no_labels_and_empty_tables(spark, documents):
    none = language.fitted(documents.withColumn("label", F.lit(None).cast("string")), label="label")
    assert none.model.languages == []
    got = language.identify(documents, none)
    assert got.filter("lang is not null").count() == 0 and got.count() == documents.count()
    model = language.fitted(documents, label="label")
    assert language.identify(documents.limit(0), model).count() == 0


def test_held_out_accuracy(spark, data):
    """Labels of one half, hidden from the model, that were not found wrong by a model of all."""
    rows = spark.read.parquet(f"{data}/documents.parquet")
    from pathlib import Path

    larger = Path(data).parent / "sf0.01" / "documents.parquet"
    rows = spark.read.parquet(str(larger)) if larger.exists() else rows
    half = F.xxhash64("doc_id") % 2 == 0
    labelled = rows.withColumn("code", language.label_code(F.col("lang"))).filter("code is not null").withColumnRenamed("lang", "label")
    model = language.fitted(labelled.filter(half), label="label")
    got = language.identify(labelled.filter(~half), model, keep=["code"]).groupBy((F.col("lang") == F.col("code")).alias("same")).count()
    counts = {r.same: r["count"] for r in got.collect()}
    assert counts[True] / sum(counts.values()) > 0.9  # some labels are wrong by design


def test_a_long_stretch_in_an_unseen_script_does_not_overflow():
    rng = np.random.default_rng(5)
    latin = [bytes(rng.choice(list(b"etaoin shrdlu"), 500_000).tolist())]
    model = ppm.fit({"aa": latin, "bb": [x[::-1] for x in latin], "cc": [x.upper() for x in latin], "ru": [("дети и школа " * 40).encode()]})
    text = np.frombuffer(("детиишкола" * 5_000).encode(), np.uint8)
    whole = ppm.stretch_bits(model, text, np.array([0]))[0]
    parts = ppm.stretch_bits(model, text, np.arange(0, len(text), 1_000))
    # a piece other than the first loses nothing: costs depend on the bytes before, not on where a piece begins
    assert len(text) == 100_000 and whole == pytest.approx(parts.sum(axis=0))
    assert model.languages[int(whole.argmin())] == "ru"
