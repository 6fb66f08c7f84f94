import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from retourlens.llm import langid
from tests.llm.helpers import documents

WORDS = {
    "en": "the and of that with this from have they their which would there about".split(),
    "fr": "le la les des une dans pour avec être était où même après très".split(),
    "el": "και την του που στο για από είναι δεν μια στην τους όπως".split(),
}


def sentence(language, seed, n=60):
    r = random.Random(f"{language}{seed}")
    return " ".join(r.choice(WORDS[language]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    texts = [sentence(language, i) for language in WORDS for i in range(40)]
    langs = [language for language in WORDS for _ in range(40)]
    docs = documents(spark, [*texts, None, "", "12 34", "the lost label"], lang=[*langs, "en", "en", "fr", None])
    return langid.fit(docs, sample_per_language=30)


def test_held_out_sentences(spark, model):
    texts = [sentence(language, i) for language in WORDS for i in range(100, 130)]
    docs = documents(spark, texts, lang=[language for language in WORDS for _ in range(30)])
    found = langid.identify(docs, model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0 < r["score"] <= 1 and not r["rejected"] for r in found)


def test_rejection_and_texts_without_letters(spark, model):
    texts = [None, "", "123 !?", "ქართული ენა არის " * 30, sentence("en", 1), sentence("en", 1), sentence("fr", 2) * 2000]
    docs = documents(spark, texts).withColumnRenamed("source", "Score").withColumnRenamed("n_chars", "value")
    found = langid.identify(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "value", "lang_pred", "score", "rejected"]
    got = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in found.collect()}
    assert [got[i] for i in (0, 1, 2)] == [("und", True)] * 3
    assert got[3][1] and got[4] == got[5] == ("en", False) and got[6] == ("fr", False)
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6]


def test_vectors():
    counts, size = langid.ngram_counts("Ab1 -- c")
    assert size == len(" ab c ") and counts.sum() == 6 + 5 + 4
    vector = langid.tfidf(counts, np.ones(langid.DIMS))
    assert np.linalg.norm(vector) == pytest.approx(1)
    assert (langid.ngram_counts("AB C")[0] == counts).all()


def test_document_frequencies_cover_all_rows(spark):
    """The sample bounds the centroids only."""
    docs = documents(spark, [sentence("en", i) for i in range(50)] + ["zebra"] * 3)
    idf = langid.fit(docs, sample_per_language=1).idf
    rare = langid.ngram_counts("zebra")[0] > 0
    common = langid.ngram_counts("the")[0] > 0
    assert idf[rare & ~common].max() == pytest.approx(np.log(54 / 4) + 1)


def test_nothing_to_learn_from(spark):
    empty = langid.fit(documents(spark, []))
    found = langid.identify(documents(spark, ["some text"]), empty).first()
    assert (found["lang_pred"], found["score"]) == ("und", 0.0)
    assert langid.identify(documents(spark, []), empty).count() == 0


def test_no_language_learned_keeps_texts_with_letters(spark):
    docs = documents(spark, ["some words", None, "12 !!", "", "more"], lang=[None] * 5).withColumn("Score", F.lit(1)).withColumn("row", F.lit("x"))
    model = langid.fit(docs)
    assert model.languages == []
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 4]


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    """A text that half of all rows share is one text of at most about the stated number."""
    seen = []
    monkeypatch.setattr(langid, "_least", lambda near, classes, part: seen.append(len(near)) or np.zeros(langid.LENGTH_CLASSES))
    texts = [sentence("en", i) + f" {chr(97 + i % 26) * 3}{chr(97 + i // 26) * 4}" for i in range(400)]
    langid.fit(documents(spark, texts + [texts[r] for r in (3, 5, 7, 11)] * 200), sample_per_language=40)
    assert 15 <= seen[0] <= 80
    langid.fit(documents(spark, ["the one text of all rows"] * 500), sample_per_language=40)
    assert seen[1] == 1
