import random
import zlib

import numpy as np
import pytest

from tessera.llm import langid as L

SYLLABLES = {"en": ["the", "ing", "th", "on", "er"], "fr": ["eau", "eux", "re", "la", "é"], "de": ["sch", "ung", "ein", "ch", "ü"]}


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(0)
    rows = []
    for k in range(900):
        lang = list(SYLLABLES)[k % 3]
        text = " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randrange(1, 4))) for _ in range(draw.randrange(3, 60)))
        rows.append((k, text, lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark, corpus):
    model = L.learn_centroids(corpus)
    assert {x: model.languages.count(x) for x in model.languages} == dict.fromkeys(SYLLABLES, L.CLUSTERS)
    rows = L.identify(corpus, model).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    # Something quite different is rejected, though the nearest language is still named.
    lang, score, rejected = L.predict("жзик вфыщ цпъэ " * 20, model)
    assert lang in SYLLABLES and rejected and score < 0.3


def test_held_out_labels_are_not_used(spark, corpus):
    from pyspark.sql import functions as F
    turned = corpus.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "xx").otherwise(F.col("lang")))
    a, b = L.learn_centroids(corpus), L.learn_centroids(turned)
    assert a.languages == b.languages and np.allclose(a.vectors, b.vectors)


def test_counts_do_not_depend_on_blocks(monkeypatch):
    text = "Ein läng'rer Text, mit 12 Zahlen und ÄÖÜ. " * 50
    whole = L.counts_of(text)
    assert whole.sum() > 0 and L.counts_of("12 34 !? \U0001f600 。") is None and L.counts_of("中") is not None
    monkeypatch.setattr(L, "BLOCK", 100_000)
    assert (L.counts_of(text) == whole).all()


def test_clusters_are_unit_vectors():
    vectors = L.vectors_of(np.random.default_rng(0).integers(0, 5, size=(40, L.DIMENSIONS)), np.ones(L.DIMENSIONS))
    assert np.allclose(np.linalg.norm(L.cluster(vectors, 4), axis=1), 1, atol=1e-4)
    assert len(L.cluster(np.repeat(vectors[:1], 5, axis=0), 4)) <= 4  # equal texts


def test_messy_and_empty_tables(spark, messy, no_docs):
    model = L.learn_centroids(messy)
    got = {r["doc_id"]: r for r in L.identify(messy, model).collect()}
    assert L.identify(messy, model).count() == messy.count()
    assert all((got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0) for k in (2, 3, 4, 10))
    assert got[0]["lang_pred"] in ("en", "de", "fr")
    assert L.learn_centroids(no_docs) is None and L.identify(no_docs, None).count() == 0
    assert {r["lang_pred"] for r in L.identify(messy, None).collect()} == {"und"}
