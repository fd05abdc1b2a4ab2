"""Language identification: counts against brute force, accuracy on held-out documents."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwell.llm import language_id, queries


def test_counts_and_scores_equal_brute_force(spark):
    rows = [("abca", "x"), ("bcd", "x"), ("", "x"), ("éa b", "y"), (None, "y"), ("zz", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.fit(df, bits=12)
    assert model.languages == ["x", "y"]

    def grams(text):
        points = np.array([ord(c) for c in text.lower()], np.uint64)
        found = []
        with np.errstate(over="ignore"):
            for n in (1, 2, 3):
                for i in range(len(points) - n + 1):
                    mixed = np.uint64(0)
                    for k in range(n):
                        mixed += points[i + n - 1 - k] * language_id._MIX[k]
                    # The k-th character back takes the k-th factor.
                    found.append(int((mixed * language_id._MIX[0]) >> np.uint64(52)))
        return found

    counts = np.zeros((4096, 2))
    for text, lang in rows:
        if text and lang:
            for g in grams(text):
                counts[g, model.languages.index(lang)] += 1
    logs = np.log((counts + 0.5) / (counts + 0.5).sum(axis=0))
    np.testing.assert_allclose(model.logs, logs, rtol=1e-5)
    text = "abcd é"
    np.testing.assert_allclose(model.totals([b"", text.encode()])[1, :2], logs[grams(text)].sum(axis=0), rtol=1e-5)
    long = "abcé d" * 50
    pieces = language_id.totals_of(model, [long.encode()], 37)
    np.testing.assert_allclose(pieces, model.totals([long.encode()]), rtol=1e-5)


def test_awkward_rows(awkward):
    model = language_id.fit(awkward)
    rows = language_id.identify(awkward.withColumn("score", F.lit("mine")), model).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in (0, 1, 2, 10))
        assert 0 <= r.score <= 1


def test_no_training_rows(awkward, empty):
    model = language_id.fit(empty)
    assert {r.lang_pred for r in language_id.identify(awkward, model).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    df = spark.createDataFrame([(f"t{i}", f"l{i}") for i in range(5)], "text string, lang string")
    with pytest.raises(ValueError):
        language_id.fit(df)


def test_query_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_language_id"](spark, folder).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.97


def test_texts_of_megabytes(spark):
    """A text cut into pieces is told as a short one is."""
    learn = [("the cat and the dog sat there " * 20, "en"), ("der hund und die katze sind hier " * 20, "de")]
    model = language_id.fit(spark.createDataFrame(learn, "text string, lang string"))
    rows = [(1, "the dog and the cat " * 150_000), (2, "die katze und der hund " * 130_000), (3, "1234 " * 500_000)]
    got = {r.doc_id: r.lang_pred for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {1: "en", 2: "de", 3: "und"}


def test_doubt_about_a_label_narrows(spark):
    texts = ("aa bb", "aa bb " * 400_000)
    doubts = [float(language_id.fit(spark.createDataFrame([(t, "xx")], "text string, lang string")).doubt[0]) for t in texts]
    assert doubts[0] > 5 and 0 < doubts[1] < 0.01
