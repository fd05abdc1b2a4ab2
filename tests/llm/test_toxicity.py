"""Toxicity: features and updates against plain Python, quality on held-out documents."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwell.llm import queries, toxicity


def test_features_do_not_depend_on_neighbours():
    texts = [b"You are a Fool!", b"", b"one", "ärger, a b a b a b".encode()]
    together = toxicity.sets(texts)
    for t, found in zip(texts, together):
        assert found.tolist() == toxicity.sets([t])[0].tolist()
    # Words, neighbours, and pairs around one and two words.
    assert [len(s) for s in together] == [4 + 3 + 2 + 1, 0, 1, 3 + 3 + 3 + 3]
    assert set(toxicity.sets([b"fool"])[0]) <= set(together[0])


def test_updates_equal_the_formula():
    rows = [([1, 2], 1), ([2, 3], 0), ([1, 3], 1), ([1, 2, 3], 0)] * 30
    model = toxicity.Ftrl(8)
    z, n = [0.0] * 9, [0.0] * 9
    a, b, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2

    def weight(i):
        if i == 8:
            return -z[i] / ((b + math.sqrt(n[i])) / a)
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((b + math.sqrt(n[i])) / a + l2)

    for at, label in rows:
        model.learn(np.array(at), label)
        ids = [*at, 8]
        w = {i: weight(i) for i in ids}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for i in ids:
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a * w[i]
            n[i] += g * g
    np.testing.assert_allclose(model.z, z[:8])
    np.testing.assert_allclose([model.bias(), *model.weights(np.arange(8))], [weight(8), *map(weight, range(8))])


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(11)] + [(None, 1), (3, None), (4, 1)], "doc_id long, toxic int")
    weights = toxicity.fit(awkward, labels)
    rows = toxicity.score(awkward.withColumn("score", F.lit("mine")), weights).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.fit(empty, labels) == {}
    assert toxicity.fit(awkward, labels.limit(0)) == {}
    assert toxicity.score(empty, weights).count() == 0


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op8_toxicity"](spark, folder).collect()
    told = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and told.get(r.doc_id) is not None]
    bad, good = [r for r in held if told[r.doc_id]], [r for r in held if not told[r.doc_id]]
    assert sum(r.predicted for r in bad) / len(bad) > 0.7
    assert sum(r.predicted for r in good) / len(good) < 0.01
    scores = sorted((r.score, told[r.doc_id]) for r in held)
    ranks = sum(i for i, (_, label) in enumerate(scores, 1) if label)
    assert (ranks - len(bad) * (len(bad) + 1) / 2) / (len(bad) * len(good)) > 0.95


def plain_ftrl(examples):
    """{bucket: weight} of one online pass after another, written out per coordinate."""
    z, n = {}, {}

    def weight(b, l1, l2):
        at = z.get(b, 0.0)
        if abs(at) <= l1:
            return 0.0
        return -(at - math.copysign(l1, at)) / ((toxicity.BETA + math.sqrt(n.get(b, 0.0))) / toxicity.ALPHA + l2)

    def limits(b):
        return (0.0, 0.0) if b == toxicity.BIAS else (toxicity.L1, toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for buckets, label in examples:
            w = {b: weight(b, *limits(b)) for b in [*buckets, toxicity.BIAS]}
            g = 1 / (1 + math.exp(-max(-30, min(30, sum(w.values()))))) - label
            for b in w:
                old = n.get(b, 0.0)
                z[b] = z.get(b, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA * w[b]
                n[b] = old + g * g
    return {b: weight(b, *limits(b)) for b in z if b == toxicity.BIAS or weight(b, *limits(b))}


def test_fit_and_score_by_hand(spark, monkeypatch):
    """Several shards, averaged; repeated rows count once, one id may have several texts, and rows are bounded."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 12)
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 40)
    rnd = random.Random(4)
    vile, fine = ["awful", "nasty", "vile", "rotten"], ["good", "kind", "calm", "nice"]
    texts = [(i, " ".join(rnd.choices(vile if i % 3 == 0 else fine, k=6) + rnd.choices(["the", "a", "of"], k=6))) for i in range(30)]
    texts += [(0, "another vile nasty text of the same id %d" % j) for j in range(200)] + [texts[1]] * 300 + [(5, None), (None, "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(30)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.fit(docs, labels)
    pairs = sorted({(i, t) for i, t in texts if i is not None and t is not None})
    hashes = spark.createDataFrame(pairs, "id long, text string").select(
        "id", "text", F.xxhash64("id").alias("o"), F.xxhash64("text").alias("m"), F.xxhash64(F.xxhash64("id"), F.xxhash64("text")).alias("h")
    )
    chosen = sorted((r.o, r.id, r.m, r.h, r.text) for r in hashes.collect())[:40]
    shards, want = 4, {}
    for shard in range(shards):
        own = sorted((h, t, i) for _, i, _, h, t in chosen if h % shards == shard)
        examples = [(toxicity.sets([t.encode()])[0].tolist(), int(i % 3 == 0)) for _, t, i in own]
        if examples:
            for b, w in plain_ftrl(examples).items():
                want[b] = want.get(b, 0.0) + w / shards
    assert got.keys() == want.keys() and all(got[b] == pytest.approx(want[b]) for b in want)
    probe = ["vile nasty rotten awful", "good kind calm", "", None]
    rows = toxicity.score(spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string"), got).orderBy("doc_id").collect()
    for r, text in zip(rows, probe):
        total = sum(want.get(b, 0.0) for b in toxicity.sets([(text or "").encode()])[0].tolist()) + want[toxicity.BIAS]
        assert r.score == pytest.approx(1 / (1 + math.exp(-total))) and r.predicted == int(r.score >= 0.5)


def test_texts_of_megabytes(spark):
    rows = [(1, "vile words " * 200_000), (2, "x" * 2_000_000)]
    weights = {int(toxicity.sets([b"vile"])[0][0]): 3.0, toxicity.BIAS: -1.0}
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), weights).orderBy("doc_id").collect()
    assert got[0].score == pytest.approx(1 / (1 + math.exp(-2))) and got[1].score == pytest.approx(1 / (1 + math.e))
