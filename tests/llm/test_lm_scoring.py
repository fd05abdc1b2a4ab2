"""LM scoring against a plain trie with explicit exclusion sets, and on held-out documents."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwell.llm import lm_scoring, queries
from tests.conftest import SMALL


class Trie:
    """Followers of every context of up to ORDER symbols."""

    def __init__(self, texts):
        self.followers = defaultdict(Counter)
        for text in texts:
            for context, symbol in self.steps(text):
                for k in range(len(context) + 1):
                    self.followers[context[len(context) - k :]][symbol] += 1

    @staticmethod
    def steps(text):
        symbols = [256] * lm_scoring.ORDER + list((text or "").encode()) + [256]
        for i in range(lm_scoring.ORDER, len(symbols)):
            yield tuple(symbols[i - lm_scoring.ORDER : i]), symbols[i]

    def log10(self, text):
        total = 0.0
        for context, symbol in self.steps(text):
            excluded = set()
            for k in range(lm_scoring.ORDER, -1, -1):
                after = self.followers.get(context[lm_scoring.ORDER - k :])
                if not after:
                    continue
                left = {s: n for s, n in after.items() if s not in excluded}
                if not left:
                    continue
                size = sum(left.values()) + len(left)
                if symbol in left:
                    total += math.log10(left[symbol] / size)
                    break
                total += math.log10(len(left) / size)
                excluded |= set(left)
            else:
                total -= math.log10(257 - len(excluded))
        return total


def base(texts, train):
    def tokens(text):
        return [*(text or "").encode().lower().split(), b""]

    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for t in texts:
        own = tokens(t)
        yield len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)


def compare(rows, docs, train):
    trie, want = Trie(train), list(base([t for _, t in docs], train))
    assert len(rows) == len(docs)
    for r, (i, text), (n, known, total, plain) in zip(rows, docs, want):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (i, n, known, total)
        assert r.base_score == pytest.approx(plain, rel=1e-9)
        assert r.score == pytest.approx(trie.log10(text), rel=1e-9)


@pytest.mark.parametrize("small", [False, True])
def test_awkward_rows(awkward, monkeypatch, small):
    if small:  # many batches, short folds
        monkeypatch.setattr(lm_scoring, "BATCH_BYTES", 1000)
    docs = awkward.withColumn("score", F.lit("mine")).withColumn("batch", F.lit(1))
    order = lambda r: (r.doc_id is None, r.doc_id or 0)
    got = sorted(lm_scoring.score(docs, F.coalesce(F.col("doc_id") % 3, F.lit(0)) != 1).collect(), key=order)
    given = sorted(awkward.collect(), key=order)
    compare(got, [(r.doc_id, r.text) for r in given], [r.text for r in given if (r.doc_id or 0) % 3 != 1])


def test_nothing_to_learn_from(awkward, empty):
    rows = lm_scoring.score(awkward, F.lit(None).cast("boolean")).collect()
    assert {r.train_tokens for r in rows} == {0} and all(r.held_out for r in rows)
    row = next(r for r in rows if r.doc_id == 3)
    assert row.score == pytest.approx(-2 * math.log10(257)) and row.base_score == pytest.approx(0)
    assert lm_scoring.score(empty, F.lit(True)).count() == 0


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    rows = sorted(queries.QUERIES["op1_lm_scoring"](spark, SMALL).collect(), key=lambda r: r.doc_id)
    learns = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in docs]
    assert [r.held_out for r in rows] == [not x for x in learns]
    compare(rows, docs, [t for (_, t), x in zip(docs, learns) if x])
    size = sum(len((t or "").encode()) + 1 for (_, t), x in zip(docs, learns) if not x)
    assert sum(r.score for r in rows if r.held_out) > -0.45 * size * math.log10(257)


def test_a_third_of_all_rows_equal(spark, monkeypatch):
    """Equal rows from several parts of the input go to several batches, and each is scored."""
    monkeypatch.setattr(lm_scoring, "BATCH_BYTES", 2000)
    rows = [(7, "the very same text again and again")] * 60 + [(i, f"text number {i} of many, all different {i * i}") for i in range(100, 220)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted(lm_scoring.score(df, F.col("doc_id") % 2 == 0).collect(), key=lambda r: r.doc_id)
    rows.sort()
    compare(got, rows, [t for i, t in rows if i % 2 == 0])


def test_long_text_and_small_folds(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FOLD", 500)
    monkeypatch.setattr(lm_scoring, "SLICE_BYTES", 3000)
    rnd = random.Random(2)
    long = " ".join(rnd.choice(["alpha", "beta", "gamma", "x" * 30, "ü漢"]) + str(rnd.randrange(50)) for _ in range(20_000))
    rows = [(1, long), (2, long[:1000]), (3, "short"), (4, None)]
    got = sorted(lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") != 1).collect(), key=lambda r: r.doc_id)
    compare(got, rows, [t for i, t in rows if i != 1])


def test_megabytes(spark):
    text = "all work and no play " * 150_000
    rows = spark.createDataFrame([(1, text), (2, "x" * 2_000_000), (3, "all work")], "doc_id long, text string")
    got = {r.doc_id: r for r in lm_scoring.score(rows, F.col("doc_id") == 1).collect()}
    assert got[1].n_tokens == 750_001 and got[2].n_tokens == 2 and got[3].n_known == 3
    assert got[1].score > -0.05 * len(text) and got[2].score < -2_000_000


def test_codes_are_found_by_hash():
    rng = np.random.default_rng(0)
    table, want = lm_scoring.Codes(), {}
    for _ in range(30):
        codes = rng.integers(0, 1 << 54, 3000) >> int(rng.integers(0, 54))
        for c, at in zip(codes.tolist(), table.add(codes).tolist()):
            assert want.setdefault(c, at) == at
    assert len(set(want.values())) == len(want) == table.n
    assert table.find(np.array([-1 + (1 << 60), *list(want)[:5]])).tolist() == [-1, *list(want.values())[:5]]
