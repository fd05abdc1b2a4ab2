"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankwell.llm import queries, ranked_search
from tests.conftest import SMALL

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score) of lists of (id, text)."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n_docs, total = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        asked = set(terms(text))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in asked}
        found = []
        for i, c, n in counted:
            m = 10 + 90 * n * n_docs // total
            score = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def compare(spark, docs, items, **options):
    got = ranked_search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    rows = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=str)
    assert rows == brute(docs, items, options.get("k", 10))


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    frequent = [1 / (i + 1) for i in range(300)]
    topics = [rnd.sample(words, 40) for _ in range(6)]
    docs = []
    for i in range(n):
        own = rnd.choice(topics)
        text = rnd.choices(words, frequent, k=rnd.randint(0, 60)) + rnd.choices(own, k=rnd.randint(0, 40))
        docs.append((i, " ".join(text)))
        if rnd.random() < 0.2:
            docs[-1] = (i, docs[rnd.randrange(len(docs))][1])
    items = [(j, " ".join(rnd.choices(rnd.choice(topics), k=rnd.randint(1, 20)) + rnd.choices(words, frequent, k=5))) for j in range(25)]
    return docs, items


@pytest.mark.parametrize(
    "options",
    [{}, {"cell_docs": 8, "seeds": 1}, {"cell_docs": 8, "part": 4}, {"cell_docs": 16, "dense": 50}, {"batch_terms": 60, "k": 3}],
    ids=["plain", "small cells", "long items", "small matrices", "batches"],
)
def test_random_corpus(spark, options):
    compare(spark, *corpus(len(str(options)), 300), **options)


def test_blocks_are_skipped_only_below_the_bound(spark):
    docs, items = corpus(4, 300)
    held = ranked_search.item_terms(spark.createDataFrame(items, ITEMS)).toArrow()
    import numpy as np

    lists = [np.sort(np.array(t.as_py(), np.int64).view(np.uint64)) for t in held["terms"]]
    batch = ranked_search._batch(held["item"].to_numpy(), lists, 256)
    marked = ranked_search.vectors(spark.createDataFrame(docs, DOCS), "doc_id", "text", batch.vocabulary).persist()
    weight = ranked_search.weights(marked, batch.vocabulary)
    packed = ranked_search.cells(marked, weight, 10, cell_docs=8)
    limits = ranked_search.bounds(ranked_search.blocks(packed, weight, batch), batch).persist()
    reached = ranked_search.scored(packed, limits, weight, batch, np.ones(len(lists), np.int64), 1000).collect()
    cell_of = {i: r.cell for r in packed.collect() for d in r.docs for i in d.ids}
    most = {}
    for r in limits.collect():
        most.setdefault((r.cell, r.item), []).append(r.bound)
    assert reached and all(min(most[cell_of[r.id], r.item]) > 0 for r in reached)
    for r in reached:
        # A document is in some of the cell's blocks, each of which bounds it.
        assert r.score <= max(most[cell_of[r.id], r.item])
    best = {}
    for r in reached:
        best.setdefault(r.item, []).append(r.score)
    tenth = {q: sorted(s, reverse=True)[9] for q, s in best.items() if len(s) >= 10}
    skipped = [1 for (_, q), b in most.items() for x in b if q in tenth and x < tenth[q]]
    assert skipped


def test_third_of_all_rows_are_copies(spark):
    docs, items = corpus(6, 200)
    same = items[0][1] + " " + items[1][1]
    docs += [(i, same) for i in range(1000, 1100)]
    compare(spark, docs, items, cell_docs=8)


def test_awkward_rows(spark, awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    items = [(1, "the cat, THE mat"), (1, "the cat"), (None, "größe 漢字"), (3, None), (4, ""), (5, "nowhere"), (6, "word x")]
    clash = awkward.withColumn("rank", F.lit(1)).withColumn("score", F.lit("s")).withColumn("item_id", F.lit(0))
    got = ranked_search.search(clash, spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(7)))
    rows = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=str)
    assert rows == brute(docs, items)


def test_long_texts(spark):
    rnd = random.Random(9)
    long = " ".join(f"v{rnd.randrange(40_000)}" for _ in range(250_000))
    docs = [(1, long), (2, long[:300_000]), (3, "v1 v2 v3"), (4, None), (5, "x" * 1_000_000)]
    items = [(1, " ".join(f"v{i}" for i in range(0, 2000, 2))), (2, "v5 v7"), (3, "x" * 1_000_000)]
    compare(spark, docs, items)


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert ranked_search.search(empty, items).count() == 0
    assert ranked_search.search(spark.createDataFrame([(1, "a")], DOCS), items.limit(0)).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = queries.QUERIES["op11_ranked_search"](spark, SMALL)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=str) == brute(docs, items)
