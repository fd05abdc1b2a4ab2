"""Decontamination against a brute-force search of every window."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rankwell.llm import decontaminate, queries
from tests.conftest import SMALL
from tests.llm.test_license_scan import words as raw_words


def words(text):
    return [w for w in raw_words(text) if w]


def brute(docs, items):
    """[(n_words, n_hit, item ids)] of each document."""
    windows = {}
    for i, text in items:
        own = words(text)
        for at in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[at : at + 10]), set()).add(i)
    lengths = {len(w) for w in windows}
    out = []
    for text in docs:
        own, hit, found = words(text), set(), set()
        for n in lengths:
            for at in range(len(own) - n + 1):
                if ids := windows.get(tuple(own[at : at + n])):
                    hit |= set(range(at, at + n))
                    found |= ids
        out.append((len(own), len(hit), sorted(str(i) for i in found)))
    return out


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz"])
def test_random_words(spark, letters):
    rnd = random.Random(len(letters))
    items = [(i, " ".join(rnd.choice(letters) for _ in range(rnd.randint(0, 25)))) for i in range(30)]
    docs = []
    for _ in range(80):
        parts = [" ".join(rnd.choice(letters) for _ in range(rnd.randint(0, 12)))]
        for _ in range(rnd.randint(0, 3)):
            own = rnd.choice(items)[1].split()
            at = rnd.randint(0, len(own))
            parts += [" ".join(own[at : at + rnd.randint(1, 20)]).upper(), rnd.choice(["", "é", "- b"])]
        docs.append(" . ".join(parts))
    got = decontaminate.scan(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).orderBy("doc_id")
    rows = got.collect()
    assert [(r.n_words, r.n_hit, r.item_ids) for r in rows] == brute(docs, items)
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_awkward_rows(spark, awkward):
    items = [(1, "The cat sat on the mat"), (1, "cat sat"), (None, "three4five"), (2, None), (3, ""), (4, "漢字"), (5, "." * 50)]
    table = spark.createDataFrame(items, "item_id long, text string")
    clash = awkward.withColumn("n_hit", F.lit(7)).withColumn("__row", F.lit(7))
    rows = decontaminate.scan(clash, table).collect()
    assert len(rows) == awkward.count()
    named = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert named[4].item_ids == ["1"] and named[4].n_hit == 12
    assert named[5].n_hit == 1 and named[5].item_ids == []
    assert named[6].item_ids == ["4"]
    assert named[0].n_words == 0 and named[0].n_hit == 0
    kept = decontaminate.clean(awkward, table)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(r.n_hit == 0 for r in rows)


def test_empty_tables(spark, awkward, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontaminate.scan(empty, some).count() == 0
    assert {r.n_hit for r in decontaminate.scan(awkward, none).collect()} == {0}


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute([t for _, t in docs], items)
    rows = queries.QUERIES["op4_decontaminate"](spark, SMALL).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows] == [
        (i, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0) for (i, _), (n, hit, ids) in zip(docs, want)
    ]
    assert any(r.contaminated for r in rows)


def test_texts_of_megabytes(spark):
    passage = " ".join(f"item{i}" for i in range(40))
    long = "some filler words here " * 150_000 + passage + " and the rest " * 150_000
    rows = spark.createDataFrame([(1, long), (2, "x" * 2_000_000), (3, "short")], "doc_id long, text string")
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.scan(rows, items).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].item_ids) == (1_050_040, 40, ["7"])
    assert [(s.start, s.end) for s in got[1].spans] == [(600_000, 600_040)]
    assert got[2].n_hit == got[3].n_hit == 0
    assert sorted(r.doc_id for r in decontaminate.clean(rows, items).collect()) == [2, 3]
