"""MinHash classes against every pair's exact similarity."""

import random

import pytest
from pyspark.sql import functions as F

from rankwell.llm import minhash, queries
from tests.conftest import SMALL

DOCS = "doc_id long, text string"


def shingles(text, size=2):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size=2, percent=80):
    """{place: (n_shingles, least place of the class)} by looking at every pair."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def compare(df, rows, **options):
    want = {}
    for (i, _), (n, c) in zip(rows, brute(rows, options.get("words", 2), options.get("percent", 80))):
        want[i] = (n, rows[c][0], rows[c][0] == i)
    got = minhash.components(df, **options).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def families(seed, count, size):
    """Texts in families of near copies around the threshold, chains among them; sorted by id."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(count):
        text = [rnd.choice(words) for _ in range(rnd.randint(20, 120))]
        for _ in range(rnd.randint(1, size)):
            texts.append(" ".join(text))
            text = list(text) if rnd.random() < 0.5 else text
            for _ in range(rnd.randint(0, max(1, len(text) // 18))):
                text[rnd.randrange(len(text))] = rnd.choice(words)
    return list(enumerate(texts))


def test_threshold_misses_nothing():
    assert minhash.match_threshold(80) == 10 and minhash.match_threshold(100) == 32


@pytest.mark.parametrize("tile, listed", [(1_000_000, 32_768), (300, 32_768), (2_000, 3)])
def test_families(spark, tile, listed):
    rows = families(tile, 40, 12)
    compare(spark.createDataFrame(rows, DOCS), rows, tile=tile, listed=listed)


def test_other_shingles_and_similarity(spark):
    rows = families(5, 15, 6)
    compare(spark.createDataFrame(rows, DOCS), rows, words=3, percent=60)


def test_large_group_in_one_list(spark):
    """A third of all rows near copies of one text, a third exact ones."""
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join(base[:at] + ["x%d" % i] + base[at:])) for i in range(150) for at in [rnd.randrange(200)]]
    rows += [(i, "the very same text again and again") for i in range(150, 300)]
    rows += [(i, " ".join(f"u{rnd.randrange(10**6)}" for _ in range(50))) for i in range(300, 450)]
    compare(spark.createDataFrame(rows, DOCS), rows)


def test_awkward_rows(awkward):
    got = minhash.components(awkward.withColumn("component_id", F.lit("mine"))).collect()
    assert len(got) == awkward.count()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    for r in got:
        if r.doc_id is not None:
            assert r.n_shingles == len(shingles(texts[r.doc_id]))
    blank = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id in (0, 1, 2)}
    assert blank == {i: (0, i, True) for i in (0, 1, 2)}
    assert [r.component_id for r in got if r.doc_id in (4, 50)] == [4, 4, 4]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert [r.n_shingles for r in got if r.doc_id == 3] == [1]


def test_long_text(spark):
    long = " ".join(f"w{i * i % 100_003}" for i in range(300_000))
    rows = [(1, long), (2, long + " more words at the end"), (3, long[: len(long) // 2]), (4, "x" * 2_000_000)]
    compare(spark.createDataFrame(rows, DOCS), rows)


def test_empty_table(empty):
    assert minhash.components(empty).count() == 0


def test_query(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    want = {rows[i][0]: (n, rows[c][0]) for i, (n, c) in enumerate(brute(rows))}
    got = queries.QUERIES["op12_minhash"](spark, SMALL).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_exploded_rows_are_not_broadcast(spark, monkeypatch):
    """Spark takes exploded rows for as many as before, so none of them may be broadcast by its size."""
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return minhash_stored(df)

    minhash_stored = minhash.stored
    monkeypatch.setattr(minhash, "stored", watched)
    rows = families(7, 10, 6)
    docs = minhash.signed(spark.createDataFrame(rows, DOCS), "text", "m").select("text", F.col("doc_id").alias("node"), "m.*")
    nodes = minhash_stored(docs)
    minhash.proposed(nodes.select("node", "signature"), minhash.match_threshold())
    assert "posexplode" in plans[0] and "Broadcast" not in plans[0]
    found = minhash.links(docs.select("text"), "text", nodes.dropDuplicates(["digest"]))
    met = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" in met and "Broadcast" not in met
