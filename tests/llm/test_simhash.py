"""Fingerprints and near-duplicate classes against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from rankwell.llm import queries, simhash
from rankwell.llm.components import connected_components
from tests.conftest import SMALL


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Least index of each fingerprint's class, by looking at every pair."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_awkward_rows(awkward):
    rows = simhash.components(awkward.withColumn("component", F.lit("mine"))).collect()
    assert len(rows) == awkward.count()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    for r in rows:
        assert r.fingerprint % (1 << 64) == fingerprint(texts[r.doc_id])
    blank = {r.doc_id: r.component_id for r in rows if r.fingerprint == 0}
    assert set(blank) == {0, 1, 2} and set(blank.values()) == {0}
    same = [r.component_id for r in rows if r.doc_id in (4, 50)]
    assert same == [4, 4, 4]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def test_empty_table(empty):
    assert simhash.components(empty).count() == 0
    assert simhash.deduplicate(empty).count() == 0


def test_long_text_in_steps(spark, monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(2000))
    want = fingerprint(text)
    monkeypatch.setattr(simhash, "STEP", 64)
    import pyarrow as pa

    assert simhash.fingerprints_of(pa.array([b"", text.encode(), b"x y"], pa.binary())).astype("u8").tolist() == [
        0,
        want,
        fingerprint("x y"),
    ]


@pytest.mark.parametrize("paired", [2, 20, 2048])
def test_links_connect_all_close_prints(spark, paired):
    rnd = random.Random(paired)
    prints = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 5, 60])):
            flips = rnd.sample(range(64), rnd.randint(0, 5))
            prints.add(centre ^ sum(1 << b for b in flips))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.near_links(df, paired=paired)
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 4 for r in links.collect())
    found = {r.node: r.component for r in connected_components(links).collect()}
    want = classes(prints)
    groups = {}
    for p, c in zip(signed, want):
        groups.setdefault(c, set()).add(found.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({g for s in groups.values() for g in s}) == len(groups)


def test_components_of_a_long_path(spark):
    rows = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (9, None)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert {found[i] for i in range(201)} == {0} and found[501] == found[500] == 500


def test_deduplicate_keeps_one_of_each_class(awkward):
    kept = simhash.deduplicate(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert (False, 0) in ids and (False, 50) not in ids and (False, 1) not in ids
    assert ids.count((False, 4)) == 1 and (True, 0) in ids


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    prints = [fingerprint(t) for _, t in docs]
    want = {i: (f"{p:016x}", docs[c][0]) for (i, _), p, c in zip(docs, prints, classes(prints))}
    rows = queries.QUERIES["op10_simhash"](spark, SMALL).collect()
    assert len(rows) == len(want)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want


def test_odd_radii_are_refused(spark):
    with pytest.raises(ValueError, match="odd"):
        simhash.near_links(spark.createDataFrame([(1,)], "fp long"), radius=3)
