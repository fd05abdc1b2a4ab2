"""Licence scans: phrase places and matching statistics against brute force."""

import random

from pyspark.sql import functions as F

from rankwell.llm import license_scan, queries
from tests.conftest import SMALL


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in lowered).split(" ")


def places(text):
    own = [w for w in words(text) if w]
    found = []
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]
    return len(own), sorted(found)


def test_scan_equals_brute_force_on_random_words():
    rnd = random.Random(3)
    templates = [("a", "x y z x y w x"), ("b", "y z x q q y z"), ("a", "x y z"), ("c", "q")]
    phrases = {"x y": "p", "z x y": "r", "q q q": "s"}
    machine = license_scan.Automaton(templates, phrases)
    for _ in range(300):
        text = [rnd.choice("xyzwqu") for _ in range(rnd.randint(0, 30))]
        found, blocks = machine.scan([w.encode() for w in text])
        want = [
            (k, i)
            for k, p in enumerate(phrases)
            for i in range(len(text))
            if text[i : i + len(p.split())] == p.split()
        ]
        assert sorted(found) == sorted(want)
        # Of each template the longest suffix of each prefix that it holds; a block where it can't go on.
        want = []
        for t, (_, k) in enumerate(templates):
            own = k.split()

            def longest(i):
                return max((n for n in range(i + 1) if any(own[j : j + n] == text[i - n : i] for j in range(len(own)))), default=0)

            stats = [longest(i) for i in range(len(text) + 1)]
            for i in range(1, len(text) + 1):
                n = stats[i]
                if n >= license_scan.MIN_BLOCK and (i == len(text) or stats[i + 1] <= n):
                    want += [(t, i - n, j, n) for j in range(len(own)) if own[j : j + n] == text[i - n : i]]
        assert sorted(blocks) == sorted(want)


def fullest_chains(blocks):
    """Spans of one template, every chain listed: the fullest, then what is left, again and again."""
    gap, taken = license_scan.MAX_GAP, []

    def fits(chain, block):
        (s, a, n), (start, at, _) = chain[-1], block
        return s + n <= start <= s + n + gap and a + n <= at

    def chains(chain):
        yield chain
        for block in blocks:
            if fits(chain, block):
                yield from chains([*chain, block])

    every = [c for block in blocks for c in chains([block])]
    spans = [(-sum(n for _, _, n in c), c[0][0], c[-1][0] + c[-1][2]) for c in every]
    for covered, first, end in sorted(spans):
        if all(end <= f or first >= e for _, f, e in taken):
            taken.append((-covered, first, end))
    return sorted((first, end, covered) for covered, first, end in taken)


def test_spans_equal_every_chain_listed():
    """The spans that hold most: no chain covers more than the fullest span found, nor than what is left over."""
    rnd = random.Random(8)
    machine = license_scan.Automaton([("t", "a b c d e f g h a b c i j")], {})
    for _ in range(200):
        text = []
        for _ in range(rnd.randint(1, 4)):
            at = rnd.randrange(10)
            text += "a b c d e f g h a b c i j".split()[at : at + rnd.randint(2, 7)] + ["u"] * rnd.choice([0, 1, 9])
        _, blocks = machine.scan([w.encode() for w in text])
        got = sorted((first, end, covered) for _, first, end, covered in machine.chain(blocks))
        want = fullest_chains([b[1:] for b in blocks])
        assert max([c for *_, c in got], default=0) == max([c for *_, c in want], default=0)
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))


def test_templates_inside_longer_matches():
    """A notice that stands whole is found, though another template's match goes on past its end."""
    head = "licensed under the apache license version 2 0"
    machine = license_scan.Automaton(license_scan.TEMPLATES, license_scan.PHRASES)
    for tail in ("see file", "the", "the license is great", "the license you may not use", ""):
        _, blocks = machine.scan(f"x {head} {tail}".encode().split())
        best = {}
        for t, _, _, covered in machine.chain(blocks):
            label, own = machine.templates[t]
            best[label] = max(best.get(label, 0), covered / len(own))
        assert best["apache-2.0"] == 1.0, tail
    machine = license_scan.Automaton([("A", "a b c d e f g h i j"), ("B", "x d e f y")], {})
    _, blocks = machine.scan(b"a b c x d e f y g h i j".split())
    assert sorted(machine.chain(blocks)) == [(0, 0, 12, 10), (1, 3, 8, 5)]


def test_long_text(spark):
    body = dict(license_scan.TEMPLATES)["bsd"]
    text = "filler words here " * 100_000 + body + " all rights reserved " + "more of it " * 100_000
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_words == 600_000 + len(body.split()) + 3
    assert [(p.label, p.start) for p in row.places] == [("reserved", 300_000 + len(body.split()))]
    assert [(s.label, s.start, s.coverage) for s in row.spans if s.coverage >= 0.8] == [("bsd", 300_000, 1.0)]


def test_chain_bridges_small_changes(spark):
    body = dict(license_scan.TEMPLATES)["bsd"].split()
    changed = body[:8] + ["new"] + body[9:]
    rows = [(1, "intro " + " ".join(changed) + " outro"), (2, " ".join(body[:5])), (3, "Released under the MIT License.")]
    out = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = {r.doc_id: r.spans for r in out.collect()}
    bsd = next(s for s in spans[1] if s.label == "bsd")
    assert (bsd.start, bsd.end) == (1, len(body) + 1) and bsd.coverage == (len(body) - 1) / len(body)
    assert all(s.coverage < license_scan.COVERED for s in spans[2])
    assert [(s.label, s.coverage) for s in spans[3] if s.coverage >= 0.8][0] == ("mit", 1.0)


def test_a_weak_early_chain_gives_way_to_a_fuller_one():
    machine = license_scan.Automaton([("t", "w1 w2 w3 w4 w5 w6 w7 w8")], {})
    text = "w1 w2 w3 w1 w2 w3 w4 w5 w6 w7 x w6 w7 w8"
    _, blocks = machine.scan(text.encode().split())
    assert sorted(blocks) == [(0, 0, 0, 3), (0, 3, 0, 7), (0, 11, 5, 3)]
    assert sorted(machine.chain(blocks)) == [(0, 0, 3, 3), (0, 3, 10, 7), (0, 11, 14, 3)]


def test_awkward_rows(awkward):
    rows = license_scan.scan(awkward.withColumn("spans", F.lit(1))).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        n, found = places(r.text)
        assert r.n_words == n and [(p.start, p.label) for p in r.places] == found
    row = next(r for r in rows if r.doc_id == 8)
    assert [p.label for p in row.places] == ["reserved", "cc-by", "gpl"]


def test_empty_table(empty):
    assert license_scan.scan(empty).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_license_scan"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    seen = set()
    for r in rows:
        n, found = places(docs[r.doc_id])
        starts = [s for s, _ in found]
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(found), ",".join(sorted({x for _, x in found})))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1
        seen |= set(r.labels.split(","))
        assert ("MIT License" in (docs[r.doc_id] or "")) == ("mit" in r.labels.split(","))
    assert {"mit", "apache-2.0", "reserved"} <= seen
