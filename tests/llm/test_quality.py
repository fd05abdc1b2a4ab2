"""Quality rules: measures against brute force, the cascade against all rules at once."""

import random
import re

from pyspark.sql import functions as F

from rankwell.llm import quality
from tests.conftest import SMALL

RULES_OF = {
    "short": lambda m: m["n"] < 50,
    "repeats": lambda m: 100 * m["repeat"] > 50 * m["n"],
    "symbols": lambda m: 100 * m["symbols"] > 10 * m["n"],
    "repeated_lines": lambda m: 100 * m["dup"] > 50 * m["lines"],
    "word_length": lambda m: m["chars"] < 2 * m["n"] or m["chars"] > 15 * m["n"],
    "few_letters": lambda m: 100 * m["lettered"] < 60 * m["n"],
}


def measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return {
        "n": len(words),
        "chars": sum(map(len, words)),
        "symbols": sum(c in "#*$%&|<>" for c in text),
        "lines": len(lines),
        "dup": len(lines) - len(set(lines)),
        "repeat": len(again),
        "lettered": sum(any(c.isalpha() for c in w) for w in words),
    }


def texts():
    rnd = random.Random(4)
    out = []
    for _ in range(150):
        letters = rnd.choice(["ab", "abcdefgh", ["one", "two", "##", "é|", "17"], [f"w{i}" for i in range(60)]])
        out.append("".join(rnd.choice(letters) + rnd.choice([" ", "  ", "\n", "\t", "\x0b", "\x1c"]) for _ in range(rnd.randint(0, 120))))
    return out


def test_measures_and_cascade_equal_brute_force(spark, awkward):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts(), 100)]
    docs = awkward.filter("doc_id <> 9").union(spark.createDataFrame(rows, awkward.schema))
    docs = docs.withColumn("n_words", F.lit("mine"))
    for rules in (quality.RULES, quality.RULES[::-1], None):
        got = quality.judge(quality.measured(docs), rules).collect()
        assert len(got) == docs.count()
        for r in got:
            m = measures(r.text)
            assert (r.n_words, r.word_chars, r.n_symbols) == (m["n"], m["chars"], m["symbols"])
            assert (r.n_dup_lines, r.n_repeat_words) == (m["dup"], m["repeat"])
            assert r.base_failed == (RULES_OF["short"](m) or RULES_OF["repeats"](m))
            broken = [x.name for x in rules or quality.RULES if RULES_OF[x.name](m)]
            if rules:
                assert r.rejected_by == (broken[0] if broken else None)
            else:
                assert (r.rejected_by in broken) if broken else r.rejected_by is None
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not any(f(measures(r.text)) for f in RULES_OF.values()) for r in docs.collect())


def test_long_text(spark):
    df = spark.createDataFrame([("word " * 30000,), (" ".join(f"w{i}" for i in range(30000)) + " w1 w2 w3",)], "text string")
    rows = quality.measured(df).collect()
    assert [(r.n_words, r.n_repeat_words) for r in rows] == [(30000, 30000), (30003, 6)]


def test_empty_table(empty):
    assert quality.judge(quality.measured(empty)).count() == 0
    assert quality.keep(empty).count() == 0


def test_order_follows_rejections_per_second(monkeypatch):
    told = [("short", 1.0, 10), ("repeats", 0.1, 9), ("symbols", 2.0, 0)]
    monkeypatch.setattr(quality, "estimates", lambda *a: told)
    assert [r.name for r in quality.ordered(None, quality.RULES[:3])] == ["repeats", "short", "symbols"]


def test_native_plan(awkward):
    df = quality.judge(quality.measured(awkward), quality.RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_rules_by_measured_columns_equal_those_by_text(spark, awkward):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.union(awkward.filter("doc_id < 50").dropDuplicates(["doc_id"]).select(F.col("doc_id") + 100_000, "text"))
    held = quality.measured(docs)
    by_text = {r.doc_id: r.rejected_by for r in quality.judge(docs, quality.RULES).collect()}
    assert by_text == {r.doc_id: r.rejected_by for r in quality.judge_measured(held, quality.RULES).collect()}
    kept = {r.doc_id for r in quality.judge_measured(held).filter("rejected_by is null").collect()}
    assert kept == {i for i, why in by_text.items() if why is None}


def test_texts_of_megabytes(spark):
    rows = [(1, "word " * 600_000), (2, "".join(f"w{i} " for i in range(400_000)))]
    got = {r.doc_id: r for r in quality.judge_measured(quality.measured(spark.createDataFrame(rows, "doc_id long, text string")), quality.RULES).collect()}
    assert (got[1].n_words, got[1].n_repeat_words, got[1].rejected_by) == (600_000, 600_000, "repeats")
    assert (got[2].n_words, got[2].n_repeat_words, got[2].rejected_by) == (400_000, 0, None)
