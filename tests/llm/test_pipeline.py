"""The pipeline against the stages' brute-force versions, one after another."""

import random

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from rankwell.llm import bpe
from tests.conftest import SMALL
from tests.llm.test_decontaminate import brute
from tests.llm.test_quality import RULES_OF, measures
from tests.llm.test_simhash import classes, fingerprint


def expected(docs, items):
    kept = sorted((i, t) for i, t in docs if not any(rule(measures(t)) for rule in RULES_OF.values()))
    kept = [(i, t) for i, t in kept if any(c.isalpha() for c in t or "")]
    own = classes([fingerprint(t) for _, t in kept])
    kept = [x for at, x in enumerate(kept) if own[at] == at]
    return [x for x, (_, hit, _) in zip(kept, brute([t for _, t in kept], items)) if not hit]


def test_run(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = expected(docs, items)
    assert 0 < len(want) < len(docs)
    rows = corpus_pipeline.run(spark, SMALL).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [i for i, _ in want]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = bpe.load_ranks(lines)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r, (_, text) in zip(rows, want):
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text) and r.exact


def test_stages_keep_columns_and_awkward_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_language_stage_drops_gibberish_and_mislabelled_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = corpus_pipeline.quality_rules(spark, docs, SMALL)
    texts = {lang: [r.text for r in clean.filter(clean.lang == lang).orderBy("doc_id").limit(3).collect()] for lang in ("en", "de")}
    rnd = random.Random(5)

    def noise(letters):
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8))) for _ in range(100))

    bad = [(noise("abcdefghijklmnopqrstuvwxyz"), "en"), (noise("asdfghjkl"), None), (noise("αβγδεζηθικλμνξοπρστυφχψω"), None)]
    bad += [(t, "de") for t in texts["en"]] + [(t, "en") for t in texts["de"]]
    good = [(t, None) for t in texts["en"] + texts["de"]]
    rows = [(-i, t, lang, "planted", len(t)) for i, (t, lang) in enumerate(bad + good, 1)]
    planted = spark.createDataFrame(rows, clean.schema)
    everything = clean.unionByName(planted)
    assert corpus_pipeline.quality_rules(spark, planted, SMALL).count() == len(rows)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, everything, SMALL).collect()}
    assert {i for i in kept if i < 0} == {-i for i in range(len(bad) + 1, len(rows) + 1)}
    assert {r.doc_id for r in clean.collect()} <= kept


def test_near_copies_leave_one(spark):
    """Near copies by the fingerprints' distance, exact copies and copies with other white space: one of each group stays."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = corpus_pipeline.quality_rules(spark, docs, SMALL)
    long = [r for r in clean.orderBy("doc_id").collect() if len((r.text or "").split()) > 400][:5]
    assert len(long) == 5
    rows = []
    for n, r in enumerate(long):
        own = r.text.split()
        near = [" ".join([*own, f"end{k}"]) for k in range(3)] + ["  ".join(own), r.text.upper(), r.text]
        rows += [(10**6 + 10 * n + k, t, r.lang, "planted", len(t)) for k, t in enumerate(near)]
    planted = spark.createDataFrame(rows, clean.schema)
    close = {i: fingerprint(t) for i, t, *_ in rows}
    want = {i for n, r in enumerate(long) for i in close if i // 10 == 10**5 + n and (close[i] ^ fingerprint(r.text)).bit_count() > 4}
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, clean.unionByName(planted), SMALL).collect()}
    assert {i for i in kept if i >= 10**6} <= want and len(want) < 8
    alone = corpus_pipeline.near_duplicates(spark, planted, SMALL).collect()
    assert len({r.doc_id // 10 for r in alone}) == 5 and len(alone) <= 5 + len(want)
