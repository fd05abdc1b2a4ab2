"""Encoding against the tiktoken library, decoding as an exact round trip."""

import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from rankwell.llm import bpe, queries
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as lines:
        return bpe.load_ranks(lines)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(coder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in coder.encode(pa.array([t.encode() for t in texts], pa.binary()))]


def test_random_texts_and_every_codepoint(ranks, library):
    rnd = random.Random(5)
    letters = "aZé1٣ \t\n'strevlmd.!#  '' ​　漢字🙂́\x00\x85\x1c"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["", "a" * 3000, " " * 2000 + "b", "'" * 300, "don't'll've"]
    points = [chr(c) for c in range(0, sys.maxunicode, 7) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{c}1{c} .." for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    assert ids_of(bpe.Encoder(ranks), texts) == [library.encode_ordinary(t) for t in texts]


def test_short_and_long_merges_agree(ranks):
    rnd = random.Random(6)
    for _ in range(300):
        piece = bytes(rnd.choice(b"etaoin hs\xc3\xa9") for _ in range(rnd.randint(2, 60)))
        short = bpe._merge_short(piece, ranks)
        bpe.SCANNED_SLICE, kept = 0, bpe.SCANNED_SLICE
        try:
            assert piece in ranks or bpe.merge(piece, ranks) == short
        finally:
            bpe.SCANNED_SLICE = kept


def test_awkward_rows(awkward, library):
    clash = awkward.withColumn("offsets", F.lit("mine")).withColumn("__result", F.lit(1))
    out = bpe.decode(bpe.encode(clash, PATH), PATH)
    assert set(out.columns) == {*awkward.columns, "__result", "ids", "offsets", "decoded"}
    rows = out.collect()
    assert len(rows) == awkward.count()
    for r in rows:
        text = r.text or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
        parts = [library.decode_single_token_bytes(i) for i in ids]
        assert r.offsets == [sum(map(len, parts[:k])) for k in range(len(parts))]


def test_empty_table(empty):
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.QUERIES["op3_bpe"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_kept_slices_stay_small():
    """Four workers of an executor keep merged slices for as long as they live."""
    coder, most = bpe.Encoder({bytes([b]): b for b in range(256)}), 0
    for start in range(0, 400_000, 5_000):
        for n in range(start, start + 5_000):
            coder._ids(b" %06d" % n)
        most = max(most, coder.kept_bytes)
    assert 10_000_000 < most < 25_000_000
