"""WARC archives: exact round trips, range reads, revisits."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rankwell.llm import warc

PAGES = "page_id long, url string, html string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rnd = random.Random(2)
    rows = [(i, f"http://h/{i}", "".join(rnd.choice("<p>é\r\n\r\n漢") for _ in range(rnd.randint(0, 4)))) for i in range(300, 500)]
    rows += [(7, None, None), (3, "http://x/\r\nWARC-Type: y", ""), (None, "u", "same"), (12, "ü", "same"), (9, "u", "same")]
    rows += [(20, "long", "x" * 3_000_000), (30, "twice", "row"), (30, "twice", "row")]
    return spark.createDataFrame(rows, PAGES).repartition(3).withColumn("digest", F.lit("mine"))


def test_round_trip(spark, pages):
    index = warc.archive(pages, records=20)
    assert index.select("file").distinct().count() > 6
    rows = warc.read(index).collect()
    given = pages.collect()
    assert len(rows) == len(given)
    payloads = {}
    for r in given:
        payloads.setdefault((r.html or "").encode(), []).append(r.page_id)
    least = {p: min((i for i in ids if i is not None), default=None) for p, ids in payloads.items()}
    by_id = {}
    for r in given:
        by_id.setdefault(r.page_id, (r.html or "").encode())
    heads = [r for r in rows if r.record_type == "response"]
    assert sorted(bytes(r.payload) for r in heads) == sorted(payloads)
    for r in rows:
        payload = by_id[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), digest(payload))
        if r.record_type == "response":
            assert r.page_id == least[payload] and r.refers_to is None and bytes(r.payload) == payload
        else:
            assert r.refers_to == least[payload] and r.payload is None


def test_small_payloads_are_all_responses(spark, pages):
    rows = warc.read(warc.write(pages, warc.shared_folder(spark), min_bytes=5), payload=False).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 5)


def test_selected_records(spark, pages):
    index = warc.archive(pages)
    some = warc.read(index.filter("page_id % 50 = 0"))
    assert sorted(r.page_id for r in some.collect()) == [300, 350, 400, 450]


def test_damage_is_noticed(spark, pages):
    index = warc.archive(pages).withColumn("offset", F.col("offset") + 1)
    with pytest.raises(Exception, match="incorrect header|differs|not a whole|invalid"):
        warc.read(index).collect()


def test_ranges():
    rows = [(0, 10), (10, 10), (25, 5), (100, 10), (110, 50), (160, 1)]
    assert warc.ranges(rows, gap=5, most=40) == [(0, 30, [0, 1, 2]), (100, 10, [3]), (110, 50, [4]), (160, 1, [5])]


def test_empty_table(spark):
    assert warc.read(warc.archive(spark.createDataFrame([], PAGES))).count() == 0
