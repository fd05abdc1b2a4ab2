"""Lists that travel to blocks in bundles, and the best of sums."""

import numpy as np
import pyarrow as pa
import pytest

from rankwell.operators import lists, neighbors
from tests.conftest import rows_of


def bundles_of(rows, width):
    batch = pa.record_batch(
        [pa.array([b for b, *_ in rows], pa.list_(pa.int32())), pa.array([o for _, o, _ in rows], pa.int64()), pa.array([p for *_, p in rows], pa.binary())],
        ["blocks", "other", "list"],
    )
    return [row for out in lists.bundled_lists(width)(iter([batch])) for row in out.to_pylist()]


def test_copies_of_lists_travel_together():
    """What a task sends to a block is one bundle: far smaller than a packed list each."""
    rng = np.random.default_rng(2)
    rows, alone = [], 0
    for other in range(500):
        ids = np.sort(rng.choice(100_000, 30, replace=False))
        packed = lists.pack(ids, [rng.integers(1, 11, 30) / 2.0], np.zeros(30, np.uint8))
        rows.append((sorted(rng.choice(8, 5, replace=False).tolist()), other * 7 - 900, packed))
        alone += 5 * (len(packed) + 16)
    found = bundles_of(rows, 1)
    assert sorted(row["block"] for row in found) == list(range(8))
    assert sum(len(row["data"]) for row in found) < 0.65 * alone
    seen = 0
    for row in found:
        others, size, gaps, values, nulls = lists.unpack_arrays(pa.py_buffer(row["data"]), ["i8", "i8", "i8", "f8", "u1"])
        for i, other in enumerate(np.cumsum(others)):
            blocks, _, packed = rows[(int(other) + 900) // 7]
            ids, (want,), _ = lists.unpack(packed, 1)
            mine = slice(30 * i, 30 * i + 30)
            assert row["block"] in blocks and size[i] == 30 and not nulls[mine].any()
            assert (np.cumsum(gaps[mine]) == ids).all() and (values[mine] == want).all()
            seen += 1
    assert seen == 500 * 5


@pytest.mark.parametrize("count", [0, 1, 50])
def test_arrays_come_back(count):
    rng = np.random.default_rng(count)
    held = [rng.integers(-(2**63), 2**63, count, np.int64), rng.standard_normal(count), np.zeros(count), np.arange(count, dtype=np.uint8)]
    back = lists.unpack_arrays(pa.py_buffer(lists.pack_arrays(*held)), ["i8", "f8", "f8", "u1"])
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(held, back))


@pytest.mark.parametrize("far", [10, 2**40, 2**62])
def test_order_by_two_columns(far):
    rng = np.random.default_rng(4)
    a, b = np.sort(rng.integers(-far, far, 20))[rng.integers(0, 20, 300)], rng.integers(-far, far, 25)[rng.integers(0, 25, 300)]
    for one in (a, np.sort(a)):
        assert (lists._order(one, b) == np.lexsort((b, one))).all()


def test_first_of_each_keeps_ties_and_signs():
    """Scores that differ by less than a float of 32 bits tells, equal ones, both zeros, NaN and nulls."""
    rng = np.random.default_rng(6)
    a = np.sort(rng.integers(0, 6, 400))
    b = rng.permutation(400) - 200
    score = rng.choice([0.0, -0.0, 0.5, 0.5 + 1e-12, -0.5, np.nan, 1e300, -1e300], 400)
    null = rng.random(400) < 0.1
    for n in (1, 3, 500):
        place, rank = lists.first_of_each(a, b, score, null, n)
        want = []
        for one in range(6):
            mine = [i for i in range(400) if a[i] == one]
            key = {i: (2, 0) if null[i] else (0, 0) if np.isnan(score[i]) else (1, -score[i] + 0.0) for i in mine}
            want += [(i, at) for at, i in enumerate(sorted(mine, key=lambda i: (key[i], b[i]))[:n], 1)]
        assert list(zip(place.tolist(), rank.tolist())) == want


def test_sums_go_to_blocks_once_or_with_ratings(spark, skewed, monkeypatch):
    """Both ways give the same, for some entities and all, with a null entity and few products a block."""
    rows = skewed.unionByName(spark.createDataFrame([(None, 3, 2.0), (4, None, 1.0), (5, 2, None)], skewed.schema))
    asked = spark.createDataFrame([(i,) for i in (1, 2, 9, 777)], "movieId long")
    widths, plain = [], neighbors.packed_lists
    monkeypatch.setattr(neighbors, "packed_lists", lambda *a: widths.append(len(a[3])) or plain(*a))
    monkeypatch.setattr(lists, "BLOCK_PRODUCTS", 40)
    found = []
    for most in (0, neighbors.MOST_TABLE):
        monkeypatch.setattr(neighbors, "MOST_TABLE", most)
        for targets in (None, asked):
            found.append(rows_of(neighbors.pearson_neighbors(rows, 5, "movieId", "userId", targets, tile_rows=7), "movieId", "rank", "neighbor", "r"))
    assert found[0] == found[2] and found[1] == found[3] and len(found[0]) > len(found[1]) > 0
    assert widths == [3, 3, 1, 1]


@pytest.mark.parametrize("digits", [None, 9])
def test_rough_products_lose_nothing(spark, digits):
    """Products in single precision only leave out rows: close scores, ties and tiny vectors come out as by brute force."""
    from rankwell.operators import products

    rng = np.random.default_rng(9)
    base = rng.standard_normal(5)
    items = [(i, base * (1 + 1e-8 * (i % 7)) + 1e-7 * rng.integers(0, 3, 5)) for i in range(300)] + [(900 + i, rng.standard_normal(5) * 1e-22) for i in range(20)]
    queries = [(q, rng.standard_normal(5) * (1e-22 if q % 5 == 0 else 1.0)) for q in range(20)]
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in rows], "id long, features array<double>") for rows in (queries, items)]
    found = rows_of(products.best_products(*frames, 6, None, digits=digits, block_items=8).best, "query", "rank", "item")
    ids, v = np.array([i for i, _ in items]), np.array([v for _, v in items])
    want = []
    for q, u in queries:
        score = v @ u
        score = score.astype(np.float32) if digits is None else np.round(score, digits)
        best = np.lexsort((ids, -score))[:6]
        want += [(q, rank, ids[i]) for rank, i in enumerate(best, 1)]
    assert len(found) == len(want)
    kept = {q: score for q, score in ((q, {int(i): float(np.float32(v[j] @ u) if digits is None else np.round(v[j] @ u, digits)) for j, i in enumerate(ids)}) for q, u in queries)}
    # Matrix and vector products may differ in the last place: the scores are what must agree.
    for (q, rank, item), (q2, rank2, item2) in zip(found, sorted(want)):
        assert (q, rank) == (q2, rank2) and kept[q][item] == pytest.approx(kept[q][item2], rel=2e-7, abs=1e-30 if digits is None else 1e-9)
