"""The rating matrix in tiles, and counts by bitmaps, against plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwell.metrics import diversity
from rankwell.operators import bitmaps, tiles
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def cells(spark):
    """One full block, a sparse rest, ids far apart, repeated and zero ratings."""
    rows = [(u, i, float((u * i) % 5)) for u in range(8, 12) for i in range(4, 8)]
    rows += [(u, u * 37 % 1000, 2.5) for u in range(40)] + [(10**9, 10**10, 4.0), (1, 37, 0.5)]
    return spark.createDataFrame(rows, "userId long, movieId long, rating double")


@pytest.mark.parametrize("size", [1, 4, 64])
def test_tiles_hold_every_cell(cells, size):
    want = cells.groupBy("userId", "movieId").agg(F.avg("rating").alias("rating"))
    held = tiles.rating_tiles(cells, size)
    assert rows_of(tiles.tile_cells(held), "userId", "movieId", "rating") == rows_of(want, "userId", "movieId", "rating")
    kinds = {(r.row_tile, r.col_tile): r for r in held.collect()}
    if size == 4:
        assert kinds[2, 1].kind == "dense" and len(kinds[2, 1]["values"]) == 16
    assert all(len(r["values"]) == (size * size if r.kind == "dense" else len(r["at"])) for r in kinds.values())
    assert all(list(r["at"]) == sorted(set(r["at"])) for r in kinds.values())


def test_dense_rows_and_columns(cells):
    held = tiles.rating_tiles(cells.filter("userId < 100"), 4)
    table = cells.filter("userId < 100").groupBy("userId", "movieId").agg(F.avg("rating").alias("x")).toPandas()
    dense = table.pivot(index="userId", columns="movieId", values="x")
    for r in tiles.dense_rows(held).collect():
        columns = range(4 * r.col_tile, 4 * r.col_tile + 4)
        assert r["values"] == [float(np.nan_to_num(dense.loc[r.userId].get(c, 0.0))) for c in columns]
    totals = {r.movieId: (r.n, r.total, r.squares) for r in tiles.column_totals(held).collect()}
    assert totals == {c: (int(dense[c].count()), dense[c].sum(), (dense[c] ** 2).sum()) for c in dense}
    centred = {(r.userId, r.movieId): r.rating for r in tiles.tile_cells(tiles.centre_columns(held)).collect()}
    want = (dense - dense.mean()).stack()
    assert centred.keys() == set(want.index) and all(abs(centred[k] - want[k]) < 1e-12 for k in centred)


def test_dense_rows_are_cut_where_their_tile_lies(spark):
    """Null ratings, users with one or all columns of a tile; a tile holds whole rows, so none is shuffled."""
    rows = [(u, i, None if (u, i) == (3, 1) else float(u + i)) for u in range(8) for i in range(4) if u != 1 and (u + i) % (u + 1) != 1]
    rows += [(9, i, 1.0) for i in range(3, 9)] + [(65, 3, 2.5), (65, 0, -0.0)]
    cells = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    for size, share in ((4, 0.25), (4, 2.0), (64, 0.25)):
        held = tiles.rating_tiles(cells, size, share).localCheckpoint()
        dense = tiles.dense_rows(held)
        assert "Exchange" not in dense._jdf.queryExecution().executedPlan().toString()
        want = {}
        for u, i, r in rows:
            want.setdefault((u, i // size), [0.0] * size)[i % size] = r or 0.0
        assert {(r.userId, r.col_tile): r["values"] for r in dense.collect()} == want


def test_null_ids_have_no_place(spark):
    for row in ((None, 1, 1.0), (1, None, 1.0)):
        held = tiles.rating_tiles(spark.createDataFrame([row, (2, 2, 1.0)], "userId long, movieId long, rating double"), 4)
        with pytest.raises(Exception, match="no place"):
            tiles.dense_rows(held).collect()


def test_tiles_of_nothing(cells):
    held = tiles.rating_tiles(cells.limit(0))
    assert held.count() == 0 and tiles.dense_rows(held).count() == 0 and tiles.centre_columns(held).count() == 0


def test_bitmap_counts(spark, cells):
    a = cells.select("userId", "movieId")
    b = cells.filter("userId % 3 = 0 or userId > 1000").select("userId", "movieId").union(spark.createDataFrame([(5, 70_000), (None, 1)], "userId long, movieId long"))
    keys = ["movieId"]
    one, two = bitmaps.id_bitmaps(a, "userId", keys), bitmaps.id_bitmaps(b, "userId", keys)
    assert bitmaps.distinct_count(one).first()[0] == a.distinct().count()
    assert bitmaps.common_count(one, two, keys).first()[0] == a.intersect(b).count()
    days = bitmaps.id_bitmaps(a.withColumn("day", F.col("userId") % 4), "movieId", ["day"])
    assert bitmaps.distinct_count(bitmaps.merged(days)).first()[0] == a.select("movieId").distinct().count()
    assert bitmaps.seen_overlap(a, b).collect() == diversity.seen_overlap(a, b).collect()
    assert bitmaps.common_count(one.limit(0), two, keys).first()[0] == 0
    assert bitmaps.distinct_count(one.limit(0)).first()[0] == 0


def test_overlap_takes_room_by_pairs(spark):
    """Ids far apart, negative, null or twice; no bitmap of a whole bucket for a single id."""
    a = [(u * 40_009 - 90_000, u % 3) for u in range(300)] + [(None, 1), (-1, 2), (-1, 2), (5, None)]
    b = [(u * 80_018 - 90_000, u * 2 % 3) for u in range(200)] + [(None, 1), (-1, 2), (64, 2), (5, None), (5, None)]
    one, two = (spark.createDataFrame(x, "userId long, movieId long") for x in (a, b))
    found = bitmaps.seen_overlap(one, two)
    assert found.first()[0] == len({x for x in a if x[0] is not None} & set(b))
    plan = found._jdf.queryExecution().toString()
    assert "bit_or" in plan and "bitmap_construct_agg" not in plan
    assert bitmaps.seen_overlap(one.limit(0), two).first()[0] == 0
