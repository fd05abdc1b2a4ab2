"""The rating matrix in tiles: square blocks of it, with no bound on its rows or columns.

A tile holds the ratings of ``size`` users by ``size`` items whose ids follow each other. What is
stored of a tile is the places with a rating and their values; a tile that is full enough holds the
whole block instead, zeros where nobody rated. No operation looks at more than a tile, or at one
number per column of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.operators.neighbors import rating_matrix
from rankwell.skew import spread_join

# Users and items of a tile, and the share of its places from which it is held whole.
SIZE, DENSE_SHARE = 64, 0.25


def _tile(id_col: str, size: int) -> Column:
    return F.floor(F.col(id_col) / size).cast("long")


def _at(values: Column, size: int) -> Column:
    """Zeros and values of a whole block from (at, value) entries."""
    held = F.map_from_entries(values)
    return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda p: F.coalesce(F.try_element_at(held, p), F.lit(0.0)))


def rating_tiles(ratings: DataFrame, size: int = SIZE, dense_share: float = DENSE_SHARE) -> DataFrame:
    """(row_tile, col_tile, kind, at, values, size): the mean rating of each (user, item), by tiles.

    ``at`` are the places with a rating, counted along the rows, sorted. ``values`` has as many
    entries in a sparse tile and size * size in a dense one. Tiles without a rating have no row.
    """
    cells = rating_matrix(ratings)
    place = (F.pmod("userId", F.lit(size)) * size + F.pmod("movieId", F.lit(size))).cast("int")
    entries = F.array_sort(F.collect_list(F.struct(place.alias("at"), F.col("rating").alias("value"))))
    # At most size * size cells a group.
    tiles = cells.groupBy(_tile("userId", size).alias("row_tile"), _tile("movieId", size).alias("col_tile")).agg(entries.alias("e"))
    dense = F.size("e") >= dense_share * size * size
    return tiles.select(
        "row_tile",
        "col_tile",
        F.when(dense, "dense").otherwise("sparse").alias("kind"),
        F.col("e.at").alias("at"),
        F.when(dense, _at(F.col("e"), size)).otherwise(F.col("e.value")).alias("values"),
        F.lit(size).alias("size"),
    )


def _entries(tiles: DataFrame) -> Column:
    """(at, value) of every place with a rating."""
    value = F.when(F.col("kind") == "dense", F.transform("at", lambda p: F.get("values", p))).otherwise(F.col("values"))
    return F.arrays_zip(F.col("at").alias("at"), value.alias("value"))


def tile_cells(tiles: DataFrame) -> DataFrame:
    """(userId, movieId, rating): the ratings that the tiles hold."""
    cells = tiles.select("row_tile", "col_tile", "size", F.explode(_entries(tiles)).alias("e"))
    user = F.col("row_tile") * F.col("size") + F.floor(F.col("e.at") / F.col("size"))
    return cells.select(
        user.alias("userId"), (F.col("col_tile") * F.col("size") + F.col("e.at") % F.col("size")).alias("movieId"), F.col("e.value").alias("rating")
    )


def dense_rows(tiles: DataFrame) -> DataFrame:
    """(userId, col_tile, values): each user's row of each tile with a rating of theirs, zeros filled in.

    Together the dense user-item matrix, in pieces of ``size`` columns; pieces of zeros only are left out.
    A tile holds the whole piece, and ``at`` is sorted, so it is cut into rows where it lies: no row is shuffled.
    """
    size, zero = F.col("size"), F.lit(0.0)

    def row(place: Column) -> Column:
        return F.floor(place / size)

    firsts = F.filter(F.transform("at", lambda p, i: F.when((i == 0) | (row(p) != row(F.get("at", i - 1))), i)), lambda i: i.isNotNull())
    cut = tiles.withColumn("firsts", firsts)

    def piece(first: Column, j: Column) -> Column:
        held = F.coalesce(F.get("firsts", j + 1), F.size("at")) - first
        here = row(F.get("at", first))
        whole = F.slice("values", (here * size + 1).cast("int"), size)
        values = F.when(F.col("kind") == "dense", whole).otherwise(F.slice("values", first + 1, held))
        return F.struct(here.alias("row"), F.slice("at", first + 1, held).alias("at"), values.alias("values"))

    pieces = cut.select("row_tile", "col_tile", "kind", "size", F.explode(F.transform("firsts", piece)).alias("e"))
    places = F.transform("e.at", lambda p: F.when(p.isNull(), F.raise_error(F.lit("a rating without user or item has no place"))).otherwise((p % size).cast("int")))
    pieces = pieces.select((F.col("row_tile") * size + F.col("e.row")).alias("userId"), "col_tile", "kind", "size", places.alias("at"), F.col("e.values").alias("values"))

    def with_gap(value: Column, j: Column) -> Column:
        """A value after the zeros between it and the one before."""
        gap = F.get("at", j) - F.coalesce(F.get("at", j - 1) + 1, F.lit(0))
        return F.concat(F.array_repeat(zero, gap), F.array(F.coalesce(value, zero)))

    tail = F.array_repeat(zero, size - 1 - F.element_at("at", -1))
    filled = F.concat(F.flatten(F.transform("values", with_gap)), tail)
    return pieces.select("userId", "col_tile", F.when(F.col("kind") == "dense", F.col("values")).otherwise(filled).alias("values"))


def column_totals(tiles: DataFrame) -> DataFrame:
    """(movieId, n, total, squares) of each column's ratings; a tile's share of a column is added up in its task."""
    value = F.col("rating")
    return tile_cells(tiles).groupBy("movieId").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.sum(value * value).alias("squares"))


def centre_columns(tiles: DataFrame) -> DataFrame:
    """The tiles with every rating less the mean of its column's ratings; places without one stay 0."""
    size = F.col("size")
    sizes = tiles.select("size").agg(F.max("size")).scalar()
    totals = column_totals(tiles).select("movieId", (F.col("total") / F.col("n")).alias("mean")).withColumn("size", sizes)
    # At most ``size`` means a tile column.
    column = F.floor(F.col("movieId") / size).cast("long").alias("col_tile")
    means = totals.groupBy(column).agg(F.map_from_entries(F.collect_list(F.struct(F.pmod("movieId", "size").cast("int").alias("p"), "mean"))).alias("means"))
    held = spread_join(tiles, means, "col_tile")
    entries = F.transform(
        _entries(tiles), lambda e: F.struct(e["at"].alias("at"), (e["value"] - F.element_at("means", (e["at"] % size).cast("int"))).alias("value"))
    )
    held = held.withColumn("e", entries)
    whole = F.transform(
        F.sequence(F.lit(0), (size * size - 1).cast("int")), lambda p: F.coalesce(F.try_element_at(F.map_from_entries("e"), p), F.lit(0.0))
    )
    values = F.when(F.col("kind") == "dense", whole).otherwise(F.col("e.value"))
    return held.select("row_tile", "col_tile", "kind", "at", values.alias("values"), "size")
