"""Item-item similarities for the pairs somebody asks for.

No operator here lists all pairs of a catalogue. A requested pair (i1, i2) needs the groups
(users) that hold both items, and those are found from two sides:

* groups of bounded size meet the rows of the items that occur as i1 with all their rows;
* in larger groups the pairs of such an item are looked up where they are fewer than the rows.

Ids that are whole numbers are worked out in blocks of items (see ``asked``). Others take joins, with
each unordered pair once; there a large group is reached from the rarer item of the pair.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.functions.expressions import dot, norm, unit
from rankwell.operators.asked import WHOLE, asked_sums
from rankwell.operators.lists import NULL_ID, meet_lists, packed_lists
from rankwell.operators.products import BLOCK_ITEMS, Found, best_products
from rankwell.skew import checkpoint, spread_join

# The functions below travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A vector is constant when n * (sum of squares) - (sum)**2 is at most this share of its first
# term: what is left of it then is rounding.
CONSTANT = 1e-12

# Groups with more rows than this are reached from the pairs.
LARGE_GROUP_ROWS = 4096
# A listed item in more lists than this meets their histories by a join.
HOT_LISTED = 2**16


def list_pairs(lists: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Pairs i1 <= i2 of the items of each user's list, the diagonal included.

    For recommendation lists of bounded length; the diversity metrics take longer lists apart
    with ``split_by_group_size`` first.
    """
    left = lists.select(user, F.col(item).alias("i1"))
    right = lists.select(user, F.col(item).alias("i2"))
    return left.join(right, user).filter(F.col("i1") <= F.col("i2"))


def history_pairs(history: DataFrame, lists: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Distinct (i1, i2): an item of a user's list, and an item of the same user's history.

    Histories go packed to blocks of listed items, so that no pair is shuffled to be told distinct. Items
    in very many lists, and ids that are no integers, take a join.
    """
    listed = lists.select(user, F.col(item).alias("i1"))
    theirs = history.select(user, F.col(item).alias("i2"))
    types = {**dict(listed.dtypes), "other": dict(theirs.dtypes)[user], "i2": dict(theirs.dtypes)["i2"]}
    if not all(t in WHOLE for t in types.values()):
        return spread_join(theirs, listed, user).select("i1", "i2").distinct()
    counts = listed.groupBy("i1").agg(F.count(F.lit(1)).alias("n"))
    # Nulls have no block.
    hot = counts.filter((F.col("n") > HOT_LISTED) | F.col("i1").isNull())
    apart = not hot.isEmpty()
    rest = listed.filter("i1 is not null").join(hot.select("i1"), "i1", "left_anti") if apart else listed

    def best(a, b, sums, each):
        return pa.table({"i1": a, "i2": pa.array(b, mask=b == NULL_ID)})

    sizes = theirs.groupBy(F.col(user).alias("other")).agg(F.count(F.lit(1)).alias("n"))
    packed = packed_lists(theirs, user, "i2", [], LARGE_GROUP_ROWS)
    own = rest.select(F.col("i1").alias("a"), F.col(user).alias("other"), F.lit(None).cast("double").alias("x"))
    found = meet_lists(own, packed, sizes, 0, lambda *_: [], best, "i1 long, i2 long")
    found = found.select(*[F.col(c).cast(types[c]).alias(c) for c in ("i1", "i2")])
    if not apart:
        return found
    often = listed.join(F.broadcast(hot.select(F.col("i1").alias("__hot"))), F.col("i1").eqNullSafe(F.col("__hot")), "left_semi")
    return found.unionByName(spread_join(theirs, often, user).select("i1", "i2").distinct())


def split_by_group_size(
    rows: DataFrame, group: str, max_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups up to ``max_rows``, rows of larger groups or None when there are none)."""
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    if (counts.agg(F.max("n")).first()[0] or 0) <= max_rows:
        return rows, None
    large = counts.filter(F.col("n") > max_rows).select(group)
    # Only large groups can be hot; their slices are cut from the same counts.
    return (
        spread_join(rows, large, group, how="left_anti", counts=counts),
        spread_join(rows, large, group, how="left_semi", counts=counts),
    )


def shared_sums(
    rows: DataFrame,
    pairs: DataFrame,
    group: str,
    item: str,
    value: str | None = None,
    large_group_rows: int = LARGE_GROUP_ROWS,
    item_rows: DataFrame | None = None,
    left_items: DataFrame | None = None,
    root_of: str | None = None,
) -> DataFrame:
    """``pairs`` (i1, i2; distinct) with ``shared``: the sum over common groups of value * value.

    Without ``value`` every row weighs one, so ``shared`` counts the common groups. Pairs
    without a common group get 0. ``rows`` hold each (group, item) once. ``left_items`` (item), all items
    that may occur as i1, spares reading the pairs for them. ``root_of`` names a column that ``value`` is
    1 / sqrt of, which packs smaller.
    """
    types = dict(pairs.dtypes)
    if set(pairs.columns) == {"i1", "i2"} and all(t in WHOLE for t in (*types.values(), dict(rows.dtypes)[group], dict(rows.dtypes)[item])):
        left = pairs.select(F.coalesce("i1", "i2").alias(item)) if left_items is None else left_items.select(item)
        marked = spread_join(rows, left.distinct().withColumn("__left", F.lit(True)), item, "left", item_rows)
        marked = marked.withColumn("__left", F.coalesce("__left", F.lit(False)))
        found = asked_sums(marked, pairs, group, item, root_of or value, "__left", large_group_rows, root_of is not None)
        kept = [F.col(c).cast(types[c]).alias(c) for c in pairs.columns]
        return found.select(*kept, F.col("shared").cast("long" if value is None else "double"))
    asked = pairs.withColumns({"lo": F.least("i1", "i2"), "hi": F.greatest("i1", "i2")})
    left_items = pairs.select(F.col("i1").alias(item)).distinct()
    sums = pair_sums(rows, left_items, asked, group, item, value, large_group_rows, item_rows)
    return asked.join(sums, ["lo", "hi"], "left").drop("lo", "hi").withColumn("shared", F.coalesce("shared", F.lit(0)))


def pair_sums(
    rows: DataFrame,
    left_items: DataFrame | None,
    pairs: DataFrame,
    group: str,
    item: str,
    value: str | None = None,
    large_group_rows: int = LARGE_GROUP_ROWS,
    item_rows: DataFrame | None = None,
) -> DataFrame:
    """(lo, hi, shared) for every pair of ``pairs`` with a common group, and maybe for others.

    Pairs are unordered, lo <= hi, as the sum is the same both ways. ``rows`` are those of all items
    of ``pairs``; every pair has an item of ``left_items`` (None: all), so only their rows meet the
    rest of their group, two of them once. Sums of pairs nobody asked for lack the large groups: join
    the result to pairs. ``item_rows`` (item, n), the rows of each item, spares counting them.
    """
    weight = F.lit(1) if value is None else F.col(value)
    rows = rows.select(group, item, weight.alias("__x"))
    if left_items is None:
        rows = rows.withColumn("__left", F.lit(True))
    else:
        marked = spread_join(rows, left_items.select(item, F.lit(True).alias("__left")), item, "left", item_rows)
        rows = marked.select(group, item, "__x", F.coalesce("__left", F.lit(False)).alias("__left"))
    # Both sides of the join, and the counts, read the stored rows.
    rows = checkpoint(rows)
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    if (counts.agg(F.max("n")).first()[0] or 0) <= large_group_rows:
        products = _from_groups(rows, group, item)
    else:
        large = counts.filter(F.col("n") > large_group_rows).select(group)
        small_rows = spread_join(rows, large, group, "left_anti", counts)
        large_rows = spread_join(rows, large, group, "left_semi", counts)
        products = _from_groups(small_rows, group, item).unionByName(_from_pairs(large_rows, pairs, group, item))
    return products.groupBy("lo", "hi").agg(F.sum("__xy").alias("shared"))


def _from_groups(rows: DataFrame, group: str, item: str) -> DataFrame:
    one = rows.filter("__left").select(group, F.col(item).alias("__a"), F.col("__x").alias("__y"))
    two = rows.select(group, F.col(item).alias("__b"), "__x", "__left")
    met = one.join(two, group).filter(~F.col("__left") | (F.col("__a") <= F.col("__b")))
    return met.select(F.least("__a", "__b").alias("lo"), F.greatest("__a", "__b").alias("hi"), (F.col("__x") * F.col("__y")).alias("__xy"))


def _from_pairs(rows: DataFrame, pairs: DataFrame, group: str, item: str) -> DataFrame:
    counts = rows.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    n1 = counts.select(F.col(item).alias("lo"), F.col("n").alias("n1"))
    n2 = counts.select(F.col(item).alias("hi"), F.col("n").alias("n2"))
    first_is_rarer = F.col("n1") <= F.col("n2")
    directed = (
        pairs.select("lo", "hi")
        .distinct()
        .join(n1, "lo")
        .join(n2, "hi")
        .select(
            "lo",
            "hi",
            F.when(first_is_rarer, F.col("lo")).otherwise(F.col("hi")).alias("__rare"),
            F.when(first_is_rarer, F.col("hi")).otherwise(F.col("lo")).alias("__other"),
        )
    )
    by_rare = rows.select(group, F.col(item).alias("__rare"), "__x")
    reached = spread_join(by_rare, directed, "__rare", counts=counts.withColumnRenamed(item, "__rare"))
    looked_up = rows.select(group, F.col(item).alias("__other"), F.col("__x").alias("__y"))
    return reached.join(looked_up, [group, "__other"]).select("lo", "hi", (F.col("__x") * F.col("__y")).alias("__xy"))


def item_counts(train: DataFrame, item: str = "movieId") -> DataFrame:
    return train.groupBy(item).agg(F.count(F.lit(1)).alias("n"))


def cooccurrence_similarity(
    train: DataFrame,
    pairs: DataFrame,
    user: str = "userId",
    item: str = "movieId",
    large_group_rows: int = LARGE_GROUP_ROWS,
    left_items: DataFrame | None = None,
) -> DataFrame:
    """n(i1, i2) / sqrt(n(i1) n(i2)) over users, for each requested pair; 0 when never together.

    ``left_items``: see ``shared_sums``.
    """
    counts = item_counts(train, item)
    shared = shared_sums(cosine_weights(train, user, item, counts), pairs, user, item, "w", large_group_rows, counts, left_items, "n")
    return shared.select("i1", "i2", F.col("shared").cast("double").alias("sim"))


def cosine_weights(train: DataFrame, user: str = "userId", item: str = "movieId", counts: DataFrame | None = None) -> DataFrame:
    """(user, item, n, w) with n the rows of the item, w = 1 / sqrt(n): sums of products of w are co-occurrence cosines.

    Weights are joined to the rows, of which there are fewer than of pairs, and no hot item is left whole.
    """
    counts = item_counts(train, item) if counts is None else counts
    weights = counts.select(item, "n", (1 / F.sqrt("n")).alias("w"))
    return spread_join(train.select(user, item), weights, item, counts=counts)


def require_features(features: DataFrame, item: str = "movieId", column: str = "features") -> None:
    """Raise ValueError unless ``features`` holds the item and an array of float or double."""
    types = dict(features.dtypes)
    if item not in types or types.get(column) not in ("array<float>", "array<double>"):
        raise ValueError(f"item features need {item} and {column} array<float|double>; found {types}")


def feature_similarity(features: DataFrame, pairs: DataFrame, item: str = "movieId", column: str = "features") -> DataFrame:
    """Cosine of the feature vectors of each requested pair; pairs without both vectors drop out."""
    require_features(features, item, column)
    known = features.select(item, column, norm(column).alias("__len"))
    f1 = known.select(F.col(item).alias("i1"), F.col(column).alias("__f1"), F.col("__len").alias("__l1"))
    f2 = known.select(F.col(item).alias("i2"), F.col(column).alias("__f2"), F.col("__len").alias("__l2"))
    cosine = F.try_divide(dot("__f1", "__f2"), F.col("__l1") * F.col("__l2"))
    # Stored, so that counting the pairs of each item does not work them out again.
    asked = checkpoint(pairs.select("i1", "i2"))
    return spread_join(spread_join(asked, f1, "i1"), f2, "i2", counts=_pairs_of(asked, "i2")).select("i1", "i2", cosine.alias("sim"))


def with_vectors(rows: DataFrame, features: DataFrame, item: str = "movieId") -> DataFrame:
    """The rows whose item has a row in ``features``: pairs of others have no similarity by features."""
    return spread_join(rows, features.select(item).distinct(), item, "left_semi")


def _pairs_of(pairs: DataFrame, side: str) -> DataFrame:
    return pairs.groupBy(side).agg(F.count(F.lit(1)).alias("n"))


def feature_neighbors(features: DataFrame, n: int = 10, item: str = "movieId", column: str = "features", block_items: int = BLOCK_ITEMS) -> Found:
    """The ``n`` items of the greatest cosine to each item, of all pairs of a catalogue: (item, neighbor, sim, rank).

    With it comes how many pairs were compared of all there are: blocks of items whose directions
    lie too far off are left out. Cosines equal to nine places tie and go by id. Items without a
    vector, or with one of length 0, take no part; an item is not its own neighbour.
    """
    require_features(features, item, column)
    units = features.select(F.col(item).cast("long").alias("id"), unit(column).alias("features")).filter("features is not null")
    units = checkpoint(units)
    found = best_products(units, units, n, units.select(F.col("id").alias("query"), F.col("id").alias("item")), digits=9, block_items=block_items)
    names = [F.col("query").alias(item), F.col("item").alias("neighbor"), F.col("score").alias("sim"), "rank"]
    return Found(found.best.select(*names), found.cost)


def item_similarity(measure: str, train: DataFrame, pairs: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """The similarity called ``measure`` (cooccurrence or features) of each requested pair."""
    if measure == "cooccurrence":
        return cooccurrence_similarity(train, pairs)
    if measure == "features":
        if features is None:
            raise ValueError("similarity by features needs item features")
        return feature_similarity(features, pairs)
    raise ValueError(f"similarity {measure!r} is not one of cooccurrence, features")


def pearson_similarity(
    ratings: DataFrame,
    pairs: DataFrame,
    entity: str = "movieId",
    other: str = "userId",
    value: str = "rating",
    large_group_rows: int = LARGE_GROUP_ROWS,
) -> DataFrame:
    """Pearson correlation over zero-filled rating vectors for each requested pair.

    ``ratings`` hold each (user, item) once. N counts the distinct values of ``other``; only
    stored ratings enter the sums. A constant vector has no correlation (null). Pairs that
    share nothing are included.
    """
    pairs = checkpoint(pairs.select("i1", "i2"))
    n = ratings.select(other).distinct().agg(F.count(other)).scalar()
    stats = vector_stats(ratings, entity, value)
    s1 = stats.select(F.col(entity).alias("i1"), F.col("s").alias("s1"), F.col("q").alias("q1"))
    s2 = stats.select(F.col(entity).alias("i2"), F.col("s").alias("s2"), F.col("q").alias("q2"))
    shared = shared_sums(ratings, pairs, other, entity, value, large_group_rows)
    known = spread_join(shared, s1, "i1", counts=_pairs_of(pairs, "i1"))
    return spread_join(known, s2, "i2", counts=_pairs_of(pairs, "i2")).select("i1", "i2", correlation(n).alias("r"))


def correlation(n) -> Column:
    """Pearson r of two vectors of length ``n`` from their sums (s1, s2), sums of squares
    (q1, q2) and product sum (shared); null when either is constant."""
    covariance = n * F.col("shared") - F.col("s1") * F.col("s2")
    spread1 = n * F.col("q1") - F.col("s1") * F.col("s1")
    spread2 = n * F.col("q2") - F.col("s2") * F.col("s2")
    varied = (spread1 > CONSTANT * n * F.col("q1")) & (spread2 > CONSTANT * n * F.col("q2"))
    return F.when(varied, covariance / F.sqrt(spread1 * spread2))


def vector_stats(ratings: DataFrame, entity: str, value: str = "rating") -> DataFrame:
    """Rows, sum and sum of squares of each entity's stored values."""
    return ratings.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q")
    )
