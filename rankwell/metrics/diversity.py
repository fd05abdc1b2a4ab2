"""Diversity, novelty, serendipity and coverage of recommendation lists.

``train`` holds (user, item) rows, ``recos`` the recommended (user, item) rows; neither holds a
pair twice. Item similarity is co-occurrence in ``train`` unless ``features`` (item, vector)
are given.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.columns import DEFAULT_COLS, Cols
from rankwell.functions.expressions import dot, unit
from rankwell.operators.asked import NO_VALUE, OWN, PARTNER, WHOLE, list_sums
from rankwell.operators.lists import NULL_ID
from rankwell.operators.similarity import (
    LARGE_GROUP_ROWS,
    cosine_weights,
    item_counts,
    list_pairs,
    pair_sums,
    require_features,
    split_by_group_size,
)
from rankwell.skew import checkpoint, spread_join

# The functions below travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Lists longer than this are not paired item by item; see the long-list functions below.
LONG_LIST_ROWS = 1000
# Pairs of a list and its history that blocks work out, however long the list.
MOST_PAIRS = 2**24


def seen_overlap(train: DataFrame, recos: DataFrame, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """One row: how many distinct recommended pairs the user had already rated."""
    keys = [cols.user, cols.item]
    seen = recos.select(*keys).distinct().join(train.select(*keys), keys, "left_semi")
    return seen.agg(F.count(F.lit(1)).alias("overlap"))


def require_unseen(train: DataFrame, recos: DataFrame, cols: Cols = DEFAULT_COLS) -> None:
    """Raise ValueError when a recommended pair occurs in ``train``."""
    keys = [cols.user, cols.item]
    if not recos.select(*keys).join(train.select(*keys), keys, "left_semi").isEmpty():
        raise ValueError("recommendations contain user-item pairs already present in train")


# Diversity


def intralist_similarity(
    train: DataFrame,
    recos: DataFrame,
    features: DataFrame | None = None,
    cols: Cols = DEFAULT_COLS,
    long_list_rows: int = LONG_LIST_ROWS,
    large_group_rows: int = LARGE_GROUP_ROWS,
) -> DataFrame:
    """Per user, the mean similarity of two different items of the list; unknown pairs count 0.

    Users with a single item have no pair and drop out.
    """
    lists = recos.select(cols.user, cols.item)
    if features is not None:
        return _intralist_by_features(lists, features, cols)
    short, long = split_by_group_size(lists, cols.user, long_list_rows)
    result = _intralist_by_pairs(train, short, cols, large_group_rows)
    return result if long is None else result.unionByName(_intralist_by_co_users(train, long, cols))


def _intralist_by_pairs(train: DataFrame, lists: DataFrame, cols: Cols, large_group_rows: int) -> DataFrame:
    if _whole(cols, train, lists):
        return _intralist_by_blocks(train, lists, cols, large_group_rows)
    pairs = list_pairs(lists, cols.user, cols.item).filter("i1 <> i2").withColumnsRenamed({"i1": "lo", "i2": "hi"})
    listed = item_counts(lists, cols.item)
    rows = spread_join(train.select(cols.user, cols.item), listed.select(cols.item), cols.item, "left_semi")
    sims = pair_sums(cosine_weights(rows, cols.user, cols.item), None, pairs, cols.user, cols.item, "w", large_group_rows)
    # A pair of two popular items may stand in most lists.
    matched = spread_join(pairs, sims, ["lo", "hi"], "left", counts=listed.withColumnRenamed(cols.item, "hi"))
    return matched.groupBy(cols.user).agg(F.avg(F.coalesce("shared", F.lit(0.0))).alias("mean_similarity"))


def _whole(cols: Cols, *tables: DataFrame) -> bool:
    return all(t in WHOLE for rows in tables for name, t in rows.dtypes if name in (cols.user, cols.item))


def _weighted_rows(train: DataFrame, lists: DataFrame, cols: Cols) -> DataFrame:
    """(user, item, n, left) of ``train``: the rows of the item, of which weights are roots, and whether ``lists`` have the item."""
    counts = item_counts(train, cols.item)
    listed = lists.select(cols.item).distinct().withColumn("left", F.lit(True))
    weights = counts.join(listed, cols.item, "left").select(cols.item, "n", F.coalesce("left", F.lit(False)).alias("left"))
    return spread_join(train.select(cols.user, cols.item), weights, cols.item, counts=counts)


def _list_entries(rows: DataFrame, cols: Cols, x: Column, flags: int) -> DataFrame:
    held = rows.filter(F.col(cols.user).isNotNull())
    return held.select(F.col(cols.user).cast("long").alias("g"), F.col(cols.item).cast("long").alias("b"), x.alias("x"), F.lit(flags).alias("flags"))


def _intralist_by_blocks(train: DataFrame, lists: DataFrame, cols: Cols, large_group_rows: int) -> DataFrame:
    """The mean over a list's pairs, worked out in blocks of items (see ``asked``); no pair is a row."""

    def out(user, x, flags, a, line, b, sums):
        # One row for each user and list item, of all pairs with greater items.
        line, at = np.unique(line, return_inverse=True)
        return pa.table({"user": user[line], "total": np.bincount(at, sums, len(line)).astype(np.float64), "n": np.bincount(at, minlength=len(line)).astype(np.int64)})

    listed = item_counts(lists, cols.item)
    # Items that nobody lists take no part.
    rows = spread_join(train.select(cols.user, cols.item), listed.select(cols.item), cols.item, "left_semi")
    entries = _list_entries(lists.filter(F.col(cols.item).isNotNull()), cols, F.lit(0.0), OWN | PARTNER)
    found = list_sums(cosine_weights(rows, cols.user, cols.item), entries, cols.user, cols.item, "n", None, large_group_rows, True, True, out, "user long, total double, n long")
    user = F.col("user").cast(dict(lists.dtypes)[cols.user]).alias(cols.user)
    return found.groupBy("user").agg((F.sum("total") / F.sum("n")).alias("mean_similarity")).select(user, "mean_similarity")


def _intralist_by_co_users(train: DataFrame, lists: DataFrame, cols: Cols) -> DataFrame:
    """The same mean for lists too long to pair.

    With w = 1/sqrt(n(item)), the similarities of a list's ordered pairs, diagonal included,
    add up to the sum over other users v of (sum of w over list items v rated) squared; each
    list item that anybody rated puts 1 on the diagonal. Rows grow with list items times
    their raters, not with the square of the list.
    """
    counts = item_counts(train, cols.item)
    weights = counts.select(cols.item, F.sqrt("n").alias("root"))
    sizes = lists.groupBy(cols.user).agg(F.count(F.lit(1)).alias("m"))
    rated = spread_join(lists, weights, cols.item)
    raters = train.select(cols.item, F.col(cols.user).alias("rater"))
    overlap = (
        spread_join(raters, rated, cols.item, counts=counts)
        .groupBy(cols.user, "rater")
        .agg(F.sum(1 / F.col("root")).alias("w"))
        .groupBy(cols.user)
        .agg(F.sum(F.col("w") * F.col("w")).alias("all_pairs"))
    )
    diagonal = rated.groupBy(cols.user).agg(F.count(F.lit(1)).alias("diagonal"))
    mean = F.coalesce(F.col("all_pairs") - F.col("diagonal"), F.lit(0.0)) / (F.col("m") * (F.col("m") - 1))
    return (
        sizes.filter("m > 1")
        .join(overlap, cols.user, "left")
        .join(diagonal, cols.user, "left")
        .select(cols.user, mean.alias("mean_similarity"))
    )


def _vector_sums(rows: DataFrame, features: DataFrame, cols: Cols) -> DataFrame:
    """Per user: rows, rows with a usable vector, and the sum of their unit vectors."""
    require_features(features, cols.item)
    units = features.select(cols.item, unit("features").alias("u")).filter("u is not null")
    sizes = rows.groupBy(cols.user).agg(F.count(F.lit(1)).alias("m"))
    sums = (
        spread_join(rows, units, cols.item)
        .groupBy(cols.user)
        .agg(F.count(F.lit(1)).alias("known"), Summarizer.sum(array_to_vector("u")).alias("v"))
        .select(cols.user, "known", vector_to_array("v").alias("v"))
    )
    return sizes.join(sums, cols.user, "left")


def _intralist_by_features(lists: DataFrame, features: DataFrame, cols: Cols) -> DataFrame:
    # Cosines of all ordered pairs add up to the squared length of the summed unit vectors.
    sums = _vector_sums(lists, features, cols).filter("m > 1")
    between = F.coalesce(dot("v", "v") - F.col("known"), F.lit(0.0))
    return sums.select(cols.user, (between / (F.col("m") * (F.col("m") - 1))).alias("mean_similarity"))


def user_diversity(train: DataFrame, recos: DataFrame, features: DataFrame | None = None, cols: Cols = DEFAULT_COLS, **limits) -> DataFrame:
    """One minus the intra-list similarity of each user."""
    similarity = intralist_similarity(train, recos, features, cols, **limits)
    return similarity.select(cols.user, (1 - F.col("mean_similarity")).alias("user_diversity"))


def diversity(train: DataFrame, recos: DataFrame, features: DataFrame | None = None, cols: Cols = DEFAULT_COLS, **limits) -> DataFrame:
    """One row: the mean user diversity."""
    return user_diversity(train, recos, features, cols, **limits).agg(F.avg("user_diversity").alias("diversity"))


# Novelty


def item_novelty(train: DataFrame, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """Per item, minus log2 of its share of all training rows."""
    counts = item_counts(train, cols.item)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(cols.item, (-F.log2(F.col("n") / total)).alias("item_novelty"))


def novelty(train: DataFrame, recos: DataFrame, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """One row: mean item novelty of the recommendations; items unseen in train count 0."""
    counts = item_counts(recos, cols.item)
    known = counts.join(item_novelty(train, cols), cols.item, "left")
    weighted = F.sum(F.coalesce(F.col("n") * F.col("item_novelty"), F.lit(0.0)))
    return known.agg((weighted / F.sum("n")).alias("novelty"))


# Serendipity


def user_item_serendipity(
    train: DataFrame,
    recos: DataFrame,
    features: DataFrame | None = None,
    relevance: str | None = None,
    cols: Cols = DEFAULT_COLS,
    long_list_rows: int = LONG_LIST_ROWS,
    large_group_rows: int = LARGE_GROUP_ROWS,
) -> DataFrame:
    """(1 - mean similarity of a recommended item to the user's history) times its relevance.

    ``relevance`` names a column of ``recos``; without it every recommendation counts 1.
    Users without history drop out.
    """
    weight = F.lit(1.0) if relevance is None else F.col(relevance).cast("double")
    wanted = recos.select(cols.user, cols.item, weight.alias("weight"))
    history = train.select(cols.user, cols.item)
    if features is not None:
        means = _history_mean_by_features(history, wanted, features, cols)
    else:
        short, long = _split_lists(history, wanted, cols, long_list_rows)
        means = _history_mean_by_pairs(history, short, cols, large_group_rows)
        if long is not None:
            means = means.unionByName(_history_mean_by_co_users(history, long, cols))
    return means.select(cols.user, cols.item, ((1 - F.col("mean_sim")) * F.col("weight")).alias("user_item_serendipity"))


def _split_lists(history: DataFrame, wanted: DataFrame, cols: Cols, long_list_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(lists that meet their history pair by pair, others or None).

    In blocks that costs no rows, so there a list is long only if its pairs are more than a block's worth.
    """
    if not _whole(cols, history, wanted):
        return split_by_group_size(wanted, cols.user, long_list_rows)
    sizes = wanted.groupBy(cols.user).agg(F.count(F.lit(1)).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= long_list_rows:
        return wanted, None
    met = history.groupBy(cols.user).agg(F.count(F.lit(1)).alias("m"))
    long = sizes.filter(F.col("n") > long_list_rows).join(met, cols.user).filter(F.col("n").cast("double") * F.col("m") > MOST_PAIRS).select(cols.user)
    long = checkpoint(long)
    if long.isEmpty():
        return wanted, None
    return spread_join(wanted, long, cols.user, "left_anti"), spread_join(wanted, long, cols.user, "left_semi")


def _history_mean_by_blocks(history: DataFrame, wanted: DataFrame, cols: Cols, large_group_rows: int) -> DataFrame:
    """The mean over the pairs of a listed item and the history, worked out in blocks of items (see ``asked``)."""

    def out(user, weight, flags, a, line, b, sums):
        line, at = np.unique(line, return_inverse=True)
        # A null stands for the item it is paired with, and that is like itself.
        null = a == NULL_ID
        sums = np.where(null[line][at], b != NULL_ID, sums)
        mean = np.bincount(at, sums, len(line)) / np.bincount(at, minlength=len(line))
        return pa.table({"user": user[line], "item": pa.array(a[line], mask=null[line]), "mean_sim": mean, "weight": pa.array(weight[line], mask=flags[line] & NO_VALUE > 0)})

    listed = _list_entries(wanted, cols, F.col("weight"), OWN)
    entries = listed.unionByName(_list_entries(history, cols, F.lit(0.0), PARTNER))
    rows = _weighted_rows(history, wanted, cols)
    found = list_sums(rows, entries, cols.user, cols.item, "n", "left", large_group_rows, True, False, out, "user long, item long, mean_sim double, weight double")
    types = dict(wanted.dtypes)
    names = [F.col(old).cast(types[new]).alias(new) for old, new in (("user", cols.user), ("item", cols.item))]
    return found.select(*names, "mean_sim", "weight")


def _history_mean_by_pairs(history: DataFrame, wanted: DataFrame, cols: Cols, large_group_rows: int) -> DataFrame:
    if _whole(cols, history, wanted):
        return _history_mean_by_blocks(history, wanted, cols, large_group_rows)
    # At most long_list_rows recommendations meet each history row.
    listed = wanted.select(cols.user, F.col(cols.item).alias("i1"), "weight")
    met = spread_join(history.withColumnRenamed(cols.item, "i2"), listed, cols.user)
    met = met.withColumns({"lo": F.least("i1", "i2"), "hi": F.greatest("i1", "i2")}).drop("i2")
    counts = item_counts(history, cols.item)
    weighted = cosine_weights(history, cols.user, cols.item, counts)
    sims = pair_sums(weighted, wanted.select(cols.item).distinct(), met, cols.user, cols.item, "w", large_group_rows, counts)
    # No pair meets more often than its rarer item occurs among histories and lists.
    matched = spread_join(met, sims, ["lo", "hi"], "left", counts=counts.withColumnRenamed(cols.item, "hi"))
    return matched.groupBy(cols.user, F.col("i1").alias(cols.item)).agg(
        F.avg(F.coalesce("shared", F.lit(0.0))).alias("mean_sim"), F.first("weight").alias("weight")
    )


def _history_mean_by_co_users(history: DataFrame, wanted: DataFrame, cols: Cols) -> DataFrame:
    """The same mean for lists too long to meet the whole history item by item.

    With w = 1/sqrt(n(item)), summing similarities of item r over a history is w(r) times the
    sum, over users v who rated r, of the w of v's items in that history.
    """
    counts = item_counts(history, cols.item)
    weights = counts.select(cols.item, F.sqrt("n").alias("root"))
    raters = history.select(cols.item, F.col(cols.user).alias("rater"))
    own = spread_join(history, wanted.select(cols.user).distinct(), cols.user, "left_semi")
    sizes = own.groupBy(cols.user).agg(F.count(F.lit(1)).alias("m"))
    overlap = (
        spread_join(raters, spread_join(own, weights, cols.item, counts=counts), cols.item, counts=counts)
        .groupBy(cols.user, "rater")
        .agg(F.sum(1 / F.col("root")).alias("w"))
    )
    listed = spread_join(wanted, weights, cols.item)
    sums = (
        spread_join(raters, listed, cols.item, counts=counts)
        .join(overlap, [cols.user, "rater"])
        .groupBy(cols.user, cols.item)
        .agg(F.sum(F.col("w") / F.col("root")).alias("total"))
    )
    mean = F.coalesce(F.col("total") / F.col("m"), F.lit(0.0))
    return (
        spread_join(wanted, sizes, cols.user)
        .join(sums, [cols.user, cols.item], "left")
        .select(cols.user, cols.item, mean.alias("mean_sim"), "weight")
    )


def _history_mean_by_features(history: DataFrame, wanted: DataFrame, features: DataFrame, cols: Cols) -> DataFrame:
    # The mean cosine to a history is the product with the mean of its unit vectors.
    users = _vector_sums(history, features, cols).select(cols.user, "m", "v")
    units = features.select(cols.item, unit("features").alias("u"))
    mean = F.coalesce(dot("u", "v") / F.col("m"), F.lit(0.0))
    listed = spread_join(wanted, units, cols.item, "left")
    per_user = wanted.groupBy(cols.user).agg(F.count(F.lit(1)).alias("n"))
    return spread_join(listed, users, cols.user, counts=per_user).select(cols.user, cols.item, mean.alias("mean_sim"), "weight")


def user_serendipity(train: DataFrame, recos: DataFrame, features=None, relevance=None, cols: Cols = DEFAULT_COLS, **limits) -> DataFrame:
    """Mean serendipity of each user's recommendations."""
    items = user_item_serendipity(train, recos, features, relevance, cols, **limits)
    return items.groupBy(cols.user).agg(F.avg("user_item_serendipity").alias("user_serendipity"))


def serendipity(train: DataFrame, recos: DataFrame, features=None, relevance=None, cols: Cols = DEFAULT_COLS, **limits) -> DataFrame:
    """One row: the mean user serendipity."""
    users = user_serendipity(train, recos, features, relevance, cols, **limits)
    return users.agg(F.avg("user_serendipity").alias("serendipity"))


# Coverage


def catalog_coverage(train: DataFrame, recos: DataFrame, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """One row: distinct recommended items over distinct training items."""
    sides = recos.select(cols.item, F.lit(1).alias("reco"), F.lit(0).alias("train")).unionByName(
        train.select(cols.item, F.lit(0).alias("reco"), F.lit(1).alias("train"))
    )
    items = sides.groupBy(cols.item).agg(F.max("reco").alias("reco"), F.max("train").alias("train"))
    return items.agg((F.sum("reco") / F.sum("train")).alias("catalog_coverage"))


def distributional_coverage(recos: DataFrame, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """One row: the entropy in bits of how recommendations spread over items."""
    counts = item_counts(recos, cols.item)
    share = F.col("n") / counts.agg(F.sum("n")).scalar()
    return counts.agg((-F.sum(share * F.log2(share))).alias("distributional_coverage"))
