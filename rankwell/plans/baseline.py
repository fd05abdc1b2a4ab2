"""Model-free recommender and predictor: popular unseen items, and user plus item means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.columns import DEFAULT_COLS, DEFAULT_K, Cols
from rankwell.skew import checkpoint, first_gaps, ranked, spread_join


def unseen_candidates(train: DataFrame, k: int = 50, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """Each user's ``k`` most rated items among all the user has not rated, ties by item.

    (user, item, prediction, rank), the prediction being the item's rating count. Exact over the
    whole catalogue, yet no user is paired with it: items are ranked once by count, and a user's
    unseen ones are the gaps between the ranks of the seen ones. Users who have rated all items
    drop out, others get what is left.
    """
    counts = train.groupBy(cols.item).agg(F.count(F.lit(1)).alias("n"))
    users = checkpoint(train.groupBy(cols.user).agg(F.count(F.lit(1)).alias("n")))
    order = [F.desc("n"), F.asc(cols.item)]
    items = ranked(counts.withColumn("__all", F.lit(0)), "__all", order, "__r").drop("__all")
    # No user's first k gaps lie beyond k places more than anybody has rated.
    items = items.filter(F.col("__r") <= k + users.agg(F.max("n")).scalar())
    seen = spread_join(train.select(cols.user, cols.item), items.select(cols.item, "__r"), cols.item, counts=counts)
    wanted = first_gaps(seen, users, cols.user, "__r", k)
    offered = items.select("__r", cols.item, F.col("n").cast("double").alias(cols.prediction))
    # No place is wanted by more than all users.
    most = offered.select("__r").withColumn("n", users.agg(F.count(F.lit(1))).scalar())
    return spread_join(wanted, offered, "__r", counts=most).select(cols.user, cols.item, cols.prediction, "rank")


def recommend_popular(train: DataFrame, k: int = DEFAULT_K, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """The ``k`` most rated unseen items of each user, with rank."""
    return unseen_candidates(train, k, cols)


def predict_by_means(train: DataFrame, pairs: DataFrame, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """``pairs`` with prediction = user mean + item mean - overall mean of ``train``.

    Pairs whose user or item has no training row drop out. The training counts tell which
    users and items are hot among the pairs.
    """
    sums = (F.sum(cols.rating).alias("s"), F.count(F.lit(1)).alias("n"))
    users, items = train.groupBy(cols.user).agg(*sums), train.groupBy(cols.item).agg(*sums)
    overall = items.agg(F.sum("s") / F.sum("n")).scalar()
    mean = F.col("s") / F.col("n")
    matched = spread_join(pairs, users.select(cols.user, mean.alias("user_mean")), cols.user, counts=users)
    matched = spread_join(matched, items.select(cols.item, mean.alias("item_mean")), cols.item, counts=items)
    return matched.withColumn(cols.prediction, F.col("user_mean") + F.col("item_mean") - overall).drop(
        "user_mean", "item_mean"
    )
