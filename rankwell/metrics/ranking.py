"""Relevant-item lists and precision, recall, NDCG and MAP over them in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.columns import DEFAULT_COLS, DEFAULT_K, Cols, require_columns
from rankwell.skew import ranked, top_rows


def relevant_top_k(predictions: DataFrame, k: int = DEFAULT_K, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """(user, item, rank) of the k best predictions per user, ties by item."""
    scored = predictions.select(cols.user, cols.item, cols.prediction)
    ranking = top_rows(scored, cols.user, [F.desc(cols.prediction), F.asc(cols.item)], k)
    return ranking.select(cols.user, cols.item, "rank")


def relevant_by_threshold(predictions: DataFrame, threshold: float, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """(user, item, rank) of all predictions of at least ``threshold``, however many."""
    scored = predictions.select(cols.user, cols.item, cols.prediction).filter(F.col(cols.prediction) >= threshold)
    order = [F.desc(cols.prediction), F.asc(cols.item)]
    return ranked(scored, cols.user, order).select(cols.user, cols.item, "rank")


def relevant_by_timestamp(predictions: DataFrame, k: int = DEFAULT_K, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """(user, item, rank) of the k most recent rows per user, ties by item."""
    require_columns(predictions, [cols.timestamp], "predictions")
    timed = predictions.select(cols.user, cols.item, cols.timestamp)
    ranking = top_rows(timed, cols.user, [F.desc(cols.timestamp), F.asc(cols.item)], k)
    return ranking.select(cols.user, cols.item, "rank")


def relevant_items(
    predictions: DataFrame,
    method: str = "top_k",
    k: int = DEFAULT_K,
    threshold: float | None = None,
    cols: Cols = DEFAULT_COLS,
) -> DataFrame:
    """The list builder called ``method``: top_k, by_threshold or by_time_stamp."""
    if method == "top_k":
        return relevant_top_k(predictions, k, cols)
    if method == "by_time_stamp":
        return relevant_by_timestamp(predictions, k, cols)
    if method == "by_threshold":
        if threshold is None:
            raise ValueError("by_threshold needs a threshold")
        return relevant_by_threshold(predictions, threshold, cols)
    raise ValueError(f"relevance method {method!r} is not one of top_k, by_threshold, by_time_stamp")


def as_lists(ranking: DataFrame, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """One row per user with the ranked items as an array, for lists cut at k."""
    entry = F.sort_array(F.collect_list(F.struct("rank", cols.item)))
    return ranking.groupBy(cols.user).agg(F.transform(entry, lambda e: e[cols.item]).alias(cols.prediction))


def ranking_metrics(
    truth: DataFrame,
    predictions: DataFrame,
    k: int = DEFAULT_K,
    method: str = "top_k",
    threshold: float | None = None,
    cols: Cols = DEFAULT_COLS,
) -> DataFrame:
    """One row (precision_at_k, recall_at_k, ndcg_at_k, map, map_at_k), averaged over users.

    Every item of a user in ``truth`` is relevant. Users missing from either side drop out.
    """
    require_columns(truth, [cols.user, cols.item, cols.rating], "truth")
    require_columns(predictions, [cols.user, cols.item, cols.prediction], "predictions")
    lists = relevant_items(predictions, method, k, threshold, cols)
    relevant = truth.select(cols.user, cols.item).distinct()

    hits = lists.join(relevant, [cols.user, cols.item])
    # "seen": hits up to and including this one. Lists cut at k have at most k hits per user.
    if method == "by_threshold":
        hits = ranked(hits.select(cols.user, "rank"), cols.user, [F.asc("rank")], "seen")
    else:
        hits = top_rows(hits.select(cols.user, "rank"), cols.user, [F.asc("rank")], k, "seen")

    within = F.col("rank") <= k
    gain = F.col("seen") / F.col("rank")
    scored = hits.groupBy(cols.user).agg(
        F.count_if(within).alias("hits"),
        F.sum(F.when(within, 1 / F.ln(F.col("rank") + 1)).otherwise(0.0)).alias("dcg"),
        F.sum(gain).alias("gains"),
        F.sum(F.when(within, gain).otherwise(0.0)).alias("gains_at_k"),
    )
    sizes = relevant.groupBy(cols.user).agg(F.count(F.lit(1)).alias("n"))
    users = lists.select(cols.user).distinct().join(sizes, cols.user).join(scored, cols.user, "left")
    best_dcg = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")),
        F.lit(0.0),
        lambda total, place: total + 1 / F.ln(place + 1),
    )

    def mean(value, name):
        return F.avg(F.coalesce(value, F.lit(0.0))).alias(name)

    return users.agg(
        mean(F.col("hits") / k, "precision_at_k"),
        mean(F.col("hits") / F.col("n"), "recall_at_k"),
        mean(F.col("dcg") / best_dcg, "ndcg_at_k"),
        mean(F.col("gains") / F.col("n"), "map"),
        mean(F.col("gains_at_k") / F.least(F.col("n"), F.lit(k)), "map_at_k"),
    )
