"""Registered queries: every operator over the whole tables of a parquet folder.

``entry`` runs the flagship query, ``queries`` lists all, ``oracle_sql`` gives the DuckDB SQL
each one must agree with. Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from rankwell.metrics import diversity, ranking, rating  # noqa: E402
from rankwell.operators import bitmaps, factorization, features, genres, neighbors, popularity, similarity, tiles  # noqa: E402
from rankwell.plans import baseline, profile, report  # noqa: E402
from rankwell.skew import checkpoint, scratch_folder, spread_join  # noqa: E402
from rankwell.sources import files, readers  # noqa: E402
from rankwell.sources.layout import lay_out  # noqa: E402
from rankwell.sources.tables import item_features, movies_view, ratings_view  # noqa: E402

try:
    from rankwell.llm import queries as llm  # noqa: E402
except ImportError:  # the package works without its subpackage for training data
    llm = None
try:
    import corpus_pipeline  # noqa: E402
except ImportError:
    corpus_pipeline = None

# Support needed by the popularity rankings; items have about 30 ratings at every scale.
MIN_COUNT = 20
PREFERENCES = {
    "plain": ["ECONOMY", "red", "bolt"],
    "repeated": ["SMALL", "small", "ring", "ring"],
    "partly known": ["blue", "gear", "Unheard-Of"],
    "unknown": ["Unheard-Of"],
}
THRESHOLD = 3.0


def entry(spark: SparkSession) -> DataFrame:
    """Movies by mean rating, on the smallest tables."""
    return queries()["popular_by_mean"](spark, "/root/testdata/sf0.001")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.round(F.col(n).cast("double"), 6).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes]
    )


# Inputs shared by the queries


def _ratings(spark, folder):
    """The ratings, built once: queries with several branches read the written rows."""
    return checkpoint(ratings_view(spark, folder))


def _split(spark, folder):
    return features.modular_split(_ratings(spark, folder))


def _recos(train):
    return baseline.recommend_popular(train)


def _lists(train, test):
    """Each user's best predicted held-out items: lists that differ from user to user."""
    return ranking.relevant_top_k(baseline.predict_by_means(train, test))


def _train_and_lists(spark, folder):
    """The stored training part, and the stored lists of held-out items."""
    train, test = _split(spark, folder)
    return train, checkpoint(_lists(train, test))


def _on_lists(use):
    return lambda spark, folder: use(*_train_and_lists(spark, folder))


def _test_predictions(spark, folder):
    train, test = _split(spark, folder)
    return test, baseline.predict_by_means(train, test)


def _candidate_predictions(train):
    """Popular unseen items scored by means, with the item's newest training rating as time."""
    candidates = baseline.unseen_candidates(train).drop("prediction")
    newest = train.groupBy("movieId").agg(F.max("timestamp").alias("timestamp"))
    train_counts = similarity.item_counts(train)
    return spread_join(baseline.predict_by_means(train, candidates), newest, "movieId", counts=train_counts)


def _asked_pairs(train, recos):
    """Distinct (recommended item, item of the same user's history) pairs."""
    return similarity.history_pairs(train, recos)


# Queries that need more than one call


def _train_test_split(spark, folder):
    train, test = _split(spark, folder)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _seen_overlap(spark, folder):
    """All ratings as recommendations: the training rows among them have been rated already."""
    ratings = _ratings(spark, folder)
    return diversity.seen_overlap(features.modular_split(ratings)[0], ratings)


def _ranking(method, threshold=None):
    def query(spark, folder):
        train, test = _split(spark, folder)
        predictions = _candidate_predictions(train)
        return ranking.ranking_metrics(test, predictions, method=method, threshold=threshold)

    return query


def _cooccurrence(**limits):
    return _on_lists(lambda train, lists: similarity.cooccurrence_similarity(train, _asked_pairs(train, lists), left_items=lists, **limits))


def _feature_similarity(spark, folder):
    train, lists = _train_and_lists(spark, folder)
    vectors = item_features(spark, folder)
    # Pairs without both vectors drop out, so none of them is formed.
    train, lists = (similarity.with_vectors(part, vectors) for part in (train, lists))
    return similarity.feature_similarity(vectors, _asked_pairs(train, lists))


def _item_pearson(spark, folder):
    train, lists = _train_and_lists(spark, folder)
    return similarity.pearson_similarity(train, _asked_pairs(train, lists))


def _weighted_serendipity(train, lists):
    weighted = lists.withColumn("relevance", 1 / F.col("rank"))
    return diversity.user_item_serendipity(train, weighted, relevance="relevance")


def _on_recos(metric, with_features=False, **limits):
    """A metric of (train, lists), with the stored vectors as item features if asked."""

    def query(spark, folder):
        train, lists = _train_and_lists(spark, folder)
        vectors = item_features(spark, folder) if with_features else None
        return metric(train, lists, vectors, **limits)

    return query


def _evaluation_report(spark, folder):
    train, test = _split(spark, folder)
    return report.evaluation_report(train, test, baseline.predict_by_means(train, test), _recos(train))


def _als(use):
    def query(spark, folder):
        train, test = features.hash_split(_ratings(spark, folder))
        return use(factorization.fit_als(train), train, test)

    return query


def _by_factors(use):
    """Scoring from factors that SQL can compute too: stored vectors, and their mean per user."""

    def query(spark, folder):
        train, test = _split(spark, folder)
        items = item_features(spark, folder).withColumnRenamed("movieId", "id")
        return use(factorization.mean_user_factors(train, items), items, train, test)

    return query


def _csv_file(which):
    return lambda spark, folder: readers.checked_csv_dataset(spark, files.write_csv_dataset(spark, folder))[which].good


def _dat_file(which):
    return lambda spark, folder: readers.checked_dat_dataset(spark, files.write_dat_dataset(spark, folder))[which].good


def _rejected_lines(spark, folder):
    """Lines of the four files that fit no schema, with how often and why."""
    csv = readers.checked_csv_dataset(spark, files.write_csv_dataset(spark, folder))
    dat = readers.checked_dat_dataset(spark, files.write_dat_dataset(spark, folder))
    parts = zip(("ratings.csv", "movies.csv", "ratings.dat", "movies.dat"), (*csv, *dat))
    named = [part.rejected.select(F.lit(name).alias("file"), "line", "reason") for name, part in parts]
    return named[0].union(named[1]).union(named[2]).union(named[3])


def _inferred_csv(spark, folder):
    """Ratings under the types that the reader finds, from a file without bad lines."""
    path = f"{scratch_folder(spark, 'inferred')}/ratings.csv"
    ratings_view(spark, folder).write.option("header", True).csv(path)
    return readers.read_inferred(spark, path)


def _json_scores(spark, folder):
    """The report as JSON, and its scores read back from it."""
    scores = report.report_json(rounded(_evaluation_report(spark, folder)))
    read = F.from_json("scores", "map<string,double>")
    return scores.select(F.explode(read).alias("metric", "score"))


def _als_preprocessed(spark, folder):
    """ALS on preprocessed ratings: well-supported users and items, centred on the user mean."""
    rows = features.preprocess_ratings(_ratings(spark, folder), movies_view(spark, folder))
    train, test = features.hash_split(checkpoint(rows.select("userId", "movieId", "rating", "timestamp")))
    return report.evaluate_als(factorization.fit_als(train), train, test)


def _tiles(use):
    return lambda spark, folder: use(checkpoint(tiles.rating_tiles(ratings_view(spark, folder))))


def _tile_sizes(held):
    total = F.aggregate("values", F.lit(0.0), lambda t, v: t + v)
    return held.select("row_tile", "col_tile", "kind", F.size("at").alias("cells"), total.alias("total"))


def _dense_rows(held):
    return tiles.dense_rows(held).select("userId", "col_tile", F.array_join("values", " ").alias("row_values"))


def _coverage_by_years(train, lists):
    """Item bitmaps of each year's training rows, stored, then merged."""
    year = F.floor(F.col("timestamp") / (365 * 86_400)).alias("year")
    yearly = checkpoint(bitmaps.id_bitmaps(train.select("movieId", year), "movieId", ["year"]))
    return bitmaps.catalog_coverage(yearly, bitmaps.id_bitmaps(lists, "movieId"))


def _seen_overlap_bitmaps(spark, folder):
    ratings = _ratings(spark, folder)
    return bitmaps.seen_overlap(features.modular_split(ratings)[0], ratings)


def _preprocess_laid_out(spark, folder):
    return features.preprocess_ratings(lay_out(ratings_view(spark, folder), "userId"), movies_view(spark, folder))


def _rating_metrics_laid_out(spark, folder):
    test, predictions = _test_predictions(spark, folder)
    both = (lay_out(rows, ["userId", "movieId"]) for rows in (test, predictions))
    return rating.rating_metrics(*both, check_empty=False)


def _on_ratings(use):
    return lambda spark, folder: use(ratings_view(spark, folder))


def _on_movies(use):
    return lambda spark, folder: use(movies_view(spark, folder))


def _on_both(use, **options):
    return lambda spark, folder: use(ratings_view(spark, folder), movies_view(spark, folder), **options)


def _on_train(use):
    return lambda spark, folder: use(_split(spark, folder)[0])


def _on_stored_ratings(use):
    return lambda spark, folder: use(_ratings(spark, folder))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings_view": ratings_view,
    "movies_view": movies_view,
    # Files
    "read_csv_ratings": _csv_file(0),
    "read_csv_movies": _csv_file(1),
    "read_dat_ratings": _dat_file(0),
    "read_dat_movies": _dat_file(1),
    "read_inferred_ratings": _inferred_csv,
    "rejected_lines": _rejected_lines,
    # Profiling
    "dataset_sizes": _on_both(profile.dataset_sizes),
    "rating_timespan": _on_ratings(profile.rating_timespan),
    "five_number_items": _on_both(profile.five_number_items),
    "five_number_users": _on_ratings(profile.five_number_users),
    "five_number_means": _on_ratings(profile.five_number_means),
    "genre_distribution": _on_movies(profile.genre_distribution),
    "genre_count": _on_movies(profile.genre_count),
    "genre_rating": _on_both(profile.genre_rating),
    "ratings_vs_age": _on_both(profile.ratings_vs_age),
    "genre_trends": _on_both(profile.genre_trends),
    "user_genre_profile": _on_both(profile.user_genre_profile),
    # Features
    "ratings_per_item": _on_ratings(features.ratings_per_item),
    "ratings_per_user": _on_ratings(features.ratings_per_user),
    "movie_age": _on_movies(features.movie_age),
    "preprocess_ratings": lambda spark, folder: features.preprocess_ratings(
        _ratings(spark, folder), movies_view(spark, folder)
    ),
    "train_test_split": _train_test_split,
    # Popularity and genres
    "popular_by_count": _on_both(popularity.popular_by_count, min_count=MIN_COUNT),
    "popular_by_mean": _on_both(popularity.popular_by_mean, min_count=MIN_COUNT),
    "popular_by_stddev": _on_both(popularity.popular_by_stddev, min_count=MIN_COUNT),
    "genre_catalog": _on_movies(genres.genre_catalog),
    "genre_recommend": _on_movies(lambda movies: genres.genre_recommend(movies, PREFERENCES)),
    # Baseline recommender and predictor
    "unseen_candidates": _on_train(baseline.unseen_candidates),
    "recommend_popular": _on_train(_recos),
    "predict_by_means": lambda spark, folder: _test_predictions(spark, folder)[1],
    # Rating and ranking metrics
    "rating_metrics": lambda spark, folder: rating.rating_metrics(*_test_predictions(spark, folder), check_empty=False),
    "preprocess_ratings_laid_out": _preprocess_laid_out,
    "rating_metrics_laid_out": _rating_metrics_laid_out,
    "relevant_top_k": lambda spark, folder: ranking.relevant_top_k(_test_predictions(spark, folder)[1]),
    "relevant_by_threshold": lambda spark, folder: ranking.relevant_by_threshold(
        _test_predictions(spark, folder)[1], THRESHOLD
    ),
    "relevant_by_timestamp": lambda spark, folder: ranking.relevant_by_timestamp(_test_predictions(spark, folder)[1]),
    "ranking_metrics": _ranking("top_k"),
    "ranking_metrics_by_threshold": _ranking("by_threshold", THRESHOLD),
    "ranking_metrics_by_timestamp": _ranking("by_time_stamp"),
    # Pairs and similarities
    "seen_overlap": _seen_overlap,
    "seen_overlap_bitmaps": _seen_overlap_bitmaps,
    "item_pairs": _on_lists(lambda train, lists: similarity.list_pairs(lists)),
    "cooccurrence_similarity": _cooccurrence(),
    # The same through the path for long histories, whatever their length.
    "cooccurrence_similarity_long_histories": _cooccurrence(large_group_rows=5),
    "feature_similarity": _feature_similarity,
    "feature_neighbors": lambda spark, folder: similarity.feature_neighbors(item_features(spark, folder)).best,
    # Diversity, novelty, serendipity, coverage
    "intralist_similarity": _on_recos(diversity.intralist_similarity),
    "intralist_similarity_long_lists": _on_recos(diversity.intralist_similarity, long_list_rows=3),
    "intralist_similarity_by_features": _on_recos(diversity.intralist_similarity, with_features=True),
    "user_diversity": _on_recos(diversity.user_diversity),
    "diversity": _on_recos(diversity.diversity),
    "item_novelty": _on_train(diversity.item_novelty),
    "novelty": _on_lists(diversity.novelty),
    "user_item_serendipity": _on_recos(diversity.user_item_serendipity),
    "user_item_serendipity_long_lists": _on_recos(diversity.user_item_serendipity, long_list_rows=3),
    "user_item_serendipity_by_relevance": _on_lists(_weighted_serendipity),
    "user_item_serendipity_by_features": _on_recos(diversity.user_item_serendipity, with_features=True),
    "user_serendipity": _on_recos(diversity.user_serendipity),
    "serendipity": _on_recos(diversity.serendipity),
    "catalog_coverage": _on_lists(diversity.catalog_coverage),
    "catalog_coverage_bitmaps": _on_lists(_coverage_by_years),
    "distributional_coverage": _on_lists(lambda train, lists: diversity.distributional_coverage(lists)),
    # Pearson
    "pearson_neighbors_large_entities": _on_stored_ratings(
        # Every user with more than 32 ratings is cut into tiles.
        lambda ratings: neighbors.pearson_neighbors(ratings, entity="movieId", other="userId", tile_rows=32)
    ),
    "rating_matrix": _on_ratings(neighbors.rating_matrix),
    "rating_tiles": _tiles(_tile_sizes),
    "rating_matrix_dense": _tiles(_dense_rows),
    "tile_column_totals": _tiles(tiles.column_totals),
    "tile_centred_cells": _tiles(lambda held: tiles.tile_cells(tiles.centre_columns(held))),
    "item_pearson": _item_pearson,
    "pearson_neighbors": _on_stored_ratings(
        lambda ratings: neighbors.pearson_neighbors(ratings, entity="movieId", other="userId")
    ),
    "user_pearson": _on_stored_ratings(neighbors.pearson_neighbors),
    # Of the held-out ratings, which are few per user, so that most best partners share none.
    "pearson_neighbors_complete": lambda spark, folder: neighbors.pearson_neighbors(
        _split(spark, folder)[1], 100, entity="movieId", other="userId", complete=True
    ),
    "pearson_recommend": _on_stored_ratings(neighbors.pearson_recommend),
    # Scoring from factors
    "factor_predict": _by_factors(lambda users, items, train, test: factorization.factor_predict(users, items, test)),
    "factor_topk_unseen": _by_factors(
        lambda users, items, train, test: factorization.factor_top_k_unseen(users, items, train)
    ),
    # Trained models
    "als_factors": _als(lambda model, train, test: factorization.als_factors(model)),
    "als_predict": _als(lambda model, train, test: factorization.als_predict(model, test)),
    "als_topk_unseen": _als(lambda model, train, test: factorization.top_k_unseen(model, train)),
    "als_evaluation": _als(report.evaluate_als),
    "als_evaluation_preprocessed": _als_preprocessed,
    "evaluation_report": _evaluation_report,
    "report_json": _json_scores,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name -> function of (session, folder of parquet tables)."""

    def with_rounding(query):
        return lambda spark, folder: rounded(query(spark, folder))

    found = {name: with_rounding(query) for name, query in _QUERIES.items()}
    if llm is not None:
        found |= llm.QUERIES
    if corpus_pipeline is not None:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """Name -> DuckDB SQL; trained models and what SQL cannot express have none."""
    found = oracle.statements()
    if llm is not None:
        found |= llm.ORACLE_SQL
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
