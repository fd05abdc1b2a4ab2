"""Movies ranked by one statistic of their ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.functions.expressions import defined
from rankwell.operators.features import ratings_per_item

_MOVIE = ("movieId", "title", "genres")


def _ranked_by(ratings: DataFrame, movies: DataFrame, metric: str, min_count: int, n: int | None) -> DataFrame:
    stats = ratings_per_item(ratings).filter(
        (F.col("number_of_rating_per_movie") >= min_count) & defined(metric)
    )
    # Copies of a movie row fold in the map tasks of the distinct, before anything is joined.
    ranking = movies.select(*_MOVIE).distinct().join(stats.select("movieId", metric), "movieId")
    ranking = ranking.select(*_MOVIE, metric).orderBy(F.desc(metric), "movieId", "title", "genres")
    return ranking if n is None else ranking.limit(n)


def popular_by_count(ratings: DataFrame, movies: DataFrame, min_count: int = 0, n: int | None = None) -> DataFrame:
    """Most rated first; at least ``min_count`` ratings, ties by movie id."""
    return _ranked_by(ratings, movies, "number_of_rating_per_movie", min_count, n)


def popular_by_mean(ratings: DataFrame, movies: DataFrame, min_count: int = 0, n: int | None = None) -> DataFrame:
    """Best rated on average first."""
    return _ranked_by(ratings, movies, "average_rating_per_movie", min_count, n)


def popular_by_stddev(ratings: DataFrame, movies: DataFrame, min_count: int = 0, n: int | None = None) -> DataFrame:
    """Most divided opinions first; movies with an undefined deviation (one rating) drop out."""
    return _ranked_by(ratings, movies, "standard_deviation_rating_per_movie", min_count, n)
