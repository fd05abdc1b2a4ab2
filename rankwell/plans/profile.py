"""Profiling queries: sizes, time span, distributions and genre trends."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.columns import NO_GENRE
from rankwell.functions.expressions import genre_list
from rankwell.operators.features import movie_age, ratings_per_item, ratings_per_user
from rankwell.skew import checkpoint, gathered, running_sums, spread_join

# Values a quantile sketch keeps, about: a bracket holds four parts in so many.
ACCURACY = 1000
_QUARTILES = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def _one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for part in parts for name in part.columns])


def dataset_sizes(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Rows of both tables and the distinct users and movies that have ratings.

    Grouping by the key folds rows in the map tasks, so distinct keys, not ratings, shuffle.
    """
    users = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
    items = ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))
    return _one_row(
        users.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("number_of_ratings"), F.count("userId").alias("number_of_users")
        ),
        items.agg(F.count("movieId").alias("number_of_rated_movies")),
        movies.agg(F.count(F.lit(1)).alias("number_of_movies")),
    )


def rating_timespan(ratings: DataFrame) -> DataFrame:
    """Days and years between the first and the last rating."""
    seconds = F.max("timestamp") - F.min("timestamp")
    return ratings.agg((seconds / 86_400).alias("timespan_in_days")).withColumn(
        "timespan_in_years", F.col("timespan_in_days") / 365.25
    )


def exact_quantiles(rows: DataFrame, column: str, shares: dict[str, float], accuracy: int = ACCURACY) -> DataFrame:
    """One row: the exact quantile of each named share, the least value with at least that share of rows up to it.

    Two passes. A sketch, merged from those of all tasks, brackets each quantile between two values
    that hold about 4 / ``accuracy`` of the rows; then only the rows of the brackets are counted by
    value and added up in order. No task ever holds all values. Nulls do not count; without any
    value all are null.
    """
    value = F.col(column)
    edges = sorted({e for s in shares.values() for e in (max(0.0, s - 2 / accuracy), min(1.0, s + 2 / accuracy))})
    sketch = rows.agg(
        F.count(value).alias("n"), F.percentile_approx(value, edges, accuracy).alias("at"), F.min(value).alias("least"), F.max(value).alias("most")
    ).first()
    kind = dict(rows.dtypes)[column]
    if not sketch["n"]:
        return rows.sparkSession.range(1).select(*[F.lit(None).cast(kind).alias(name) for name in shares])
    at = dict(zip(edges, sketch["at"]))
    target = {name: max(1, math.ceil(s * sketch["n"])) for name, s in shares.items()}
    low = {name: sketch["least"] if s <= 2 / accuracy else at[max(0.0, s - 2 / accuracy)] for name, s in shares.items()}
    high = {name: sketch["most"] if s >= 1 - 2 / accuracy else at[min(1.0, s + 2 / accuracy)] for name, s in shares.items()}
    low |= {name: sketch["least"] for name in shares if shares[name] == 0}
    high |= {name: sketch["least"] for name in shares if shares[name] == 0}
    low |= {name: sketch["most"] for name in shares if shares[name] == 1}

    def counts():
        below = [F.count_if(value < F.lit(low[name])).alias(f"{name}_below") for name in shares]
        inside = [F.count_if(value <= F.lit(high[name])).alias(f"{name}_to") for name in shares]
        return rows.agg(*below, *inside).first()

    found = counts()
    missed = [name for name in shares if not found[f"{name}_below"] < target[name] <= found[f"{name}_to"]]
    if missed:  # the sketch was off: look at all rows for these
        low |= {name: sketch["least"] for name in missed}
        high |= {name: sketch["most"] for name in missed}
        found = counts()
    open_names = [name for name in shares if low[name] != high[name]]
    picked = [F.lit(low[name]).cast(kind).alias(name) if name not in open_names else None for name in shares]
    if open_names:
        hit = F.array(*[F.when((value >= F.lit(low[n])) & (value <= F.lit(high[n])), n) for n in open_names])
        inside = rows.select(value.alias("value"), F.explode(F.array_compact(hit)).alias("name")).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
        placed = running_sums(inside, "name", [F.asc("value")], "n")
        need = F.element_at(F.create_map(*[F.lit(x) for n in open_names for x in (n, target[n] - found[f"{n}_below"])]), F.col("name"))
        least = placed.filter(F.col("running") >= need)
        picked = [p if p is not None else F.min(F.when(F.col("name") == n, F.col("value"))).alias(n) for n, p in zip(shares, picked)]
        return least.agg(*picked)
    return rows.sparkSession.range(1).select(*picked)


def five_number_summary(counts: DataFrame, column: str) -> DataFrame:
    """Exact minimum, quartiles and maximum of a column, with mean and natural logs."""
    counts = checkpoint(counts.select(column))
    summary = _one_row(exact_quantiles(counts, column, _QUARTILES), counts.agg(F.avg(column).alias("mean")))
    return summary.select("*", *[F.ln(name).alias(f"ln_{name}") for name in _QUARTILES])


def five_number_items(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Distribution of ratings per movie, over the movies listed in ``movies``."""
    counts = movies.select("movieId").join(ratings_per_item(ratings), "movieId")
    return five_number_summary(counts, "number_of_rating_per_movie")


def five_number_users(ratings: DataFrame) -> DataFrame:
    """Distribution of ratings per user."""
    return five_number_summary(ratings_per_user(ratings), "number_of_rating_per_user")


def five_number_means(ratings: DataFrame) -> DataFrame:
    """Distribution of the movies' mean ratings."""
    return five_number_summary(ratings_per_item(ratings), "average_rating_per_movie")


def genre_distribution(movies: DataFrame) -> DataFrame:
    """Movies per genre."""
    return (
        movies.select(F.explode(genre_list("genres")).alias("genre"))
        .groupBy("genre")
        .agg(F.count(F.lit(1)).alias("number_of_movies"))
    )


def genre_count(movies: DataFrame) -> DataFrame:
    """How many genres there are, the placeholder for "no genre" not being one."""
    return genre_distribution(movies).filter(F.col("genre") != NO_GENRE).agg(F.count(F.lit(1)).alias("n_genres"))


def genre_rating(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Mean over a genre's movies of each movie's mean rating; every movie weighs the same."""
    rated = movies.select("movieId", "genres").join(ratings_per_item(ratings), "movieId")
    return (
        rated.select(F.explode(genre_list("genres")).alias("genre"), "average_rating_per_movie")
        .groupBy("genre")
        .agg(F.avg("average_rating_per_movie").alias("rating"))
    )


def _known_age(movies: DataFrame, current_year: int, max_age: int = 200) -> DataFrame:
    return movie_age(movies, current_year).filter(F.col("movie_age") < max_age)


def ratings_vs_age(ratings: DataFrame, movies: DataFrame, current_year: int = 2024) -> DataFrame:
    """Rating count and age of each movie with a believable release year."""
    return (
        movies.select("movieId", "title")
        .join(ratings_per_item(ratings), "movieId")
        .join(_known_age(movies, current_year), "movieId")
        .select("movieId", "title", "number_of_rating_per_movie", "movie_age")
    )


def genre_trends(ratings: DataFrame, movies: DataFrame, current_year: int = 2024) -> DataFrame:
    """Ratings per genre and release year.

    Ratings are counted per movie before the join: one row per movie is shuffled and exploded,
    not one per rating.
    """
    counts = ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))
    listed = movies.filter(F.col("genres") != NO_GENRE).select("movieId", "genres")
    return (
        listed.join(_known_age(movies, current_year), "movieId")
        .join(counts, "movieId")
        .select("released_year", F.explode(genre_list("genres")).alias("genre"), "n")
        .groupBy("released_year", "genre")
        .agg(F.sum("n").alias("number_of_ratings"))
    )


def user_genre_profile(ratings: DataFrame, movies: DataFrame, user=None) -> DataFrame:
    """How often each genre occurs among the movies a user rated, for one user or all."""
    if user is not None:
        ratings = ratings.filter(F.col("userId") == user)
    watched = spread_join(ratings.select("userId", "movieId"), movies.select("movieId", "genres"), "movieId")
    # Users come together before their genres are told apart: among rows dealt by movie, nearly every
    # (user, genre) would be a group of its own, several for each rating, in a task's memory.
    together = gathered(watched.select("userId", "genres"), "userId", ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n")))
    return (
        together.select("userId", F.explode(genre_list("genres")).alias("genre"))
        .groupBy("userId", "genre")
        .agg(F.count(F.lit(1)).alias("number_of_movies"))
    )


def full_profile(ratings: DataFrame, movies: DataFrame, current_year: int = 2024) -> dict[str, DataFrame]:
    """All profiling tables by name, none computed until used."""
    return {
        "dataset_sizes": dataset_sizes(ratings, movies),
        "rating_timespan": rating_timespan(ratings),
        "five_number_items": five_number_items(ratings, movies),
        "five_number_users": five_number_users(ratings),
        "five_number_means": five_number_means(ratings),
        "genre_distribution": genre_distribution(movies),
        "genre_count": genre_count(movies),
        "genre_rating": genre_rating(ratings, movies),
        "ratings_vs_age": ratings_vs_age(ratings, movies, current_year),
        "genre_trends": genre_trends(ratings, movies, current_year),
        "user_genre_profile": user_genre_profile(ratings, movies),
    }
