"""Per-item and per-user statistics, item age, preprocessing and the train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.columns import DEFAULT_COLS, ITEM_COUNT, ITEM_DEVIATION, ITEM_MEAN, SEED, USER_COUNT, USER_MEAN, Cols
from rankwell.functions.expressions import released_year
from rankwell.skew import spread_join


def ratings_per_item(ratings: DataFrame) -> DataFrame:
    """Count, mean and sample standard deviation of each item's ratings."""
    return ratings.groupBy("movieId").agg(
        F.count("userId").alias(ITEM_COUNT),
        F.avg("rating").alias(ITEM_MEAN),
        F.stddev_samp("rating").alias(ITEM_DEVIATION),
    )


def ratings_per_user(ratings: DataFrame) -> DataFrame:
    """Count and mean of each user's ratings."""
    return ratings.groupBy("userId").agg(
        F.count("userId").alias(USER_COUNT),
        F.avg("rating").alias(USER_MEAN),
    )


def movie_age(movies: DataFrame, current_year: int = 2024, last_number: bool = False) -> DataFrame:
    """Release year from the title and age in years; null where the title names no year."""
    year = released_year("title", last_number)
    return movies.select("movieId", year.alias("released_year")).withColumn(
        "movie_age", F.lit(current_year) - F.col("released_year")
    )


def extract_features(ratings: DataFrame, movies: DataFrame, current_year: int = 2024) -> dict[str, DataFrame]:
    """The three feature tables, none computed until used."""
    return {
        "movie_age": movie_age(movies, current_year),
        "ratings_per_item": ratings_per_item(ratings),
        "ratings_per_user": ratings_per_user(ratings),
    }


def preprocess_ratings(
    ratings: DataFrame,
    movies: DataFrame,
    min_item_ratings: int = 20,
    min_user_ratings: int = 30,
    max_age: int = 100,
    current_year: int = 2024,
    user_means_from: DataFrame | None = None,
) -> DataFrame:
    """Ratings of well-supported users and items of known age, centred on the user mean.

    Support is counted once, on all ratings. ``user_means_from`` takes the user means from
    another table, such as the training part only; by default they come from ``ratings``.
    """
    item_stats, user_stats = ratings_per_item(ratings), ratings_per_user(ratings)
    items = item_stats.filter(F.col("number_of_rating_per_movie") >= min_item_ratings).join(
        movie_age(movies, current_year).filter(F.col("movie_age") <= max_age), "movieId"
    )
    users = user_stats.filter(F.col("number_of_rating_per_user") >= min_user_ratings)
    if user_means_from is not None:
        means = ratings_per_user(user_means_from).select("userId", "average_rating_per_user")
        users = users.drop("average_rating_per_user").join(means, "userId")

    kept = spread_join(ratings, items, "movieId", counts=item_stats, n="number_of_rating_per_movie")
    kept = spread_join(kept, users, "userId", counts=user_stats, n="number_of_rating_per_user")
    return kept.withColumn("rating", F.col("rating") - F.col("average_rating_per_user"))


def hash_split(
    ratings: DataFrame, test_share: float = 0.25, seed: int = SEED, cols: Cols = DEFAULT_COLS
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of user and item: the same rows for any partitioning or rerun."""
    draw = F.pmod(F.xxhash64(cols.user, cols.item, F.lit(seed)), F.lit(1_000_000))
    is_test = draw < int(test_share * 1_000_000)
    return ratings.filter(~is_test), ratings.filter(is_test)


def modular_split(ratings: DataFrame, parts: int = 4, cols: Cols = DEFAULT_COLS) -> tuple[DataFrame, DataFrame]:
    """(train, test) by plain arithmetic on the ids, one in ``parts`` to test.

    (31 user + 17 item) mod parts, reduced before multiplying so large ids cannot overflow.
    """
    user, item = F.pmod(F.col(cols.user), F.lit(parts)), F.pmod(F.col(cols.item), F.lit(parts))
    is_test = F.pmod(user * 31 + item * 17, F.lit(parts)) == 0
    return ratings.filter(~is_test), ratings.filter(is_test)


def random_split(ratings: DataFrame, test_share: float = 0.25, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Spark's own seeded split; the rows drawn depend on the partitioning of ``ratings``."""
    train, test = ratings.randomSplit([1 - test_share, test_share], seed=seed)
    return train, test
