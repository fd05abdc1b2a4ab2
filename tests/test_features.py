import math

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from rankwell import skew
from rankwell.functions.expressions import genre_list
from rankwell.operators import features, genres, popularity
from rankwell.plans import profile
from tests.conftest import rows_of


def test_title_years(spark):
    titles = ["No year", "(500) Days of Summer (2009)", "Toy Story (1995)", "Big (99999999999)", "X (1963-67)"]
    movies = spark.createDataFrame(list(enumerate(titles)), "movieId long, title string")
    ages = features.movie_age(movies).orderBy("movieId").collect()
    assert [tuple(r) for r in ages] == [(0, None, None), (1, 500, 1524), (2, 1995, 29), (3, None, None), (4, None, None)]
    last = features.movie_age(movies, last_number=True).filter("movieId = 1").first()
    assert last["released_year"] == 2009


def test_single_rating_has_no_deviation(spark):
    ratings = spark.createDataFrame(
        [(1, 10, 4.0, 1), (1, 20, 2.0, 2), (2, 20, 5.0, 3)], "userId long, movieId long, rating double, timestamp long"
    )
    movies = spark.createDataFrame(
        [(10, "A (2000)", "Drama"), (20, "B (2001)", "Drama|War"), (20, "B (2001)", "Drama|War"), (30, "C", "War")],
        "movieId long, title string, genres string",
    )
    stats = {r["movieId"]: r for r in features.ratings_per_item(ratings).collect()}
    assert stats[10]["standard_deviation_rating_per_movie"] is None
    assert [r["movieId"] for r in popularity.popular_by_stddev(ratings, movies).collect()] == [20]
    assert [tuple(r) for r in popularity.popular_by_count(ratings, movies).collect()] == [
        (20, "B (2001)", "Drama|War", 2),
        (10, "A (2000)", "Drama", 1),
    ]
    assert [r["movieId"] for r in popularity.popular_by_mean(ratings, movies, n=1).collect()] == [10]
    assert [r["movieId"] for r in popularity.popular_by_count(ratings, movies, min_count=2).collect()] == [20]


def test_split_is_repeatable_and_complete(ratings):
    for split in (features.hash_split, features.modular_split, features.random_split):
        train, test = split(ratings)
        assert train.count() + test.count() == ratings.count()
        assert 0.15 < test.count() / ratings.count() < 0.35
    first = rows_of(features.hash_split(ratings)[1], "userId", "movieId")
    assert rows_of(features.hash_split(ratings.repartition(13))[1], "userId", "movieId") == first


def test_modular_split_of_large_ids(spark):
    big = spark.createDataFrame([(2**62, 2**62, 1.0)], "userId long, movieId long, rating double")
    train, test = features.modular_split(big)
    assert train.count() + test.count() == 1


def test_preprocess_with_training_means(ratings, movies):
    train, _ = features.modular_split(ratings)
    got = features.preprocess_ratings(ratings, movies, 5, 5, user_means_from=train)
    means = train.groupBy("userId").agg(F.avg("rating").alias("m"))
    joined = got.join(means, "userId")
    assert joined.count() == got.count() > 0
    assert joined.filter(F.abs(F.col("average_rating_per_user") - F.col("m")) > 1e-9).count() == 0


def test_quantiles_equal_approx_quantile(spark, ratings, movies):
    for rows in (ratings, ratings.filter("userId < 11"), ratings.filter("userId < 10"), ratings.filter("userId < 4")):
        counts = features.ratings_per_user(rows)
        want = counts.approxQuantile("number_of_rating_per_user", [0.0, 0.25, 0.5, 0.75, 1.0], 0)
        got = profile.five_number_users(rows).first()
        assert [got[n] for n in ("min", "q1", "median", "q3", "max")] == want
    ten = spark.range(1, 11).select(F.col("id").alias("n"))
    assert profile.five_number_summary(ten, "n").first()[:5] == (1, 3, 5, 8, 10)


def test_profile_of_unlisted_genres(spark):
    movies = spark.createDataFrame(
        [(1, "A (2000)", "Drama|War"), (2, "B (1990)", "(no genres listed)"), (3, "C (1)", "War")],
        "movieId long, title string, genres string",
    )
    ratings = spark.createDataFrame(
        [(1, 1, 4.0, 1), (2, 1, 2.0, 86401), (2, 2, 2.0, 5), (2, 3, 1.0, 9)],
        "userId long, movieId long, rating double, timestamp long",
    )
    tables = profile.full_profile(ratings, movies)
    assert tables["genre_count"].first()[0] == 2
    assert rows_of(tables["genre_trends"]) == [(2000, "Drama", 2), (2000, "War", 2)]
    assert tables["rating_timespan"].first()["timespan_in_days"] == 1.0
    assert rows_of(tables["dataset_sizes"]) == [(4, 2, 3, 3)]
    assert rows_of(profile.user_genre_profile(ratings, movies, user=1)) == [(1, "Drama", 1), (1, "War", 1)]
    assert set(features.extract_features(ratings, movies)) == {"movie_age", "ratings_per_item", "ratings_per_user"}


def test_genre_cosine_equals_count_vectors(spark, movies):
    listed = movies.withColumn("genres", genre_list("genres"))
    model = CountVectorizer(inputCol="genres", outputCol="v").fit(listed)
    wanted = ["ECONOMY", "red", "red", "bolt", "Unheard-Of"]
    mine = model.transform(spark.createDataFrame([(wanted,)], ["genres"])).first()["v"]
    want = {
        r["movieId"]: float(r["v"].dot(mine) / (r["v"].norm(2) * mine.norm(2))) for r in model.transform(listed).collect()
    }
    got = genres.genre_recommend(movies, {"me": wanted}, n=500).collect()
    assert len(got) == len(want)
    assert max(abs(r["similarity"] - want[r["movieId"]]) for r in got) < 1e-12
    ranks = [(r["similarity"], -r["movieId"]) for r in sorted(got, key=lambda r: r["rank"])]
    assert ranks == sorted(ranks, reverse=True)


def test_genre_preferences_are_bounded(movies):
    with pytest.raises(ValueError):
        genres.genre_recommend(movies, {"me": [f"g{i}" for i in range(genres.MAX_PREFERENCES + 1)]})
    assert genres.genre_recommend(movies, {"me": ["Unheard-Of"]}).count() == 0


@pytest.mark.parametrize("accuracy", [20, 1000])
def test_exact_quantiles_of_any_column(spark, accuracy):
    """Values that all differ, values that are mostly one, a single one, and none."""
    columns = {
        "distinct": [((i * 7919) % 10_007) / 3 for i in range(5000)],
        "crowded": [5.0] * 3000 + [float(i % 11) for i in range(700)],
        "single": [2.5],
    }
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    for values in columns.values():
        rows = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(3)
        got = profile.exact_quantiles(rows, "x", shares, accuracy).first()
        ordered = sorted(values)
        assert [got[n] for n in shares] == [ordered[max(1, math.ceil(s * len(ordered))) - 1] for s in shares.values()]
    none = spark.createDataFrame([(None,)], "x double")
    assert profile.exact_quantiles(none, "x", shares).first() == (None,) * 5


def test_user_genre_profile_gathers_users_first(spark, monkeypatch):
    """Rows meet by user before genres are told apart; a user with most ratings lies in several slices."""
    listed = {i: [f"g{i % k}" for k in (2, 3, 5)] for i in range(40)}
    movies = spark.createDataFrame([(i, f"M{i} (2000)", "|".join(g)) for i, g in listed.items()], "movieId long, title string, genres string")
    rows = [(1, i) for i in range(40)] + [(u, (u * 7 + j) % 45) for u in range(2, 12) for j in range(3)] + [(None, 1), (None, 2)]
    ratings = spark.createDataFrame(rows, "userId long, movieId long")
    want = {}
    for user, movie in rows:
        for genre in listed.get(movie, []):
            want[user, genre] = want.get((user, genre), 0) + 1
    for slice_rows in (1_000_000, 5):
        with monkeypatch.context() as patch:
            patch.setattr(profile, "gathered", lambda rows, key, counts: skew.gathered(rows, key, counts, slice_rows=slice_rows))
            found = profile.user_genre_profile(ratings, movies)
        plan = found._jdf.queryExecution().analyzed().toString()
        assert plan.index("Generate explode") < plan.index("RebalancePartitions")
        assert {(r.userId, r.genre): r.number_of_movies for r in found.collect()} == want
    assert skew.gathered(ratings, "userId", ratings.groupBy("userId").agg(F.count("*").alias("n")), slice_rows=5).count() == len(rows)
