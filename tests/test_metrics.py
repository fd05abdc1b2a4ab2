import math

import pytest
from pyspark.mllib.evaluation import RankingMetrics, RegressionMetrics
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankwell.columns import Cols
from rankwell.metrics import ranking, rating
from rankwell.operators import features
from rankwell.plans import baseline, report
from tests.conftest import rows_of

TRIPLE = "userId long, movieId long, rating double"
SCORED = "userId long, movieId long, prediction double"


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_rating_metrics_by_hand(spark):
    truth = table(spark, [(1, 1, 2.0), (1, 2, 2.5), (1, 3, 5.0), (9, 9, 1.0)], TRIPLE)
    guess = table(spark, [(1, 1, 1.0), (1, 2, 2.0), (1, 3, 3.0)], SCORED)
    got = rating.rating_metrics(truth, guess).first()
    assert round(got["rmse"], 6) == 1.322876
    assert round(got["mae"], 6) == 1.166667
    assert round(got["rsquared"], 6) == -0.016129


def test_rating_metrics_equal_mllib(ratings):
    train, test = features.modular_split(ratings)
    guess = baseline.predict_by_means(train, test)
    got = rating.rating_metrics(test, guess).first()
    want = RegressionMetrics(guess.select("prediction", "rating").rdd.map(tuple))
    assert math.isclose(got["rmse"], want.rootMeanSquaredError, rel_tol=1e-9)
    assert math.isclose(got["mae"], want.meanAbsoluteError, rel_tol=1e-9)
    assert math.isclose(got["rsquared"], want.r2, rel_tol=1e-9)


def test_explained_variance_without_spread(spark):
    truth = table(spark, [(1, 1, 2.0), (1, 2, 2.0)], TRIPLE)
    varied = table(spark, [(1, 1, 1.0), (1, 2, 2.0)], SCORED)
    constant = table(spark, [(1, 1, 1.0), (1, 2, 1.0)], SCORED)
    single = table(spark, [(1, 1, 1.0)], SCORED)
    assert rating.rating_metrics(truth, varied).first()["exp_var"] == -math.inf
    assert rating.rating_metrics(truth, constant).first()["exp_var"] is None
    assert rating.rating_metrics(truth, single).first()["exp_var"] == -math.inf


def test_input_checks(spark):
    truth = table(spark, [(1, 1, 2.0)], TRIPLE)
    guess = table(spark, [(1, 1, 2.0)], SCORED)
    with pytest.raises(ValueError, match="Empty"):
        rating.rating_metrics(truth.limit(0), guess)
    with pytest.raises(ValueError, match="Empty"):
        rating.rating_metrics(truth, guess.limit(0))
    for metric in (rating.rating_metrics, ranking.ranking_metrics):
        with pytest.raises(ValueError, match="truth"):
            metric(truth.drop("rating"), guess)
        with pytest.raises(ValueError, match="predictions"):
            metric(truth, guess.drop("prediction"))
    with pytest.raises(ValueError, match="unheard"):
        ranking.ranking_metrics(truth, guess, method="unheard")
    with pytest.raises(ValueError, match="threshold"):
        ranking.ranking_metrics(truth, guess, method="by_threshold")
    with pytest.raises(ValueError, match="timestamp"):
        ranking.ranking_metrics(truth, guess, method="by_time_stamp")


def test_ranking_metrics_by_hand(spark):
    # Lists [1,2,3] / truth {1,3,9,10} and [5,6] / {7}; users 3 and 4 miss one side. The
    # worked example has a third user who scores 0, hence two thirds of our means.
    guess = table(
        spark, [(1, 1, 0.9), (1, 2, 0.8), (1, 3, 0.7), (2, 5, 0.9), (2, 6, 0.8), (3, 8, 0.5)], SCORED
    )
    truth = table(spark, [(1, i, 1.0) for i in (1, 3, 9, 10, 10)] + [(2, 7, 1.0), (4, 1, 1.0)], TRIPLE)
    two = ranking.ranking_metrics(truth, guess, k=2).first()
    ten = ranking.ranking_metrics(truth, guess, k=10).first()
    worked = [
        (two["precision_at_k"], 0.166667),
        (two["recall_at_k"], 0.083333),
        (two["ndcg_at_k"], 0.204382),
        (ten["ndcg_at_k"], 0.195190),
        (ten["map"], 0.138889),
        (two["map_at_k"], 0.166667),
    ]
    for got, want in worked:
        assert math.isclose(got * 2 / 3, want, abs_tol=1e-6)


@pytest.mark.parametrize("method", ["top_k", "by_threshold"])
def test_ranking_metrics_equal_mllib(ratings, method):
    train, test = features.modular_split(ratings)
    candidates = baseline.unseen_candidates(train).drop("prediction")
    guess = baseline.predict_by_means(train, candidates).persist()
    lists = ranking.relevant_items(guess, method, 5, 2.5)
    pairs = ranking.as_lists(lists).join(test.groupBy("userId").agg(F.collect_list("movieId").alias("truth")), "userId")
    want = RankingMetrics(pairs.select("prediction", "truth").rdd.map(lambda r: (r[0], r[1])))
    got = ranking.ranking_metrics(test, guess, 5, method, 2.5).first()
    assert got["precision_at_k"] > 0
    assert math.isclose(got["precision_at_k"], want.precisionAt(5), rel_tol=1e-9)
    assert math.isclose(got["recall_at_k"], want.recallAt(5), rel_tol=1e-9)
    assert math.isclose(got["ndcg_at_k"], want.ndcgAt(5), rel_tol=1e-9)
    assert math.isclose(got["map"], want.meanAveragePrecision, rel_tol=1e-9)
    assert math.isclose(got["map_at_k"], want.meanAveragePrecisionAt(5), rel_tol=1e-9)


def test_ties_go_by_item(spark):
    guess = table(spark, [(1, i, 1.0) for i in (5, 3, 9, 1)], SCORED)
    assert rows_of(ranking.relevant_top_k(guess, 2)) == [(1, 1, 1), (1, 3, 2)]
    assert rows_of(ranking.relevant_by_threshold(guess, 1.0)) == [(1, 1, 1), (1, 3, 2), (1, 5, 3), (1, 9, 4)]
    assert ranking.relevant_by_threshold(guess, 10).count() == 0


def test_threshold_lists_of_hot_users(skewed):
    guess = skewed.withColumnRenamed("rating", "prediction")
    window = Window.partitionBy("userId").orderBy(F.desc("prediction"), "movieId")
    plain = guess.filter("prediction >= 2").select("userId", "movieId", F.row_number().over(window).alias("rank"))
    assert rows_of(ranking.relevant_by_threshold(guess, 2.0)) == rows_of(plain)


def test_other_column_names(spark):
    cols = Cols(user="u", item="i", rating="stars", prediction="score")
    truth = spark.createDataFrame([(1, 1, 2.0), (1, 2, 4.0)], "u long, i long, stars double")
    guess = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "u long, i long, score double")
    assert rating.rating_metrics(truth, guess, cols).first()["mae"] == 0.5
    assert ranking.ranking_metrics(truth, guess, 2, cols=cols).first()["precision_at_k"] == 1.0


def test_report_as_json(spark, ratings):
    train, test = features.modular_split(ratings)
    made = report.evaluation_report(train, test, baseline.predict_by_means(train, test), baseline.recommend_popular(train))
    scores = report.report_json(made).first()["scores"]
    assert '"rmse":' in scores and '"distributional_coverage":' in scores
    row = made.first()
    assert 0 < row["catalog_coverage"] <= 1 and 0 <= row["precision_at_k"] <= 1


def test_popular_unseen_items_over_the_whole_catalogue(spark):
    """Users who rated much of the head of the ranking, or all of it, against brute force."""
    rows = [(u, i, 3.0) for u in range(1, 40) for i in range(1, 81) if (u * i) % 7 < 2 + u % 3]
    rows += [(100, i, 1.0) for i in range(1, 81)] + [(101, i, 1.0) for i in range(1, 76)] + [(102, 80, 1.0)]
    train = spark.createDataFrame(rows, TRIPLE)
    counts = {}
    for _, i, _ in rows:
        counts[i] = counts.get(i, 0) + 1
    order = sorted(counts, key=lambda i: (-counts[i], i))
    want = []
    for u in {u for u, _, _ in rows}:
        seen = {i for v, i, _ in rows if v == u}
        want += [(u, i, float(counts[i]), n) for n, i in enumerate([i for i in order if i not in seen][:10], 1)]
    got = baseline.recommend_popular(train, 10)
    assert rows_of(got, "userId", "movieId", "prediction", "rank") == sorted(want)
    assert got.filter("userId = 100").count() == 0 and got.filter("userId = 101").count() == 5


def test_report_refuses_rated_recommendations(ratings):
    train, test = features.modular_split(ratings)
    with pytest.raises(ValueError, match="already present"):
        report.evaluation_report(train, test, baseline.predict_by_means(train, test), train.withColumn("rank", F.lit(1)))


def test_report_checks_within_its_own_jobs(spark, ratings, monkeypatch):
    """No job runs for the checks alone: they raise from what the metrics' own jobs count."""
    train, test = (part.persist() for part in features.modular_split(ratings))
    predictions, recos = baseline.predict_by_means(train, test).persist(), baseline.recommend_popular(train).persist()

    def refused(*_):
        raise AssertionError("a job of its own")

    context = spark.sparkContext

    def jobs(group, checked):
        context.setJobGroup(group, group)
        with monkeypatch.context() as m:
            for name in ("isEmpty", "count"):
                m.setattr(type(ratings), name, refused)
            if not checked:
                m.setattr(type(ratings), "observe", lambda self, *_: self)
                m.setattr(report, "Observation", lambda name: type("None_", (), {"get": {"rows": 1, "overlap": 0}})())
            report.evaluation_report(train, test, predictions, recos).collect()
        return len(context.statusTracker().getJobIdsForGroup(group))

    jobs("warm", False)
    assert jobs("checked", True) == jobs("unchecked", False)
    for empty in ("truth", "predictions", "recommendations"):
        parts = {"truth": test, "predictions": predictions, "recommendations": recos}
        parts[empty] = parts[empty].limit(0)
        with pytest.raises(ValueError, match=f"Empty input dataframe: {empty}"):
            report.evaluation_report(train, *parts.values())
