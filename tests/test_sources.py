from pyspark.sql.types import IntegerType

from rankwell.metrics import rating
from rankwell.operators import features
from rankwell.plans import baseline
from rankwell.skew import checkpoint
from rankwell.sources import layout, readers
from tests.conftest import rows_of


def test_csv_folder(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,1112486027\n1,29,4.0,1112484676\n")
    (tmp_path / "movies.csv").write_text('movieId,title,genres\n11,"American President, The (1995)",Comedy|Drama\n')
    ratings, movies = readers.read_csv_dataset(spark, str(tmp_path))
    assert ratings.collect() == [(1, 2, 3.5, 1112486027), (1, 29, 4.0, 1112484676)]
    assert movies.collect() == [(11, "American President, The (1995)", "Comedy|Drama")]
    assert dict(ratings.dtypes) == {"userId": "bigint", "movieId": "bigint", "rating": "double", "timestamp": "bigint"}


def test_dat_folder_keeps_the_first_row(spark, tmp_path):
    (tmp_path / "ratings.dat").write_text("1::1193::5::978300760\n1::661::3::978302109\n")
    (tmp_path / "movies.dat").write_text("1::Toy Story (1995)::Animation|Children's|Comedy\n")
    ratings, movies = readers.read_dat_dataset(spark, str(tmp_path))
    assert ratings.count() == 2
    assert movies.first()["title"] == "Toy Story (1995)"


def test_inferred_schema(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,movieId,rating\n1,2,3.5\n")
    assert readers.read_inferred(spark, str(tmp_path / "r.csv")).schema["userId"].dataType == IntegerType()


def test_written_results_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5)], "k long, v double")
    readers.write_result(df, str(tmp_path / "out"))
    readers.write_result(df, str(tmp_path / "out.json"))
    assert spark.read.parquet(str(tmp_path / "out")).collect() == [(1, 0.5)]
    assert spark.read.json(str(tmp_path / "out.json")).collect() == [(1, 0.5)]


def test_bad_lines_are_told_apart(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,10\nx,2,3.5,10\n1,2\n\n3,4,5.0,6,7\n4,5,,6\n5,6,1.0,7\n")
    (tmp_path / "movies.csv").write_text('movieId,title,genres\n1,"A, ""B"" (1990)",x|y\n2,only\n,none,x\n3,"",x\n')
    ratings, movies = readers.checked_csv_dataset(spark, str(tmp_path))
    assert [tuple(r) for r in ratings.good.collect()] == [(1, 2, 3.5, 10), (5, 6, 1.0, 7)]
    assert ratings.counts.get == {"rows": 6, "good": 2, "rejected": 4}
    assert {r.line: r.reason for r in ratings.rejected.collect()} == {
        "x,2,3.5,10": "no valid userId",
        "1,2": "no valid rating, timestamp",
        "3,4,5.0,6,7": "wrong number of fields",
        "4,5,,6": "no valid rating",
    }
    assert [r.title for r in movies.good.collect()] == ['A, "B" (1990)']
    assert sorted(r.reason for r in movies.rejected.collect()) == ["no valid genres", "no valid movieId", "no valid title"]


def test_few_columns_of_a_checked_file(spark, tmp_path):
    """Lines are judged by all their fields, whichever are asked for."""
    (tmp_path / "r.dat").write_text("1::2::3.5::10\n1::3::bad::10\n2::3::1.0\n")
    found = readers.read_checked(spark, str(tmp_path / "r.dat"), readers.RATINGS_SCHEMA, "::", False)
    assert [r[0] for r in found.good.select("userId").collect()] == [1]
    assert found.rejected.count() == 2


def test_checked_file_without_rows(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n")
    found = readers.read_checked(spark, str(tmp_path / "ratings.csv"), readers.RATINGS_SCHEMA)
    assert found.good.count() == 0 and found.rejected.count() == 0


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_laid_out_tables_need_fewer_exchanges(spark, ratings, movies):
    plain = checkpoint(ratings)
    by_user = layout.lay_out(plain, "userId")
    assert sorted(by_user.collect()) == sorted(plain.collect())
    assert exchanges(features.ratings_per_user(by_user)) == 0 < exchanges(features.ratings_per_user(plain))
    done, before = (features.preprocess_ratings(rows, movies, 2, 2) for rows in (by_user, plain))
    assert exchanges(done) < exchanges(before)
    assert rows_of(done, *before.columns) == rows_of(before)
    train, test = features.modular_split(plain)
    predictions = baseline.predict_by_means(train, test)
    both = [layout.lay_out(rows, ["userId", "movieId"]) for rows in (test, predictions)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        metrics = rating.rating_metrics(*both, check_empty=False)
        assert exchanges(metrics) == 0
        want = rating.rating_metrics(test, predictions, check_empty=False).first()
        assert all(abs(a - b) < 1e-12 for a, b in zip(metrics.first(), want))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
