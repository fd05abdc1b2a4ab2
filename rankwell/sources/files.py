"""The rating and movie tables written as the delimited files users have, bad lines among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.skew import scratch_folder
from rankwell.sources.tables import movies_view, ratings_view, table


def _bad_lines(spark: SparkSession, folder: str, sep: str) -> tuple[DataFrame, DataFrame]:
    """(rating lines, movie lines) that no reader should take, one of each kind per nation and region."""
    key = F.col("n_nationkey").cast("string")
    lines = [
        F.concat_ws(sep, F.concat(F.lit("u"), key), F.lit("1"), F.lit("3.5"), F.lit("100")),
        F.concat_ws(sep, key, F.lit("2"), F.lit("four"), F.lit("later")),
        F.concat_ws(sep, key, F.lit("3"), F.lit("3.5")),
        F.concat_ws(sep, key, F.lit("4"), F.lit("3.5"), F.lit("100"), F.lit("more")),
        F.concat_ws(sep, key, F.lit("5"), F.lit(""), F.lit("100")),
    ]
    ratings = table(spark, folder, "nation").select(F.explode(F.array(*lines)).alias("line"))
    key = F.col("r_regionkey").cast("string")
    lines = [F.concat_ws(sep, F.col("r_name"), F.lit("A Title (1999)"), F.lit("Drama")), F.concat_ws(sep, key, F.lit("No Genre (1999)"))]
    return ratings, table(spark, folder, "region").select(F.explode(F.array(*lines)).alias("line"))


def listed_movies(spark: SparkSession, folder: str) -> DataFrame:
    """Movies with the separators and quotes of real titles in theirs."""
    title = F.concat(F.replace("title", F.lit(" ("), F.lit(', The "Best" (')))
    return movies_view(spark, folder).select("movieId", title.alias("title"), "genres")


def write_csv_dataset(spark: SparkSession, folder: str) -> str:
    """A folder with ratings.csv and movies.csv, each in parts with a header line; fields are quoted where needed."""
    to = scratch_folder(spark, "csv")
    bad_ratings, bad_movies = _bad_lines(spark, folder, ",")
    for name, rows, bad in (("ratings", ratings_view(spark, folder), bad_ratings), ("movies", listed_movies(spark, folder), bad_movies)):
        path = f"{to}/{name}.csv"
        rows.write.option("header", True).option("escape", '"').csv(path)
        # The bad lines are parts of their own: as they stand, below a header.
        bad.coalesce(1).withColumnRenamed("line", ",".join(rows.columns)).write.mode("append").options(
            header=True, quote="\u0000", sep="\u0001"
        ).csv(path)
    return to


def write_dat_dataset(spark: SparkSession, folder: str) -> str:
    """A folder with ratings.dat and movies.dat, headerless, fields apart by two colons."""
    to = scratch_folder(spark, "dat")
    bad_ratings, bad_movies = _bad_lines(spark, folder, "::")
    for name, rows, bad in (("ratings", ratings_view(spark, folder), bad_ratings), ("movies", movies_view(spark, folder), bad_movies)):
        line = F.concat_ws("::", *[F.col(c).cast("string") for c in rows.columns]).alias("line")
        rows.select(line).union(bad).write.text(f"{to}/{name}.dat")
    return to
