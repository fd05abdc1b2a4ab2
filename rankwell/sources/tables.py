"""Ratings and movies read from the order and part tables of a parquet folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def ratings_view(spark: SparkSession, folder: str) -> DataFrame:
    """One rating per (customer, part): half stars from the quantity, newest order as time."""
    # o_orderdate has no zone, so its distance to a zoneless epoch does not depend on the session.
    epoch_seconds = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("o_orderdate"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", epoch_seconds.alias("seconds"))
    stars = (F.pmod(F.col("l_quantity").cast("int"), F.lit(10)) + 1) / F.lit(2.0)
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", stars.alias("stars"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"))
        .agg(F.max("stars").alias("rating"), F.max("seconds").alias("timestamp"))
    )


def movies_view(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as movies: the name with a year as title, type and name words as genres."""
    part = table(spark, folder, "part")
    year = (F.lit(1920) + F.col("p_partkey") % 100).cast("string")
    return part.select(
        F.col("p_partkey").alias("movieId"),
        F.concat("p_name", F.lit(" ("), year, F.lit(")")).alias("title"),
        F.concat_ws("|", "p_type", F.replace("p_name", F.lit(" "), F.lit("|"))).alias("genres"),
    )


def item_features(spark: SparkSession, folder: str) -> DataFrame:
    """Embedding vectors as item features."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("movieId"), F.col("embedding").alias("features")
    )
