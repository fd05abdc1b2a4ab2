"""Scans of rating and movie files, with explicit schemas."""

from __future__ import annotations

import os
import uuid

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# The fields of the two file formats.
RATINGS_SCHEMA = StructType(
    [
        StructField("userId", LongType(), False),
        StructField("movieId", LongType(), False),
        StructField("rating", DoubleType(), False),
        StructField("timestamp", LongType(), False),
    ]
)

MOVIES_SCHEMA = StructType(
    [
        StructField("movieId", LongType(), False),
        StructField("title", StringType(), False),
        StructField("genres", StringType(), False),
    ]
)


def read_delimited(
    spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = True
) -> DataFrame:
    """A delimited file under an explicit schema; no inference pass over the data."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


# Holds the whole line where it cannot be read.
_LINE = "__line"


@dataclass
class Checked:
    """What a file holds: the rows that fit its schema, and the lines that do not.

    ``counts`` tells rows, good and rejected after any action that has read all of ``good`` or
    ``rejected``: they are counted in that pass.
    """

    good: DataFrame
    rejected: DataFrame
    counts: Observation


def read_checked(
    spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = True, quoted: bool = True
) -> Checked:
    """A delimited file whose bad lines are told apart instead of becoming nulls.

    ``rejected`` has the line and the reason: the fields that are missing or of another kind, or
    else another number of fields than the schema's. Every field is required; an empty one is missing. Empty lines are
    skipped, as is each file's first line with ``header``. A quoted field may hold separators, and
    quotes twice; with ``quoted`` false quotes are characters like others. A line that could be read but lacks a
    field is given as its fields, without their quotes.
    """
    names = schema.fieldNames()
    loose = StructType([StructField(f.name, f.dataType, True) for f in schema] + [StructField(_LINE, StringType(), True)])
    options = {"sep": sep, "header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "enforceSchema": True, "quote": '"' if quoted else "", "escape": '"'}
    missing = F.concat_ws(", ", *[F.when(F.col(n).isNull(), F.lit(n)) for n in names])
    reason = F.when(missing != "", F.concat(F.lit("no valid "), missing)).when(F.col(_LINE).isNotNull(), "wrong number of fields")
    counts = Observation(f"lines-{uuid.uuid4().hex}")
    read = spark.read.schema(loose).options(**options).csv(path).withColumn("reason", reason)
    read = read.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("reason").isNull()).alias("good"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )
    line = F.coalesce(_LINE, F.concat_ws(sep, *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]))
    return Checked(
        read.filter("reason is null").select(*names), read.filter("reason is not null").select(line.alias("line"), "reason"), counts
    )


def read_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A headed delimited file whose types Spark finds in one extra pass over it."""
    return spark.read.option("sep", sep).option("header", True).csv(path, inferSchema=True)


def read_ratings(spark: SparkSession, path: str, sep: str = ",", header: bool = True) -> DataFrame:
    return read_delimited(spark, path, RATINGS_SCHEMA, sep, header)


def read_movies(spark: SparkSession, path: str, sep: str = ",", header: bool = True) -> DataFrame:
    return read_delimited(spark, path, MOVIES_SCHEMA, sep, header)


def read_csv_dataset(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(ratings, movies) of a folder with ratings.csv and movies.csv (the 20M and small sets)."""
    return (
        read_ratings(spark, os.path.join(folder, "ratings.csv")),
        read_movies(spark, os.path.join(folder, "movies.csv")),
    )


def read_dat_dataset(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(ratings, movies) of a folder with headerless ``::``-separated .dat files (the 1M set)."""
    return (
        read_ratings(spark, os.path.join(folder, "ratings.dat"), sep="::", header=False),
        read_movies(spark, os.path.join(folder, "movies.dat"), sep="::", header=False),
    )


def checked_csv_dataset(spark: SparkSession, folder: str) -> tuple[Checked, Checked]:
    """(ratings, movies) of ``read_csv_dataset``, with the lines that do not fit."""
    return (
        read_checked(spark, os.path.join(folder, "ratings.csv"), RATINGS_SCHEMA),
        read_checked(spark, os.path.join(folder, "movies.csv"), MOVIES_SCHEMA),
    )


def checked_dat_dataset(spark: SparkSession, folder: str) -> tuple[Checked, Checked]:
    """(ratings, movies) of ``read_dat_dataset``, with the lines that do not fit."""
    return (
        read_checked(spark, os.path.join(folder, "ratings.dat"), RATINGS_SCHEMA, "::", False, False),
        read_checked(spark, os.path.join(folder, "movies.dat"), MOVIES_SCHEMA, "::", False, False),
    )


def write_result(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Keep a result as parquet, or as JSON lines when the path ends in .json."""
    writer = df.write.mode(mode)
    if path.endswith(".json"):
        writer.json(path)
    else:
        writer.parquet(path)
