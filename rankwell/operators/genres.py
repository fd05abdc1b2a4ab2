"""Genre catalogue and the cold-start recommender from stated genre preferences."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.functions.expressions import genre_list
from rankwell.skew import top_rows

# The preferences travel inside the query plan, so their number is checked.
MAX_PREFERENCES = 1000


def genre_catalog(movies: DataFrame) -> DataFrame:
    """Every genre named by any movie."""
    return movies.select(F.explode(genre_list("genres")).alias("genre")).distinct()


def genre_recommend(movies: DataFrame, preferences: Mapping[str, Sequence[str]], n: int = 10) -> DataFrame:
    """The ``n`` movies whose genre counts lie closest (cosine) to each named preference list.

    A genre repeated in a list counts each time. Genres no movie has are left out of the
    preference vector; a list without any known genre gives no rows. Movies are scored in
    place by array expressions, and only n rows per list and task are shuffled.
    """
    wanted = [
        (profile, genre, times)
        for profile, genres in preferences.items()
        for genre, times in Counter(genres).items()
    ]
    if len(wanted) > MAX_PREFERENCES:
        raise ValueError(f"{len(wanted)} preference entries; at most {MAX_PREFERENCES} fit in one call")
    entries = [F.struct(F.lit(p).alias("profile"), F.lit(g).alias("genre"), F.lit(t).alias("times")) for p, g, t in wanted]
    wanted_rows = movies.sparkSession.range(1).select(F.inline(F.array(*entries)))

    # Of the catalogue only the wanted genres are kept, before the distinct.
    names = sorted({genre for _, genre, _ in wanted})
    known = movies.select(F.explode(genre_list("genres")).alias("genre")).filter(F.col("genre").isin(names)).distinct()
    profiles = (
        F.broadcast(wanted_rows)
        .join(known, "genre")
        .groupBy("profile")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("genre", "times"))).alias("weights"),
            F.sqrt(F.sum(F.col("times") * F.col("times"))).alias("length"),
        )
    )
    # At most MAX_PREFERENCES short structs: one value of the plan, not a table to join.
    all_profiles = profiles.agg(F.collect_list(F.struct("profile", "weights", "length"))).scalar()

    words = genre_list("genres")
    word_counts = F.transform(
        F.array_distinct(words),
        lambda word: F.struct(word.alias("genre"), F.size(F.filter(words, lambda x: x == word)).alias("times")),
    )
    shared = F.aggregate(
        "word_counts",
        F.lit(0).cast("long"),
        lambda total, w: total + w["times"] * F.coalesce(F.try_element_at("p.weights", w["genre"]), F.lit(0)),
    )
    length = F.sqrt(
        F.aggregate("word_counts", F.lit(0).cast("long"), lambda total, w: total + w["times"] * w["times"])
    )
    scored = (
        movies.select("movieId", "title", "genres", word_counts.alias("word_counts"))
        .withColumn("p", F.explode(all_profiles))
        .select(
            F.col("p.profile").alias("profile"),
            "movieId",
            "title",
            "genres",
            (shared / (length * F.col("p.length"))).alias("similarity"),
        )
    )
    return top_rows(scored, "profile", [F.desc("similarity"), F.asc("movieId"), F.asc("title")], n)
