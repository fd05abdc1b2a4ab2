"""Distinct and common ids counted by bitmaps, which can be stored and merged.

Ids are cut into buckets of 32,768; a bitmap of 4 KB tells which ids of a bucket occur. Bitmaps of
days, or of parts of a table, are merged by or-ing, so counts over many days need no rows again.
Worth it where ids lie close together; a bucket with a single id takes 4 KB too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.columns import DEFAULT_COLS, Cols


def id_bitmaps(rows: DataFrame, id_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, bucket, bits): the ids that occur with each key; null ids are left out. Folded in the map tasks."""
    held = rows.filter(F.col(id_col).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(id_col)).alias("bucket")
    return held.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id_col))).alias("bits"))


def merged(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One bitmap per (keys, bucket) of the union of all; further columns go."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(bitmaps: DataFrame, name: str = "n") -> DataFrame:
    """One row: how many (key, id) pairs merged bitmaps hold."""
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(name))


def common_count(a: DataFrame, b: DataFrame, keys: Sequence[str] = (), name: str = "n") -> DataFrame:
    """One row: how many (key, id) pairs two sets of merged bitmaps share.

    Per bucket the ids of both are those of a and of b less those of either.
    """
    both = a.select(*keys, "bucket", "bits").unionByName(b.select(*keys, "bucket", "bits"))
    sizes = both.groupBy(*keys, "bucket").agg(F.sum(F.bitmap_count("bits")).alias("each"), F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"))
    return sizes.agg(F.coalesce(F.sum(F.col("each") - F.col("either")), F.lit(0)).cast("long").alias(name))


def id_words(rows: DataFrame, id_col: str, keys: Sequence[str], name: str) -> DataFrame:
    """(keys, word, name): bitmaps of 64 ids in a long, for ids that lie far apart; null ids are left out."""
    number = F.col(id_col).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int")).alias(name)
    return rows.filter(F.col(id_col).isNotNull()).select(*keys, F.shiftright(number, 6).alias("word"), bit)


def seen_overlap(train: DataFrame, recos: DataFrame, cols: Cols = DEFAULT_COLS) -> DataFrame:
    """One row (overlap): distinct recommended pairs that occur in ``train``, by the users of each item.

    An item's users are few in a bucket of 32,768, so words of 64 users are or-ed, which takes no more
    room than the pairs do.
    """
    none = F.lit(0).cast("long")
    seen = id_words(train, cols.user, [cols.item], "train").withColumn("reco", none)
    both = seen.unionByName(id_words(recos, cols.user, [cols.item], "reco").withColumn("train", none))
    words = both.groupBy(cols.item, "word").agg(F.bit_or("train").alias("train"), F.bit_or("reco").alias("reco"))
    common = F.bit_count(F.col("train").bitwiseAND(F.col("reco")))
    return words.agg(F.coalesce(F.sum(common), F.lit(0)).cast("long").alias("overlap"))


def catalog_coverage(train_bitmaps: DataFrame, reco_bitmaps: DataFrame) -> DataFrame:
    """One row: distinct recommended items over distinct training items, from item bitmaps of any parts."""
    reco = merged(reco_bitmaps).select(F.bitmap_count("bits").alias("reco"), F.lit(0).cast("long").alias("train"))
    train = merged(train_bitmaps).select(F.lit(0).cast("long").alias("reco"), F.bitmap_count("bits").alias("train"))
    return reco.unionByName(train).agg((F.sum("reco") / F.sum("train")).alias("catalog_coverage"))
