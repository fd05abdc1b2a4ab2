import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankwell import skew
from tests.conftest import rows_of


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(spark, skewed, how):
    side = spark.range(1, 40).select(F.col("id").alias("userId"), (F.col("id") * 10).alias("extra")).filter("userId % 3 > 0")
    want = skewed.join(side, "userId", how)
    got = skew.spread_join(skewed, side, "userId", how, slice_rows=5)
    assert rows_of(got, *want.columns) == rows_of(want)


def test_every_hot_key_is_cut(spark, skewed):
    counts = skewed.groupBy("userId").agg(F.count("*").alias("n"))
    assert rows_of(skew.hot_keys(counts, "userId", "n", slice_rows=10)) == [(1, 6)]
    many = spark.range(5000).select(F.col("id").alias("k"), F.lit(30).alias("n"))
    assert rows_of(skew.hot_keys(many, "k", "n", slice_rows=10).agg(F.count("*"), F.min("__slices"))) == [(5000, 3)]
    # Beyond an even share only what stands out is hot, which bounds the table.
    assert skew.hot_keys(many, "k", "n", slice_rows=10, share=4000).count() == 0
    uneven = many.withColumn("n", F.when(F.col("k") < 3, 30_000).otherwise(30))
    assert skew.hot_keys(uneven, "k", "n", slice_rows=10, share=100).count() == 3


def test_spread_join_takes_estimated_counts(spark, skewed):
    guess = spark.createDataFrame([(1, 100), (5, 7)], "userId long, n long")
    side = skewed.groupBy("userId").agg(F.avg("rating").alias("mean"))
    got = skew.spread_join(skewed, side, "userId", counts=guess, slice_rows=2)
    assert rows_of(got, "userId", "movieId", "mean") == rows_of(skewed.join(side, "userId"), "userId", "movieId", "mean")


def test_ranking_equals_a_window(skewed):
    order = [F.desc("rating"), F.asc("movieId")]
    want = skewed.withColumn("rank", F.row_number().over(Window.partitionBy("userId").orderBy(*order)).cast("long"))
    assert rows_of(skew.ranked(skewed, "userId", order), *want.columns) == rows_of(want)


def test_top_rows_beyond_the_group_limit(skewed, monkeypatch):
    order = [F.desc("rating"), F.asc("movieId")]
    pruned = skew.top_rows(skewed, "userId", order, 3)
    monkeypatch.setattr(skew, "GROUP_LIMIT_K", 2)
    whole = skew.top_rows(skewed, "userId", order, 3)
    assert dict(whole.dtypes) == dict(pruned.dtypes)
    assert rows_of(whole, "userId", "movieId", "rank") == rows_of(pruned, "userId", "movieId", "rank")


def test_top_rows_are_pruned_before_the_shuffle(skewed):
    plan = skew.top_rows(skewed, "userId", [F.desc("rating")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(0, 3), min_size=1, max_size=30), slice_rows=st.integers(1, 6))
def test_spread_join_keeps_every_row_once(spark, keys, slice_rows):
    rows = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k long, v long")
    side = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k long, s string")
    got = skew.spread_join(rows, side, "k", slice_rows=slice_rows)
    assert rows_of(got, "k", "v", "s") == rows_of(rows.join(side, "k"), "k", "v", "s")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equal_rows_of_a_hot_key_are_dealt_out(spark, how):
    rows = spark.createDataFrame([(1, "same")] * 50 + [(1, "other")] * 3 + [(2, "b"), (3, "c")], "k long, v string")
    side = spark.createDataFrame([(1, "x"), (2, "y")], "k long, s string")
    want = rows.join(side, "k", how)
    got = skew.spread_join(rows, side, "k", how, slice_rows=5, repeated=True)
    assert rows_of(got, *want.columns) == rows_of(want)
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    dealt = skew._dealt(rows, skew.hot_keys(counts, "k", "n", 5), "k").filter("k = 1")
    sizes = [r[0] for r in dealt.groupBy("__slice").agg(F.sum("__copy")).select("sum(__copy)").collect()]
    assert len(sizes) == 11 and max(sizes) <= 8 and sum(sizes) == 53


def test_first_gaps_by_brute_force(spark):
    taken = {1: [], 2: [1, 2, 3], 3: [2, 4, 9, 40], 4: list(range(1, 60)), 5: [5]}
    owners = spark.createDataFrame([(o, len(t)) for o, t in taken.items()], "o long, n long")
    rows = spark.createDataFrame([(o, p) for o, t in taken.items() for p in t], "o long, p long")
    want = []
    for o, t in taken.items():
        want += [(o, rank, p) for rank, p in enumerate([p for p in range(1, 100) if p not in t][:4], 1)]
    assert rows_of(skew.first_gaps(rows, owners, "o", "p", 4), "o", "rank", "p") == sorted(want)
