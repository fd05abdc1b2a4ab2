"""Joins and rankings that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more rows than this is cut into slices of about this size, or of one HOT_SHARE-th of
# all rows where that is more. So fewer than HOT_SHARE keys are ever hot, and none that is left
# whole holds more than the even share of a partition among HOT_SHARE.
SLICE_ROWS = 1_000_000
HOT_SHARE = 100_000

# Spark prunes row_number() <= k before the shuffle only up to this k
# (default of spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT_K = 1000

_SLICES, _SLICE, _COPY = "__slices", "__slice", "__copy"


def hot_keys(counts: DataFrame, key: str, n: str, slice_rows: int = SLICE_ROWS, share: int = HOT_SHARE) -> DataFrame:
    """The hot keys of a (key, n) count table, with the slices to cut each into.

    Fewer than ``share`` keys can hold more than one ``share``-th of all rows each, so the
    result is small enough to broadcast however long ``counts`` is.
    """
    most = F.greatest(F.lit(float(slice_rows)), counts.agg(F.sum(n) / share).scalar())
    return counts.filter(F.col(n) > most).select(key, F.ceil(F.col(n) / most).cast("int").alias(_SLICES))


def spread_join(
    rows: DataFrame,
    side: DataFrame,
    on: str | list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    n: str = "n",
    slice_rows: int = SLICE_ROWS,
    repeated: bool = False,
) -> DataFrame:
    """``rows`` joined to ``side`` on ``on``, each hot key of ``rows`` cut into slices.

    The slice is a hash of the whole row, so a retried task cuts the same way. ``side`` is
    copied once per slice of its hot keys. With several columns the last one tells hot keys.

    Rows that are equal in all columns have one hash. Where a hot key may hold many of those,
    ``repeated`` counts them first and deals the copies out over the slices, at the price of reading
    ``rows`` twice.

    Slices only balance the work, so ``counts`` (last column of ``on``, n) may be any estimate
    of the rows per key, such as the counts of a related table; without it ``rows`` are
    counted. ``how`` may be inner, left, left_semi or left_anti. The greatest count is fetched at
    once (one small job); a table without hot keys gets the plain join.
    """
    on = [on] if isinstance(on, str) else on
    key = on[-1]
    if counts is None:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    # Where no key is hot, slices would only add joins to a plan that adaptive execution balances.
    largest, total = counts.agg(F.max(n), F.sum(n)).first()
    if (largest or 0) <= max(slice_rows, (total or 0) / HOT_SHARE):
        return rows.join(side, on, how)
    hot = F.broadcast(hot_keys(counts, key, n, slice_rows))
    slices = F.coalesce(F.col(_SLICES), F.lit(1))
    place = F.pmod(F.xxhash64(*rows.columns), slices).cast("int")
    if repeated:
        cut = _dealt(rows, hot, key)
    else:
        cut = rows.join(hot, key, "left").withColumn(_SLICE, place).drop(_SLICES)
    copied = (
        side.join(hot, key, "left")
        .withColumn(_SLICE, F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop(_SLICES)
    )
    joined = cut.join(copied, [*on, _SLICE], how).drop(_SLICE)
    if repeated:
        joined = joined.withColumn(_COPY, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_COPY)))).drop(_COPY)
    return joined


def _dealt(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``rows`` with slice and copies: equal rows of a hot key as one row per slice they are dealt to."""
    one = F.lit(1).cast("long")
    cold = rows.join(hot, key, "left_anti").select(*rows.columns, F.lit(0).alias(_SLICE), one.alias(_COPY))
    counted = rows.join(hot, key).groupBy(*rows.columns, _SLICES).agg(F.count(F.lit(1)).alias(_COPY))
    parts = F.least(F.col(_COPY), F.col(_SLICES).cast("long"))
    spread = counted.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    share = F.floor(F.col(_COPY) / parts) + F.when(F.col("__part") < F.col(_COPY) % parts, 1).otherwise(0)
    place = F.pmod(F.xxhash64(*rows.columns) + F.col("__part"), F.col(_SLICES)).cast("int")
    return cold.unionByName(spread.select(*rows.columns, place.alias(_SLICE), share.cast("long").alias(_COPY)))


def gathered(rows: DataFrame, key: str, counts: DataFrame, n: str = "n", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``rows`` dealt anew so that those of a key lie in one task, those of a hot key in slices.

    For groupings by ``key`` whose rows are many where they are, and few per key once they meet.
    ``counts`` (key, n) may be any estimate, as in ``spread_join``; the greatest is fetched at once.
    """
    largest, total = counts.agg(F.max(n), F.sum(n)).first()
    if (largest or 0) <= max(slice_rows, (total or 0) / HOT_SHARE):
        return rows.hint("rebalance", F.col(key))
    hot = F.broadcast(hot_keys(counts, key, n, slice_rows))
    place = F.pmod(F.xxhash64(*rows.columns), F.coalesce(F.col(_SLICES), F.lit(1))).cast("int")
    cut = rows.join(hot, key, "left").select(*rows.columns, place.alias(_SLICE))
    return cut.hint("rebalance", F.col(key), F.col(_SLICE)).drop(_SLICE)


def top_rows(df: DataFrame, group: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their 1-based rank (long).

    Up to ``GROUP_LIMIT_K`` Spark cuts each map task's share of a group to k rows before the
    shuffle, so a hot group never reaches one task whole; a larger k takes the ranking that
    does not need one task per group.
    """
    if k > GROUP_LIMIT_K:
        return ranked(df, group, order, rank).filter(F.col(rank) <= k)
    # The limit is seen through a filter on the row number itself, so the cast comes last.
    window = Window.partitionBy(group).orderBy(*order)
    best = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
    return best.withColumn(rank, F.col(rank).cast("long"))


def ranked(df: DataFrame, group: str, order: list[Column], rank: str = "rank") -> DataFrame:
    """Every row with its 1-based rank in its group; ``order`` must leave no ties.

    No group is ever put into one task: the rows are sorted by (group, order) over all tasks,
    and each rank is the position in the sorted run plus the group's rows in earlier runs. The
    sorted rows are written to the checkpoint folder, which fixes the runs.
    """
    # monotonically_increasing_id is (partition << 33) + position; the checkpoint fixes it.
    run = F.shiftright("__at", 33)
    placed = df.orderBy(group, *order).withColumn("__at", F.monotonically_increasing_id())
    placed = checkpoint(placed).withColumn("__run", run)
    runs = placed.groupBy(group, "__run").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    # One row per (group, run): no longer than the number of sorted runs.
    before = Window.partitionBy(group).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return (
        placed.join(runs, [group, "__run"])
        .withColumn(rank, F.col("__before") + F.col("__at") - F.col("__first") + 1)
        .drop("__at", "__run", "__first", "__before")
    )


def running_sums(df: DataFrame, group: str, order: list[Column], value: str, name: str = "running") -> DataFrame:
    """Every row with the sum of ``value`` over its group up to and with it; ``order`` must leave no ties.

    Like ``ranked``: sorted over all tasks, sums within a sorted run plus those of earlier runs.
    """
    run = F.shiftright("__at", 33)
    placed = df.orderBy(group, *order).withColumn("__at", F.monotonically_increasing_id())
    placed = checkpoint(placed).withColumn("__run", run)
    runs = placed.groupBy(group, "__run").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(group).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    # A run is one task's share of the sorted rows, so no window holds more than that.
    within = Window.partitionBy(group, "__run").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn(name, F.sum(value).over(within)).join(runs, [group, "__run"])
    return summed.withColumn(name, F.col(name) + F.col("__before")).drop("__at", "__run", "__before")


def first_gaps(taken: DataFrame, owners: DataFrame, owner: str, place: str, k: int, n: str = "n", rank: str = "rank") -> DataFrame:
    """(owner, rank, place): the first ``k`` places from 1 on that ``taken`` does not hold, for each owner."""
    free = gap_lists(taken, owners, owner, place, k, n)
    at = F.posexplode("places").alias("__at", place)
    return free.select(owner, at).select(owner, (F.col("__at") + 1).cast("long").alias(rank), place)


def gap_lists(taken: DataFrame, owners: DataFrame, owner: str, place: str, k: int, n: str = "n", keep: tuple[str, ...] = ()) -> DataFrame:
    """(owner, columns to ``keep`` of ``owners``, places): the first ``k`` places that ``taken`` does not hold, in order.

    ``taken`` holds distinct (owner, place) rows, ``owners`` every owner once with ``n``, the number of
    its taken places. With an owner's taken places r_1 < r_2 < ..., r_j - j free ones come before the
    j-th, so the t-th free place is t plus the number of taken ones with r_j - j < t. Only places up to
    k + n can count, which leaves few rows to sort where places are many and owners take few.
    """
    longest = owners.agg(F.max(n)).scalar()
    near = taken.select(owner, place).filter(F.col(place) <= k + longest)
    sizes = owners.select(owner, F.col(n).alias("__n"))
    near = spread_join(near, sizes, owner, counts=owners, n=n).filter(F.col(place) <= k + F.col("__n")).drop("__n")
    placed = ranked(near, owner, [F.asc(place)], "__j")
    # Of the taken places only how many have each number of free ones before them matters.
    free = F.col(place) - F.col("__j")
    before = placed.filter(free < k).groupBy(owner, free.alias("u")).agg(F.count(F.lit(1)).alias("c"))
    # At most k entries an owner.
    before = before.groupBy(owner).agg(F.collect_list(F.struct("u", "c")).alias("__taken"))
    nothing = F.array().cast("array<struct<u: bigint, c: bigint>>")
    asked = owners.select(owner, *keep).join(before, owner, "left").withColumn("__taken", F.coalesce("__taken", nothing))

    def at(t: Column) -> Column:
        return t + F.aggregate("__taken", F.lit(0).cast("long"), lambda total, e: total + F.when(e["u"] < t, e["c"]).otherwise(0))

    ranks = F.sequence(F.lit(1).cast("long"), F.lit(k).cast("long"))
    return asked.select(owner, *keep, F.transform(ranks, at).alias("places"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's checkpoint folder and cut its lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ensure_checkpoint_dir(spark) -> None:
    """Use the folder the session names in spark.checkpoint.dir.

    Only a session on one machine that names none gets a folder of its own, deleted when it ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="rankwell-checkpoint-")
        path = context._jvm.org.apache.hadoop.fs.Path(f"file://{folder}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    context.setCheckpointDir(folder)


def scratch_folder(spark, name: str) -> str:
    """A new folder below the checkpoint folder, which all executors share; deleted when the driver ends."""
    import uuid

    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    folder = f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
