"""Tables laid out once by key, for many joins and groupings on it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from rankwell.skew import scratch_folder


def lay_out(df: DataFrame, keys: str | Sequence[str], buckets: int | None = None) -> DataFrame:
    """``df`` written in buckets by ``keys``, sorted within, and read again.

    Groupings by ``keys``, and joins on them of two tables with as many buckets, read such a table
    without an exchange. All rows of a key lie in one bucket, so lay tables out by keys that
    none of which holds a large share, such as user and item together; joins that cut hot keys into
    slices do not use the layout. As many buckets as shuffle partitions by default. The files lie
    below the checkpoint folder and go when the driver ends.
    """
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"laid_out_{uuid.uuid4().hex}"
    # Rows of a bucket in one task each, so that a bucket is one file.
    dealt = df.repartition(count, *keys)
    dealt.write.format("parquet").bucketBy(count, *keys).sortBy(*keys).option("path", scratch_folder(spark, "layout")).saveAsTable(name)
    return spark.table(name)
