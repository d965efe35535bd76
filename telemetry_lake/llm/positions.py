"""Gapless positions within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hash buckets of a group. A group is ranked bucket by bucket, so that none, however large, meets in one task.
BUCKETS = 1024


def numbered(df: DataFrame, group: str, order: Sequence[str], output: str) -> DataFrame:
    """Add 0..n-1 per value of ``group`` (which must not be null), in the order of a hash of ``order``, then ``order``.

    Rows equal in ``order`` get different positions, in any order among themselves.
    """
    bucket: Column = F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int")
    hashed = df.withColumn("_bucket", bucket)
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    ranked = hashed.withColumn("_rank", F.row_number().over(inside))
    return ranked.join(offsets, [group, "_bucket"]).select(
        *df.columns, (F.col("_offset") + F.col("_rank") - 1).cast("bigint").alias(output)
    )
