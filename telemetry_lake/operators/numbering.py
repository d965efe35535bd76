"""Positions and bounded batches without a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.session import scratch_path

# Hexadecimal digits of the hash that name a bucket: 16^3 = 4096 buckets per group.
BUCKET_DIGITS = 3


def number_rows(df: DataFrame, key: str, within: Sequence[str] = (), output: str = "position") -> DataFrame:
    """Add a position 0..n-1 per group to rows whose ``key`` is distinct in the group.

    The order is that of the key's MD5 (then the key): fixed for a given set of keys, and its leading digits
    cut every group, however large, into even buckets. Rows are ranked inside buckets; the bucket sizes, at
    most 4096 per group, give the offsets. No group is ever in one task. Null keys have no position.
    """
    hashed = df.withColumn("__hash", F.md5(quoted(key).cast("string"))).withColumn(
        "__bucket", F.substring("__hash", 1, BUCKET_DIGITS)
    )
    # Stated here, for both uses alike, so that Spark computes the keys once and reuses the exchange.
    hashed = hashed.filter(F.col("__bucket").isNotNull())
    group = []
    if within:
        # An object is equal to another with the same nulls inside, so null groups join without a null-safe
        # condition, which would shuffle the ranked rows once more.
        hashed = hashed.withColumn("__group", F.struct(*[quoted(n) for n in within]))
        group = ["__group"]
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*group, "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    inside = Window.partitionBy(*group, "__bucket").orderBy("__hash", quoted(key).cast("string"))
    ranked = hashed.withColumn("__rank", F.row_number().over(inside))
    columns = [quoted(n) for n in df.columns]
    found = ranked.join(offsets, [*group, "__bucket"], "inner").select(
        *columns, (F.col("__offset") + F.col("__rank") - 1).cast("bigint").alias(output)
    )
    keyless = df.filter(quoted(key).isNull())
    return found.unionByName(keyless.select(*columns, F.lit(None).cast("bigint").alias(output)))


def order_rows(
    df: DataFrame, order: Sequence[Column], output: str = "position", within: Sequence[str] = ()
) -> DataFrame:
    """Add gapless positions 0..n-1 in a global order, or in that order per group of ``within``, with no single task.

    Rows are cut into ranges of the order and written once to the shared folder, each with its range and its place
    inside; the sizes of the ranges (one row each) give the offsets. A group's positions are those of its rows less
    its first one, for which the order must begin with the group's columns; groups join null-safely.
    """
    path = scratch_path(df.sparkSession, "ordered")
    names = [quoted(n) for n in df.columns]
    # The number that Spark gives a row holds its range in the upper bits and its place in the lower 33.
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select(*names, F.monotonically_increasing_id().alias("__row")).write.parquet(path)
    stored = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("__row", T.LongType())]))
    rows = stored.parquet(path).withColumn("__range", F.shiftright("__row", 33))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    place = F.col("__offset") + F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.join(offsets, "__range").select(*names, place.cast("bigint").alias(output))
    if not within:
        return placed
    group = F.struct(*[quoted(n) for n in within]).alias("__group")
    firsts = placed.groupBy(group).agg(F.min(quoted(output)).alias("__first"))
    grouped = placed.withColumn("__group", group).join(firsts, "__group")
    return grouped.select(*names, (quoted(output) - F.col("__first")).alias(output))


def batch_keys(
    df: DataFrame, key: str, size: int, within: Sequence[str] = (), batch: str = "batch", output: str = "keys"
) -> DataFrame:
    """Collect distinct keys of each group into lists of at most ``size``; every key is in exactly one list.

    Null keys are in none.
    """
    group = [quoted(n) for n in within]
    keyed = df.select(*group, quoted(key)).filter(quoted(key).isNotNull())
    numbered = number_rows(keyed, key, within, "__position")
    return (
        numbered.withColumn(batch, F.expr(f"__position div {int(size)}"))
        .groupBy(*group, batch)
        .agg(F.array_sort(F.collect_list(quoted(key))).alias(output))
    )


def reverse_mapping(df: DataFrame, key: str, value: str, size: int) -> DataFrame:
    """Keys of every value, as lists of at most ``size`` numbered from 0; small values have one list."""
    return batch_keys(df.select(quoted(key), quoted(value)).distinct(), key, size, [value])
