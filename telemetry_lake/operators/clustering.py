"""Clustering over several columns: a position on a space-filling curve, computed in columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.names import quoted


def range_number(value: Column, bounds: Sequence) -> Column:
    """Number of the range a value falls in: how many of the rising ``bounds`` are at most the value; null is 0."""
    if not bounds:
        return F.lit(0)
    listed = F.array(*[F.lit(b) for b in bounds])
    return F.when(value.isNull(), 0).otherwise(F.size(F.filter(listed, lambda bound: bound <= value)))


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """Bits of several whole numbers in turn, the first one's first (Z-order): near on all of them means near on the curve."""
    parts = [
        F.shiftleft(F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1)), bit * len(numbers) + len(numbers) - 1 - i)
        for bit in range(bits)
        for i, number in enumerate(numbers)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def curve_position(df: DataFrame, columns: Sequence[str], bits: int = 6, error: float = 0.002) -> Column:
    """Position of a row by all ``columns`` alike.

    Every column is cut in ``2**bits`` ranges of about as many rows each, by its approximate quantiles: one pass, a
    bounded sketch. Numbers, days, times and text take part; text is ordered by its first seven bytes.
    """
    ranked = {}
    for name in columns:
        kind = dict(df.dtypes)[name]
        column = quoted(name)
        if kind in ("date", "timestamp", "timestamp_ntz"):
            column = F.unix_micros(column.cast("timestamp"))
        elif kind == "string":
            column = F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
        ranked[name] = column
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    sketches = df.agg(*[F.percentile_approx(c, cuts, int(1 / error)).alias(str(i)) for i, c in enumerate(ranked.values())]).first()
    bounds = [sorted(set(found or ())) for found in sketches]
    # A column of few values has few ranges: they are spread over all bits, so that it counts as much as the others.
    numbers = [F.floor(range_number(c, b) * ((1 << bits) / (len(b) + 1))) for c, b in zip(ranked.values(), bounds)]
    return interleaved(numbers, bits)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, partitions: Sequence[str] = (), bits: int = 6
) -> None:
    """Write files whose min/max ranges are narrow on every one of ``columns``, not on the first alone.

    Rows are dealt to about ``files`` ranges of the curve and sorted on it. A value that holds very many rows fills
    several files, which its place on the other columns tells apart; rows equal on all of them are dealt by their hash.
    """
    place = curve_position(df, columns, bits)
    names = [quoted(n) for n in df.columns]
    placed = df.select(*names, place.alias("__place")).select(*names, "__place", F.xxhash64(*names).alias("__tie"))
    keys = [*[quoted(n) for n in partitions], F.col("__place"), F.col("__tie")]
    out = placed.repartitionByRange(files, *keys).sortWithinPartitions(*keys).drop("__place", "__tie")
    writer = out.write.mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
