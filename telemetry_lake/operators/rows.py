"""Filters, duplicate removal and row updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.functions.text import serialize_nested


def filter_rows(df: DataFrame, query: str, require: Sequence[str] = ()) -> DataFrame:
    """Keep rows where a SQL expression holds; unfiltered if a required column is absent."""
    if not set(require) <= set(df.columns):
        return df
    return df.filter(F.expr(query))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """Without columns: drop rows holding any null. With columns: drop rows where all of those that exist are
    null. If none exists the rows are kept, or all dropped if ``strict``."""
    if columns is None:
        return df.na.drop(how="any")
    present = [n for n in columns if n in df.columns]
    if not present:
        return df.filter(F.lit(False)) if strict else df
    return df.na.drop(how="all", subset=present)


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return False


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows, null equal to null; nested cells keep their type.

    Equal rows are merged before the shuffle, so a row repeated very often costs one row per task.
    """
    if any(_holds_map(f.dataType) for f in df.schema.fields):
        # Maps have no order of their own; grouping compares them by sorted entries.
        return df.groupBy(*[quoted(n) for n in df.columns]).count().select(*[quoted(n) for n in df.columns])
    return df.dropDuplicates()


def distinct_nested(df: DataFrame, serialize: bool = False) -> DataFrame:
    """Distinct whole rows where cells may be nested; ``serialize`` gives nested cells as canonical JSON."""
    if serialize:
        df = df.select(*[serialize_nested(f.name, f.dataType) for f in df.schema.fields])
    return distinct_rows(df)


def distinct_on(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """First row per key. The order is explicit: the given columns, then all others, so results repeat.
    Columns of ``scope`` that exist join the key: with a file's day there, results do not depend on which
    days run together.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a hot key costs
    one row per task.
    """
    absent = [k for k in keys if k not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {', '.join(absent)}")
    keys = [*keys, *[n for n in scope if n in df.columns and n not in keys]]
    first = [quoted(o) if isinstance(o, str) else o for o in (order_by or [])]
    named = {o for o in (order_by or []) if isinstance(o, str)}
    rest = [
        quoted(f.name)
        for f in df.schema.fields
        if f.name not in keys and f.name not in named and not _holds_map(f.dataType)
    ]
    order = first + rest
    if not order:
        return distinct_rows(df)
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column; only that column is read."""
    return df.select(quoted(column)).distinct()


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column some frame lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def conditional_update(
    df: DataFrame,
    endpoint: str,
    value: int,
    match: Column | None = None,
    order_by: Sequence[str] = ("table_name",),
    endpoint_column: str = "endpoint",
    target: str = "is_processed",
) -> DataFrame:
    """Set ``target`` on the rows of an endpoint.

    If several rows carry the endpoint and some satisfy ``match``, only the first of those (by ``order_by``)
    is set, else all. The decision is a one-row aggregate, so no row moves.
    """
    here = quoted(endpoint_column) == F.lit(endpoint)
    chosen = here
    if match is not None:
        key = F.struct(*[quoted(o) for o in order_by])
        matches = here & F.coalesce(match, F.lit(False))
        decided = df.agg(
            F.struct(F.count_if(here).alias("n"), F.min(F.when(matches, key)).alias("first")).alias("d")
        ).scalar()
        single = (decided["n"] > 1) & decided["first"].isNotNull()
        chosen = here & (~single | (matches & (key == decided["first"])))
    return df.withColumn(target, F.when(chosen, F.lit(value)).otherwise(quoted(target)))
