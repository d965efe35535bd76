"""Nested data: objects to columns, lists to rows. The schema is walked on the driver, data never."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import clean_name, quoted, require_unique


def leaves(column: Column, dtype: T.StructType, sep: str = "_", path: str = "") -> list[tuple[str, Column]]:
    """Name and column of every leaf below an object; lists and maps are leaves."""
    out = []
    for field in dtype.fields:
        name = f"{path}{sep}{field.name}" if path else field.name
        inner = column.getField(field.name)
        if isinstance(field.dataType, T.StructType):
            out += leaves(inner, field.dataType, sep, name)
        else:
            out.append((name, inner))
    return out


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every nested object to one column per leaf, names joined by ``sep`` and cleaned; lists stay."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            columns += leaves(quoted(field.name), field.dataType, sep, field.name)
        else:
            columns.append((field.name, quoted(field.name)))
    cleaned = [(clean_name(name), column) for name, column in columns]
    require_unique([name for name, _ in cleaned], "flatten")
    return df.select(*[column.alias(name) for name, column in cleaned])


def normalize(
    df: DataFrame, column: str, prefix: str = "", sep: str = "_", keep: Sequence[str] | None = None
) -> DataFrame:
    """Replace an object column by one column per leaf. Rows without an object keep their other columns;
    a column that holds no objects at all is just removed. The column must exist."""
    if column not in df.columns:
        raise ValueError(f"no such column: {column}")
    kept = [n for n in (df.columns if keep is None else keep) if n != column]
    dtype = df.schema[column].dataType
    added = leaves(quoted(column), dtype, sep) if isinstance(dtype, T.StructType) else []
    require_unique(kept + [prefix + name for name, _ in added], "normalize")
    return df.select(*[quoted(n) for n in kept], *[leaf.alias(prefix + name) for name, leaf in added])


def explode(df: DataFrame, column: str) -> DataFrame:
    """One row per list element; empty and null lists keep one row with null. Other types and absent
    columns pass unchanged."""
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.ArrayType):
        return df
    return df.select(*[F.explode_outer(quoted(n)).alias(n) if n == column else quoted(n) for n in df.columns])


def unique_items(df: DataFrame, column: str) -> DataFrame:
    """Drop repeated items inside each list of a column; absent columns and other types pass unchanged.

    Before several lists of a row are combined and the combinations made distinct, this keeps repeated items
    from multiplying; the outcome is the same.
    """
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.ArrayType):
        return df
    return df.withColumn(column, F.array_distinct(quoted(column)))


def explode_coerced(df: DataFrame, column: str) -> DataFrame:
    """Like explode, but a scalar counts as a list of one element and null as an empty list."""
    dtype = df.schema[column].dataType
    value = quoted(column)
    items = value if isinstance(dtype, T.ArrayType) else F.when(value.isNotNull(), F.array(value))
    return df.select(*[F.explode_outer(items).alias(n) if n == column else quoted(n) for n in df.columns])


def normalize_list(
    df: DataFrame, column: str, prefix: str = "", sep: str = "_", keep: Sequence[str] | None = None
) -> DataFrame:
    """Object or list of objects to columns: a list gives one row per element, an empty list keeps its row."""
    if column not in df.columns:
        raise ValueError(f"no such column: {column}")
    return normalize(explode(df, column), column, prefix, sep, keep)
