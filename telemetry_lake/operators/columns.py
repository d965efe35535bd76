"""Projections and casts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import clean_name, quoted, require_unique
from telemetry_lake.functions.time import epoch_to_timestamp, format_timestamp, parse_timestamp

PLAIN_TYPES = {
    "float": "double",
    "double": "double",
    "int": "bigint",
    "bigint": "bigint",
    "str": "string",
    "string": "string",
    "bool": "boolean",
    "boolean": "boolean",
}


def matching(names: Iterable[str], wanted: Sequence[str]) -> list[str]:
    """Names that are listed, or match a listed pattern (a pattern starts with ``^``), in table order."""
    exact = {w for w in wanted if not w.startswith("^")}
    patterns = [re.compile(w) for w in wanted if w.startswith("^")]
    return [n for n in names if n in exact or any(p.search(n) for p in patterns)]


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns; absent ones are ignored."""
    gone = set(matching(df.columns, columns))
    return df.select(*[quoted(n) for n in df.columns if n not in gone]) if gone else df


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename all at once, so that names can be swapped; absent ones are ignored."""
    if not any(old in mapping for old in df.columns):
        return df
    targets = [mapping.get(n, n) for n in df.columns]
    require_unique(targets, "rename")
    return df.select(*[quoted(old).alias(new) for old, new in zip(df.columns, targets)])


def clean_columns(df: DataFrame) -> DataFrame:
    """Clean every name; raise if two names become one."""
    targets = [clean_name(n) for n in df.columns]
    require_unique(targets, "clean")
    return df.toDF(*targets)


def add_prefix(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    return rename_columns(df, {n: prefix + n for n in (df.columns if columns is None else columns)})


def set_column(df: DataFrame, column: str, value: object) -> DataFrame:
    """Constant column holding the value as text; a missing value gives null. A Column is taken as it is."""
    if isinstance(value, Column):
        return df.withColumn(column, value)
    return df.withColumn(column, F.lit(None if value is None else str(value)).cast("string"))


def cast_columns(
    df: DataFrame, columns: Sequence[str], dtype: str, strftime: str | None = None, lenient: bool = False
) -> DataFrame:
    """Cast the listed columns that exist. ``datetime`` reads text as UTC (bad values give null) and can
    print it again; plain types raise on bad values unless ``lenient``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name in columns:
        if name not in types:
            continue
        column = quoted(name)
        if dtype == "datetime":
            column = parse_timestamp(column, types[name])
            if strftime:
                column = format_timestamp(column, strftime)
        else:
            target = PLAIN_TYPES[dtype]
            column = column.try_cast(target) if lenient else column.cast(target)
        changed[name] = column
    return df.withColumns(changed) if changed else df


def epoch_columns(df: DataFrame, columns: Sequence[str], unit: str = "ms") -> DataFrame:
    """Epoch counts to timestamps; the columns must exist."""
    types = {f.name: f.dataType for f in df.schema.fields}
    absent = [n for n in columns if n not in types]
    if absent:
        raise ValueError(f"no such columns: {', '.join(absent)}")
    return df.withColumns({n: epoch_to_timestamp(quoted(n), types[n], unit) for n in columns})


def pick_columns(
    df: DataFrame, shared: Sequence[str], columns: Sequence[str] = (), prefix: str | None = None
) -> DataFrame:
    """Shared columns first, then the listed ones or those with the prefix; absent ones are skipped."""
    present = set(df.columns)
    picked = []
    for name in shared:
        picked += matching(df.columns, [name]) if name.startswith("^") else [name] * (name in present)
    if prefix is not None:
        chosen = [n for n in df.columns if n.startswith(prefix)]
    else:
        chosen = [n for n in columns if n in present]
    return df.select(*[quoted(n) for n in dict.fromkeys(picked + chosen)])


def zoneless_timestamps(df: DataFrame) -> DataFrame:
    """Every timestamp as UTC wall time without zone."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: quoted(n).cast("timestamp_ntz") for n in zoned}) if zoned else df
