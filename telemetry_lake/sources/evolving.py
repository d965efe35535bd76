"""Tables whose types drift from day to day: a stored schema that only widens, and reads that need no file footer.

Types form a lattice: null < bigint < double < text; objects widen field by field, lists by their elements; any other
pair meets at text. Each table keeps the versions of its schema in ``_schema``; its days lie in ``v=<version>/…`` as
written, so a file always has exactly the types of its version. A read takes every version with its own schema and
casts it to the newest one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.functions.text import canonical_json
from telemetry_lake.operators.columns import zoneless_timestamps
from telemetry_lake.sources import versions

SCHEMAS = "_schema"
NESTED = (T.StructType, T.ArrayType, T.MapType)


def widen(first: T.DataType, second: T.DataType) -> T.DataType:
    """The narrowest type of the lattice that holds values of both."""
    if isinstance(first, T.NullType):
        return _plain(second)
    if isinstance(second, T.NullType):
        return _plain(first)
    if isinstance(first, T.StructType) and isinstance(second, T.StructType):
        return widen_schema(first, second)
    if isinstance(first, T.ArrayType) and isinstance(second, T.ArrayType):
        return T.ArrayType(widen(first.elementType, second.elementType))
    if isinstance(first, T.MapType) and isinstance(second, T.MapType):
        return T.MapType(widen(first.keyType, second.keyType), widen(first.valueType, second.valueType))
    one, two = _plain(first), _plain(second)
    if one == two:
        return one
    kinds = {type(one), type(two)}
    if kinds <= {T.LongType, T.DoubleType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def _plain(dtype: T.DataType) -> T.DataType:
    """A type as tables keep it: whole numbers of 64 bits, doubles for fractions, times without zone."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(_plain(dtype.keyType), _plain(dtype.valueType))
    if isinstance(dtype, T.DecimalType):
        return T.LongType() if dtype.scale == 0 and dtype.precision <= 18 else T.DoubleType()
    if isinstance(dtype, T.IntegralType):
        return T.LongType()
    if isinstance(dtype, T.FractionalType):
        return T.DoubleType()
    if isinstance(dtype, T.TimestampType):
        return T.TimestampNTZType()
    if isinstance(dtype, T.VariantType):
        return T.StringType()
    return dtype


def widen_schema(first: T.StructType, second: T.StructType) -> T.StructType:
    """Fields of the first in their order, widened by those of the second, whose own fields follow."""
    news = {f.name: f.dataType for f in second.fields}
    kept = [T.StructField(f.name, widen(f.dataType, news.pop(f.name, T.NullType()))) for f in first.fields]
    return T.StructType(kept + [T.StructField(n, _plain(d)) for n, d in news.items()])


def found_schema(records: DataFrame, record: str = "record") -> T.StructType:
    """The type of a batch of VARIANT records, fields that are null throughout being null in it.

    One partial aggregation over the batch, not over the table. Records that are not all objects raise.
    """
    merged = records.select(F.schema_of_variant_agg(quoted(record))).first()[0]
    # No records, or none but nulls, have no fields.
    found = T.DataType.fromDDL(re.sub(r"(^|: |<)OBJECT<", r"\1STRUCT<", merged)) if merged else T.NullType()
    if isinstance(found, T.NullType):
        return T.StructType()
    if not isinstance(found, T.StructType):
        raise ValueError(f"records are not all objects: {merged}")
    return _plain(found)


def storable(dtype: T.DataType) -> T.DataType:
    """The type that files hold: fields that have been null so far are text, which no value has had to be read as."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, storable(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(storable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(storable(dtype.keyType), storable(dtype.valueType))
    return T.StringType() if isinstance(dtype, T.NullType) else dtype


def as_type(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """A value of a narrower type as one of a wider type; objects and lists become canonical JSON where text is wanted."""
    if source == target:
        return value
    if isinstance(source, T.NullType):
        return F.lit(None).cast(target)
    if isinstance(target, T.StringType) and isinstance(source, NESTED):
        return F.when(value.isNotNull(), canonical_json(value, source))
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        have = {f.name: f.dataType for f in source.fields}
        fields = [
            as_type(value.getField(f.name) if f.name in have else F.lit(None), have.get(f.name, T.NullType()), f.dataType).alias(f.name)
            for f in target.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(value, lambda item: as_type(item, source.elementType, target.elementType))
    return value.cast(target)


def conform(df: DataFrame, schema: T.StructType, source: T.StructType | None = None) -> DataFrame:
    """Columns of a schema that is at least as wide as the table's, in its order, absent ones null.

    ``source`` gives the types of the columns where it knows more: what is null in it is null whatever the column's type.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    known = {f.name: f.dataType for f in (source or df.schema).fields}
    return df.select(
        *[
            as_type(
                quoted(f.name) if f.name in have else F.lit(None),
                known.get(f.name, have[f.name]) if f.name in have else T.NullType(),
                f.dataType,
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def stored_schema(spark: SparkSession, base: str) -> tuple[int, T.StructType]:
    """Number and fields of a table's newest schema; 0 and none for a table without."""
    found = versions.newest(spark, f"{base}/{SCHEMAS}")
    if found is None:
        return 0, T.StructType()
    return found[0], T.StructType.fromJson(json.loads(found[1]))


def merge_schema(spark: SparkSession, base: str, found: T.StructType) -> tuple[int, T.StructType]:
    """Widen a table's schema by that of a batch; a new version is committed only where it changes.

    Of two writers that widen at once, the one that comes second widens what the first committed.
    """
    while True:
        number, stored = stored_schema(spark, base)
        merged = widen_schema(stored, found)
        if merged == stored and number:
            return number, stored
        try:
            return versions.commit(spark, f"{base}/{SCHEMAS}", number, merged.json()), merged
        except versions.Conflict:
            continue


def remember(spark: SparkSession, base: str, written: T.StructType) -> None:
    """Keep the schema of a plain folder of files beside it, with the columns of a batch added.

    Files of such a folder are read with one schema, so a column whose type changes makes the folder go without (its
    schema becomes one without fields, and readers merge footers, which tells where the types differ).
    """
    while True:
        found = versions.newest(spark, f"{base}/{SCHEMAS}")
        stored = T.StructType.fromJson(json.loads(found[1])) if found else T.StructType()
        known = {f.name: f.dataType for f in stored.fields}
        fields = _nullable(written).fields
        fresh = [f for f in fields if f.name not in known]
        same = all(known.get(f.name, f.dataType) == f.dataType for f in fields)
        if found and (not stored.fields or (same and not fresh)):
            return
        merged = T.StructType([*stored.fields, *fresh]) if same else T.StructType()
        try:
            versions.commit(spark, f"{base}/{SCHEMAS}", found[0] if found else 0, merged.json())
            return
        except versions.Conflict:
            continue


def remembered(spark: SparkSession, base: str) -> T.StructType | None:
    """The schema kept beside a plain folder; none where there is none, or where types differ."""
    found = versions.newest(spark, f"{base}/{SCHEMAS}")
    schema = T.StructType.fromJson(json.loads(found[1])) if found else T.StructType()
    return schema if schema.fields else None


def _nullable(dtype: T.DataType) -> T.DataType:
    """A type whose parts may all be null, as files are read."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_nullable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(_nullable(dtype.keyType), _nullable(dtype.valueType))
    return dtype


def _folder(names: Sequence[str], values: Sequence[object]) -> str:
    return "/".join(f"{n}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for n, v in zip(names, values))


def write_days(
    df: DataFrame,
    base: str,
    days: Sequence[date | None] | Sequence[tuple[date | None, int]],
    day: str = "file_date",
    cluster_by: Sequence[str] = (),
    found: T.StructType | None = None,
    part: str | None = None,
) -> int:
    """Write a batch that holds ``days`` whole, and give the version of the schema it has.

    All of these days are replaced, in every version, also those that have no row now; other days stay. ``found`` is
    the batch's schema where it knows more than its columns (fields that are null throughout). Files are written
    before older ones of the same days go, so a write that stopped is mended by repeating it.

    ``part`` names a column of numbers that cuts days into parts (a request's window, a batch of a stream); ``days``
    are then pairs of day and part, which are replaced alone. A table has parts in all of its writes, or in none.
    """
    spark = df.sparkSession
    given = zoneless_timestamps(df)
    keys = [day, part] if part else [day]
    own = T.StructType([f for f in (found or given.schema).fields if f.name not in keys])
    number, schema = merge_schema(spark, base, own)
    target = f"{base}/v={number}"
    placed = [T.StructField(day, T.DateType()), *([T.StructField(part, T.LongType())] if part else [])]
    shaped = conform(given, T.StructType([*storable(schema).fields, *placed]), T.StructType([*own.fields, *placed]))
    whole = [one[0] for one in days] if part else days
    out = shaped.filter(_among(day, whole)).hint("rebalance", *map(quoted, keys))
    out = out.sortWithinPartitions(*map(quoted, [*keys, *cluster_by]))
    folders = [_folder(keys, one if part else (one,)) for one in days]
    before = {folder: versions.child_names(spark, f"{target}/{folder}") for folder in folders}
    if schema.fields:  # without any field so far there are no files to hold rows
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(target)
    for folder in folders:
        # A day without rows in the batch has kept its files.
        if before[folder] and versions.child_names(spark, f"{target}/{folder}") == before[folder]:
            versions.remove(spark, f"{target}/{folder}")
        for version in _versions(spark, base):
            if version != number:
                versions.remove(spark, f"{base}/v={version}/{folder}")
    return number


def _versions(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(n[2:]) for n in versions.child_names(spark, base) if n.startswith("v="))


def _schema_of(spark: SparkSession, base: str, number: int) -> T.StructType:
    return T.StructType.fromJson(json.loads(versions.read(spark, f"{base}/{SCHEMAS}", number)))


def _among(day: str, days: Sequence[date | None]) -> Column:
    """Whether a day is one of those listed; none stands for rows without a day."""
    known = [d for d in days if d is not None]
    there = quoted(day).isin(*known) if known else F.lit(False)
    return there | quoted(day).isNull() if None in days else there


def read_days(
    spark: SparkSession, base: str, day: str = "file_date", days: Sequence[date | None] | None = None, since: date | None = None
) -> DataFrame:
    """The table with its newest schema, and the day of each row.

    One scan per version, each with its stored schema, so no footer is read for planning, however many files there
    are. ``days`` and ``since`` are filters on the partition column: other days are not listed among the files read.
    """
    _, schema = stored_schema(spark, base)
    target = T.StructType([*storable(schema).fields, T.StructField(day, T.DateType())])
    out = spark.createDataFrame([], target)
    for number in _versions(spark, base):
        own = _schema_of(spark, base, number)
        stored = T.StructType([*storable(own).fields, T.StructField(day, T.DateType())])
        part = spark.read.schema(stored).parquet(f"{base}/v={number}")
        if days is not None:
            part = part.filter(_among(day, days))
        if since is not None:
            part = part.filter(quoted(day).isNull() | (quoted(day) >= F.lit(since)))
        out = out.unionByName(conform(part, target, own))
    return out
