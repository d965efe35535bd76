"""Response pages: JSON envelopes to records, records to columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.operators.nested import flatten


def unwrap_envelope(
    df: DataFrame, body: str = "body", record: str = "record", malformed: str = "raise"
) -> DataFrame:
    """One row per record of a page, as VARIANT; the other columns stay. Text that is no JSON stops the job, or is
    left out with ``malformed="drop"``.

    No ``data`` (or null): the whole object is the record. A list: its elements. An object with one key that
    holds a list: the elements of that list. Another object: itself. An empty list or object: no rows.
    """
    if malformed not in ("raise", "drop"):
        raise ValueError(f"unknown policy: {malformed}")
    page = F.parse_json(quoted(body)) if malformed == "raise" else F.try_parse_json(quoted(body))
    data = F.try_variant_get(F.col("__page"), "$.data", "variant")
    parsed = df.withColumn("__page", page).withColumn("__data", data)
    as_list = F.try_variant_get(F.col("__data"), "$", "array<variant>")
    as_map = F.try_variant_get(F.col("__data"), "$", "map<string,variant>")
    inner = F.try_variant_get(F.element_at(F.map_values(F.col("__map")), 1), "$", "array<variant>")
    parsed = parsed.withColumn("__list", as_list).withColumn("__map", as_map)
    parsed = parsed.withColumn("__inner", F.when(F.size("__map") == 1, inner))
    records = (
        F.when(F.col("__page").isNull(), F.lit(None).cast("array<variant>"))
        .when(F.col("__data").isNull() | F.is_variant_null(F.col("__data")), F.array("__page"))
        .when(F.col("__list").isNotNull(), F.col("__list"))
        .when(F.col("__inner").isNotNull(), F.col("__inner"))
        .when(F.size("__map") > 0, F.array("__data"))
    )
    others = [quoted(n) for n in df.columns if n != body]
    return parsed.select(*others, F.explode(records).alias(record))


def record_schema(df: DataFrame, record: str = "record") -> T.StructType:
    """One type covering all records: a single partial aggregation over the data.

    For tables without a declared schema; declare one to spare the extra pass. Fractions become doubles, and
    fields that are null in every record text. Records that are not all objects have no such type: this raises.
    """
    merged = df.select(F.schema_of_variant_agg(quoted(record))).first()[0]
    found = T.DataType.fromDDL(re.sub(r"(^|: |<)OBJECT<", r"\1STRUCT<", merged))
    if isinstance(found, T.NullType):
        return T.StructType()
    if not isinstance(found, T.StructType):
        raise ValueError(f"records are not all objects: {merged}")
    return _storable(found)


def _storable(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _storable(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_storable(dtype.elementType))
    if isinstance(dtype, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(dtype, T.DecimalType) and dtype.scale > 0:
        return T.DoubleType()
    return dtype


def _type_text(dtype: T.DataType) -> str:
    """DDL of a type with every field name quoted."""
    if isinstance(dtype, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_type_text(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"array<{_type_text(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"map<{_type_text(dtype.keyType)}, {_type_text(dtype.valueType)}>"
    return dtype.simpleString()


def records_to_columns(
    df: DataFrame, schema: T.StructType | str, record: str = "record", unfit: str = "raise"
) -> DataFrame:
    """Records read with a type, nested objects flattened to one cleaned column per leaf, lists kept.

    Fields a record lacks are null. A value that does not fit its type stops the job, or is null with
    ``unfit="null"``.
    """
    if unfit not in ("raise", "null"):
        raise ValueError(f"unknown policy: {unfit}")
    read = F.variant_get if unfit == "raise" else F.try_variant_get
    target = schema if isinstance(schema, str) else _type_text(schema)
    others = [quoted(n) for n in df.columns if n != record]
    typed = df.select(*others, read(quoted(record), "$", target).alias("__record"))
    return flatten(typed.select(*others, "__record.*"))
