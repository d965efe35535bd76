"""Records read with a declared type, and what does not fit it kept beside the columns instead of lost.

Every record gives its typed columns and one VARIANT object, the rescued values: fields that the type does not have,
and values that are not of their declared type, under their path (``place.row``; a point in a name is ``\\.``). A list with an element that does
not fit is rescued whole, and its column is null. A record that is no object is rescued under ``$``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.operators.nested import flatten
from telemetry_lake.sources.envelope import _type_text

ROOT = "$"
# Fixed value: a point in a field's name, which is not one between two names of a path.
POINT = "\\."


def _get(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, ROOT, kind)


def _fields(value: Column) -> Column:
    """Fields of a VARIANT object; null for anything else."""
    return F.when(F.schema_of_variant(value).startswith("OBJECT<"), _get(value, "map<string,variant>"))


def _absent(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def fits(value: Column, dtype: T.DataType) -> Column:
    """Whether a VARIANT is of a type without loss: absent and null values fit any type.

    Whole numbers fit whole and fractional types, fractions fractional ones; text columns take any single value; times
    and days take text that reads as one. Objects may lack fields; a field the type does not have does not fit.
    """
    if isinstance(dtype, T.StructType):
        known = {f.name: f for f in dtype.fields}
        own = _fields(value)
        strange = F.size(F.map_filter(own, lambda name, item: ~name.isin(*known) & ~_absent(item))) > 0
        inner = [fits(F.try_element_at(own, F.lit(n)), f.dataType) for n, f in known.items()]
        fine = own.isNotNull() & ~F.coalesce(strange, F.lit(False)) & reduce(lambda a, b: a & b, inner, F.lit(True))
        return _absent(value) | fine
    if isinstance(dtype, T.ArrayType):
        items = F.when(F.schema_of_variant(value).startswith("ARRAY<"), _get(value, "array<variant>"))
        return _absent(value) | (items.isNotNull() & F.forall(items, lambda item: fits(item, dtype.elementType)))
    if isinstance(dtype, T.VariantType):
        return F.lit(True)
    kind = F.schema_of_variant(value)
    whole, fraction = (kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$"), kind.startswith("DECIMAL(") | (kind == "DOUBLE")
    read = _get(value, dtype.simpleString()).isNotNull()
    if isinstance(dtype, T.IntegralType):
        fine = whole & read
    elif isinstance(dtype, (T.FractionalType, T.DecimalType)):
        fine = (whole | fraction) & read
    elif isinstance(dtype, T.BooleanType):
        fine = kind == "BOOLEAN"
    elif isinstance(dtype, T.StringType):
        fine = ~kind.startswith("OBJECT<") & ~kind.startswith("ARRAY<")
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        fine = (kind == "STRING") & read
    else:
        raise ValueError(f"no rule for values of type {dtype.simpleString()}")
    return _absent(value) | F.coalesce(fine, F.lit(False))


def _typed(value: Column, dtype: T.DataType) -> Column:
    """A value of its type, null where it does not fit; objects field by field."""
    if isinstance(dtype, T.StructType):
        own = _fields(value)
        inner = [_typed(F.try_element_at(own, F.lit(f.name)), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(own.isNotNull(), F.struct(*inner))
    return F.when(fits(value, dtype), _get(value, _type_text(dtype)))


def _rescued(value: Column, dtype: T.StructType, path: str = "") -> list[Column]:
    """Maps of path to VARIANT, one per place where something may be left over."""
    known, own = {f.name: f for f in dtype.fields}, _fields(value)
    strange = F.map_filter(own, lambda name, item: ~name.isin(*known) & ~_absent(item))
    found = [F.transform_keys(strange, lambda name, _: F.concat(F.lit(path), F.replace(name, F.lit("."), F.lit(POINT))))]
    for name, field in known.items():
        item, place = F.try_element_at(own, F.lit(name)), path + name.replace(".", POINT)
        if isinstance(field.dataType, T.StructType):
            found += _rescued(item, field.dataType, f"{place}.")
            unfit = ~_absent(item) & ~F.schema_of_variant(item).startswith("OBJECT<")
        else:
            unfit = ~fits(item, field.dataType)
        found.append(F.when(unfit, F.create_map(F.lit(place), item)))
    return found


def records_rescued(
    df: DataFrame, schema: T.StructType | str, record: str = "record", rescued: str = "rescued"
) -> DataFrame:
    """Typed, flattened columns of VARIANT records, and their rescued values as a VARIANT object, null if there are none.

    Nothing is lost: a value of a record is in its column or among the rescued ones. Every value is judged alone, so no
    type is searched over the data.
    """
    dtype = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    value = quoted(record)
    none = F.create_map().cast("map<string,variant>")
    other = F.when(~_absent(value) & ~F.schema_of_variant(value).startswith("OBJECT<"), F.create_map(F.lit(ROOT), value))
    maps = F.map_concat(*[F.coalesce(m, none) for m in [*_rescued(value, dtype), other]])
    others = [quoted(n) for n in df.columns if n != record]
    kept = df.select(*others, _typed(value, dtype).alias("__record"), maps.alias("__rescued"))
    left = F.when(F.size("__rescued") > 0, F.to_variant_object("__rescued"))
    return flatten(kept.select(*others, "__record.*", left.alias(rescued)))


def restore(df: DataFrame, schema: T.StructType | str, rescued: str = "rescued", path: str = "") -> DataFrame:
    """Rescued values of fields that a wider type has, moved to columns: each field's value where its column is null.

    For flat fields: run it when a type was widened, so that values rescued before are read with it.
    """
    dtype = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    own = _fields(quoted(rescued))
    out = df
    for field in dtype.fields:
        item = F.try_element_at(own, F.lit(f"{path}{field.name}"))
        found = _typed(item, field.dataType)
        known = quoted(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        out = out.withColumn(field.name, F.coalesce(known, found))
    moved = [(f"{path}{f.name}", f.dataType) for f in dtype.fields]
    left = F.map_filter(
        own, lambda name, item: ~reduce(lambda a, b: a | b, [(name == n) & fits(item, d) for n, d in moved], F.lit(False))
    )
    return out.withColumn(rescued, F.when(F.size(left) > 0, F.to_variant_object(left)))
