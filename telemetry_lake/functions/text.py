"""Text functions: request parameters, templates, paths and canonical JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted

# The UTF-16 units that JSON escapes with a letter or themselves.
SHORT_ESCAPES = (
    ("0008", "\\b"),
    ("0009", "\\t"),
    ("000A", "\\n"),
    ("000C", "\\f"),
    ("000D", "\\r"),
    ("0022", '\\"'),
    ("005C", "\\\\"),
)

# A comma ends a parameter only if a key and "=" follow before the next comma.
PARAM_BOUNDARY = ",(?=[^,=]*=)"
PARAM_KEY = "(?:^|,)([^,=]*)="


def parse_params(params: Column) -> Column:
    """``k=v,k2=v2,more`` to a map: a part without ``=`` continues the value before it,
    values of a repeated key are joined by commas. Null, empty and key-less texts give null or no entries."""
    keys = F.regexp_extract_all(params, F.lit(PARAM_KEY), F.lit(1))
    single = F.size(keys) == F.size(F.array_distinct(keys))
    readable = F.instr(F.substring_index(params, ",", 1), "=") > 0
    return (
        F.when(readable & single, F.str_to_map(params, F.lit(PARAM_BOUNDARY), F.lit("=")))
        .when(readable, _joined_params(params))
        .when(params == "", F.create_map().cast("map<string,string>"))
    )


def _joined_params(params: Column) -> Column:
    """Map of a text in which some key stands several times."""
    pairs = F.transform(
        F.split(params, PARAM_BOUNDARY),
        lambda part: F.struct(
            F.substring_index(part, "=", 1).alias("k"),
            F.substr(part, F.instr(part, "=") + 1).alias("v"),
        ),
    )

    def entry(key: Column) -> Column:
        values = F.transform(F.filter(pairs, lambda pair: pair["k"] == key), lambda pair: pair["v"])
        return F.struct(key.alias("key"), F.array_join(values, ",").alias("value"))

    return F.map_from_entries(F.transform(F.array_distinct(F.transform(pairs, lambda pair: pair["k"])), entry))


def params_text(params: Column) -> Column:
    """Map back to ``k=v`` text, keys in order."""
    entries = F.array_sort(F.map_entries(params))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def _has(params: Column, key: str) -> Column:
    return F.coalesce(F.length(F.try_element_at(params, F.lit(key))) > 0, F.lit(False))


# The parameter pairs that carry a date range, in order of precedence.
DATE_PARAMS = (
    ("datetime", "startTime", "endTime"),
    ("date", "startDate", "endDate"),
    ("timestamp_ms", "startMs", "endMs"),
)


def date_param_kind(params: Column) -> Column:
    """Kind of date range a parameter map holds, null if none; both ends must be non-empty."""
    return F.coalesce(
        *[F.when(_has(params, start) & _has(params, end), F.lit(kind)) for kind, start, end in DATE_PARAMS]
    )


def date_param(params: Column, kind: Column, side: str) -> Column:
    """Text of the ``start`` or ``end`` bound for the detected kind."""
    picked = F.lit(None).cast("string")
    for name, start, end in DATE_PARAMS:
        key = start if side == "start" else end
        picked = F.when(kind == name, F.try_element_at(params, F.lit(key))).otherwise(picked)
    return picked


def fill_template(template: Column, name: Column, value: Column) -> Column:
    """Replace ``{name}`` in a template by a value."""
    return F.replace(template, F.concat(F.lit("{"), name, F.lit("}")), value)


def table_folder(family: Column, table: Column) -> Column:
    """``family/table``, or ``table`` if there is no family."""
    return F.concat_ws("/", family, table)


def _json_string(value: Column) -> Column:
    """JSON string literal in ASCII. The JVM writer escapes quotes and usual controls; texts with other characters,
    and with the controls whose number it writes in capitals, are escaped by their UTF-16 units."""
    units = F.regexp_extract_all(F.hex(F.encode(value, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))

    def escaped(unit: Column) -> Column:
        short = F.try_element_at(F.create_map(*[F.lit(x) for pair in SHORT_ESCAPES for x in pair]), unit)
        plain = F.decode(F.unhex(unit), "UTF-16BE")
        numbered = F.concat(F.lit("\\u"), F.lower(unit))
        return F.when((unit < "0020") | (unit > "007E") | unit.isin("0022", "005C"), F.coalesce(short, numbered)).otherwise(plain)

    by_unit = F.concat(F.lit('"'), F.array_join(F.transform(units, escaped), ""), F.lit('"'))
    return F.when(value.rlike("[^\\x00-\\x7E]|[\\x0B\\x0E\\x0F\\x1A-\\x1F]"), by_unit).otherwise(
        F.btrim(F.to_json(F.array(value)), F.lit("[]"))
    )


def _json_double(value: Column) -> Column:
    """Number with the fewest digits that give it back: plain from 0.0001 up to 10 ** 16, else with an exponent of two
    digits or more. Spark's own text has an exponent outside 0.001 to 10 ** 7, and there up to two digits too many."""
    text, size = value.cast("string"), F.abs(value)
    digits = F.rtrim(F.trim(text.cast("decimal(38,21)").cast("string")), F.lit("0"))
    plain = F.concat(digits, F.when(digits.endswith("."), "0").otherwise(""))
    power = F.substring_index(text, "E", -1)
    size_of_power = F.ltrim(power, F.lit("-"))
    exponent = F.concat(
        F.when(power.startswith("-"), "-").otherwise("+"), F.when(F.length(size_of_power) == 1, "0").otherwise(""), size_of_power
    )
    # Below 2 ** 63 the whole number itself has the exact digits.
    whole = F.abs(value.cast("bigint")).cast("string")
    sign = F.when(value < 0, "-").otherwise("")
    exact = F.concat(sign, F.substr(whole, F.lit(1), F.lit(1)), F.lit("."), F.substr(whole, F.lit(2)))
    long = F.when((size >= 1e16) & (size < 2.0**63), exact).otherwise(F.substring_index(text, "E", 1))
    mantissa = F.coalesce(
        *[
            F.when(F.concat(short, F.lit("E"), power).cast("double") == value.cast("double"), short)
            for short in (F.round(long.cast("decimal(20,18)"), k).cast("string") for k in (15, 16))
        ],
        long,
    )
    mantissa = F.regexp_replace(mantissa, "\\.?0*$", "")
    return (
        F.when(F.isnan(value) | (size == 0) | (size == float("inf")) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, F.lit("e"), exponent))
    )


def canonical_json(value: Column, dtype: T.DataType) -> Column:
    """JSON text with sorted keys, nulls kept, ``", "`` and ``": "`` as separators and ASCII only.

    The type decides the text builder, so the whole expression stays in the JVM.
    """
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        parts = [
            F.concat(F.lit(json.dumps(f.name) + ": "), canonical_json(value.getField(f.name), f.dataType)) for f in fields
        ]
        text = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")) if parts else F.lit("{}")
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda item: canonical_json(item, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.MapType):
        entries = F.transform(
            F.array_sort(F.map_entries(value)),
            lambda e: F.concat(
                _json_string(e["key"].cast("string")), F.lit(": "), canonical_json(e["value"], dtype.valueType)
            ),
        )
        text = F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
    elif isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        text = _json_double(value)
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        text = value.cast("string")
    else:
        text = _json_string(value.cast("string"))
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def serialize_nested(name: str, dtype: T.DataType) -> Column:
    """Column as is, or its canonical JSON if it is nested; a missing value stays missing."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        column = quoted(name)
        return F.when(column.isNotNull(), canonical_json(column, dtype)).alias(name)
    return quoted(name)
