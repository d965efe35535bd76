"""Time functions: parsing, formatting, epochs, request bounds and day windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_FORMAT = "dd/MM/yyyy"
FILE_DAY_FORMAT = "yyyy_MM_dd"

# Strftime directives and the Java pattern letters that print the same text.
STRFTIME_TO_JAVA = {
    "a": "EEE",
    "A": "EEEE",
    "b": "MMM",
    "B": "MMMM",
    "d": "dd",
    "f": "SSSSSS",
    "H": "HH",
    "I": "hh",
    "j": "DDD",
    "m": "MM",
    "M": "mm",
    "p": "a",
    "S": "ss",
    "y": "yy",
    "Y": "yyyy",
    "z": "xx",
    "%": "%",
}

# Microseconds per unit of an epoch count.
MICROS_PER_UNIT = {"s": 1_000_000, "ms": 1_000, "us": 1}

# Spark's timestamps are microseconds held in 64 bits; epochs beyond them count as bad values.
LAST_MICRO = 2**63 - 1


def java_pattern(strftime: str) -> str:
    """Translate a strftime format to a Spark datetime pattern."""
    out, literal, i = [], "", 0

    def flush(text: str) -> str:
        return "'" + text.replace("'", "''") + "'" if any(ch.isalpha() or ch in "'[]{}#" for ch in text) else text

    while i < len(strftime):
        if strftime[i] == "%" and i + 1 < len(strftime):
            directive = strftime[i + 1]
            if directive not in STRFTIME_TO_JAVA:
                raise ValueError(f"unsupported strftime directive: %{directive}")
            out.append(flush(literal))
            out.append(STRFTIME_TO_JAVA[directive])
            literal = ""
            i += 2
        else:
            literal += strftime[i]
            i += 1
    out.append(flush(literal))
    return "".join(out)


def parse_timestamp(value: Column, dtype: T.DataType) -> Column:
    """Timestamp in UTC; unreadable text becomes null and timestamps pass unchanged."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(value)
    if isinstance(dtype, T.NumericType):
        return epoch_to_timestamp(value / F.lit(1000), T.DoubleType(), "us")
    if isinstance(dtype, T.DateType):
        return value.cast("timestamp")
    return F.lit(None).cast("timestamp")


def epoch_to_timestamp(value: Column, dtype: T.DataType, unit: str) -> Column:
    """Timestamp of an epoch count in ``s``, ``ms`` or ``us``; unreadable or out-of-range counts give null."""
    if unit not in MICROS_PER_UNIT:
        raise ValueError(f"unknown epoch unit: {unit}")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value
    scale = MICROS_PER_UNIT[unit]
    if isinstance(dtype, T.StringType):
        value, dtype = value.try_cast("decimal(38,9)"), T.DecimalType(38, 9)
    if isinstance(dtype, T.IntegralType):
        limit = LAST_MICRO // scale
        whole = value.cast("bigint")
        micros = F.when(whole.between(-limit, limit), whole * F.lit(scale))
    else:
        limit = LAST_MICRO / scale
        micros = F.when(value.between(-limit, limit), (value * F.lit(scale)).cast("bigint"))
    return F.timestamp_micros(micros)


def format_timestamp(value: Column, strftime: str) -> Column:
    return F.date_format(value, java_pattern(strftime))


def zoneless(value: Column) -> Column:
    """UTC wall time without zone, as written to files."""
    return value.cast("timestamp_ntz")


def iso_text(value: Column) -> Column:
    """ISO-8601 text with offset; the fraction is printed only where there is one."""
    return F.when(
        value == F.date_trunc("second", value), F.date_format(value, "yyyy-MM-dd'T'HH:mm:ssxxx")
    ).otherwise(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def reformat_date(value: Column, source_delimiter: str = "/", target_delimiter: str = "-") -> Column:
    """``dd/MM/yyyy`` text to ``yyyy-MM-dd`` text, delimiters as given."""
    source = java_pattern(f"%d{source_delimiter}%m{source_delimiter}%Y")
    target = java_pattern(f"%Y{target_delimiter}%m{target_delimiter}%d")
    return F.date_format(F.try_to_timestamp(value, F.lit(source)), target)


def date_to_epoch(value: Column, strftime: str = "%d/%m/%Y") -> Column:
    """Seconds since 1970 of a date text, read as UTC."""
    return F.unix_seconds(F.try_to_timestamp(value, F.lit(java_pattern(strftime))))


def seconds_to_millis(value: Column) -> Column:
    """Whole milliseconds, truncated towards zero."""
    return (value * F.lit(1000)).cast("bigint")


def millis_to_seconds(value: Column) -> Column:
    return value / F.lit(1000)


def parse_bound(value: Column, kind: Column) -> Column:
    """Request bound text to timestamp, by kind ``datetime``, ``date`` or ``timestamp_ms``."""
    return (
        F.when(kind == "datetime", F.try_to_timestamp(value, F.lit(DAY_FORMAT)))
        .when(kind == "date", F.try_to_timestamp(value, F.lit("yyyy-MM-dd")))
        .when(kind == "timestamp_ms", epoch_to_timestamp(value, T.StringType(), "ms"))
    )


def render_bound(value: Column, kind: Column) -> Column:
    """Timestamp to the text a request of this kind carries."""
    return (
        F.when(kind == "datetime", iso_text(value))
        .when(kind == "date", F.date_format(value, "yyyy-MM-dd"))
        .when(kind == "timestamp_ms", F.unix_millis(value).cast("string"))
    )


def window_starts(start: Column, end: Column, delta_days: Column) -> Column:
    """Array of window starts of ``[start, end)``; empty if the range is empty or reversed."""
    step = F.make_dt_interval(days=delta_days)
    return F.when(
        (start < end) & (delta_days > 0),
        F.sequence(start, end - F.expr("INTERVAL 1 MICROSECOND"), step),
    ).otherwise(F.array().cast("array<timestamp>"))


def window_end(window_start: Column, end: Column, delta_days: Column) -> Column:
    """Last second of the window, cut at the end of the range."""
    step = F.make_dt_interval(days=delta_days)
    return F.least(window_start + step - F.expr("INTERVAL 1 SECOND"), end)


def days_between(first: Column, after_last: Column) -> Column:
    """Array of the days in ``[first, after_last)``; empty, never counting down, if there are none."""
    return F.when(first < after_last, F.sequence(first, F.date_sub(after_last, 1))).otherwise(
        F.array().cast("array<date>")
    )


def date_label(start: Column, end: Column, delta_days: Column) -> Column:
    """Label of a window's file: ``yyyy_mm_dd`` for one-day windows, ``a_to_b`` otherwise."""
    first = F.date_format(start, FILE_DAY_FORMAT)
    return F.when(delta_days == 1, first).otherwise(F.concat(first, F.lit("_to_"), F.date_format(end, FILE_DAY_FORMAT)))
