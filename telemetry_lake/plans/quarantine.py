"""Steps with a row-wise error policy: rows that a step cannot convert leave with the step and the reason."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.functions.time import epoch_to_timestamp, parse_timestamp
from telemetry_lake.operators.columns import PLAIN_TYPES
from telemetry_lake.plans.steps import Step

QUARANTINE = "step int, operation string, reason string, record string"


def _cast_reasons(
    df: DataFrame, columns: Sequence[str], dtype: str, strftime: str | None = None, lenient: bool = False
) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [] if lenient else [n for n in columns if n in types]

    def read(name: str) -> Column:
        if dtype == "datetime":
            return parse_timestamp(quoted(name), types[name])
        return quoted(name).try_cast(PLAIN_TYPES[dtype])

    return [
        F.when(quoted(n).isNotNull() & read(n).isNull(), F.concat(F.lit(f"{n} is no {dtype}: "), quoted(n).cast("string")))
        for n in present
        if not isinstance(types[n], (T.StructType, T.ArrayType, T.MapType))
    ]


def _epoch_reasons(df: DataFrame, columns: Sequence[str], unit: str = "ms") -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        F.when(
            quoted(n).isNotNull() & epoch_to_timestamp(quoted(n), types[n], unit).isNull(),
            F.concat(F.lit(f"{n} is no time in {unit}: "), quoted(n).cast("string")),
        )
        for n in columns
        if n in types
    ]


# Steps that convert values, and what tells that they cannot: a text per column, null where it fits.
REASONS: dict[str, Callable[..., list[Column]]] = {"cast": _cast_reasons, "epoch": _epoch_reasons}


def run_steps_rowwise(df: DataFrame, steps: Sequence[Step]) -> tuple[DataFrame, DataFrame]:
    """Run steps in order; give the table of the rows that every step could convert, and the others.

    Before a converting step (``cast``, also of times, ``epoch``) rows with a value it cannot read are taken out: they
    come with the step's number from 1, its name, the reason (all failing columns) and the row as JSON as it was then.
    Other steps have no row of their own to fail on. Every row ends in exactly one of the two, or goes by a step that
    removes rows. Rows are judged natively (``try_`` conversions), so nothing stops the job; each failing step is one
    more branch over the source, so land the input first where it is costly.
    """
    spark = df.sparkSession
    out = spark.createDataFrame([], QUARANTINE)
    for number, current in enumerate(steps, start=1):
        reasons = REASONS[current.operation](df, **current.arguments) if current.operation in REASONS else []
        if reasons:
            reason = F.nullif(F.concat_ws("; ", *reasons), F.lit(""))
            row = F.to_json(F.struct(*[quoted(n) for n in df.columns]))
            failed = df.filter(reason.isNotNull()).select(
                F.lit(number).alias("step"), F.lit(current.operation).alias("operation"), reason.alias("reason"), row.alias("record")
            )
            out = out.unionByName(failed)
            df = df.filter(reason.isNull())
        df = df.transform(current)
    return df, out
