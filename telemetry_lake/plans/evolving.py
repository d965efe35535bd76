"""The batch stages over tables whose types drift: every stage reads with a stored schema and writes whole days."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.operators.split import split_table
from telemetry_lake.plans.jobs import FILE_DATE, TableJob
from telemetry_lake.plans.tables import SPLITS, TRANSFORMED_AT_LANDING, split_plan, transform_table
from telemetry_lake.sources import evolving
from telemetry_lake.sources.envelope import records_to_columns, unwrap_envelope
from telemetry_lake.sources.lake import table_path
from telemetry_lake.sources.warehouse import LoadSpec, conform_types

PART = "part"


def days_of(pages: DataFrame, *more: str) -> list:
    """Days that a batch of pages answers, those without a record too (with their parts, if named); bounded by the
    calendar and the windows asked for."""
    found = pages.select(F.col(FILE_DATE).cast("date"), *more).distinct().collect()
    return sorted((tuple(r) if more else r[0] for r in found), key=str)


def _leaves(dtype: T.DataType) -> list[T.DataType]:
    if isinstance(dtype, T.StructType):
        return [leaf for f in dtype.fields for leaf in _leaves(f.dataType)]
    return [dtype]


def land_days(pages: DataFrame, raw_root: str, job: TableJob) -> list[date | None]:
    """Pages (``body``, ``file_date``) of whole days to the raw table, and the days they answer.

    The batch's own type is found in one pass over the batch and widens the table's stored one; a declared type
    (``job.schema``) takes part in it as the first version. Pages with a column ``part`` (a number) are parts of their
    days: one window of several, one batch of a stream. A part replaces itself and nothing else.
    """
    more = [PART] if PART in pages.columns else []
    days = days_of(pages, *more)
    records = unwrap_envelope(pages.select("body", F.col(FILE_DATE).cast("date").alias(FILE_DATE), *more))
    found = evolving.found_schema(records)
    if job.schema is not None:
        declared = T.DataType.fromDDL(job.schema) if isinstance(job.schema, str) else job.schema
        found = evolving.widen_schema(declared, found)
    base, flat = table_path(raw_root, job.family, job.table), None
    if not found.fields:
        landed = records.select(FILE_DATE, *more)
    else:
        landed = records_to_columns(records, evolving.storable(found))
        names = [n for n in landed.columns if n not in (FILE_DATE, *more)]
        flat = T.StructType([T.StructField(n, d) for n, d in zip(names, _leaves(found), strict=True)])
    evolving.write_days(landed, base, days, FILE_DATE, found=flat, part=PART if more else None)
    return sorted({one[0] for one in days}, key=str) if more else days


def _found(df: DataFrame, raw: T.StructType) -> T.StructType:
    """The type of a transformed batch, with what is null so far in the raw table's type ``raw``.

    Columns that are still the raw ones keep their type; other text columns without a value in the batch are null.
    """
    if not _has_null(raw):
        return df.schema
    same = {f.name: f.dataType for f in raw.fields}
    known = {
        f.name: same[f.name] for f in df.schema.fields if f.name in same and evolving.storable(same[f.name]) == f.dataType
    }
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in known]
    held = df.agg(*[F.count(quoted(n)).alias(str(i)) for i, n in enumerate(texts)]).first() if texts else ()
    void = {n: T.NullType() for n, count in zip(texts, held) if not count}
    return T.StructType([T.StructField(f.name, (known | void).get(f.name, f.dataType)) for f in df.schema.fields])


def _has_null(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_null(f.dataType) for f in dtype.fields)
    return _has_null(dtype.elementType) if isinstance(dtype, T.ArrayType) else isinstance(dtype, T.NullType)


def transform_days(
    spark: SparkSession, raw_root: str, flat_root: str, job: TableJob, days: Sequence[date | None], on_error: str = "raise"
) -> list[str]:
    """Run a table's steps over some days of its raw table; every output replaces these days. Gives the outputs' folders."""
    source = table_path(raw_root, job.family, job.table)
    types = evolving.stored_schema(spark, source)[1]
    raw = evolving.read_days(spark, source, FILE_DATE, days)
    flat = transform_table(raw, job.table, TRANSFORMED_AT_LANDING, on_error, external_system=job.external_system)
    base = table_path(flat_root, job.family, job.table)
    parts = {job.table: flat}
    if job.table in SPLITS:
        evolving.write_days(flat, f"{base}/_whole", days, FILE_DATE, found=_found(flat, types))
        whole = evolving.read_days(spark, f"{base}/_whole", FILE_DATE, days)
        shared, outputs = split_plan(whole, job.table, job.external_system)
        parts = {
            name: transform_table(part, name, on_error=on_error, external_system=job.external_system)
            for name, part in split_table(whole, [*shared, FILE_DATE], outputs).items()
            if not set(part.columns) <= {*shared, FILE_DATE}  # a list that no record has had yet has no table yet
        }
    for name, part in parts.items():
        evolving.write_days(part, f"{base}/{name}", days, FILE_DATE, found=_found(part, types))
    return [f"{base}/{name}" for name in parts]


def load_days(
    spark: SparkSession, flat_root: str, warehouse_root: str, job: TableJob, spec: LoadSpec, days: Sequence[date | None]
) -> str:
    """Load some days of a flattened table, in warehouse types, with the newest stored schema; they replace themselves."""
    source = f"{table_path(flat_root, job.family, job.parent or job.table)}/{job.table}"
    flat = evolving.read_days(spark, source, FILE_DATE, days)
    void = [f for f in evolving.stored_schema(spark, source)[1].fields if isinstance(f.dataType, T.NullType)]
    kept = flat.drop(*[f.name for f in void])
    time = spec.time_partitioning_field if spec.time_partitioning_field in kept.columns else None
    # The day is no column of the warehouse types, which would make text of it.
    typed = conform_types(kept, time).withColumn(FILE_DATE, quoted(FILE_DATE).cast("date"))
    found = T.StructType([*typed.schema.fields, *void])
    cluster = [n for n in (time, *spec.clustering_fields) if n is not None and n in typed.columns]
    target = f"{warehouse_root.rstrip('/')}/{job.table}"
    evolving.write_days(typed, target, days, FILE_DATE, cluster, found)
    return target


def run_days(
    spark: SparkSession,
    raw_root: str,
    flat_root: str,
    warehouse_root: str,
    pages: DataFrame,
    job: TableJob,
    spec: LoadSpec,
) -> list[date | None]:
    """Land, transform and load the days that ``pages`` answer; repeating it leaves the same tables."""
    days = land_days(pages, raw_root, job)
    outputs = transform_days(spark, raw_root, flat_root, job, days)
    for folder in outputs:
        name = folder.rpartition("/")[2]
        sub = job if name == job.table else replace(job, table=name, parent=job.table)
        load_days(spark, flat_root, warehouse_root, sub, spec, days)
    return days
