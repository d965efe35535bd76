"""The batch stages over lake folders: pages to raw, raw to flattened, flattened to warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.operators.columns import zoneless_timestamps
from telemetry_lake.operators.split import split_table
from telemetry_lake.plans.tables import SPLITS, TABLE_STEPS, TRANSFORMED_AT_LANDING, split_plan, transform_table
from telemetry_lake.sources.envelope import record_schema, records_to_columns, unwrap_envelope
from telemetry_lake.sources.evolving import remember, remembered
from telemetry_lake.sources.lake import read_since, replacing, table_path, write_partitioned
from telemetry_lake.sources.manifest import read_named_files
from telemetry_lake.sources.versions import child_names
from telemetry_lake.sources.warehouse import LoadSpec, load_table

FILE_DATE = "file_date"


@dataclass(frozen=True)
class TableJob:
    """One table to move: where it lives, how it is kept, from which day on, and (to load) its main table.

    ``external_system`` names the outside system whose identifiers the transform drops.

    ``late`` are days before the watermark that are done as well.

    ``layout`` is ``days`` for ``file_date=…`` folders and ``named`` for raw files that carry the day in their name.
    """

    family: str | None
    table: str
    download_type: str = "time"
    watermark: str | None = None
    schema: T.StructType | str | None = None
    parent: str | None = None
    layout: str = "days"
    external_system: str | None = None
    late: tuple[date, ...] = ()


def _since(df: DataFrame, job: TableJob) -> DataFrame:
    """A ``time`` table from its watermark day on, and its late days: a filter on the partition column, so other
    earlier days are not read."""
    if job.download_type != "time" or job.watermark is None:
        return df
    mark = F.lit(job.watermark).cast("date")
    if not job.late:
        return read_since(df, mark, F.col(FILE_DATE))
    day = F.col(FILE_DATE).cast("date")
    return df.filter(day.isNull() | (day >= mark) | day.isin(*job.late))


def land_stage(pages: DataFrame, raw_root: str, job: TableJob) -> str:
    """Response pages (``body``, ``file_date``) to the raw files of their table, one folder per day."""
    records = unwrap_envelope(pages.select("body", FILE_DATE))
    schema = job.schema if job.schema is not None else record_schema(records)
    landed = records_to_columns(records, schema)
    if job.table in TRANSFORMED_AT_LANDING:
        landed = transform_table(landed, job.table, date=F.col(FILE_DATE).cast("string"), external_system=job.external_system)
    target = table_path(raw_root, job.family, job.table)
    days = [r[0] for r in pages.select(FILE_DATE).distinct().collect()]
    _write_days(landed, target, days)
    return target


def _write_days(df: DataFrame, target: str, days: Sequence[object]) -> None:
    """Write whole days, so that what they held before goes, and keep the schema beside them."""
    with replacing(df.sparkSession, target, days):
        write_partitioned(df, target, [FILE_DATE])
    remember(df.sparkSession, target, zoneless_timestamps(df.drop(FILE_DATE)).schema)


def _stored_table(spark: SparkSession, folder: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A folder of days with its kept schema, for which no footer is read; without one, footers are merged."""
    known = remembered(spark, folder) if schema is None else None
    if known is not None:
        schema = T.StructType([*known.fields, T.StructField(FILE_DATE, T.DateType())])
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    return reader.parquet(folder)


def _days_since(spark: SparkSession, folder: str, job: TableJob) -> list[str | None]:
    """Days that a stage does, by the names of their folders alone."""
    names = [n.removeprefix(f"{FILE_DATE}=") for n in child_names(spark, folder) if n.startswith(f"{FILE_DATE}=")]
    days = [None if n == "__HIVE_DEFAULT_PARTITION__" else n for n in names]
    if job.download_type != "time" or job.watermark is None:
        return days
    late = {str(d) for d in job.late}
    return [d for d in days if d is None or d >= job.watermark or d in late]


def transform_stage(
    spark: SparkSession, raw_root: str, flat_root: str, jobs: Sequence[TableJob], on_error: str = "raise"
) -> list[str]:
    """Run each table's steps over its raw files and write ``family/table/sub_table/file_date=…``.

    The file's day stays a column through the steps, so duplicates are removed per day and a day that is done
    again replaces itself. A table that splits after steps of its own is written once and split from there.
    """
    written = []
    for job in jobs:
        if job.layout == "named":
            raw = read_named_files(spark, raw_root, job.family, job.table, schema=job.schema, file_date=FILE_DATE)
        else:
            raw = _stored_table(spark, table_path(raw_root, job.family, job.table), job.schema)
        if FILE_DATE not in raw.columns:
            raw = raw.withColumn(FILE_DATE, F.lit(None).cast("date"))
        flat = transform_table(
            _since(raw, job), job.table, TRANSFORMED_AT_LANDING, on_error, external_system=job.external_system
        )
        base = table_path(flat_root, job.family, job.table)
        days = _days_since(spark, table_path(raw_root, job.family, job.table), job)
        parts = {job.table: flat}
        if job.table in SPLITS:
            if job.table in TABLE_STEPS:
                whole = f"{base}/_whole"
                _write_days(flat, whole, days)
                stored = spark.read.schema(T.StructType([f for f in flat.schema if f.name != FILE_DATE]))
                flat = _since(stored.parquet(whole).withColumn(FILE_DATE, F.col(FILE_DATE).cast("date")), job)
            shared, outputs = split_plan(flat, job.table, job.external_system)
            parts = {
                name: transform_table(part, name, on_error=on_error, external_system=job.external_system)
                for name, part in split_table(flat, [*shared, FILE_DATE], outputs).items()
            }
        for name, part in parts.items():
            _write_days(part, f"{base}/{name}", days)
            written.append(f"{base}/{name}")
    return written


def load_stage(
    spark: SparkSession,
    flat_root: str,
    warehouse_root: str,
    jobs: Sequence[TableJob],
    specs: Mapping[str, LoadSpec],
    replace_days: bool = True,
    start: str | None = None,
    end: str | None = None,
) -> list[str]:
    """Load flattened tables, one write per table; only files from the watermark day on are read.

    ``start`` and ``end`` (days, both within) bound the files further. By default a load may be run again: the file
    days that it reads replace themselves in the warehouse table, which keeps ``file_date`` as its first partition.
    Rows that a file brings for an earlier day, or without a time, stay beside what other files brought. Of a
    ``oneshot`` table the newest file day is the whole table. ``replace_days=False`` appends, without ``file_date``.
    """
    loaded = []
    for job in jobs:
        folder = f"{table_path(flat_root, job.family, job.parent or job.table)}/{job.table}"
        flat = _since(_stored_table(spark, folder), job)
        day = F.col(FILE_DATE).cast("date")
        if start is not None:
            flat = flat.filter(day >= F.lit(start).cast("date"))
        if end is not None:
            flat = flat.filter(day <= F.lit(end).cast("date"))
        spec = specs.get(job.table, LoadSpec(job.download_type))
        target = f"{warehouse_root.rstrip('/')}/{job.table}"
        if spec.download_type == "oneshot":
            newest = flat.agg(F.max(FILE_DATE)).first()[0]
            flat = flat.filter(F.col(FILE_DATE).eqNullSafe(F.lit(newest)))
        if spec.download_type == "oneshot" or not replace_days:
            load_table(flat.drop(FILE_DATE), target, spec)
        else:
            days = _days_since(spark, folder, job)
            days = [d for d in days if (start is None or d is None or d >= start) and (end is None or d is None or d <= end)]
            with replacing(spark, target, days):
                load_table(flat, target, spec, batch_day=FILE_DATE)
        loaded.append(target)
    return loaded
