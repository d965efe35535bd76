"""One incremental run: given pages land, then every table is transformed and loaded from its own progress on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.plans.catalogue import catalogue
from telemetry_lake.plans.gaps import HISTORY_START, empty_days, missing_days
from telemetry_lake.plans.jobs import FILE_DATE, TableJob, land_stage, load_stage, transform_stage
from telemetry_lake.plans.progress import WATERMARKS, merge_no_data, read_state, upsert_state, write_state
from telemetry_lake.plans.tables import TRANSFORMED_AT_LANDING
from telemetry_lake.sources.envelope import records_to_columns, unwrap_envelope
from telemetry_lake.sources.lake import table_path
from telemetry_lake.sources.warehouse import load_spec


# Fixed value: folder inside a version of the state, unseen by its readers, for the days that stay unanswered.
OPEN_DAYS = "_open_days"


@dataclass(frozen=True)
class Roots:
    """Folders of the raw, flattened and loaded tables."""

    raw: str
    flat: str
    warehouse: str


def run_pipeline(
    spark: SparkSession,
    roots: Roots,
    state_path: str,
    new_state_path: str,
    pages: DataFrame,
    jobs: Sequence[TableJob],
    end: str,
    at_once: int = 4,
) -> DataFrame:
    """Bring the tables of ``jobs`` up to the day ``end`` and return the new state, which is written as a new version.

    ``pages`` has (table_name, body, file_date): the answers to this run's requests, whole days each. Days before a
    table's download mark are not landed again, unless they are still missing: the new state keeps the days that have
    neither a raw file nor known emptiness (``open_days``), and pages of those days are landed, transformed and loaded
    by any later run. Days that were answered without a record are kept as known to be empty, so that they are not
    missing days later. Every stage starts at the mark of its own, and the days that it
    does again replace themselves: a run that was stopped, or is repeated from the same state, leaves the same tables.
    The new state is written last. ``at_once`` tables, which are independent of each other, run at the same time.
    """
    state = read_state(spark, state_path)
    # One row per job at most.
    marks = {row[0]: row for row in state.filter(F.col("table_name").isin([j.table for j in jobs])).collect()}
    specs = {j.table: load_spec(catalogue(spark), j.table) for j in jobs}

    late = _late_days(spark, roots, state_path, state, pages, jobs, end)

    def since(job: TableJob, watermark: str) -> TableJob:
        row = marks.get(job.table)
        mark = str(row[watermark]) if row and row[watermark] else job.watermark
        return replace(job, watermark=mark, late=late.get(job.parent or job.table, ()))

    def answered(job: TableJob) -> DataFrame:
        own = pages.filter((F.col("table_name") == job.table) & (F.col(FILE_DATE) < F.lit(end).cast("date")))
        mark = since(job, "last_download_time").watermark
        if mark is not None and job.download_type == "time":
            day = F.col(FILE_DATE).cast("date")
            own = own.filter((day >= F.lit(mark).cast("date")) | day.isin(*late.get(job.table, ())))
        return own.select("body", FILE_DATE)

    def stored(job: TableJob, own: DataFrame) -> T.StructType | None:
        """Columns that records of the declared type land as, so that no footers are merged."""
        if job.schema is None or job.table in TRANSFORMED_AT_LANDING:
            return None
        return records_to_columns(unwrap_envelope(own), job.schema).drop(FILE_DATE).schema

    def advance(job: TableJob) -> None:
        own = answered(job)
        if not unwrap_envelope(own).isEmpty():
            land_stage(own, roots.raw, job)
        if _there(spark, table_path(roots.raw, job.family, job.table)):
            transform_stage(spark, roots.raw, roots.flat, [replace(since(job, "last_transformation_time"), schema=stored(job, own))])

    def load(job: TableJob) -> None:
        folder = f"{table_path(roots.flat, job.family, job.parent or job.table)}/{job.table}"
        if _there(spark, folder):
            load_stage(spark, roots.flat, roots.warehouse, [since(job, "last_db_migration_time")], specs)

    # Sub-tables are cut from their main table, so all of these are transformed before any is loaded.
    _each(advance, [j for j in jobs if j.parent is None], at_once)
    _each(load, jobs, at_once)

    empty = None
    for job in jobs:
        if job.parent is None and job.download_type == "time":
            own = answered(job)
            held = unwrap_envelope(own).select(FILE_DATE).distinct()
            days = own.select(FILE_DATE).distinct().join(held, FILE_DATE, "left_anti")
            days = days.select(F.lit(job.table).alias("table_name"), F.col(FILE_DATE).alias("day"))
            empty = days if empty is None else empty.union(days)
    updates = spark.createDataFrame(
        [(j.table, j.download_type) for j in jobs], "table_name string, download_type string"
    )
    for watermark in WATERMARKS:
        state = upsert_state(state, updates, watermark, F.lit(end))
    write_state(state if empty is None else merge_no_data(state, empty), new_state_path)
    new = read_state(spark, new_state_path)
    _unanswered(spark, roots, new, jobs, end).coalesce(1).write.parquet(f"{new_state_path}/{OPEN_DAYS}")
    return new


def open_days(spark: SparkSession, state_path: str) -> DataFrame | None:
    """Days that stayed unanswered up to a version of the state, as (table_name, day); none if it has no record."""
    try:
        return spark.read.schema("table_name string, day date").parquet(f"{state_path}/{OPEN_DAYS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _unanswered(spark: SparkSession, roots: Roots, state: DataFrame, jobs: Sequence[TableJob], end: str) -> DataFrame:
    """Missing days of the main ``time`` tables of ``jobs`` from their first day (else that of history) to ``end``."""
    timed = [j for j in jobs if j.parent is None and j.download_type == "time"]
    # A file that covers no day lets a table without any file take part.
    paths = [(j.table, f"{j.table}_2000_01_01_to_2000_01_01.parquet") for j in timed]
    for job in timed:
        for name in _names(spark, table_path(roots.raw, job.family, job.table)):
            day = name.removeprefix(f"{FILE_DATE}=")
            paths.append((job.table, name if day == name else f"{job.table}_{day.replace('-', '_')}.parquet"))
    tables = spark.createDataFrame(
        [(j.family or "-", j.table, j.download_type, j.watermark or HISTORY_START) for j in timed],
        "family string, table_name string, download_type string, first_day string",
    )
    starts = tables.select("table_name", F.col("first_day").cast("date").alias("last_download_time"))
    known = starts.join(state.select("table_name", "date_no_data"), "table_name", "left")
    files = spark.createDataFrame(paths, "table_name string, path string")
    return missing_days(tables, files, known, F.lit(end))


def _late_days(
    spark: SparkSession, roots: Roots, state_path: str, state: DataFrame, pages: DataFrame, jobs: Sequence[TableJob], end: str
) -> dict[str, tuple[date, ...]]:
    """Open days of each table that are answered now, or were landed by a run that stopped before its end.

    They follow from the state and what is given, so a run repeated from the same state does the same days. A state
    without a record of open days takes all given days that are not known to be empty. Days are bounded by the calendar.
    """
    names = [j.table for j in jobs if j.parent is None and j.download_type == "time"]
    given = pages.filter(F.col("table_name").isin(names) & (F.col(FILE_DATE) < F.lit(end).cast("date")))
    given = given.select("table_name", F.col(FILE_DATE).cast("date").alias("day")).distinct()
    recorded = open_days(spark, state_path)
    if recorded is None:
        days = given.join(empty_days(state), ["table_name", "day"], "left_anti")
        first = {j.table: date.fromisoformat(j.watermark) for j in jobs if j.watermark}
    else:
        landed = [
            (j.table, name.removeprefix(f"{FILE_DATE}="))
            for j in jobs
            if j.table in names
            for name in _names(spark, table_path(roots.raw, j.family, j.table))
            if name.startswith(f"{FILE_DATE}=")
        ]
        there = spark.createDataFrame(landed, "table_name string, day string")
        there = there.select("table_name", F.col("day").try_cast("date").alias("day"))
        days, first = recorded.join(given.union(there).distinct(), ["table_name", "day"]), {}
    late: dict[str, tuple[date, ...]] = {}
    for table, day in sorted(map(tuple, days.collect())):
        if table not in first or day >= first[table]:
            late[table] = (*late.get(table, ()), day)
    return late


def _each(work: Callable[[TableJob], None], jobs: Sequence[TableJob], at_once: int) -> None:
    """Run the work of several jobs at a time; the first failure is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(inheritable_thread_target(work), job) for job in jobs]:
            done.result()


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in any file system that Spark reads; none if there is no folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def _there(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, in any file system that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
