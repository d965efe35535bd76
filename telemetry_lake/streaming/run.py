"""The whole run as a stream: a folder of pages drives land, transform and load, batch by batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.plans.evolving import FILE_DATE, PART, run_days
from telemetry_lake.plans.jobs import TableJob
from telemetry_lake.plans.run import Roots
from telemetry_lake.sources.warehouse import LoadSpec
from telemetry_lake.streaming.incremental import _run_batches, read_stream

PAGES = "table_name string, body string, file_date date"


def run_batch(
    pages: DataFrame, batch_id: int, roots: Roots, jobs: Sequence[TableJob], specs: Mapping[str, LoadSpec]
) -> None:
    """One batch of pages through all stages. Pages lie by day and batch, so a day may come in several batches; a batch
    that runs again replaces what it had landed, and the days it touches are transformed and loaded anew."""
    spark = pages.sparkSession
    for job in jobs:
        own = pages.filter(F.col("table_name") == job.table).select("body", FILE_DATE)
        parts = own.withColumn(PART, F.lit(batch_id).cast("bigint"))
        run_days(spark, roots.raw, roots.flat, roots.warehouse, parts, job, specs.get(job.table, LoadSpec()))


def stream_run(
    spark: SparkSession,
    source: str,
    roots: Roots,
    jobs: Sequence[TableJob],
    specs: Mapping[str, LoadSpec],
    checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Bring what has arrived in a folder of pages (Parquet: table_name, body, file_date) to all tables, then stop.

    The checkpoint is the only progress: a file is taken once, and a batch whose run was stopped is run again under
    the same number, which leaves the same tables. Tables may change their types on the way.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run_batch(batch, batch_id, roots, jobs, specs)

    _run_batches(read_stream(spark, source, PAGES, max_files), write, checkpoint)
