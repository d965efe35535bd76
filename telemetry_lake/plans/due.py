"""Runs over what is due: open windows of a plan, their answers to tables, and the keys that other requests need."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions.names import quoted
from telemetry_lake.plans.evolving import FILE_DATE, PART, run_days
from telemetry_lake.plans.jobs import TableJob
from telemetry_lake.plans.ledger import END, START, record_answers, requests_open
from telemetry_lake.plans.run import Roots
from telemetry_lake.sources.evolving import read_days
from telemetry_lake.sources.lake import table_path
from telemetry_lake.sources.versions import child_names
from telemetry_lake.sources.warehouse import LoadSpec


def lake_keys(spark: SparkSession, raw_root: str, catalogue: DataFrame) -> DataFrame:
    """(source_table, key): the distinct keys that the catalogue's keyed requests need, read from the raw tables.

    Which table and column comes from the catalogue rows: one scan per pair, of that column alone, and one distinct
    over all of them. The raw column is the one named, or ``id`` where the table keeps its key under its own name.
    Source tables that have not landed give no keys; nulls are no keys. Raw tables may be evolving or plain folders.
    """
    config = F.col("exception_config")
    wanted = catalogue.filter((config["exception_type"] == "table") & (config["constraint"] == "dynamic_url")).select(
        config["table_name"].alias("source_table"), config["table_column_name"].alias("column")
    )
    families = catalogue.select(F.col("table_name").alias("source_table"), "family").distinct()
    found = None
    # Catalogue rows with an exception: a handful.
    for table, column, family in sorted(map(tuple, wanted.distinct().join(families, "source_table", "left").collect())):
        base = table_path(raw_root, family, table)
        inside = child_names(spark, base)
        if not inside:
            continue
        if any(n.startswith("v=") for n in inside):
            raw = read_days(spark, base)
        else:
            raw = spark.read.parquet(base)
        name = column if column in raw.columns else "id"
        keys = raw.select(F.lit(table).alias("source_table"), quoted(name).cast("string").alias("key"))
        found = keys if found is None else found.unionByName(keys)
    if found is None:
        return spark.createDataFrame([], "source_table string, key string")
    return found.filter(F.col("key").isNotNull()).distinct()


def run_due(
    spark: SparkSession,
    roots: Roots,
    ledger: str,
    planned: DataFrame,
    answer: Callable[[DataFrame], DataFrame],
    jobs: Sequence[TableJob],
    specs: dict[str, LoadSpec],
) -> int:
    """Ask for what is due, bring the answers to raw, flattened and loaded tables, and record them.

    ``planned`` has (table_name, window_start, window_end) and whatever ``answer`` needs; it gets the open windows only
    and gives pages (table_name, body, window_start, window_end), of all or some of them, an answer without a record
    having an empty page. A page's day is that of its window's start, and its rows are the part of that day that its
    window answers, so partial windows of one day stand beside each other. The ledger is written last: a run that
    stopped is mended by the next one, which asks again and replaces the same parts. Gives the ledger's version.
    """
    pages = answer(requests_open(spark, ledger, planned))
    for job in jobs:
        own = pages.filter(F.col("table_name") == job.table)
        dated = own.select("body", F.to_date(START).alias(FILE_DATE), F.unix_micros(START).alias(PART))
        run_days(spark, roots.raw, roots.flat, roots.warehouse, dated, job, specs.get(job.table, LoadSpec()))
    return record_answers(pages.select("table_name", START, END).distinct(), ledger)
