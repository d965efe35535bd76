"""Missing days: the calendar of every table less what its files cover and what is known to be empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.time import days_between
from telemetry_lake.plans.catalogue import resolve_alias
from telemetry_lake.sources.manifest import covered_days

# Fixed value: first day of history.
HISTORY_START = "2020-07-13"


def union_days(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct (table_name, day) rows of two sets; each is reduced before the shuffle."""
    return first.select("table_name", "day").union(second.select("table_name", "day")).distinct()


def empty_days(state: DataFrame) -> DataFrame:
    """Known empty days as (table_name, day) rows."""
    return state.select("table_name", F.explode("date_no_data").alias("day"))


def missing_days(
    catalogue: DataFrame,
    files: DataFrame,
    state: DataFrame,
    end: Column,
    start: Column | None = None,
    alias: DataFrame | None = None,
) -> DataFrame:
    """Days in ``[start, end)`` with neither file nor known emptiness, as (table_name, day).

    Only ``time`` tables of the catalogue that have a family and some dated file take part; files of
    sub-tables count for their main table. A table starts at its own download watermark, else at ``start``,
    else at the beginning of history.

    Files are read once and reduced to distinct days before anything else, so a table's set of days is bounded
    by the calendar; from there on there is one row per table until its missing days are listed.
    """
    default_start = F.to_date(F.lit(HISTORY_START)) if start is None else start.cast("date")
    none = F.array().cast("array<date>")
    days = covered_days(files, keep_empty=True).select("table_name", "day").distinct()
    covered = (
        resolve_alias(days, alias)
        .groupBy(F.col("main_table").alias("table_name"))
        .agg(F.collect_set("day").alias("__covered"))
    )
    timed = (
        catalogue.filter(
            (F.length("family") > 0) & (F.length("table_name") > 0) & ~F.col("download_type").eqNullSafe("oneshot")
        )
        .select("table_name")
        .distinct()
    )
    known = state.select("table_name", "last_download_time", "date_no_data")
    calendar = days_between(F.coalesce("last_download_time", default_start), end.cast("date"))
    return (
        timed.join(covered, "table_name", "inner")
        .join(known, "table_name", "left")
        .withColumn("__done", F.concat("__covered", F.coalesce("date_no_data", none)))
        .select("table_name", F.explode(F.array_except(calendar, F.col("__done"))).alias("day"))
    )


def gap_summary(missing: DataFrame) -> DataFrame:
    """Missing days per table."""
    return missing.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_days"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )


def replan_gaps(missing: DataFrame, catalogue: DataFrame, alias: DataFrame | None = None) -> DataFrame:
    """Requests that fetch missing days again: the catalogue row of the main table for ``[day, day + 1)``;
    ``oneshot`` tables are left out."""
    wanted = resolve_alias(missing, alias).select("main_table", F.col("table_name").alias("missing_table"), "day")
    rows = catalogue.filter(~F.col("download_type").eqNullSafe("oneshot"))
    return (
        wanted.join(rows, F.col("main_table") == F.col("table_name"), "inner")
        .withColumn("start_date", F.col("day"))
        .withColumn("end_date", F.date_add("day", 1))
        .drop("main_table", "day")
    )
