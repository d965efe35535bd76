"""Progress per table: watermarks, known empty days, and the filters that follow from them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE_TYPE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("download_type", T.StringType()),
        T.StructField("last_download_time", T.DateType()),
        T.StructField("last_transformation_time", T.DateType()),
        T.StructField("last_db_migration_time", T.DateType()),
        T.StructField("date_no_data", T.ArrayType(T.DateType())),
    ]
)
WATERMARKS = ("last_download_time", "last_transformation_time", "last_db_migration_time")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """State table, empty if there is none yet."""
    try:
        return spark.read.schema(STATE_TYPE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE_TYPE)


def import_state(spark: SparkSession, path: str) -> DataFrame:
    """State from a JSON file ``{table: {download_type, last_…: "dd/MM/yyyy", date_no_data: [...]}}``."""
    entry = "struct<download_type: string, " + ", ".join(f"{n}: string" for n in WATERMARKS)
    text = spark.read.text(path, wholetext=True)
    tables = text.select(F.explode(F.from_json("value", f"map<string, {entry}, date_no_data: array<string>>>")))
    day = "dd/MM/yyyy"
    return tables.select(
        F.col("key").alias("table_name"),
        F.col("value.download_type").alias("download_type"),
        *[F.to_date(F.col(f"value.{n}"), day).alias(n) for n in WATERMARKS],
        F.transform("value.date_no_data", lambda text: F.to_date(text, day)).alias("date_no_data"),
    )


def upsert_state(state: DataFrame, updates: DataFrame, watermark: str, end_time: Column) -> DataFrame:
    """Set one watermark of the updated tables to ``end_time`` and their type to the given one (``time`` if
    none); other values stay, new tables are added. ``updates`` is (table_name, download_type)."""
    if watermark not in WATERMARKS:
        raise ValueError(f"unknown watermark: {watermark}")
    new = updates.groupBy(F.col("table_name").alias("__table")).agg(
        F.coalesce(F.max("download_type"), F.lit("time")).alias("__type")
    )
    joined = state.join(new, F.col("table_name") == F.col("__table"), "full")
    updated = F.col("__table").isNotNull()
    return joined.select(
        F.coalesce("table_name", "__table").alias("table_name"),
        F.coalesce("__type", "download_type").alias("download_type"),
        *[
            (F.when(updated, end_time.cast("date")).otherwise(F.col(n)) if n == watermark else F.col(n)).alias(n)
            for n in WATERMARKS
        ],
        F.col("date_no_data"),
    )


def merge_no_data(state: DataFrame, empty_days: DataFrame) -> DataFrame:
    """Add days known to hold no data: per table the distinct union of old and new days, in order.

    ``empty_days`` is (table_name, day). Days repeated per table are merged before they are collected, so a
    list holds at most one entry per calendar day.
    """
    new = (
        empty_days.filter(F.col("day").isNotNull())
        .select(F.col("table_name").alias("__table"), F.col("day").cast("date").alias("day"))
        .groupBy("__table")
        .agg(F.collect_set("day").alias("__days"))
    )
    joined = state.join(new, F.col("table_name") == F.col("__table"), "full")
    none = F.array().cast("array<date>")
    merged = F.array_sort(
        F.array_distinct(F.concat(F.coalesce("date_no_data", none), F.coalesce("__days", none)))
    )
    return joined.select(
        F.coalesce("table_name", "__table").alias("table_name"),
        F.coalesce("download_type", F.when(F.col("__table").isNotNull(), F.lit("time"))).alias("download_type"),
        *WATERMARKS,
        merged.alias("date_no_data"),
    )


def write_state(state: DataFrame, path: str) -> None:
    """Write a new version of the state; the version read stays untouched (use a new path per run)."""
    state.write.mode("errorifexists").parquet(path)


def _with_state(files: DataFrame, state: DataFrame, watermark: str, key: str) -> DataFrame:
    mark = state.select(
        F.col("table_name").alias("__state_table"),
        F.col(watermark).alias("__mark"),
    )
    return files.join(mark, F.col(key) == F.col("__state_table"), "left").drop("__state_table")


def files_to_transform(files: DataFrame, state: DataFrame, key: str = "main_table") -> DataFrame:
    """Files of a manifest still to transform. For ``time`` tables with a watermark, files that start or end
    before it are skipped; the watermark day is done again. Undated files and ``oneshot`` tables always pass.

    ``files`` carries start_date, end_date, download_type and the table the state is kept under.
    """
    mark = F.col("__mark")
    timed = (F.coalesce("download_type", F.lit("time")) == "time") & mark.isNotNull()
    early = (F.col("start_date") < mark) | (F.col("end_date") < mark)
    return _with_state(files, state, "last_transformation_time", key).filter(
        ~(timed & F.coalesce(early, F.lit(False)))
    ).drop("__mark")


def files_to_load(
    files: DataFrame,
    state: DataFrame,
    lower: Column | None = None,
    upper: Column | None = None,
    key: str = "main_table",
) -> DataFrame:
    """Files of a manifest still to load: not starting before ``lower``, not ending after ``upper``, not
    starting before the table's load watermark. Undated files always pass."""

    def no(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(False))

    keep = no(F.col("start_date") < F.col("__mark"))
    if lower is not None:
        keep = keep & no(F.col("start_date") < lower)
    if upper is not None:
        keep = keep & no(F.coalesce("end_date", "start_date") > upper)
    return _with_state(files, state, "last_db_migration_time", key).filter(keep).drop("__mark")
