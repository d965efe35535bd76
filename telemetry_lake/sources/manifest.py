"""File manifests: what the paths say about tables and days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.functions.time import days_between
from telemetry_lake.operators.numbering import batch_keys, order_rows
from telemetry_lake.sources.lake import table_path

# The layout family/main_family/table[_date][_to_date][_index].parquet and the dates in a name.
NAME_ENDING = r"(?:_(\d{4}_\d{2}_\d{2}))?(?:_to_(\d{4}_\d{2}_\d{2}))?(?:_(\d+))?\.parquet"
PATH_PATTERN = rf"^([^/]+)/([^/]+)/(.+?){NAME_ENDING}$"
PATH_PARTS = ("family", "main_family", "table_name", "start_date", "end_date", "index")
MANIFEST_TYPE = (
    "struct<family: string, main_family: string, table_name: string, start_date: date, end_date: date, index: int>"
)
SEPARATOR = "\x01"
NAME_DATE = r"_(\d{4}_\d{2}_\d{2})"
NAME_RANGE = r"_\d{4}_\d{2}_\d{2}_to_(\d{4}_\d{2}_\d{2})"


def _day(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit("-")).try_cast("date")


def path_part(path: Column, part: str) -> Column:
    """One part of a path as text, null if the path does not match or lacks it."""
    return F.nullif(F.regexp_extract(path, PATH_PATTERN, PATH_PARTS.index(part) + 1), F.lit(""))


def manifest(df: DataFrame, path: str = "path") -> DataFrame:
    """Add family, main_family, table_name, start_date, end_date and index read from each path.

    The pattern runs once per path: the parts come back in one text that is cut at a separator.
    """
    joined = SEPARATOR.join(f"${i}" for i in range(1, len(PATH_PARTS) + 1))
    cut = df.withColumn("__parts", F.split(F.regexp_replace(quoted(path), PATH_PATTERN, joined), SEPARATOR))
    part = {name: F.nullif(F.get("__parts", F.lit(i)), F.lit("")) for i, name in enumerate(PATH_PARTS)}
    part["start_date"] = _day(part["start_date"])
    part["end_date"] = _day(part["end_date"])
    part["index"] = part["index"].cast("int")
    parsed = F.struct(*[column.alias(name) for name, column in part.items()])
    none = F.lit(None).cast(MANIFEST_TYPE)
    # A one-element list keeps later filters above the parsing, so they do not run the pattern again.
    row = F.array(F.when(F.size("__parts") == len(PATH_PARTS), parsed).otherwise(none))
    return cut.select(*[quoted(n) for n in df.columns], F.inline(row))


def read_named_files(
    spark: SparkSession,
    root: str,
    family: str | None,
    folder: str,
    table: str | None = None,
    schema: T.StructType | str | None = None,
    file_date: str = "file_date",
) -> DataFrame:
    """Rows of the files of one table in a folder of named files, with the first day of their name.

    A folder may hold files of several tables (sub-tables stay with their parent); ``table`` names the one to
    read, the folder's own if none. Table and day come from the file's path, so filters on them skip files
    before they are opened.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    df = reader.parquet(table_path(root, family, folder))
    # The first part of the path that ends like a file of the layout: the file, or the folder a job wrote as one.
    pattern = rf"/([^/]+?){NAME_ENDING}(?:/|$)"
    path = F.col("_metadata.file_path")
    return df.filter(F.regexp_extract(path, pattern, 1) == F.lit(table or folder)).withColumn(
        file_date, _day(F.regexp_extract(path, pattern, 2))
    )


def covered_days(df: DataFrame, path: str = "path", day: str = "day", keep_empty: bool = False) -> DataFrame:
    """One row per day a file covers: a single date covers itself, a range all days but its end,
    a name without date none. ``keep_empty`` keeps a dated file that covers no day, with null."""
    name = F.substring_index(quoted(path), "/", -1)
    dated = df.withColumns(
        {
            "__first": _day(F.regexp_extract(name, NAME_DATE, 1)),
            "__last": _day(F.regexp_extract(name, NAME_RANGE, 1)),
        }
    )
    first, last = F.col("__first"), F.col("__last")
    days = F.when(last.isNull(), F.array(first)).otherwise(days_between(first, last))
    explode = F.explode_outer if keep_empty else F.explode
    return dated.filter(first.isNotNull()).select(*[quoted(n) for n in df.columns], explode(days).alias(day))


def newest_first(df: DataFrame, table: str = "table_name", path: str = "path") -> DataFrame:
    """Files of each table, last in name order first. A range sort on table and path: a table of very many
    files is spread over several tasks."""
    return df.orderBy(quoted(table), quoted(path).desc())


def file_positions(df: DataFrame, table: str = "table_name", path: str = "path") -> DataFrame:
    """Add the position of each file among those of its table, the last in name order being 0."""
    return order_rows(df, [quoted(table), quoted(path).desc()], "position", [table])


def newest_file(df: DataFrame, table: str = "table_name", path: str = "path") -> DataFrame:
    """The file of each table whose schema wins: the last in name order. Merged before the shuffle."""
    return df.groupBy(quoted(table)).agg(F.max(quoted(path)).alias("newest_path"))


def files_per_table(df: DataFrame, table: str = "table_name") -> DataFrame:
    """Number of files and first and last day per table."""
    return df.groupBy(quoted(table)).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.min("start_date").alias("first_day"),
        F.max(F.coalesce("end_date", "start_date")).alias("last_day"),
    )


def paths_per_table(df: DataFrame, size: int, table: str = "table_name", path: str = "path") -> DataFrame:
    """Paths of every table, as lists of at most ``size``: a table of very many files has several lists."""
    return batch_keys(df.select(quoted(table), quoted(path)).distinct(), path, size, [table], output="paths")
