"""Lake folders of Parquet files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.operators.columns import zoneless_timestamps
from telemetry_lake.sources.versions import files_below, remove

# Fixed value: the part of a file name that starts with its date.
FILE_SUFFIX = r"^[a-zA-Z0-9_]+?_(\d{4}_\d{2}_\d{2}.*)"


def table_path(root: str, family: str | None, table: str) -> str:
    return "/".join([root.rstrip("/"), *([family] if family else []), table])


def read_table(
    spark: SparkSession,
    root: str,
    family: str | None,
    table: str,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    merge_schema: bool = True,
) -> DataFrame:
    """All Parquet files of one table, below exactly its own folder.

    With a schema no file footer is read for planning; without one, footers are merged so that columns added
    later are there (a Spark job over all footers: give the schema for tables of very many files).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(table_path(root, family, table))
    return df.select(*[quoted(n) for n in columns]) if columns else df


def read_since(df: DataFrame, watermark: Column, date: Column) -> DataFrame:
    """Rows dated at the watermark or later, and undated rows. Over ``file_date`` partitions, or over
    ``_metadata.file_name``, Spark skips the other files before reading them."""
    return df.filter(date.isNull() | watermark.isNull() | (date >= watermark))


def file_suffix(name: Column) -> Column:
    """Part of a file name from its date on, null if it has none."""
    return F.nullif(F.regexp_extract(name, FILE_SUFFIX, 1), F.lit(""))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with timestamps in microseconds and without zone."""
    zoneless_timestamps(df).write.mode(mode).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = ("file_date",),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write ``path/<partition>=<value>/…``; a partition written again is replaced, others stay.

    Rebalancing brings the rows of a partition together in files of the advised size and lets Spark split a
    partition that is much larger than the others; sorting inside gives narrow min/max ranges per file.
    """
    keys = [quoted(n) for n in partitions]
    out = zoneless_timestamps(df).hint("rebalance", *keys)
    out = out.sortWithinPartitions(*keys, *[quoted(n) for n in cluster_by])
    writer = out.write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


@contextmanager
def replacing(spark: SparkSession, path: str, days: Iterable[object], day: str = "file_date") -> Iterator[None]:
    """Around a write with dynamic overwrite: all that these days held goes once the write has ended.

    The write itself replaces the partitions that it has rows for; a day that is redone to no rows, or to fewer parts,
    would keep the rest. A write that fails leaves everything, and one that stopped after it is mended by repeating it.
    """
    folders = [f"{path}/{day}={'__HIVE_DEFAULT_PARTITION__' if one is None else one}" for one in days]
    before = {folder: files_below(spark, folder) for folder in folders}
    yield
    for folder, files in before.items():
        if files:
            for stale in files & files_below(spark, folder):
                remove(spark, stale)


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Paths below a root, relative to it. Only the listing is read, never the content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    base = urlparse(root).path.rstrip("/") + "/"
    return files.select(
        F.substr("path", F.instr("path", base) + len(base)).alias("path"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("bytes"),
    )


def newest_schema(spark: SparkSession, root: str, paths: DataFrame) -> T.StructType:
    """Schema of the newest file, taken as the last path in name order: one footer is read."""
    newest = paths.agg(F.max("path")).first()[0]
    if newest is None:
        raise ValueError("no files")
    return spark.read.parquet(f"{root.rstrip('/')}/{newest}").schema


def conform_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order, absent ones null; columns it does not know follow."""
    known = {f.name for f in schema.fields}
    present = set(df.columns)
    columns = [
        (quoted(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns, *[quoted(n) for n in df.columns if n not in known])
