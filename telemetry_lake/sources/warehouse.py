"""Warehouse tables: types, load modes, day partitions, clustering and added columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.functions.text import canonical_json
from telemetry_lake.functions.time import parse_timestamp
from telemetry_lake.operators.columns import zoneless_timestamps
from telemetry_lake.plans.catalogue import MAIN_TABLE

DAY_COLUMN = "load_day"


@dataclass(frozen=True)
class LoadSpec:
    """How the catalogue wants a table loaded."""

    download_type: str = "time"
    time_partitioning_field: str | None = None
    clustering_fields: Sequence[str] = ()


def load_spec(catalogue: DataFrame, table: str) -> LoadSpec:
    """Settings of a table, or of its main table, from the first catalogue row in endpoint order."""
    row = (
        catalogue.filter(F.col("table_name") == MAIN_TABLE.get(table, table))
        .orderBy("endpoint")
        .select("download_type", "time_partitioning_field", "clustering_fields")
        .first()
    )
    if row is None:
        return LoadSpec()
    return LoadSpec(row[0] or "time", row[1], tuple(row[2] or ()))


def warehouse_type(name: str, dtype: T.DataType) -> str:
    """Warehouse type of a column type; types the warehouse does not know raise."""
    if isinstance(dtype, (T.StringType, T.DateType, T.DecimalType, T.StructType, T.ArrayType, T.MapType)):
        return "STRING"
    if isinstance(dtype, T.IntegralType):
        return "INTEGER"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "FLOAT"
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    raise ValueError(f"type {dtype.simpleString()} of column {name} is not supported")


SPARK_TYPES = {"INTEGER": "bigint", "FLOAT": "double", "BOOLEAN": "boolean", "STRING": "string"}


def warehouse_schema(df: DataFrame, time_column: str | None = None) -> list[tuple[str, str]]:
    """Name and warehouse type per column; the time column is a TIMESTAMP whatever it holds."""
    return [
        (f.name, "TIMESTAMP" if f.name == time_column else warehouse_type(f.name, f.dataType))
        for f in df.schema.fields
    ]


def conform_types(df: DataFrame, time_column: str | None = None) -> DataFrame:
    """Cast every column to its warehouse type; nested values become JSON text."""
    columns = []
    for field, (name, target) in zip(df.schema.fields, warehouse_schema(df, time_column)):
        value = quoted(name)
        if target == "TIMESTAMP":
            value = parse_timestamp(value, field.dataType)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            value = F.when(value.isNotNull(), canonical_json(value, field.dataType))
        else:
            value = value.cast(SPARK_TYPES[target])
        columns.append(value.alias(name))
    return df.select(*columns)


def load_table(
    df: DataFrame, path: str, spec: LoadSpec, replace_days: bool = False, batch_day: str | None = None
) -> None:
    """Load one table in one write.

    ``oneshot`` tables are overwritten, ``time`` tables appended. With a partitioning field the table is laid out by
    its day; clustering fields order the rows inside. Two ways make a load repeatable. ``batch_day`` names a column
    with the day of the file that a row came in: the table is laid out by it first, and the batch replaces its own
    file days, so rows of other files stay, whatever day they tell of. ``replace_days`` replaces the days of the
    partitioning field instead (the batch must then hold them whole) and raises for a table without one.
    """
    out = zoneless_timestamps(df)
    cluster = [n for n in spec.clustering_fields if n in out.columns]
    field = spec.time_partitioning_field
    by_day = field is not None and field in out.columns
    oneshot = spec.download_type == "oneshot"
    layout = [batch_day] if batch_day is not None and not oneshot else []
    if by_day:
        out = out.withColumn(DAY_COLUMN, quoted(field).cast("date"))
        layout.append(DAY_COLUMN)
    if replace_days and not layout and not oneshot:
        raise ValueError("a table without partitioning field is replaced by its file days: give batch_day")
    keys = [quoted(n) for n in layout or cluster]
    if keys:
        out = out.hint("rebalance", *keys).sortWithinPartitions(*[quoted(n) for n in [*layout, *cluster]])
    if oneshot:
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    elif layout and (replace_days or batch_day is not None):
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = out.write.mode("append")
    if layout:
        writer = writer.partitionBy(*layout)
    writer.parquet(path)


def read_loaded(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A loaded table with every column any load has added (null where a load lacked it)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return reader.parquet(path)
