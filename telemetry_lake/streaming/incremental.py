"""Incremental ingest, duplicate removal and multi-table writes as ``availableNow`` streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.operators.columns import zoneless_timestamps
from telemetry_lake.plans.tables import split_and_transform, transform_table

BATCH_COLUMN = "batch_id"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """Stream of the Parquet files of a folder; each file is read once per checkpoint."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def ingest(stream: DataFrame, target: str, checkpoint: str, partitions: Sequence[str] = ()) -> None:
    """Append what has arrived since the last run to a folder, then stop. The checkpoint is the progress."""
    writer = zoneless_timestamps(stream).writeStream.option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.trigger(availableNow=True).format("parquet").outputMode("append").start(target).awaitTermination()


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str, delay: str, salts: int = 16) -> DataFrame:
    """Stream without rows delivered again.

    ``delay`` says how much later a repetition may come, in the time of the data; state older than that is
    let go, so it stays bounded by the rows of that span. A row that comes later than ``delay`` is taken for a
    repetition, also if it was never there; where that may happen, ``ingest_distinct`` looks at the target instead.

    A key delivered very often would send all its copies to one task. With ``salts`` the copies are first
    reduced within that many parts, by the task that read them, and then across the parts; which part a copy
    falls in has no effect on the result. ``salts=0`` spares the second state where keys repeat rarely.
    """
    timed = stream.withWatermark(time, delay)
    if salts:
        parted = timed.withColumn("__part", F.spark_partition_id() % F.lit(salts))
        timed = parted.dropDuplicatesWithinWatermark([*keys, "__part"]).drop("__part")
    return timed.dropDuplicatesWithinWatermark(list(keys))


def ingest_distinct(stream: DataFrame, keys: Sequence[str], day: str, target: str, checkpoint: str) -> None:
    """Append the rows whose keys are not in the target yet, however late they come, then stop.

    ``day`` is a date column and part of the key. The target lies by day and batch, and a batch reads the keys of its
    own days only; a batch run again replaces what it had written. Nulls are equal to each other.
    """
    wanted = list(dict.fromkeys([day, *keys]))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = zoneless_timestamps(batch.dropDuplicates(wanted))
        try:
            # The calendar bounds the days of a batch.
            known = spark.read.schema(fresh.withColumn(BATCH_COLUMN, F.lit(0).cast("bigint")).schema).parquet(target)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
        else:
            days = [row[0] for row in fresh.select(day).distinct().collect()]
            here = quoted_in(day, days) & (F.col(BATCH_COLUMN) != batch_id)
            seen = known.filter(here).select(*[quoted(n).alias(f"__{n}") for n in wanted])
            same = [quoted(n).eqNullSafe(quoted(f"__{n}")) for n in wanted]
            fresh = fresh.join(seen, same, "left_anti")
        (
            fresh.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(day, BATCH_COLUMN)
            .parquet(target)
        )

    _run_batches(stream, write, checkpoint)


def quoted_in(name: str, values: Sequence[object]) -> Column:
    """Whether a column holds one of the values, null being one of them if it is listed."""
    present = [v for v in values if v is not None]
    found = quoted(name).isin(present)
    return found | quoted(name).isNull() if len(present) < len(values) else found


def write_tables(
    stream: DataFrame,
    outputs: Callable[[DataFrame], dict[str, DataFrame]],
    root: str,
    checkpoint: str,
    partitions: Sequence[str] = (),
    parent: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write several tables from every micro-batch, then stop.

    Each batch goes to its own ``batch_id`` partition with dynamic overwrite: a batch run again after a
    failure replaces what it had written, and never what other batches wrote. What ``parent`` makes of a batch is
    written once, in place of that of the batch before, and the outputs are read from it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if parent is not None:
            whole = f"{root.rstrip('/')}/_whole"
            made = parent(batch)
            made.write.mode("overwrite").parquet(whole)
            batch = batch.sparkSession.read.schema(made.schema).parquet(whole)
        for name, table in outputs(batch).items():
            out = zoneless_timestamps(table).withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint"))
            if partitions:
                out = out.hint("rebalance", *[quoted(n) for n in partitions])
            (
                out.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*partitions, BATCH_COLUMN)
                .parquet(f"{root.rstrip('/')}/{name}")
            )

    _run_batches(stream, write, checkpoint)


def _run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def split_stream(
    stream: DataFrame, table: str, root: str, checkpoint: str, external_system: str | None = None
) -> None:
    """Transform and split every micro-batch of a raw table into its sub-tables.

    Steps run per batch, so duplicates are removed within a batch; ``ingest_distinct`` removes them across.
    """
    write_tables(
        stream,
        lambda batch: split_and_transform(batch, table, external_system=external_system),
        root,
        checkpoint,
        parent=lambda batch: transform_table(batch, table, external_system=external_system),
    )
