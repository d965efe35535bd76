"""Keyed upsert by copy on write: a batch rewrites the buckets that it touches, and a committed version names them.

A table's rows lie in buckets by a hash of their key. A version lists one folder per bucket and the schema; an upsert
writes new folders for the buckets of its batch and commits the next version, which keeps the folders of all others.
Readers have the version they began with, a write that stopped leaves nothing that a reader sees, and of two writers
at once the second starts anew from what the first committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted
from telemetry_lake.sources import versions
from telemetry_lake.sources.evolving import conform, storable, widen_schema

VERSIONS = "_versions"
BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[quoted(n) for n in keys]), F.lit(buckets)).cast("int")


def _newest(spark: SparkSession, base: str) -> tuple[int, dict]:
    found = versions.newest(spark, f"{base}/{VERSIONS}")
    return (found[0], json.loads(found[1])) if found else (0, {"buckets": 0, "folders": {}, "schema": T.StructType().jsonValue()})


def _read(spark: SparkSession, base: str, held: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(held["schema"])
    # One scan per schema in use: folders written before a type was widened keep the types they have.
    folders: dict[str, list[str]] = {}
    for bucket, (folder, written) in held["folders"].items():
        if buckets is None or int(bucket) in buckets:
            folders.setdefault(json.dumps(written), []).append(f"{base}/{folder}/{BUCKET}={bucket}")
    out = spark.createDataFrame([], storable(schema))
    for written, paths in folders.items():
        own = T.StructType.fromJson(json.loads(written))
        out = out.unionByName(conform(spark.read.schema(storable(own)).parquet(*sorted(paths)), storable(schema), own))
    return out


def read_upserted(spark: SparkSession, base: str) -> DataFrame:
    """The table as of its newest version; no footer is read for planning."""
    return _read(spark, base, _newest(spark, base)[1])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. Cut per task before the shuffle, so a key with very many
    deliveries is cheap; null keys are equal to each other."""
    first = Window.partitionBy(*[quoted(n) for n in keys]).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")


def upsert(batch: DataFrame, base: str, keys: Sequence[str], delivered: str, buckets: int = 64) -> int:
    """Put a batch into the table and give the number of the new version.

    Per key the row with the greatest ``delivered`` stays, wherever it comes from; of equal ones the batch's, then the
    one that is first by its other columns. Rows without a value in ``delivered`` yield to all others. New columns are
    added and types widened. ``buckets`` counts for a new table; later batches use the table's own number.
    """
    spark = batch.sparkSession
    while True:
        number, held = _newest(spark, base)
        count = held["buckets"] or buckets
        bucketed = batch.withColumn(BUCKET, bucket_of(keys, count))
        touched = sorted(r[0] for r in bucketed.select(BUCKET).distinct().collect())  # as many as buckets, at most
        if not touched:
            return number
        schema = widen_schema(T.StructType.fromJson(held["schema"]), batch.schema)
        stored = storable(schema)
        old = conform(_read(spark, base, held, touched), stored).withColumn("__old", F.lit(1))
        new = conform(batch, stored).withColumn("__old", F.lit(0))
        others = [F.hash(quoted(f.name)) if isinstance(f.dataType, T.MapType) else quoted(f.name) for f in stored.fields]
        merged = latest_per_key(old.unionByName(new), keys, [quoted(delivered).desc_nulls_last(), F.col("__old"), *others])
        folder = f"data/{uuid.uuid4().hex}"
        out = merged.drop("__old").withColumn(BUCKET, bucket_of(keys, count)).hint("rebalance", F.col(BUCKET))
        out.sortWithinPartitions(BUCKET, *[quoted(n) for n in keys]).write.partitionBy(BUCKET).parquet(f"{base}/{folder}")
        kept = {**held["folders"], **{str(b): [folder, schema.jsonValue()] for b in touched}}
        content = {"buckets": count, "folders": kept, "schema": schema.jsonValue()}
        try:
            return versions.commit(spark, f"{base}/{VERSIONS}", number, json.dumps(content))
        except versions.Conflict:
            versions.remove(spark, f"{base}/{folder}")
