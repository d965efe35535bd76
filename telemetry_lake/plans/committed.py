"""A small table kept in committed versions: state, ledgers.

Every version is a folder of Parquet files of its own; it becomes the table's newest by a version file that is made
once. Two runs that began from the same version cannot both commit: the second one fails and nothing of it is seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from telemetry_lake.plans.progress import STATE_TYPE
from telemetry_lake.sources import versions

VERSIONS = "_versions"


def newest(spark: SparkSession, root: str, schema: T.StructType | str = STATE_TYPE) -> tuple[int, DataFrame | None]:
    """Number of the newest version and its table; 0 and none if nothing was committed."""
    found = versions.newest(spark, f"{root}/{VERSIONS}")
    return (0, None) if found is None else (found[0], spark.read.schema(schema).parquet(f"{root}/{found[1]}"))


def at(spark: SparkSession, root: str, number: int, schema: T.StructType | str = STATE_TYPE) -> DataFrame:
    """The table as of an earlier version."""
    return spark.read.schema(schema).parquet(f"{root}/{versions.read(spark, f'{root}/{VERSIONS}', number)}")


def commit(df: DataFrame, root: str, after: int) -> int:
    """Write a table as the version that follows ``after`` and give its number.

    Raises ``versions.Conflict`` if another run has committed since ``after`` was read; what this one wrote is removed.
    """
    spark = df.sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    try:
        return versions.commit(spark, f"{root}/{VERSIONS}", after, folder)
    except versions.Conflict:
        versions.remove(spark, f"{root}/{folder}")
        raise
