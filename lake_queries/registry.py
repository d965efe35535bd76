"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from telemetry_lake.operators.columns import zoneless_timestamps
from telemetry_lake.plans.tables import EXTERNAL_SYSTEM
from telemetry_lake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its timestamps leave without zone, as files and the SQL side have them."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query exists: {name}")

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark).conf.set(EXTERNAL_SYSTEM, "fleet")
            return zoneless_timestamps(function(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add
