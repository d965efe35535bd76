"""The same table transforms in plain pandas and in Spark, from the same nested Parquet files.

usage: python benchmarks/pandas_side_by_side.py [scale folder] [copies]

The nested files are written once to the shared folder (``copies`` times the rows); both sides then read them,
transform and keep the result without writing it; both run twice, and the second time counts. pandas runs on one core, as libraries of its kind do.
"""

from __future__ import annotations

import json
import os
import sys
import time

import pandas as pd
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lake_queries import fixtures  # noqa: E402
from telemetry_lake import build_session, scratch_path  # noqa: E402
from telemetry_lake.plans import tables  # noqa: E402

RENAME = {"id": "vehicle_id", "name": "parc_id"}


def lists_to_columns(df: pd.DataFrame, column: str, prefix: str = "") -> pd.DataFrame:
    df = df.explode(column, ignore_index=True)
    flat = pd.json_normalize([v if isinstance(v, dict) else {} for v in df[column]], sep="_").add_prefix(prefix)
    return pd.concat([df.drop(columns=[column]), flat], axis=1)


def stat(df: pd.DataFrame) -> pd.DataFrame:
    df = lists_to_columns(df, "engineRpm").rename(columns={"value": "engineRpm", **RENAME})
    df = df.drop(columns=["externalIds_fleet_serial", "externalIds_fleet_vin"])
    df["time"] = pd.to_datetime(df["time"], errors="coerce", utc=True)
    return df.drop_duplicates()


def reefer(df: pd.DataFrame) -> pd.DataFrame:
    df = lists_to_columns(df[["assetType", "id", "name", "ReeferStats_setPoint"]], "ReeferStats_setPoint")
    df["changedAtMs"] = pd.to_datetime(df["changedAtMs"], unit="ms", errors="coerce")
    df = df[~df[["changedAtMs", "tempInMilliC"]].isnull().all(axis=1)]
    return df.drop_duplicates(subset=["id", "changedAtMs"])


def safety(df: pd.DataFrame) -> pd.DataFrame:
    df["time"] = pd.to_datetime(df["time"], errors="coerce", utc=True)
    return lists_to_columns(df, "behaviorLabels", "behavior_").rename(columns={"id": "event_id"}).drop_duplicates()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    spark = build_session(
        "side by side",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    cases = {
        "vehicle_stat": (
            fixtures.vehicle_stat(spark, sf_dir, "engineRpm", 0),
            stat,
            lambda df: tables.transform_table(df, "fleet_vehicle_stats_engineRpm"),
        ),
        "reefer_set_point": (
            fixtures.reefers(spark, sf_dir),
            reefer,
            lambda df: tables.split_and_transform(df, "fleet_assets_reefers")["ReeferStats_setPoint"],
        ),
        "safety_events": (
            fixtures.safety_events(spark, sf_dir),
            safety,
            lambda df: tables.transform_table(df, "fleet_safety_events"),
        ),
    }
    for name, (raw, in_pandas, in_spark) in cases.items():
        path = scratch_path(spark, f"raw-{name}")
        for copy in range(copies):
            key = raw.columns[0] if name != "reefer_set_point" else "id"
            part = raw.withColumn(key, F.concat(F.col(key), F.lit(f"c{copy}"))) if copy else raw
            part.write.mode("append").parquet(path)
        for _ in range(2):
            started = time.perf_counter()
            n_pandas = len(in_pandas(pd.read_parquet(path.removeprefix("file:"))))
            pandas_seconds = time.perf_counter() - started
        for _ in range(2):
            started = time.perf_counter()
            in_spark(spark.read.parquet(path)).write.format("noop").mode("overwrite").save()
            spark_seconds = time.perf_counter() - started
        n_spark = in_spark(spark.read.parquet(path)).count()
        print(
            json.dumps(
                {
                    "case": name,
                    "copies": copies,
                    "pandas_seconds": round(pandas_seconds, 2),
                    "spark_seconds": round(spark_seconds, 2),
                    "rows_pandas": n_pandas,
                    "rows_spark": n_spark,
                }
            ),
            flush=True,
        )


if __name__ == "__main__":
    main()
