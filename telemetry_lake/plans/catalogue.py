"""The built-in table catalogue and the lookups on any catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.names import quoted

# Metrics of the vehicle statistics feed and the request rate of each group.
ELECTRIC_METRICS = (
    "evStateOfChargeMilliPercent",
    "evChargingStatus",
    "evChargingEnergyMicroWh",
    "evChargingVoltageMilliVolt",
    "evChargingCurrentMilliAmp",
    "evConsumedEnergyMicroWh",
    "evRegeneratedEnergyMicroWh",
    "evBatteryStateOfHealthMilliPercent",
    "evAverageBatteryTemperatureMilliCelsius",
    "evDistanceDrivenMeters",
)
ENGINE_METRICS = (
    "ambientAirTemperatureMilliC",
    "barometricPressurePa",
    "batteryMilliVolts",
    "defLevelMilliPercent",
    "ecuSpeedMph",
    "engineCoolantTemperatureMilliC",
    "engineImmobilizer",
    "engineLoadPercent",
    "engineOilPressureKPa",
    "engineRpm",
    "engineStates",
    "faultCodes",
    "fuelPercents",
    "gpsDistanceMeters",
    "gpsOdometerMeters",
    "intakeManifoldTemperatureMilliC",
    "obdEngineSeconds",
)
ELECTRIC_RATE = 60.0
ENGINE_RATE = 50.0
DEFAULT_RATE = 5.0

# The parameter text of a date range by kind; {start} and {end} are filled per plan.
TIMES = "startTime={start},endTime={end}"
DATES = "startDate={start},endDate={end}"
MILLIS = "startMs={start},endMs={end}"

# The other tables as family, table, endpoint, parameters, rate, type.
OTHER_TABLES = (
    ("core", "addresses", "addresses", None, 5.0, "oneshot"),
    ("core", "alerts_configurations", "alerts/configurations", None, 5.0, "oneshot"),
    ("alerts", "alerts_incidents", "alerts/incidents/stream", "configurationIds={configurationIds}," + TIMES, 10.0, "time"),
    ("assets", "fleet_assets", "v1/fleet/assets", None, None, "oneshot"),
    ("assets", "fleet_assets_reefers", "v1/fleet/assets/reefers", MILLIS, None, "time"),
    ("core", "contacts", "contacts", None, None, "oneshot"),
    ("documents", "fleet_document_types", "fleet/document-types", TIMES, 5.0, "time"),
    ("documents", "fleet_documents", "fleet/documents", TIMES, 5.0, "time"),
    ("driver_vehicle_assignments", "driver_vehicle_assignments", "fleet/driver-vehicle-assignments", "filterBy=drivers," + TIMES, 5.0, "time"),
    ("drivers", "fleet_drivers", "fleet/drivers", None, None, "oneshot"),
    ("equipment", "fleet_equipment", "fleet/equipment", None, None, "oneshot"),
    ("fuel_energy", "fleet_vehicles_fuel_energy", "fleet/reports/vehicles/fuel-energy", DATES, 25.0, "time"),
    ("hours_of_service", "fleet_hos_clocks", "fleet/hos/clocks", None, None, "oneshot"),
    ("hours_of_service", "fleet_hos_daily_logs", "fleet/hos/daily-logs", DATES, 5.0, "time"),
    ("hours_of_service", "fleet_hos_violations", "fleet/hos/violations", TIMES, 5.0, "time"),
    ("fuel_energy", "fleet_vehicle_idling", "fleet/reports/vehicle/idling", "limit=512," + TIMES, 25.0, "time"),
    ("safety", "fleet_safety_events", "fleet/safety-events", TIMES, None, "time"),
    ("safety", "fleet_safety_events_audit_logs", "fleet/safety-events/audit-logs/feed", "startTime={start_iso}", 3.0, "time"),
    ("safety", "fleet_vehicle_safety_score", "v1/fleet/vehicles/{vehicleId}/safety/score", MILLIS, 3.0, "time"),
    ("trailers", "fleet_trailers", "fleet/trailers", None, 5.0, "oneshot"),
    ("vehicles", "fleet_vehicles", "fleet/vehicles", "limit=512, createdAfterTime=2025-05-01T00:00:00+00:00", 25.0, "oneshot"),
    ("core", "fleet_tags", "tags", "limit=512", 25.0, "oneshot"),
    ("core", "fleet_devices", "devices", "limit=100,includeHealth=true", 5.0, "oneshot"),
)

# Partition fields of the tables outside the vehicle statistics feed.
PARTITION_FIELDS = {
    "fleet_vehicles_fuel_energy": "date",
    "fleet_vehicle_idling": "startTime",
    "fleet_safety_events": "time",
}
CLUSTER_FIELDS = ["vehicle_id"]

# Tables whose requests need more than a date range, as type, constraint, source table, source
# column, parameter, place to fill, whether keys go in one list.
EXCEPTIONS = {
    "alerts_incidents": ("table", "dynamic_url", "alerts_configurations", "vehicle_id", "configurationIds", "params", 1),
    "fleet_vehicles_fuel_energy": ("date", "is_data_but_datetime", None, None, None, None, None),
    "fleet_safety_events_audit_logs": ("date", "only_start_date", None, None, None, None, None),
    "fleet_vehicle_safety_score": ("table", "dynamic_url", "fleet_vehicles", "vehicle_id", "vehicleId", "endpoint", 0),
}

# Sub-tables of each main table.
SUB_TABLES = {
    "fleet_vehicle_stats_faultCodes": (
        "fleet_vehicle_stats_faultCodes_obdii",
        "fleet_vehicle_stats_faultCodes_j1939",
    ),
    "fleet_assets_reefers": (
        "ReeferStats_engineHours",
        "ReeferStats_fuelPercentage",
        "ReeferStats_returnAirTemperature",
        "ReeferStats_ambientAirTemperature",
        "ReeferStats_dischargeAirTemperature",
        "ReeferStats_setPoint",
        "ReeferStats_powerStatus",
        "ReeferStats_reeferAlarms",
    ),
    "fleet_tags": (
        "fleet_tags_vehicles",
        "fleet_tags_assets",
        "fleet_tags_sensors",
        "fleet_tags_addresses",
        "fleet_tags_drivers",
    ),
    "fleet_devices": ("fleet_devices_healthReasons", "fleet_devices_health"),
}
MAIN_TABLE = {sub: main for main, subs in SUB_TABLES.items() for sub in subs}


def _stat(metric: str) -> str:
    return f"fleet_vehicle_stats_{metric}"


# Tables that run when none are named, by category.
DEFAULT_TABLES = {
    "ev": tuple(sorted(_stat(m) for m in ELECTRIC_METRICS)),
    "time": (
        *(_stat(m) for m in ("obdEngineSeconds", "engineStates", "gpsOdometerMeters", "ecuSpeedMph", "faultCodes")),
        "fleet_vehicles_fuel_energy",
        "fleet_safety_events",
        "fleet_assets_reefers",
        "fleet_vehicle_idling",
    ),
    "stats": tuple(
        _stat(m)
        for m in (
            "intakeManifoldTemperatureMilliC",
            "engineRpm",
            "engineOilPressureKPa",
            "engineLoadPercent",
            "engineImmobilizer",
            "engineCoolantTemperatureMilliC",
            "defLevelMilliPercent",
            "batteryMilliVolts",
            "barometricPressurePa",
            "ambientAirTemperatureMilliC",
        )
    ),
    "core": ("fleet_vehicles", "fleet_assets", "fleet_trailers", "fleet_tags", "fleet_devices"),
}

EXCEPTION_TYPE = T.StructType(
    [
        T.StructField("exception_type", T.StringType()),
        T.StructField("constraint", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("table_column_name", T.StringType()),
        T.StructField("exception_param_name", T.StringType()),
        T.StructField("key_to_apply_on", T.StringType()),
        T.StructField("is_list", T.IntegerType()),
    ]
)
CATALOGUE_TYPE = T.StructType(
    [
        T.StructField("family", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("params", T.StringType()),
        T.StructField("is_processed", T.IntegerType()),
        T.StructField("rate_limit_per_seconde", T.DoubleType()),
        T.StructField("is_exception", T.IntegerType()),
        T.StructField("exception_config", EXCEPTION_TYPE),
        T.StructField("delta_days", T.IntegerType()),
        T.StructField("download_type", T.StringType()),
        T.StructField("time_partitioning_field", T.StringType()),
        T.StructField("clustering_fields", T.ArrayType(T.StringType())),
    ]
)


def catalogue_rows() -> list[tuple]:
    """The 50 tables; ``params`` keeps ``{start}`` and ``{end}`` open."""
    rows = []
    for metrics, rate in ((ELECTRIC_METRICS, ELECTRIC_RATE), (ENGINE_METRICS, ENGINE_RATE)):
        for metric in metrics:
            rows.append(
                (
                    "vehicle_stats", _stat(metric), "fleet/vehicles/stats/history", f"Types={metric},{TIMES}",
                    0, rate, 0, None, 1, "time", "time", CLUSTER_FIELDS,
                )
            )
    for family, table, endpoint, params, rate, kind in OTHER_TABLES:
        field = PARTITION_FIELDS.get(table)
        rows.append(
            (
                family, table, endpoint, params, 0, rate, int(table in EXCEPTIONS), EXCEPTIONS.get(table),
                1 if kind == "time" else None, kind, field, CLUSTER_FIELDS if field else None,
            )
        )
    return rows


def catalogue(spark: SparkSession) -> DataFrame:
    """The built-in catalogue as a DataFrame."""
    return spark.createDataFrame(catalogue_rows(), CATALOGUE_TYPE)


def main_table(table: Column) -> Column:
    """Main table of a built-in sub-table, the table itself otherwise: 17 literal entries, no join."""
    pairs = [F.lit(text) for item in MAIN_TABLE.items() for text in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), table), table)


def resolve_alias(
    df: DataFrame, alias: DataFrame | None = None, column: str = "table_name", output: str = "main_table"
) -> DataFrame:
    """Add the main table of each row; without ``alias`` (sub_table, main_table) the built-in one is used."""
    if alias is None:
        return df.withColumn(output, main_table(quoted(column)))
    named = alias.select(F.col("sub_table").alias("__sub"), F.col("main_table").alias("__main"))
    joined = df.join(named, quoted(column) == F.col("__sub"), "left")
    return joined.select(*[quoted(n) for n in df.columns], F.coalesce("__main", quoted(column)).alias(output))


FLAGS = (
    "is_exception_row",
    "is_exception_date",
    "is_exception_only_start_date",
    "is_exception_table",
    "is_date_range",
    "is_vehicle_stats",
    "is_downloadable_oneshot",
)


def classify(df: DataFrame) -> DataFrame:
    """Add seven flags that say how a table is requested."""

    def yes(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    exception = yes(F.col("is_exception") == 1)
    config = F.col("exception_config")
    on_date = exception & yes(config["exception_type"] == "date")
    has_end = reduce(
        lambda a, b: a | b, [yes(F.col("params").contains(text)) for text in ("endDate", "endTime", "endMs")]
    )
    date_range = ~exception & has_end
    stats = yes(F.col("family") == "vehicle_stats")
    return df.withColumns(
        {
            "is_exception_row": exception,
            "is_exception_date": on_date & yes(config["constraint"] == "is_data_but_datetime"),
            "is_exception_only_start_date": on_date & yes(config["constraint"] == "only_start_date"),
            "is_exception_table": exception & yes(config["exception_type"] == "table"),
            "is_date_range": date_range,
            "is_vehicle_stats": stats,
            "is_downloadable_oneshot": ~stats & ~exception & ~date_range,
        }
    )


def select_class(df: DataFrame, flag: str | None = None, tables: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Catalogue rows of one class (all if none), of the listed tables only if a list is given."""
    picked = df if tables is None else semi_join_tables(df, tables)
    if flag is None:
        return picked
    if flag not in FLAGS:
        raise ValueError(f"unknown class: {flag}")
    return classify(picked).filter(F.col(flag)).drop(*FLAGS)


def semi_join_tables(df: DataFrame, tables: DataFrame | Sequence[str], column: str = "table_name") -> DataFrame:
    """Rows whose table is in a list (literal) or in the first column of a DataFrame."""
    if isinstance(tables, DataFrame):
        wanted = tables.select(quoted(tables.columns[0]).alias("__wanted"))
        return df.join(wanted, quoted(column) == F.col("__wanted"), "left_semi")
    return df.filter(quoted(column).isin(*tables)) if tables else df.filter(F.lit(False))


def select_tables(
    spark: SparkSession,
    df: DataFrame,
    choice: str | None = None,
    tables_file: str | None = None,
    categories: DataFrame | None = None,
) -> DataFrame:
    """Catalogue rows to run: ``ALL``, the first column of a CSV file, a category, or the default list.

    ``categories`` (category, table_name) replaces the built-in categories.
    """
    if choice == "ALL":
        return df
    if tables_file is not None:
        return semi_join_tables(df, spark.read.option("header", "true").csv(tables_file))
    if categories is not None:
        chosen = categories if choice is None else categories.filter(F.col("category") == choice)
        return semi_join_tables(df, chosen.select("table_name"))
    if choice is not None:
        if choice not in DEFAULT_TABLES:
            raise ValueError(f"unknown category: {choice}")
        return semi_join_tables(df, DEFAULT_TABLES[choice])
    return semi_join_tables(df, [name for names in DEFAULT_TABLES.values() for name in names])
