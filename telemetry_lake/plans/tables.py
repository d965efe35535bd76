"""The declared tables: which steps each raw table takes, and which tables split into which."""

from __future__ import annotations

from collections.abc import Collection
from functools import lru_cache

from pyspark.sql import Column, DataFrame

from telemetry_lake.operators.split import SubTable, split_table
from telemetry_lake.plans.catalogue import ELECTRIC_METRICS, SUB_TABLES
from telemetry_lake.plans.steps import Step, run_steps, step

# Setting that names the outside system whose identifiers the tables drop, where a call does not name it.
EXTERNAL_SYSTEM = "telemetry_lake.externalSystem"


def external_ids(system: str | None) -> list[str]:
    """The columns that carry identifiers of an outside system; those of other systems stay."""
    if system is None:
        return []
    return [f"{owner}externalIds_{system}_{kind}" for owner in ("", "vehicle_") for kind in ("serial", "vin")]


def default_steps(system: str | None = None) -> tuple[Step, ...]:
    """Closing steps of most tables."""
    return (
        step("rename", mapping={"id": "vehicle_id", "name": "parc_id"}),
        step("drop", columns=external_ids(system)),
        step("cast", columns=["time"], dtype="datetime"),
        step("distinct"),
    )


# Metrics whose readings are plain (time, value) lists.
STAT_METRICS = (
    *ELECTRIC_METRICS,
    "obdEngineSeconds",
    "engineStates",
    "gpsOdometerMeters",
    "ecuSpeedMph",
    "intakeManifoldTemperatureMilliC",
    "engineRpm",
    "engineOilPressureKPa",
    "engineLoadPercent",
    "engineCoolantTemperatureMilliC",
    "defLevelMilliPercent",
    "batteryMilliVolts",
    "barometricPressurePa",
    "ambientAirTemperatureMilliC",
)


def stat_steps(metric: str, system: str | None = None) -> tuple[Step, ...]:
    """Readings of one metric, one row each."""
    return (
        step("explode", column=metric),
        step("normalize", column=metric),
        step("drop", columns=[metric]),
        step("rename", mapping={"value": metric}),
        *default_steps(system),
    )


# The refrigeration feeds; what the value column becomes, and whether rows without a value but with a
# time stay apart from rows without both.
REEFER_TEMPERATURES = ("returnAirTemperature", "ambientAirTemperature", "dischargeAirTemperature", "setPoint")


def reefer_steps(feed: str, system: str | None = None) -> tuple[Step, ...]:
    """Readings of one refrigeration feed, first per asset and moment."""
    column = f"ReeferStats_{feed}"
    names = {"changedAtMs": f"{feed}ChangedAt", "id": "asset_id", "name": "asset_name"}
    required = ["changedAtMs"]
    nested: tuple[Step, ...] = ()
    closing: tuple[Step, ...] = ()
    if feed in REEFER_TEMPERATURES:
        names["tempInMilliC"] = f"{feed}MilliCelsius"
        required.append("tempInMilliC")
    elif feed == "powerStatus":
        names["status"] = "powerStatus"
        closing = default_steps(system)
    elif feed == "reeferAlarms":
        # One alarm per asset and moment stays, as declared; which one is fixed by the order of distinct_on.
        nested = (step("explode", column="alarms"), step("normalize", column="alarms", prefix="alarm_"))
        required = ["alarm_alarmCode"]
        closing = default_steps(system)
    return (
        step("explode", column=column),
        step("normalize", column=column),
        step("epoch", columns=["changedAtMs"], unit="ms"),
        *nested,
        step("drop_nulls", columns=required),
        step("distinct_on", keys=["id", "changedAtMs"], scope=["file_date"]),
        step("rename", mapping=names),
        *closing,
    )


def fault_code_steps() -> tuple[Step, ...]:
    return (
        step("explode", column="faultCodes"),
        step("normalize", column="faultCodes"),
        step("cast", columns=["time"], dtype="datetime"),
    )


def obdii_steps(system: str | None = None) -> tuple[Step, ...]:
    """All combinations of pending, permanent and confirmed codes of one transmitter."""
    kinds = ("pending", "permanent", "confirmed")
    return (
        step("explode", column="obdii_diagnosticTroubleCodes"),
        step("normalize", column="obdii_diagnosticTroubleCodes", prefix="obdii_"),
        *(step("unique_items", column=f"obdii_{kind}Dtcs") for kind in kinds),
        *(step("explode", column=f"obdii_{kind}Dtcs") for kind in kinds),
        *(step("normalize", column=f"obdii_{kind}Dtcs", prefix=f"obdii_{kind}_") for kind in kinds),
        step("rename", mapping={"obdii_checkEngineLightIsOn": "obdii_engine_light_on"}),
        step(
            "drop_nulls",
            columns=["obdii_engine_light_on", "obdii_txId", *(f"obdii_{kind}_dtcId" for kind in kinds)],
        ),
        *default_steps(system),
    )


def j1939_steps(system: str | None = None) -> tuple[Step, ...]:
    lights = {
        f"j1939_checkEngineLights_{kind}IsOn": f"j1939_{kind}_engine_light_On"
        for kind in ("protect", "warning", "stop", "emissions")
    }
    codes = [f"j1939_diag_trouble_codes_{kind}" for kind in ("spnId", "fmiId")]
    return (
        step("explode", column="j1939_diagnosticTroubleCodes"),
        step("normalize", column="j1939_diagnosticTroubleCodes", prefix="j1939_diag_trouble_codes_"),
        step("rename", mapping=lights),
        step("drop_nulls", columns=[*lights.values(), *codes]),
        *default_steps(system),
    )


def fuel_energy_steps(date: str | Column | None = None, system: str | None = None) -> tuple[Step, ...]:
    """Fuel report of one day; ``date`` is its text (underscores allowed) or a column that holds it."""
    text = date.replace("_", "-") if isinstance(date, str) else date
    amounts = ["efficiencyMpge", "energyUsedKwh", "estFuelEnergyCost_amount", "estCarbonEmissionsKg"]
    return (
        step("set", column="date", value=text),
        step("cast", columns=amounts, dtype="float"),
        step("rename", mapping={"vehicle_name": "parc_id"}),
        step("cast", columns=["date"], dtype="datetime"),
        *default_steps(system),
    )


def member_steps(column: str, prefix: str, system: str | None = None) -> tuple[Step, ...]:
    """Members listed in a column, one row each."""
    return (step("explode", column=column), step("normalize", column=column, prefix=prefix), *default_steps(system))


@lru_cache
def declared_steps(system: str | None = None) -> dict[str, tuple[Step, ...]]:
    """Steps of every table, for the outside system whose identifiers go."""
    tables = {f"fleet_vehicle_stats_{metric}": stat_steps(metric, system) for metric in STAT_METRICS}
    tables |= {sub: reefer_steps(sub.removeprefix("ReeferStats_"), system) for sub in SUB_TABLES["fleet_assets_reefers"]}
    tables |= {
        f"fleet_tags_{members}": member_steps(members, prefix, system)
        for members, prefix in (
            ("vehicles", "vehicle_"),
            ("assets", "asset_"),
            ("sensors", "sensor_"),
            ("addresses", "address_"),
            ("drivers", "driver_"),
        )
    }
    tables["fleet_vehicle_stats_engineImmobilizer"] = (
        step("explode", column="engineImmobilizer"),
        step("normalize", column="engineImmobilizer", prefix="engine_immobilizer_"),
        step("rename", mapping={"engine_immobilizer_time": "time"}),
        *default_steps(system),
    )
    tables["fleet_vehicle_stats_faultCodes"] = fault_code_steps()
    tables["fleet_vehicle_stats_faultCodes_obdii"] = obdii_steps(system)
    tables["fleet_vehicle_stats_faultCodes_j1939"] = j1939_steps(system)
    tables["fleet_vehicles_fuel_energy"] = fuel_energy_steps(system=system)
    tables["fleet_vehicle_idling"] = (
        step("cast", columns=["startTime", "endTime"], dtype="datetime"),
        step("rename", mapping={"vehicle_name": "name", "vehicle_id": "id"}),
        step("drop_nulls", columns=["address_formatted"]),
        *default_steps(system),
    )
    tables["fleet_safety_events"] = (
        step("cast", columns=["time"], dtype="datetime"),
        step("explode", column="behaviorLabels"),
        step("normalize", column="behaviorLabels", prefix="behavior_"),
        step("rename", mapping={"id": "event_id"}),
        *default_steps(system),
    )
    as_vehicle = {"id": "vehicle_id", "name": "parc_id"}
    tables["fleet_vehicles"] = (
        step("drop", columns=["tags", "sensorConfiguration_areas", "sensorConfiguration_doors", "attributes"]),
        step("rename", mapping=as_vehicle),
    )
    tables["fleet_assets"] = (
        step("explode", column="assets"),
        step("normalize", column="assets"),
        step("rename", mapping={"id": "asset_id", "name": "asset_name"}),
    )
    tables["fleet_trailers"] = (step("drop", columns=["tags"]), step("rename", mapping=as_vehicle))
    tables["fleet_tags"] = (
        step("rename", mapping={"id": "tag_id", "name": "tag_name"}),
        step("drop", columns=["machines"]),
    )
    tables["fleet_devices"] = default_steps(system)
    tables["fleet_devices_health"] = (step("drop", columns=["health_healthReasons"]), *default_steps(system))
    tables["fleet_devices_healthReasons"] = (
        step("explode", column="health_healthReasons"),
        step("normalize", column="health_healthReasons"),
        *default_steps(system),
    )
    return tables


TABLE_STEPS = declared_steps()

# Shared columns and outputs of the tables that split; {system} stands for the outside system.
SPLITS: dict[str, tuple[list[str], dict[str, SubTable]]] = {
    "fleet_vehicle_stats_faultCodes": (
        ["id", "name", "time", "canBusType"],
        {
            f"fleet_vehicle_stats_faultCodes_{protocol}": SubTable(prefix=f"{protocol}_")
            for protocol in ("obdii", "j1939")
        },
    ),
    "fleet_assets_reefers": (
        ["assetType", "id", "name"],
        {sub: SubTable(columns=[sub]) for sub in SUB_TABLES["fleet_assets_reefers"]},
    ),
    "fleet_tags": (
        ["tag_id", "tag_name", "externalIds_{system}_name", "parentTagId", "parentTag_id", "parentTag_name"],
        {sub: SubTable(columns=[sub.removeprefix("fleet_tags_")]) for sub in SUB_TABLES["fleet_tags"]},
    ),
    "fleet_devices": (
        ["asset_id", "asset_name"],
        {
            "fleet_devices_healthReasons": SubTable(columns=["health_healthReasons"]),
            "fleet_devices": SubTable(
                columns=[
                    "serial",
                    "model",
                    "lastConnectedTime",
                    "lastKnownLocation_latitude",
                    "lastKnownLocation_longitude",
                    "lastKnownLocation_id",
                ]
            ),
            "fleet_devices_health": SubTable(prefix="health_"),
        },
    ),
}

# Landed already transformed, so the transform stage passes it through.
TRANSFORMED_AT_LANDING = ("fleet_vehicles_fuel_energy",)


def _system(df: DataFrame, external_system: str | None) -> str | None:
    return external_system or df.sparkSession.conf.get(EXTERNAL_SYSTEM, None)


def split_plan(df: DataFrame, table: str, external_system: str | None = None) -> tuple[list[str], dict[str, SubTable]]:
    """Shared columns and outputs of a table that splits."""
    shared, outputs = SPLITS[table]
    system = _system(df, external_system)
    return [n.format(system=system) for n in shared if system or "{system}" not in n], outputs


def transform_table(
    df: DataFrame,
    table: str,
    passthrough: Collection[str] = (),
    on_error: str = "raise",
    date: str | Column | None = None,
    external_system: str | None = None,
) -> DataFrame:
    """Run the steps declared for a table; tables without steps, and those passed through, stay unchanged.

    ``external_system`` (else the session's ``telemetry_lake.externalSystem``) names the outside system whose four
    identifier columns go; identifiers of other systems stay.
    """
    if table in passthrough:
        return df
    system = _system(df, external_system)
    steps = (
        fuel_energy_steps(date, system) if table == "fleet_vehicles_fuel_energy" else declared_steps(system).get(table, ())
    )
    return run_steps(df, steps, on_error)


def split_only(df: DataFrame, table: str, external_system: str | None = None) -> dict[str, DataFrame]:
    """Sub-tables of a table as they are cut, or the table itself under its name."""
    if table not in SPLITS:
        return {table: df}
    shared, outputs = split_plan(df, table, external_system)
    return split_table(df, shared, outputs)


def split_and_transform(
    df: DataFrame, table: str, on_error: str = "raise", external_system: str | None = None
) -> dict[str, DataFrame]:
    """Split a transformed table and run each sub-table's own steps; a table that does not split stays as it is."""
    if table not in SPLITS:
        return {table: df}
    return {
        name: transform_table(part, name, on_error=on_error, external_system=external_system)
        for name, part in split_only(df, table, external_system).items()
    }
