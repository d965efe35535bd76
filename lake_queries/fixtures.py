"""Raw tables as the feeds land them, derived row by row from the given tables.

Every nested list is built from the fields of its own row, so no fixture shuffles or collects; lists that are
null, empty, repeated or partly null come from the data. Comments give the rule; the SQL sides state it flat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS\\'Z\\'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(expression: str) -> str:
    return f"date_format({expression}, '{ISO}')"


TEXT_METRICS = ("engineStates", "evChargingStatus")


def vehicle_stat(spark: SparkSession, sf_dir: str, metric: str, shift: int) -> DataFrame:
    """Events as readings: errors have no list, views an empty one, others a reading given twice and a later one."""
    first, second = f"value + {shift}", f"(value + {shift}) * 2"
    if metric in TEXT_METRICS:
        first, second = "event_type", "upper(event_type)"
    reading = f"named_struct('time', {iso('ts')}, 'value', {first})"
    later = f"named_struct('time', {iso('ts + INTERVAL 1 HOUR')}, 'value', {second})"
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS id",
        "concat('V', user_id) AS name",
        "concat('S', event_id) AS externalIds_fleet_serial",
        "props AS externalIds_fleet_vin",
        f"""CASE event_type WHEN 'error' THEN NULL
            WHEN 'view' THEN array()
            ELSE array({reading}, {reading}, {later}) END AS {metric}""",
    )


def immobilizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = f"named_struct('time', {iso('ts')}, 'connected', value > 10, 'state', event_type)"
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS id",
        "concat('V', user_id) AS name",
        f"CASE WHEN event_type <> 'error' THEN array({state}, {state}) END AS engineImmobilizer",
    )


def fault_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as fault records. First lines have no record; finished ones speak OBD-II, open ones J1939."""
    obdii = """CASE WHEN l_linestatus = 'F' THEN named_struct(
        'checkEngineLightIsOn', l_tax > 0.04,
        'diagnosticTroubleCodes', array(named_struct(
            'txId', l_suppkey,
            'confirmedDtcs', CASE l_returnflag
                WHEN 'A' THEN array(named_struct('dtcId', l_partkey), named_struct('dtcId', l_partkey + 1))
                ELSE array() END,
            'pendingDtcs', CASE WHEN l_quantity > 25 THEN array(named_struct('dtcId', l_orderkey)) END,
            'permanentDtcs', CASE WHEN l_discount >= 0.05
                THEN array(named_struct('dtcId', l_suppkey), named_struct('dtcId', l_partkey))
                ELSE array(named_struct('dtcId', l_partkey)) END))) END"""
    j1939 = """CASE WHEN l_linestatus = 'O' THEN named_struct(
        'checkEngineLights', CASE WHEN l_returnflag <> 'R' THEN named_struct(
            'protectIsOn', l_tax > 0.02, 'warningIsOn', l_tax > 0.04,
            'stopIsOn', l_tax > 0.06, 'emissionsIsOn', l_discount > 0.05) END,
        'diagnosticTroubleCodes', CASE WHEN l_quantity >= 10 THEN array(
            named_struct('spnId', l_partkey, 'fmiId', l_linenumber),
            named_struct('spnId', l_suppkey, 'fmiId', l_linenumber)) END) END"""
    record = f"""named_struct('time', {iso('l_shipdate')}, 'canBusType', concat('CAN_', l_linestatus),
        'obdii', {obdii}, 'j1939', {j1939})"""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS id",
        "concat('T', l_suppkey) AS name",
        f"CASE WHEN l_linenumber > 1 THEN array({record}) END AS faultCodes",
    )


def reefers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as refrigeration records at the start of their month: finished orders have no list, pending ones a
    record without time (urgent ones with a value), open ones two readings an hour apart."""
    moment = "unix_millis(cast(date_trunc('month', o_orderdate) AS timestamp))"

    def readings(value: str, kind: str, name: str) -> str:
        item = "named_struct('changedAtMs', cast({0} AS bigint), '" + name + "', cast({1} AS " + kind + "))"
        none = item.format("NULL", f"CASE WHEN o_orderpriority = '1-URGENT' THEN {value} END")
        return f"""CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN array({none})
            ELSE array({item.format(moment, value)}, {item.format(moment + ' + 3600000', value)}) END"""

    alarms = """CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '1-URGENT'
        THEN array(named_struct('alarmCode', 'A1', 'severity', o_orderkey),
                   named_struct('alarmCode', 'A2', 'severity', o_orderkey))
        ELSE array(named_struct('alarmCode', o_orderstatus, 'severity', o_orderkey)) END"""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority AS assetType",
        "cast(o_custkey AS string) AS id",
        "concat('R', o_custkey) AS name",
        f"{readings('o_orderkey', 'bigint', 'engineHours')} AS ReeferStats_engineHours",
        f"{readings('o_orderkey + 1', 'bigint', 'fuelPercentage')} AS ReeferStats_fuelPercentage",
        f"{readings('round(o_totalprice)', 'bigint', 'tempInMilliC')} AS ReeferStats_returnAirTemperature",
        f"{readings('round(o_totalprice) + 1', 'bigint', 'tempInMilliC')} AS ReeferStats_ambientAirTemperature",
        f"{readings('round(o_totalprice) + 2', 'bigint', 'tempInMilliC')} AS ReeferStats_dischargeAirTemperature",
        f"{readings('round(o_totalprice) + 3', 'bigint', 'tempInMilliC')} AS ReeferStats_setPoint",
        f"{readings('o_orderpriority', 'string', 'status')} AS ReeferStats_powerStatus",
        f"""CASE WHEN o_orderstatus <> 'F' THEN array(named_struct('changedAtMs', {moment}, 'alarms', {alarms}))
            END AS ReeferStats_reeferAlarms""",
    )


def safety_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = "named_struct('label', event_type, 'source', props)"
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id AS string) AS id",
        f"CASE WHEN event_type = 'signup' THEN 'soon' ELSE {iso('ts')} END AS time",
        "cast(user_id AS string) AS vehicle_id",
        f"CASE WHEN event_type = 'view' THEN NULL ELSE array({label}, {label}) END AS behaviorLabels",
    )


def fuel_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS vehicle_id",
        "c_name AS vehicle_name",
        "cast(c_acctbal AS string) AS efficiencyMpge",
        "c_nationkey AS energyUsedKwh",
        "cast(c_nationkey AS string) AS estFuelEnergyCost_amount",
        "c_acctbal AS estCarbonEmissionsKg",
        "c_mktsegment AS vehicle_externalIds_fleet_serial",
        "c_mktsegment AS vehicle_externalIds_fleet_vin",
    )


def idling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey AS string) AS vehicle_id",
        "concat('V', o_custkey) AS vehicle_name",
        f"{iso('o_orderdate')} AS startTime",
        f"CASE WHEN o_orderpriority = '5-LOW' THEN 'later' ELSE {iso('o_orderdate + INTERVAL 90 MINUTE')} END AS endTime",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS address_formatted",
    )


# Member list of tags to the customer segments whose tag has no list, or an empty one.
TAG_MEMBERS = {
    "vehicles": ("BUILDING", "MACHINERY"),
    "assets": ("MACHINERY", "FURNITURE"),
    "sensors": ("FURNITURE", "HOUSEHOLD"),
    "addresses": ("HOUSEHOLD", "AUTOMOBILE"),
    "drivers": ("AUTOMOBILE", "BUILDING"),
}


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    def members(column: str) -> str:
        none, empty = TAG_MEMBERS[column]
        one = f"named_struct('id', concat('{column[0]}', c_custkey), 'name', c_name)"
        two = f"named_struct('id', concat('{column[0]}n', c_nationkey), 'name', c_mktsegment)"
        return f"""CASE c_mktsegment WHEN '{none}' THEN NULL
            WHEN '{empty}' THEN array() ELSE array({one}, {two}, {two}) END AS {column}"""

    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS id",
        "c_name AS name",
        "c_mktsegment AS externalIds_fleet_name",
        "cast(c_nationkey AS string) AS parentTagId",
        "cast(c_nationkey AS string) AS parentTag_id",
        "concat('N', c_nationkey) AS parentTag_name",
        "array(named_struct('id', c_custkey)) AS machines",
        *[members(column) for column in TAG_MEMBERS],
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as devices, every page delivered twice."""
    once = table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey AS string) AS asset_id",
        "p_name AS asset_name",
        "p_brand AS serial",
        "p_type AS model",
        "cast(p_size AS string) AS lastConnectedTime",
        "p_retailprice AS lastKnownLocation_latitude",
        "p_retailprice * 2 AS lastKnownLocation_longitude",
        "cast(p_size AS string) AS lastKnownLocation_id",
        "p_size AS health_healthStatus",
        """CASE WHEN p_size > 40 THEN NULL ELSE array(
            named_struct('reason', p_brand, 'detail', named_struct('level', p_size)),
            named_struct('reason', p_type, 'detail', named_struct('level', p_size + 1))) END AS health_healthReasons""",
    )
    return once.union(once)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey AS string) AS id",
        "s_name AS name",
        "array(named_struct('id', s_nationkey)) AS tags",
        "array(s_nationkey) AS sensorConfiguration_areas",
        "array(s_nationkey) AS sensorConfiguration_doors",
        "array(s_name) AS attributes",
        "s_acctbal AS odometer",
    )


def asset_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    asset = "named_struct('id', c_custkey, 'name', c_name, 'cable', named_struct('assetType', c_mktsegment))"
    return table(spark, sf_dir, "customer").selectExpr(
        f"""CASE WHEN c_acctbal < 0 THEN NULL ELSE array({asset},
            named_struct('id', c_custkey + 1000000, 'name', c_name, 'cable', NULL)) END AS assets"""
    )


# Event type to the shape of the file path it stands for.
PATHS = """CASE event_type
    WHEN 'signup' THEN concat('vehicle_stats/', t, '/', t, '.parquet')
    WHEN 'view' THEN concat('vehicle_stats/', t, '/', t, '_', day0, '_to_', day3, '.parquet')
    WHEN 'error' THEN concat('vehicle_stats/', t, '/', t, '_', day0, '_to_', day2, '_', event_id, '.parquet')
    WHEN 'purchase' THEN concat(t, '_', day0, '.parquet')
    ELSE concat('vehicle_stats/', t, '/', t, '_', day0, '.parquet') END"""


def file_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path per event: undated, ranged, ranged with index, outside the layout, or of one day."""
    named = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        "concat('readings_u', user_id) AS t",
        "date_format(ts, 'yyyy_MM_dd') AS day0",
        "date_format(ts + INTERVAL 2 DAY, 'yyyy_MM_dd') AS day2",
        "date_format(ts + INTERVAL 3 DAY, 'yyyy_MM_dd') AS day3",
    )
    return named.select("event_id", F.expr(PATHS).alias("path"))


def fleet_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per customer; buildings are one-shot, furniture has no type, machinery no family."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'vehicle_stats' END AS family",
        "concat('readings_u', c_custkey) AS table_name",
        "concat('Types=', c_name, ',startTime={start},endTime={end}') AS params",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'oneshot' WHEN 'FURNITURE' THEN NULL ELSE 'time' END AS download_type",
        "1 AS delta_days",
        "0 AS is_exception",
        "cast(NULL AS struct<exception_type: string, constraint: string>) AS exception_config",
    )


def fleet_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of the customers with money: watermarks follow the nation."""
    return (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal > 0")
        .selectExpr(
            "concat('readings_u', c_custkey) AS table_name",
            "CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'oneshot' ELSE 'time' END AS download_type",
            "date_add(DATE'2024-01-01', c_nationkey) AS last_download_time",
            "CASE WHEN c_nationkey < 20 THEN date_add(DATE'2024-01-03', c_nationkey) END AS last_transformation_time",
            "CASE WHEN c_nationkey > 4 THEN date_add(DATE'2024-01-02', c_nationkey) END AS last_db_migration_time",
            """CASE WHEN c_nationkey > 2 THEN
                array(date_add(DATE'2024-01-09', c_nationkey), date_add(DATE'2024-01-05', c_nationkey)) END
                AS date_no_data""",
        )
    )


def fleet_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of automobile customers are sub-tables of the table numbered like their nation."""
    return (
        table(spark, sf_dir, "customer")
        .filter("c_mktsegment = 'AUTOMOBILE'")
        .selectExpr("concat('readings_u', c_custkey) AS sub_table", "concat('readings_u', c_nationkey) AS main_table")
    )
