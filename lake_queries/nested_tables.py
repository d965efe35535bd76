"""Nested data, splits, declared steps and the declared tables."""

from __future__ import annotations

import logging

from pyspark.sql import functions as F

from lake_queries import fixtures
from lake_queries.fixtures import TAG_MEMBERS, TEXT_METRICS, iso, table
from lake_queries.registry import ORACLES, query
from telemetry_lake.functions.text import canonical_json
from telemetry_lake.operators import nested
from telemetry_lake.operators.split import SubTable, split_table
from telemetry_lake.plans import tables
from telemetry_lake.plans.steps import run_steps, step

# --- objects and lists -------------------------------------------------------------------------------------------


def order_objects(spark, sf_dir):
    """Orders with a nested object, null for pending ones."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderstatus <> 'P' THEN named_struct('status', o_orderstatus,
            'place', named_struct('row', o_custkey, 'by.name', o_orderpriority),
            'codes', array(o_custkey, o_orderkey)) END AS obj""",
        "o_totalprice",
    )


@query(
    "flatten_struct",
    """SELECT o_orderkey, CASE WHEN f THEN o_orderstatus END AS obj_status, CASE WHEN f THEN o_custkey END AS obj_place_row,
    CASE WHEN f THEN o_orderpriority END AS obj_place_by_name, CASE WHEN f THEN o_custkey + o_orderkey END AS obj_codes,
    o_totalprice FROM (SELECT *, o_orderstatus <> 'P' AS f FROM orders)""",
)
def flatten_struct(spark, sf_dir):
    flat = nested.flatten(order_objects(spark, sf_dir))
    return flat.withColumn("obj_codes", F.expr("obj_codes[0] + obj_codes[1]"))


@query(
    "normalize_object",
    """SELECT o_orderkey, CASE WHEN f THEN o_orderstatus END AS status, CASE WHEN f THEN o_custkey END AS place_row,
    CASE WHEN f THEN o_orderpriority END AS "place_by.name", CASE WHEN f THEN 2 ELSE NULL END AS codes
    FROM (SELECT *, o_orderstatus <> 'P' AS f FROM orders)""",
)
def normalize_object(spark, sf_dir):
    flat = nested.normalize(order_objects(spark, sf_dir), "obj", keep=["o_orderkey"])
    return flat.withColumn("codes", F.when(F.col("codes").isNotNull(), F.size("codes")))


@query(
    "normalize_prefix",
    """SELECT o_orderkey, o_totalprice, CASE WHEN f THEN o_orderstatus END AS order_status,
    CASE WHEN f THEN o_custkey END AS "order_place.row", CASE WHEN f THEN o_orderpriority END AS "order_place.by.name"
    FROM (SELECT *, o_orderstatus <> 'P' AS f FROM orders)""",
)
def normalize_prefix(spark, sf_dir):
    return nested.normalize(order_objects(spark, sf_dir), "obj", prefix="order_", sep=".").drop("order_codes")


def line_lists(spark, sf_dir):
    """Line items with a list: null for returned ones, empty for open ones, else two objects."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'O' THEN array()
            ELSE array(named_struct('part', l_partkey, 'at', named_struct('tax', l_tax)),
                       named_struct('part', l_suppkey, 'at', NULL)) END AS items""",
        "l_shipdate",
    )


LISTS = """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey AS part, l_tax AS at_tax FROM lineitem
      WHERE l_returnflag <> 'R' AND l_linestatus <> 'O'
    UNION ALL SELECT l_orderkey, l_linenumber, l_shipdate, l_suppkey, NULL FROM lineitem
      WHERE l_returnflag <> 'R' AND l_linestatus <> 'O'
    UNION ALL SELECT l_orderkey, l_linenumber, l_shipdate, NULL, NULL FROM lineitem
      WHERE l_returnflag = 'R' OR l_linestatus = 'O'"""


@query("normalize_list", LISTS)
def normalize_list(spark, sf_dir):
    return nested.normalize_list(line_lists(spark, sf_dir), "items")


@query("explode_outer", f"SELECT l_orderkey, l_linenumber, part FROM ({LISTS})")
def explode_outer(spark, sf_dir):
    exploded = nested.explode(nested.explode(line_lists(spark, sf_dir), "items"), "absent")
    exploded = nested.explode(exploded, "l_linenumber")
    return exploded.selectExpr("l_orderkey", "l_linenumber", "items.part")


@query(
    "explode_coerced",
    f"""SELECT l_orderkey, 'list' AS kind, part AS value FROM ({LISTS})
    UNION ALL SELECT l_orderkey, 'scalar', CASE WHEN l_returnflag <> 'R' THEN l_partkey END FROM lineitem""",
)
def explode_coerced(spark, sf_dir):
    lists = nested.explode_coerced(line_lists(spark, sf_dir), "items")
    scalars = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS value"
    )
    return lists.selectExpr("l_orderkey", "'list' AS kind", "items.part AS value").union(
        nested.explode_coerced(scalars, "value").selectExpr("l_orderkey", "'scalar'", "value")
    )


@query(
    "canonical_json",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE
    '{"codes": [' || o_custkey || ', ' || o_orderkey || '], "place": {"by.name": "' || o_orderpriority || '", "row": '
    || o_custkey || '}, "status": "' || o_orderstatus || '"}' END AS obj,
    '"d\\u00e9j\\u00e0 \\"' || o_orderstatus || '\\""' AS txt,
    CASE o_orderkey % 5 WHEN 0 THEN '1e-05' WHEN 1 THEN '0.0005' WHEN 2 THEN '1e+16' WHEN 3 THEN '1.5e+22'
      ELSE (o_orderkey * 10000000) || '.0' END AS num FROM orders""",
)
def canonical(spark, sf_dir):
    df = order_objects(spark, sf_dir).withColumn(
        "txt", F.concat(F.lit('déjà "'), F.coalesce("obj.status", F.lit("P")), F.lit('"'))
    ).withColumn("num", F.expr("CASE o_orderkey % 5 WHEN 0 THEN 1e-5D WHEN 1 THEN 5e-4D WHEN 2 THEN 1e16D WHEN 3 THEN 1.5e22D ELSE o_orderkey * 1e7D END"))
    return df.select(
        "o_orderkey",
        *[canonical_json(F.col(n), df.schema[n].dataType).alias(n) for n in ("obj", "txt", "num")],
    )


# --- splits ------------------------------------------------------------------------------------------------------

SPLIT_OUTPUTS = {
    "dates": SubTable(prefix="l_ship"),
    "prices": SubTable(columns=["l_tax", "absent", "missing", "l_discount"], query="l_tax > 0.04"),
    "flags": SubTable(columns=["l_returnflag"], drop_duplicates=True),
    "first_parts": SubTable(columns=["l_partkey"], drop_duplicates=True, subset=["l_orderkey"]),
}


def split_lines(spark, sf_dir):
    return split_table(table(spark, sf_dir, "lineitem"), ["l_orderkey", "absent"], SPLIT_OUTPUTS)


for _name, _sql in (
    ("dates", "SELECT l_orderkey, l_shipdate FROM lineitem"),
    ("prices", "SELECT l_orderkey, l_tax, l_discount FROM lineitem WHERE l_tax > 0.04"),
    ("flags", "SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem"),
    ("first_parts", "SELECT l_orderkey, min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey"),
):
    query(f"split_tables_{_name}", _sql)(lambda spark, sf_dir, name=_name: split_lines(spark, sf_dir)[name])


# --- declared steps ----------------------------------------------------------------------------------------------


@query(
    "steps_run",
    """SELECT DISTINCT o_custkey AS customer, date_trunc('day', o_orderdate) AS day, o_orderpriority AS priority
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def steps_run(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").selectExpr(
        f"named_struct('cust', o_custkey, 'at', {iso('o_orderdate')}) AS who",
        "o_orderstatus",
        "array(o_orderpriority, o_orderpriority) AS priority",
    )
    return run_steps(
        raw,
        [
            step("normalize", column="who"),
            step("explode", column="priority"),
            step("filter", query="o_orderstatus <> 'P'"),
            step("cast", columns=["at"], dtype="datetime"),
            step("rename", mapping={"cust": "customer", "at": "day"}),
            step("drop", columns=["o_orderstatus"]),
            step("distinct"),
        ],
    )


@query("steps_passthrough", "SELECT *, 'listed' AS why FROM supplier UNION ALL SELECT *, 'no steps' FROM supplier")
def steps_passthrough(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    listed = tables.transform_table(suppliers, "fleet_vehicles", passthrough=["fleet_vehicles"])
    unknown = tables.transform_table(suppliers, "contacts")
    return listed.withColumn("why", F.lit("listed")).union(unknown.withColumn("why", F.lit("no steps")))


@query("steps_on_error", "SELECT s_suppkey AS id, s_name, s_nationkey, s_acctbal FROM supplier")
def steps_on_error(spark, sf_dir):
    logging.getLogger("telemetry_lake.plans.steps").setLevel(logging.CRITICAL)
    steps = [
        step("rename", mapping={"s_suppkey": "id"}),
        step("normalize", column="absent"),
        step("drop", columns=["id"]),
    ]
    return run_steps(table(spark, sf_dir, "supplier"), steps, on_error="keep")


# --- vehicle statistics ------------------------------------------------------------------------------------------


def stat_sql(metric: str, shift: int) -> str:
    first, second = f"value + {shift}", f"(value + {shift}) * 2"
    if metric in TEXT_METRICS:
        first, second = "event_type", "upper(event_type)"
    return f"""SELECT DISTINCT CAST(user_id AS VARCHAR) AS vehicle_id, 'V' || user_id AS parc_id, seen AS time, v AS "{metric}"
    FROM (SELECT user_id, ts AS seen, {first} AS v FROM events WHERE event_type NOT IN ('error', 'view')
      UNION ALL SELECT user_id, ts + INTERVAL 1 HOUR, {second} FROM events WHERE event_type NOT IN ('error', 'view')
      UNION ALL SELECT user_id, NULL, NULL FROM events WHERE event_type IN ('error', 'view'))"""


for _shift, _metric in enumerate(tables.STAT_METRICS):
    query("vehicle_stat_table" if _shift == 0 else f"stat_{_metric}", stat_sql(_metric, _shift))(
        lambda spark, sf_dir, metric=_metric, shift=_shift: tables.transform_table(
            fixtures.vehicle_stat(spark, sf_dir, metric, shift), f"fleet_vehicle_stats_{metric}"
        )
    )


@query(
    "engine_immobilizer",
    """SELECT DISTINCT CAST(user_id AS VARCHAR) AS vehicle_id, 'V' || user_id AS parc_id,
    CASE WHEN f THEN ts END AS time, CASE WHEN f THEN value > 10 END AS engine_immobilizer_connected,
    CASE WHEN f THEN event_type END AS engine_immobilizer_state FROM (SELECT *, event_type <> 'error' AS f FROM events)""",
)
def engine_immobilizer(spark, sf_dir):
    return tables.transform_table(
        fixtures.immobilizer(spark, sf_dir), "fleet_vehicle_stats_engineImmobilizer"
    ).drop("externalIds_fleet_serial")


# --- fault codes -------------------------------------------------------------------------------------------------

FAULTS = "fleet_vehicle_stats_faultCodes"


def fault_parent(spark, sf_dir):
    return tables.transform_table(fixtures.fault_codes(spark, sf_dir), FAULTS)


@query(
    "fault_codes",
    """SELECT CAST(l_orderkey AS VARCHAR) AS id, 'T' || l_suppkey AS name, CASE WHEN r THEN l_shipdate END AS time,
    CASE WHEN r THEN 'CAN_' || l_linestatus END AS "canBusType",
    CASE WHEN r AND o THEN l_tax > 0.04 END AS "obdii_checkEngineLightIsOn",
    CASE WHEN r AND o THEN l_suppkey END AS tx,
    CASE WHEN r AND NOT o AND l_returnflag <> 'R' THEN l_tax > 0.02 END AS "j1939_checkEngineLights_protectIsOn",
    CASE WHEN r AND NOT o AND l_returnflag <> 'R' THEN l_tax > 0.04 END AS "j1939_checkEngineLights_warningIsOn",
    CASE WHEN r AND NOT o AND l_returnflag <> 'R' THEN l_tax > 0.06 END AS "j1939_checkEngineLights_stopIsOn",
    CASE WHEN r AND NOT o AND l_returnflag <> 'R' THEN l_discount > 0.05 END AS "j1939_checkEngineLights_emissionsIsOn",
    CASE WHEN r AND NOT o AND l_quantity >= 10 THEN l_partkey + l_suppkey END AS spn
    FROM (SELECT *, l_linenumber > 1 AS r, l_linestatus = 'F' AS o FROM lineitem)""",
)
def fault_codes(spark, sf_dir):
    parent = fault_parent(spark, sf_dir)
    return parent.withColumn("tx", F.expr("obdii_diagnosticTroubleCodes[0].txId")).withColumn(
        "spn", F.expr("j1939_diagnosticTroubleCodes[0].spnId + j1939_diagnosticTroubleCodes[1].spnId")
    ).drop("obdii_diagnosticTroubleCodes", "j1939_diagnosticTroubleCodes")


def fault_sub(spark, sf_dir, protocol):
    name = f"{FAULTS}_{protocol}"
    return tables.split_and_transform(fault_parent(spark, sf_dir), FAULTS)[name]


@query(
    "fault_codes_obdii",
    """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS vehicle_id, 'T' || l_suppkey AS parc_id, l_shipdate AS time,
    'CAN_F' AS "canBusType", l_tax > 0.04 AS obdii_engine_light_on, l_suppkey AS "obdii_txId",
    c.x AS "obdii_confirmed_dtcId", p.x AS "obdii_pending_dtcId", q.x AS "obdii_permanent_dtcId"
    FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN [l_partkey, l_partkey + 1] ELSE [NULL] END AS cs,
        CASE WHEN l_quantity > 25 THEN [l_orderkey] ELSE [NULL] END AS ps,
        CASE WHEN l_discount >= 0.05 THEN [l_suppkey, l_partkey] ELSE [l_partkey] END AS qs
      FROM lineitem WHERE l_linenumber > 1 AND l_linestatus = 'F') AS b,
    UNNEST(b.cs) AS c(x), UNNEST(b.ps) AS p(x), UNNEST(b.qs) AS q(x)""",
)
def fault_codes_obdii(spark, sf_dir):
    return fault_sub(spark, sf_dir, "obdii")


@query(
    "fault_codes_j1939",
    """WITH b AS (SELECT *, l_returnflag <> 'R' AS lit FROM lineitem WHERE l_linenumber > 1 AND l_linestatus = 'O'),
    codes AS (SELECT *, l_partkey AS spn, l_linenumber AS fmi FROM b WHERE l_quantity >= 10
      UNION ALL SELECT *, l_suppkey, l_linenumber FROM b WHERE l_quantity >= 10
      UNION ALL SELECT *, NULL, NULL FROM b WHERE l_quantity < 10 AND lit)
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS vehicle_id, 'T' || l_suppkey AS parc_id, l_shipdate AS time,
    'CAN_O' AS "canBusType",
    CASE WHEN lit THEN l_tax > 0.02 END AS "j1939_protect_engine_light_On",
    CASE WHEN lit THEN l_tax > 0.04 END AS "j1939_warning_engine_light_On",
    CASE WHEN lit THEN l_tax > 0.06 END AS "j1939_stop_engine_light_On",
    CASE WHEN lit THEN l_discount > 0.05 END AS "j1939_emissions_engine_light_On",
    spn AS "j1939_diag_trouble_codes_spnId", fmi AS "j1939_diag_trouble_codes_fmiId" FROM codes""",
)
def fault_codes_j1939(spark, sf_dir):
    return fault_sub(spark, sf_dir, "j1939")


@query(
    "fault_codes_split",
    """SELECT p AS part, CAST(l_orderkey AS VARCHAR) AS id, 'T' || l_suppkey AS name, CASE WHEN r THEN l_shipdate END AS time,
    CASE WHEN r THEN 'CAN_' || l_linestatus END AS "canBusType",
    CASE WHEN r AND p = 'obdii' AND o THEN l_tax > 0.04 WHEN r AND p = 'j1939' AND NOT o AND l_returnflag <> 'R' THEN l_tax > 0.04
      END AS light,
    CASE WHEN r AND p = 'obdii' AND o THEN l_suppkey WHEN r AND p = 'j1939' AND NOT o AND l_quantity >= 10 THEN l_partkey
      END AS first_code
    FROM (SELECT *, l_linenumber > 1 AS r, l_linestatus = 'F' AS o FROM lineitem), (SELECT unnest(['obdii', 'j1939']) AS p)""",
)
def fault_codes_split(spark, sf_dir):
    """Both sub-tables as they are cut: shared columns, one light and the first code of the list."""
    parts = tables.split_only(fault_parent(spark, sf_dir), FAULTS)
    shown = {
        "obdii": ("obdii_checkEngineLightIsOn", "obdii_diagnosticTroubleCodes[0].txId"),
        "j1939": ("j1939_checkEngineLights_warningIsOn", "j1939_diagnosticTroubleCodes[0].spnId"),
    }
    cut = [
        parts[f"{FAULTS}_{protocol}"].selectExpr(
            f"'{protocol}' AS part", "id", "name", "time", "canBusType", f"{light} AS light", f"{code} AS first_code"
        )
        for protocol, (light, code) in shown.items()
    ]
    return cut[0].union(cut[1])


# --- refrigeration -----------------------------------------------------------------------------------------------

REEFERS = "fleet_assets_reefers"
# Feed to the value of its reading, the name it leaves under and the column that carries it.
READINGS = {
    "engineHours": ("o_orderkey", "engineHours", "BIGINT"),
    "fuelPercentage": ("o_orderkey + 1", "fuelPercentage", "BIGINT"),
    "returnAirTemperature": ("round(o_totalprice)", "returnAirTemperatureMilliCelsius", "BIGINT"),
    "ambientAirTemperature": ("round(o_totalprice) + 1", "ambientAirTemperatureMilliCelsius", "BIGINT"),
    "dischargeAirTemperature": ("round(o_totalprice) + 2", "dischargeAirTemperatureMilliCelsius", "BIGINT"),
    "setPoint": ("round(o_totalprice) + 3", "setPointMilliCelsius", "BIGINT"),
    "powerStatus": ("o_orderpriority", "powerStatus", "VARCHAR"),
}
REEFER_QUERIES = {
    "engineHours": "reefer_engine_hours",
    "fuelPercentage": "reefer_fuel_percentage",
    "returnAirTemperature": "reefer_temperature",
    "ambientAirTemperature": "reefer_ambient_temperature",
    "dischargeAirTemperature": "reefer_discharge_temperature",
    "setPoint": "reefer_set_point",
    "powerStatus": "reefer_power_status",
}


def reefer_sql(feed: str) -> str:
    value, output, kind = READINGS[feed]
    keep = "NOT (seen IS NULL AND v IS NULL)" if output.endswith("MilliCelsius") else "seen IS NOT NULL"
    return f"""SELECT "assetType", asset_id, asset_name, seen AS "{feed}ChangedAt", v AS "{output}" FROM (
      SELECT *, row_number() OVER (PARTITION BY asset_id, seen
        ORDER BY "assetType" NULLS FIRST, asset_name NULLS FIRST, v NULLS FIRST) AS n FROM (
        SELECT o_orderpriority AS "assetType", CAST(o_custkey AS VARCHAR) AS asset_id, 'R' || o_custkey AS asset_name, seen,
          CAST(v AS {kind}) AS v FROM (
          SELECT *, date_trunc('month', o_orderdate) AS seen, {value} AS v FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT *, date_trunc('month', o_orderdate) + INTERVAL 1 HOUR, {value} FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT *, NULL, CASE WHEN o_orderpriority = '1-URGENT' THEN {value} END FROM orders WHERE o_orderstatus = 'P'))
      WHERE {keep}) WHERE n = 1"""


def reefer_sub(spark, sf_dir, feed):
    return tables.split_and_transform(fixtures.reefers(spark, sf_dir), REEFERS)[f"ReeferStats_{feed}"]


for _feed, _name in REEFER_QUERIES.items():
    query(_name, reefer_sql(_feed))(lambda spark, sf_dir, feed=_feed: reefer_sub(spark, sf_dir, feed))


REEFER_ALARMS = """SELECT "assetType", asset_id, asset_name, seen AS "reeferAlarmsChangedAt", code AS "alarm_alarmCode", severity AS alarm_severity
    FROM (SELECT *, row_number() OVER (PARTITION BY asset_id, seen ORDER BY "assetType", asset_name, code, severity) AS n FROM (
      SELECT o_orderpriority AS "assetType", CAST(o_custkey AS VARCHAR) AS asset_id, 'R' || o_custkey AS asset_name,
        date_trunc('month', o_orderdate) AS seen, code, o_orderkey AS severity
      FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 'A1' ELSE o_orderstatus END AS code FROM orders
        UNION ALL SELECT *, 'A2' FROM orders WHERE o_orderpriority = '1-URGENT')
      WHERE o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW')) WHERE n = 1"""


@query("reefer_alarms", REEFER_ALARMS)
def reefer_alarms(spark, sf_dir):
    return reefer_sub(spark, sf_dir, "reeferAlarms")


_FEED_VALUES = {
    "engineHours": ("engineHours", "o_orderkey"),
    "fuelPercentage": ("fuelPercentage", "o_orderkey + 1"),
    "returnAirTemperature": ("tempInMilliC", "round(o_totalprice)"),
    "ambientAirTemperature": ("tempInMilliC", "round(o_totalprice) + 1"),
    "dischargeAirTemperature": ("tempInMilliC", "round(o_totalprice) + 2"),
    "setPoint": ("tempInMilliC", "round(o_totalprice) + 3"),
    "powerStatus": ("status", "o_orderpriority"),
}


def _cut_sql(feed: str, value: str) -> str:
    if feed != "powerStatus":
        value = f"CAST({value} AS BIGINT)"
    return f"""SELECT 'ReeferStats_{feed}' AS part, o_orderpriority AS "assetType", CAST(o_custkey AS VARCHAR) AS asset_id,
      CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN 1 ELSE 2 END AS items,
      CAST(CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') THEN {value} END AS VARCHAR) AS first
      FROM orders"""


@query(
    "reefer_split",
    " UNION ALL ".join(_cut_sql(feed, value) for feed, (_, value) in _FEED_VALUES.items())
    + """ UNION ALL SELECT 'ReeferStats_reeferAlarms', o_orderpriority, CAST(o_custkey AS VARCHAR),
      CASE WHEN o_orderstatus <> 'F' THEN 1 END, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'
      THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'A1' ELSE o_orderstatus END END FROM orders""",
)
def reefer_split(spark, sf_dir):
    """The eight sub-tables as they are cut: shared columns, length of the list and its first value."""
    parts, out = tables.split_only(fixtures.reefers(spark, sf_dir), REEFERS), None
    for name, part in parts.items():
        feed = name.removeprefix("ReeferStats_")
        first = "alarms[0].alarmCode" if feed == "reeferAlarms" else _FEED_VALUES[feed][0]
        cut = part.selectExpr(
            f"'{name}' AS part", "assetType", "id AS asset_id", f"CASE WHEN {name} IS NOT NULL THEN size({name}) END AS items",
            f"cast(get({name}, 0).{first} AS string) AS first",
        )
        out = cut if out is None else out.union(cut)
    return out


# --- reports, events and master data -------------------------------------------------------------------------------


@query(
    "fuel_energy",
    """SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS vehicle_id, c_name AS parc_id, c_acctbal AS "efficiencyMpge",
    CAST(c_nationkey AS DOUBLE) AS "energyUsedKwh", CAST(c_nationkey AS DOUBLE) AS "estFuelEnergyCost_amount",
    c_acctbal AS "estCarbonEmissionsKg", TIMESTAMP '2024-02-01' AS date FROM customer""",
)
def fuel_energy(spark, sf_dir):
    return tables.transform_table(
        fixtures.fuel_energy(spark, sf_dir), "fleet_vehicles_fuel_energy", date="2024_02_01"
    )


@query(
    "vehicle_idling",
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS vehicle_id, 'V' || o_custkey AS parc_id, o_orderdate AS "startTime",
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + INTERVAL 90 MINUTE END AS "endTime",
    o_orderpriority AS address_formatted FROM orders WHERE o_orderstatus <> 'P'""",
)
def vehicle_idling(spark, sf_dir):
    return tables.transform_table(fixtures.idling(spark, sf_dir), "fleet_vehicle_idling")


@query(
    "safety_events",
    """SELECT DISTINCT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type <> 'signup' THEN ts END AS time,
    CAST(user_id AS VARCHAR) AS vehicle_id, CASE WHEN event_type <> 'view' THEN event_type END AS behavior_label,
    CASE WHEN event_type <> 'view' THEN props END AS behavior_source FROM events""",
)
def safety_events(spark, sf_dir):
    return tables.transform_table(fixtures.safety_events(spark, sf_dir), "fleet_safety_events")


@query("vehicles", "SELECT CAST(s_suppkey AS VARCHAR) AS vehicle_id, s_name AS parc_id, s_acctbal AS odometer FROM supplier")
def vehicles(spark, sf_dir):
    return tables.transform_table(fixtures.vehicles(spark, sf_dir), "fleet_vehicles")


@query(
    "trailers",
    "SELECT CAST(s_suppkey AS VARCHAR) AS vehicle_id, s_name AS parc_id, s_acctbal AS odometer, s_name AS attribute FROM supplier",
)
def trailers(spark, sf_dir):
    flat = tables.transform_table(fixtures.vehicles(spark, sf_dir), "fleet_trailers")
    return flat.withColumn("attribute", F.col("attributes")[0]).drop(
        "attributes", "sensorConfiguration_areas", "sensorConfiguration_doors"
    )


@query(
    "assets",
    """SELECT c_custkey AS asset_id, c_name AS asset_name, c_mktsegment AS "cable_assetType" FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT c_custkey + 1000000, c_name, NULL FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT NULL, NULL, NULL FROM customer WHERE c_acctbal < 0""",
)
def assets(spark, sf_dir):
    return tables.transform_table(fixtures.asset_pages(spark, sf_dir), "fleet_assets")


TAG_COLUMNS = """CAST(c_custkey AS VARCHAR) AS tag_id, c_name AS tag_name, c_mktsegment AS "externalIds_fleet_name",
    CAST(c_nationkey AS VARCHAR) AS "parentTagId", CAST(c_nationkey AS VARCHAR) AS "parentTag_id",
    'N' || c_nationkey AS "parentTag_name" """


def tag_sql(members: str) -> str:
    none, empty = TAG_MEMBERS[members]
    prefix = tables.TABLE_STEPS[f"fleet_tags_{members}"][1].arguments["prefix"]
    listed = f"c_mktsegment NOT IN ('{none}', '{empty}')"
    letter = members[0]
    return f"""SELECT DISTINCT * FROM (
      SELECT {TAG_COLUMNS}, '{letter}' || c_custkey AS {prefix}id, c_name AS {prefix}name FROM customer WHERE {listed}
      UNION ALL SELECT {TAG_COLUMNS}, '{letter}n' || c_nationkey, c_mktsegment FROM customer WHERE {listed}
      UNION ALL SELECT {TAG_COLUMNS}, NULL, NULL FROM customer WHERE NOT {listed})"""


for _members in TAG_MEMBERS:
    query(f"tags_children_{_members}", tag_sql(_members))(
        lambda spark, sf_dir, members=_members: tables.split_and_transform(
            tables.transform_table(fixtures.tags(spark, sf_dir), "fleet_tags"), "fleet_tags"
        )[f"fleet_tags_{members}"]
    )


@query("tags", f"SELECT {TAG_COLUMNS}, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'v' || c_custkey END AS vehicle FROM customer")
def tags(spark, sf_dir):
    flat = tables.transform_table(fixtures.tags(spark, sf_dir), "fleet_tags")
    return flat.withColumn("vehicle", F.expr("get(vehicles, 0).id")).drop(*TAG_MEMBERS)


def _tag_cut_sql(members: str) -> str:
    none, empty = TAG_MEMBERS[members]
    return f"""SELECT 'fleet_tags_{members}' AS part, {TAG_COLUMNS},
      CASE WHEN c_mktsegment = '{none}' THEN NULL WHEN c_mktsegment = '{empty}' THEN '' ELSE
      '{members[0]}' || c_custkey || ' ' || c_name || '|' || repeat('{members[0]}n' || c_nationkey || ' ' || c_mktsegment || '|', 2)
      END AS members FROM customer"""


@query("tags_split", " UNION ALL ".join(map(_tag_cut_sql, TAG_MEMBERS)))
def tags_split(spark, sf_dir):
    """The five sub-tables as they are cut: shared columns and all members, in order."""
    parts = tables.split_only(tables.transform_table(fixtures.tags(spark, sf_dir), "fleet_tags"), "fleet_tags")
    out = None
    for name, part in parts.items():
        *shared, members = part.columns
        listed = F.array_join(F.transform(members, lambda m: F.concat_ws(" ", m["id"], m["name"], F.lit("|"))), "")
        cut = part.select(F.lit(name).alias("part"), *shared, F.replace(listed, F.lit(" |"), F.lit("|")).alias("members"))
        out = cut if out is None else out.union(cut)
    return out


def device_sub(spark, sf_dir, name):
    parent = tables.transform_table(fixtures.devices(spark, sf_dir), "fleet_devices")
    return tables.split_and_transform(parent, "fleet_devices")[name]


DEVICE = "CAST(p_partkey AS VARCHAR) AS asset_id, p_name AS asset_name"


@query(
    "devices",
    f"""SELECT DISTINCT {DEVICE}, p_brand AS serial, p_type AS model, CAST(p_size AS VARCHAR) AS "lastConnectedTime",
    p_retailprice AS "lastKnownLocation_latitude", p_retailprice * 2 AS "lastKnownLocation_longitude",
    CAST(p_size AS VARCHAR) AS "lastKnownLocation_id" FROM part""",
)
def devices(spark, sf_dir):
    return device_sub(spark, sf_dir, "fleet_devices")


@query("devices_health", f'SELECT DISTINCT {DEVICE}, p_size AS "health_healthStatus" FROM part')
def devices_health(spark, sf_dir):
    return device_sub(spark, sf_dir, "fleet_devices_health")


@query(
    "device_health_reasons",
    f"""SELECT DISTINCT * FROM (SELECT {DEVICE}, p_brand AS reason, p_size AS detail_level FROM part WHERE p_size <= 40
      UNION ALL SELECT {DEVICE}, p_type, p_size + 1 FROM part WHERE p_size <= 40
      UNION ALL SELECT {DEVICE}, NULL, NULL FROM part WHERE p_size > 40)""",
)
def device_health_reasons(spark, sf_dir):
    return device_sub(spark, sf_dir, "fleet_devices_healthReasons")


@query(
    "devices_split",
    f"""WITH d AS (SELECT *, CAST(p_partkey AS VARCHAR) AS asset_id, CASE WHEN p_size <= 40 THEN p_brand || ' ' || p_size
      || '|' || p_type || ' ' || (p_size + 1) END AS reasons FROM part)
    SELECT 'fleet_devices' AS part, asset_id, p_name AS asset_name, p_brand || ' ' || p_type AS own, p_retailprice AS latitude,
      NULL::INTEGER AS status FROM d
    UNION ALL SELECT 'fleet_devices_health', asset_id, p_name, reasons, NULL, p_size FROM d
    UNION ALL SELECT 'fleet_devices_healthReasons', asset_id, p_name, reasons, NULL, NULL FROM d""",
)
def devices_split(spark, sf_dir):
    """The three sub-tables as they are cut, before their own steps remove repetitions."""
    parts = tables.split_only(tables.transform_table(fixtures.devices(spark, sf_dir), "fleet_devices"), "fleet_devices")
    shared = "asset_id", "asset_name"
    reasons = F.array_join(
        F.transform("health_healthReasons", lambda r: F.concat_ws(" ", r["reason"], r["detail"]["level"].cast("string"))), "|"
    )
    none = F.lit(None)
    main, health, listed = (parts[n] for n in ("fleet_devices", "fleet_devices_health", "fleet_devices_healthReasons"))
    own, latitude = F.concat_ws(" ", "serial", "model").alias("own"), F.col("lastKnownLocation_latitude").alias("latitude")
    cut = main.select(F.lit("fleet_devices").alias("part"), *shared, own, latitude, none.cast("int").alias("status"))
    cut = cut.union(
        health.select(F.lit("fleet_devices_health"), *shared, reasons, none.cast("double"), F.col("health_healthStatus"))
    )
    return cut.union(
        listed.select(F.lit("fleet_devices_healthReasons"), *shared, reasons, none.cast("double"), none.cast("int"))
    )


@query(
    "split_and_transform",
    f"""SELECT '{FAULTS}_obdii' AS part, vehicle_id, parc_id, time, "canBusType", obdii_engine_light_on AS light,
      "obdii_confirmed_dtcId" AS code, "obdii_permanent_dtcId" AS other FROM ({ORACLES["fault_codes_obdii"]})
    UNION ALL SELECT '{FAULTS}_j1939', vehicle_id, parc_id, time, "canBusType", "j1939_warning_engine_light_On",
      "j1939_diag_trouble_codes_spnId", "j1939_diag_trouble_codes_fmiId" FROM ({ORACLES["fault_codes_j1939"]})""",
)
def split_and_transform(spark, sf_dir):
    """All rows of both sub-tables, cut from one parent and run through their own steps."""
    parts = tables.split_and_transform(fault_parent(spark, sf_dir), FAULTS)
    shared = "vehicle_id", "parc_id", "time", "canBusType"
    obdii = parts[f"{FAULTS}_obdii"].select(
        F.lit(f"{FAULTS}_obdii").alias("part"), *shared, F.col("obdii_engine_light_on").alias("light"),
        F.col("obdii_confirmed_dtcId").alias("code"), F.col("obdii_permanent_dtcId").alias("other"),
    )
    return obdii.union(
        parts[f"{FAULTS}_j1939"].select(
            F.lit(f"{FAULTS}_j1939"), *shared, "j1939_warning_engine_light_On", "j1939_diag_trouble_codes_spnId",
            "j1939_diag_trouble_codes_fmiId",
        )
    )
