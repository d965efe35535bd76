"""Manifests, progress, gaps, the catalogue and request planning.

Catalogue, progress and aliases come from ``customer`` (one table per customer), files from ``events``, requests
from ``orders``, so planning grows with the data; the built-in catalogue only adds its fixed rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lake_queries import fixtures
from lake_queries.columns_rows import batched
from lake_queries.fixtures import table
from lake_queries.registry import query
from telemetry_lake.plans import catalogue, gaps, progress, requests
from telemetry_lake.session import scratch_path
from telemetry_lake.sources import lake, manifest

# --- manifests ---------------------------------------------------------------------------------------------------

FILES = """SELECT event_id, event_type, 'readings_u' || user_id AS t, CAST(ts AS DATE) AS d0,
    strftime(ts, '%Y_%m_%d') AS day0, strftime(ts + INTERVAL 2 DAY, '%Y_%m_%d') AS day2,
    strftime(ts + INTERVAL 3 DAY, '%Y_%m_%d') AS day3 FROM events"""
PARSED = f"""SELECT event_id, event_type, CASE WHEN event_type <> 'purchase' THEN 'vehicle_stats' END AS family,
    CASE WHEN event_type <> 'purchase' THEN t END AS main_family,
    CASE WHEN event_type <> 'purchase' THEN t END AS table_name,
    CASE WHEN event_type NOT IN ('purchase', 'signup') THEN d0 END AS start_date,
    CASE event_type WHEN 'view' THEN d0 + 3 WHEN 'error' THEN d0 + 2 END AS end_date,
    CASE WHEN event_type = 'error' THEN CAST(event_id AS INTEGER) END AS index FROM ({FILES})"""
PATH_SQL = f"""SELECT event_id, CASE event_type
    WHEN 'signup' THEN 'vehicle_stats/' || t || '/' || t || '.parquet'
    WHEN 'view' THEN 'vehicle_stats/' || t || '/' || t || '_' || day0 || '_to_' || day3 || '.parquet'
    WHEN 'error' THEN 'vehicle_stats/' || t || '/' || t || '_' || day0 || '_to_' || day2 || '_' || event_id || '.parquet'
    WHEN 'purchase' THEN t || '_' || day0 || '.parquet'
    ELSE 'vehicle_stats/' || t || '/' || t || '_' || day0 || '.parquet' END AS path, t, event_type FROM ({FILES})"""


def files(spark, sf_dir):
    return manifest.manifest(fixtures.file_paths(spark, sf_dir))


@query("file_manifest", f"SELECT event_id, family, main_family, table_name, start_date, end_date, index FROM ({PARSED})")
def file_manifest(spark, sf_dir):
    return files(spark, sf_dir).drop("path")


@query(
    "file_suffix",
    f"""SELECT event_id, CASE event_type WHEN 'signup' THEN NULL WHEN 'view' THEN day0 || '_to_' || day3 || '.parquet'
    WHEN 'error' THEN day0 || '_to_' || day2 || '_' || event_id || '.parquet' ELSE day0 || '.parquet' END AS suffix
    FROM ({FILES})""",
)
def file_suffix(spark, sf_dir):
    name = F.substring_index("path", "/", -1)
    return fixtures.file_paths(spark, sf_dir).select("event_id", lake.file_suffix(name).alias("suffix"))


COVERED = f"""SELECT event_id, t, CAST(unnest(generate_series(d0, d0 + CASE event_type WHEN 'view' THEN 2
    WHEN 'error' THEN 1 ELSE 0 END, INTERVAL 1 DAY)) AS DATE) AS day FROM ({FILES}) WHERE event_type <> 'signup'"""


@query("file_date_coverage", f"SELECT event_id, day FROM ({COVERED})")
def file_date_coverage(spark, sf_dir):
    return manifest.covered_days(fixtures.file_paths(spark, sf_dir)).drop("path")


@query(
    "newest_files",
    f"""SELECT t AS table_name, path, row_number() OVER (PARTITION BY t ORDER BY path DESC) - 1 AS position
    FROM ({PATH_SQL}) WHERE event_type <> 'purchase'""",
)
def newest_files(spark, sf_dir):
    """Every file with its position among those of its table, newest first."""
    named = files(spark, sf_dir).filter("table_name IS NOT NULL").select("table_name", "path")
    return manifest.file_positions(named)


@query(
    "newest_file",
    f"""SELECT t AS table_name, max(path) AS newest_path FROM ({PATH_SQL}) WHERE event_type <> 'purchase' GROUP BY t""",
)
def newest_file(spark, sf_dir):
    return manifest.newest_file(files(spark, sf_dir).filter("table_name IS NOT NULL"))


@query(
    "files_per_table",
    f"""SELECT table_name, count(*) AS n_files, min(start_date) AS first_day, max(coalesce(end_date, start_date)) AS last_day
    FROM ({PARSED}) GROUP BY table_name""",
)
def files_per_table(spark, sf_dir):
    return manifest.files_per_table(files(spark, sf_dir))


@query(
    "paths_per_table",
    batched(f"SELECT DISTINCT t AS table_name, path FROM ({PATH_SQL}) WHERE event_type <> 'purchase'", "table_name", "path", 20, "paths"),
)
def paths_per_table(spark, sf_dir):
    grouped = manifest.paths_per_table(files(spark, sf_dir).filter("table_name IS NOT NULL"), size=20)
    return grouped.withColumn("paths", F.array_join("paths", "|"))


# --- progress ----------------------------------------------------------------------------------------------------

STATE = """SELECT 'readings_u' || c_custkey AS table_name,
    CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'oneshot' ELSE 'time' END AS download_type,
    DATE '2024-01-01' + c_nationkey AS last_download_time,
    CASE WHEN c_nationkey < 20 THEN DATE '2024-01-03' + c_nationkey END AS last_transformation_time,
    CASE WHEN c_nationkey > 4 THEN DATE '2024-01-02' + c_nationkey END AS last_db_migration_time,
    CASE WHEN c_nationkey > 2 THEN [DATE '2024-01-05' + c_nationkey, DATE '2024-01-09' + c_nationkey] END AS date_no_data
    FROM customer WHERE c_acctbal > 0"""
CATALOGUE = """SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'vehicle_stats' END AS family,
    'readings_u' || c_custkey AS table_name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'oneshot' WHEN 'FURNITURE' THEN NULL ELSE 'time' END AS download_type FROM customer"""


@query(
    "state_upsert",
    f"""WITH u AS (SELECT 'readings_u' || o_custkey AS t, coalesce(max(CASE o_orderstatus WHEN 'O' THEN 'oneshot'
      WHEN 'P' THEN NULL ELSE 'time' END), 'time') AS dt FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT coalesce(table_name, t) AS table_name, coalesce(dt, download_type) AS download_type,
    last_download_time, CASE WHEN t IS NOT NULL THEN DATE '2024-02-01' ELSE last_transformation_time END
    AS last_transformation_time, last_db_migration_time, len(date_no_data) AS n_no_data
    FROM ({STATE}) FULL JOIN u ON table_name = t""",
)
def state_upsert(spark, sf_dir):
    updates = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").selectExpr(
        "concat('readings_u', o_custkey) AS table_name",
        "CASE o_orderstatus WHEN 'O' THEN 'oneshot' WHEN 'P' THEN NULL ELSE 'time' END AS download_type",
    )
    state = progress.upsert_state(
        fixtures.fleet_state(spark, sf_dir), updates, "last_transformation_time", F.to_date(F.lit("2024-02-01"))
    )
    counted = F.when(F.col("date_no_data").isNotNull(), F.size("date_no_data").cast("bigint"))
    return state.withColumn("n_no_data", counted).drop("date_no_data")


@query(
    "state_no_data",
    f"""WITH n AS (SELECT DISTINCT 'readings_u' || user_id AS t, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'error'),
    days AS (SELECT table_name, unnest(date_no_data) AS d FROM ({STATE}) UNION SELECT t, d FROM n)
    SELECT coalesce(s.table_name, d.table_name) AS table_name, coalesce(download_type, 'time') AS download_type,
    coalesce(days, '') AS days FROM ({STATE}) AS s FULL JOIN
      (SELECT table_name, string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d) AS days FROM days GROUP BY 1) AS d
      ON s.table_name = d.table_name""",
)
def state_no_data(spark, sf_dir):
    empty = table(spark, sf_dir, "events").filter("event_type = 'error'").selectExpr(
        "concat('readings_u', user_id) AS table_name", "cast(ts AS date) AS day"
    )
    state = progress.merge_no_data(fixtures.fleet_state(spark, sf_dir), empty)
    return state.select("table_name", "download_type", F.array_join(F.col("date_no_data").cast("array<string>"), ",").alias("days"))


def typed_files(spark, sf_dir):
    """Files with the type their table has in the catalogue, kept under the table's own name."""
    types = fixtures.fleet_catalogue(spark, sf_dir).select("table_name", "download_type")
    return files(spark, sf_dir).join(types, "table_name").withColumn("main_table", F.col("table_name"))


@query(
    "incremental_transform",
    f"""SELECT f.event_id, f.table_name FROM ({PARSED}) AS f JOIN ({CATALOGUE}) AS c ON f.table_name = c.table_name
    LEFT JOIN ({STATE}) AS s ON s.table_name = f.table_name
    WHERE coalesce(c.download_type, 'time') <> 'time' OR last_transformation_time IS NULL OR start_date IS NULL
      OR (start_date >= last_transformation_time AND coalesce(end_date >= last_transformation_time, true))""",
)
def incremental_transform(spark, sf_dir):
    kept = progress.files_to_transform(typed_files(spark, sf_dir), fixtures.fleet_state(spark, sf_dir))
    return kept.select("event_id", "table_name")


@query(
    "incremental_load",
    f"""SELECT f.event_id, f.table_name FROM ({PARSED}) AS f LEFT JOIN ({STATE}) AS s ON s.table_name = f.table_name
    WHERE f.table_name IS NOT NULL AND coalesce(start_date >= DATE '2024-01-05', true)
      AND coalesce(coalesce(end_date, start_date) <= DATE '2024-01-20', true)
      AND coalesce(start_date >= last_db_migration_time, true)""",
)
def incremental_load(spark, sf_dir):
    listed = files(spark, sf_dir).filter("table_name IS NOT NULL").withColumn("main_table", F.col("table_name"))
    day = F.to_date
    kept = progress.files_to_load(
        listed, fixtures.fleet_state(spark, sf_dir), day(F.lit("2024-01-05")), day(F.lit("2024-01-20"))
    )
    return kept.select("event_id", "table_name")


@query(
    "late_files",
    f"""SELECT e.event_id, e.ts FROM events AS e LEFT JOIN ({STATE}) AS s ON s.table_name = 'readings_u' || e.user_id
    WHERE last_db_migration_time IS NULL OR CAST(e.ts AS DATE) >= last_db_migration_time""",
)
def late_files(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("table_name", F.expr("concat('readings_u', user_id)"))
    marks = fixtures.fleet_state(spark, sf_dir).select("table_name", "last_db_migration_time")
    joined = events.join(marks, "table_name", "left")
    return lake.read_since(joined, F.col("last_db_migration_time"), F.col("ts").cast("date")).select("event_id", "ts")


# --- gaps --------------------------------------------------------------------------------------------------------

ALIAS = """SELECT 'readings_u' || c_custkey AS sub_table, 'readings_u' || c_nationkey AS main_table FROM customer
    WHERE c_mktsegment = 'AUTOMOBILE'"""
MISSING = f"""SELECT table_name, day FROM (
      SELECT c.table_name, CAST(unnest(generate_series(coalesce(last_download_time, DATE '2024-01-01'),
        DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day
      FROM ({CATALOGUE}) AS c LEFT JOIN ({STATE}) AS s ON s.table_name = c.table_name
      WHERE family IS NOT NULL AND coalesce(c.download_type, 'time') <> 'oneshot'
        AND c.table_name IN (SELECT coalesce(main_table, t) FROM ({COVERED}) LEFT JOIN ({ALIAS}) ON sub_table = t))
    WHERE (table_name, day) NOT IN (SELECT coalesce(main_table, t), day FROM ({COVERED}) LEFT JOIN ({ALIAS}) ON sub_table = t)
      AND (table_name, day) NOT IN (SELECT table_name, unnest(date_no_data) FROM ({STATE}))"""


def missing(spark, sf_dir):
    return gaps.missing_days(
        fixtures.fleet_catalogue(spark, sf_dir),
        fixtures.file_paths(spark, sf_dir).withColumn("table_name", F.regexp_extract("path", r"(readings_u\d+)", 1)),
        fixtures.fleet_state(spark, sf_dir),
        end=F.to_date(F.lit("2024-02-01")),
        start=F.to_date(F.lit("2024-01-01")),
        alias=fixtures.fleet_alias(spark, sf_dir),
    )


@query("gap_detection", MISSING)
def gap_detection(spark, sf_dir):
    return missing(spark, sf_dir)


@query(
    "gap_summary",
    f"SELECT table_name, count(*) AS n_days, min(day) AS first_day, max(day) AS last_day FROM ({MISSING}) GROUP BY table_name",
)
def gap_summary(spark, sf_dir):
    return gaps.gap_summary(missing(spark, sf_dir))


@query(
    "gap_replan",
    f"""SELECT coalesce(main_table, m.t) AS table_name, m.t AS missing_table, c.family, m.day AS start_date, m.day + 1 AS end_date
    FROM (SELECT DISTINCT t, day FROM ({COVERED})) AS m LEFT JOIN ({ALIAS}) ON sub_table = m.t
    JOIN ({CATALOGUE}) AS c ON c.table_name = coalesce(main_table, m.t) WHERE coalesce(c.download_type, 'time') <> 'oneshot'""",
)
def gap_replan(spark, sf_dir):
    """The days files cover stand for missing days here: they fall on sub-tables and one-shot tables too."""
    days = manifest.covered_days(fixtures.file_paths(spark, sf_dir)).select(
        F.regexp_extract("path", r"(readings_u\d+)", 1).alias("table_name"), "day"
    )
    planned = gaps.replan_gaps(
        days.distinct(), fixtures.fleet_catalogue(spark, sf_dir), fixtures.fleet_alias(spark, sf_dir)
    )
    return planned.select("table_name", "missing_table", "family", "start_date", "end_date")


@query(
    "date_union",
    f"""SELECT t AS table_name, day FROM ({COVERED}) UNION SELECT table_name, unnest(date_no_data) FROM ({STATE})""",
)
def date_union(spark, sf_dir):
    covered = manifest.covered_days(fixtures.file_paths(spark, sf_dir)).select(
        F.regexp_extract("path", r"(readings_u\d+)", 1).alias("table_name"), "day"
    )
    return gaps.union_days(covered, gaps.empty_days(fixtures.fleet_state(spark, sf_dir)))


# --- catalogue ---------------------------------------------------------------------------------------------------


@query(
    "alias_resolve",
    f"""SELECT event_id, t AS table_name, coalesce(main_table, t) AS main_table FROM ({FILES}) LEFT JOIN ({ALIAS}) ON sub_table = t""",
)
def alias_resolve(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr("event_id", "concat('readings_u', user_id) AS table_name")
    return catalogue.resolve_alias(events, fixtures.fleet_alias(spark, sf_dir))


BUILT_IN_SUBS = {
    "click": "fleet_tags_drivers",
    "view": "ReeferStats_setPoint",
    "error": "fleet_devices_health",
    "signup": "fleet_vehicle_stats_faultCodes_j1939",
}


@query(
    "alias_built_in",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'fleet_tags' WHEN 'view' THEN 'fleet_assets_reefers'
    WHEN 'error' THEN 'fleet_devices' WHEN 'signup' THEN 'fleet_vehicle_stats_faultCodes' ELSE event_type END AS main_table
    FROM events""",
)
def alias_built_in(spark, sf_dir):
    named = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in BUILT_IN_SUBS.items()], "event_type")
    events = table(spark, sf_dir, "events").select("event_id", named.alias("table_name"))
    return catalogue.resolve_alias(events).drop("table_name")


@query(
    "semi_join_tables",
    f"""SELECT table_name, download_type FROM ({CATALOGUE}) WHERE table_name IN (SELECT 'readings_u' || user_id FROM events)""",
)
def semi_join_tables(spark, sf_dir):
    wanted = table(spark, sf_dir, "events").selectExpr("concat('readings_u', user_id) AS t")
    return catalogue.semi_join_tables(fixtures.fleet_catalogue(spark, sf_dir), wanted).select("table_name", "download_type")


@query(
    "catalogue_flags",
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'vehicle_stats' ELSE 'core' END AS family,
      o_totalprice > 250000 AS e, o_orderpriority, o_orderstatus,
      o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH') AS has_end FROM orders)
    SELECT o_orderkey, e AS is_exception_row,
    e AND o_orderpriority IN ('2-HIGH', '3-MEDIUM') AND o_orderstatus = 'O' AS is_exception_date,
    e AND o_orderpriority IN ('2-HIGH', '3-MEDIUM') AND o_orderstatus = 'F' AS is_exception_only_start_date,
    e AND o_orderpriority = '5-LOW' AS is_exception_table,
    NOT e AND has_end AS is_date_range, family = 'vehicle_stats' AS is_vehicle_stats,
    family <> 'vehicle_stats' AND NOT e AND NOT has_end AS is_downloadable_oneshot FROM r""",
)
def catalogue_flags(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'vehicle_stats' ELSE 'core' END AS family",
        """CASE WHEN o_orderstatus = 'O' THEN 'startTime=1,endTime=2' WHEN o_orderstatus = 'F' THEN NULL
           WHEN o_orderpriority = '2-HIGH' THEN 'startMs=1,endMs=2' ELSE 'limit=512' END AS params""",
        "CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS is_exception",
        """CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN named_struct('exception_type', 'date', 'constraint',
             CASE o_orderstatus WHEN 'O' THEN 'is_data_but_datetime' WHEN 'F' THEN 'only_start_date' END)
           WHEN o_orderpriority = '5-LOW' THEN named_struct('exception_type', 'table', 'constraint', 'dynamic_url')
           END AS exception_config""",
    )
    return catalogue.classify(df).select("o_orderkey", *catalogue.FLAGS)


@query(
    "select_tables",
    f"""WITH c AS ({CATALOGUE}) SELECT 'all' AS choice, table_name FROM c
    UNION ALL SELECT 'file', table_name FROM c WHERE table_name IN (SELECT 'readings_u' || user_id FROM events)
    UNION ALL SELECT 'category', table_name FROM c WHERE table_name IN
      (SELECT 'readings_u' || o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
    UNION ALL SELECT 'default', table_name FROM c WHERE table_name IN
      (SELECT 'readings_u' || o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def select_tables(spark, sf_dir):
    fleet = fixtures.fleet_catalogue(spark, sf_dir).select("table_name")
    listed = scratch_path(spark, "table-list")
    (
        table(spark, sf_dir, "events")
        .selectExpr("concat('readings_u', user_id) AS name", "event_type")
        .distinct()
        .write.option("header", "true")
        .csv(listed)
    )
    categories = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").selectExpr(
        "o_orderstatus AS category", "concat('readings_u', o_custkey) AS table_name"
    )
    runs = {
        "all": catalogue.select_tables(spark, fleet, "ALL"),
        "file": catalogue.select_tables(spark, fleet, tables_file=listed),
        "category": catalogue.select_tables(spark, fleet, "P", categories=categories),
        "default": catalogue.select_tables(spark, fleet, categories=categories),
    }
    out = None
    for choice, picked in runs.items():
        named = picked.select(F.lit(choice).alias("choice"), "table_name")
        out = named if out is None else out.union(named)
    return out


# --- request planning --------------------------------------------------------------------------------------------

PLAN = f"""SELECT DISTINCT 'readings_u' || o_custkey AS table_name, c.family,
    coalesce(c.download_type, s.download_type, 'time') AS download_type,
    coalesce(CASE WHEN s.download_type = 'time' THEN last_download_time END, DATE '2024-01-28') AS last_download_time,
    DATE '2024-02-01' AS end_date
    FROM orders JOIN ({CATALOGUE}) AS c ON c.table_name = 'readings_u' || o_custkey
    LEFT JOIN ({STATE}) AS s ON s.table_name = c.table_name"""


def plan(spark, sf_dir):
    requested = table(spark, sf_dir, "orders").selectExpr("concat('readings_u', o_custkey) AS table_name")
    return requests.build_plan(
        requested,
        fixtures.fleet_catalogue(spark, sf_dir),
        fixtures.fleet_state(spark, sf_dir),
        start=F.to_date(F.lit("2024-01-28")),
        end=F.to_date(F.lit("2024-02-01")),
    )


@query("plan_build", PLAN)
def plan_build(spark, sf_dir):
    return plan(spark, sf_dir).select("table_name", "family", "download_type", "last_download_time", "end_date")


@query(
    "plan_requests",
    f"""SELECT table_name, coalesce(family || '/', '') || table_name AS folder,
      strftime(d, '%Y-%m-%dT00:00:00+00:00') AS start_text, strftime(d, '%Y-%m-%dT23:59:59+00:00') AS end_text,
      strftime(d, '%Y_%m_%d') AS file_label
    FROM (SELECT table_name, family, CAST(unnest(generate_series(last_download_time, end_date - 1, INTERVAL 1 DAY)) AS DATE) AS d
      FROM ({PLAN}))""",
)
def plan_requests(spark, sf_dir):
    windows = requests.window_requests(requests.fill_range(plan(spark, sf_dir)))
    return windows.select("table_name", "folder", "start_text", "end_text", "file_label")


@query(
    "fanout_keys",
    """SELECT k AS key, row_number() OVER (ORDER BY md5(CAST(k AS VARCHAR)), CAST(k AS VARCHAR)) - 1 AS key_index,
    'v1/fleet/vehicles/' || k || '/safety/score' AS endpoint FROM (SELECT DISTINCT o_custkey AS k FROM orders)""",
)
def fanout_keys(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").selectExpr("'fleet_vehicles' AS source_table", "o_custkey AS key").distinct()
    return requests.fan_out(catalogue.catalogue(spark), keys).select("key", "key_index", "endpoint")


@query(
    "fanout_chunks",
    """SELECT key_batch, 'configurationIds=' || string_agg(k, ',' ORDER BY k) || ',startTime={start},endTime={end}' AS params
    FROM (SELECT k, (row_number() OVER (ORDER BY md5(k), k) - 1) // 50 AS key_batch
      FROM (SELECT DISTINCT 'c' || o_custkey AS k FROM orders)) GROUP BY key_batch""",
)
def fanout_chunks(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").selectExpr(
        "'alerts_configurations' AS source_table", "concat('c', o_custkey) AS key"
    )
    return requests.fan_out_batches(catalogue.catalogue(spark), keys.distinct()).select("key_batch", "params")


@query(
    "keyed_requests",
    """WITH k AS (SELECT CAST(c_custkey AS VARCHAR) AS k FROM customer),
    n AS (SELECT k, row_number() OVER (ORDER BY md5(k), k) - 1 AS i FROM k),
    b AS (SELECT i // 50 AS i, string_agg(k, ',' ORDER BY k) AS ks FROM n GROUP BY 1)
    SELECT 'fleet_vehicle_safety_score' AS table_name, 'v1/fleet/vehicles/' || k || '/safety/score' AS endpoint,
      NULL AS keys, '1706745600000' AS start_text, '1707004800000' AS end_text, '2024_02_01_' || i AS file_label FROM n
    UNION ALL SELECT 'alerts_incidents', 'alerts/incidents/stream', ks, strftime(d, '%Y-%m-%dT00:00:00+00:00'),
      strftime(d, '%Y-%m-%dT23:59:59+00:00'), strftime(d, '%Y_%m_%d') || '_' || i
    FROM b, (SELECT unnest([DATE '2024-02-01', DATE '2024-02-02', DATE '2024-02-03']) AS d)""",
)
def keyed_requests(spark, sf_dir):
    day = F.to_date
    ranged = catalogue.catalogue(spark).withColumns(
        {"last_download_time": day(F.lit("2024-02-01")), "end_date": day(F.lit("2024-02-04"))}
    )
    sources = F.explode(F.array(F.lit("fleet_vehicles"), F.lit("alerts_configurations")))
    keys = table(spark, sf_dir, "customer").select(sources.alias("source_table"), F.col("c_custkey").cast("string").alias("key"))
    out = requests.keyed_requests(requests.fill_range(ranged), keys.distinct())
    sent = F.try_element_at("request_params", F.lit("configurationIds"))
    return out.select("table_name", "endpoint", sent.alias("keys"), "start_text", "end_text", "file_label")
