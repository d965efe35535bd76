"""Pages, lake folders, warehouse tables and streams; what is written goes below the shared folder and is read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from lake_queries import fixtures
from lake_queries.fixtures import table
from lake_queries.nested_tables import READINGS, REEFER_ALARMS, REEFERS, reefer_sql
from lake_queries.registry import query
from telemetry_lake.plans import run
from telemetry_lake.plans.catalogue import catalogue
from telemetry_lake.plans.jobs import TableJob, load_stage
from telemetry_lake.session import scratch_path
from telemetry_lake.sources import envelope, lake, manifest, warehouse
from telemetry_lake.streaming import incremental

# --- scans -------------------------------------------------------------------------------------------------------


@query("scan_table", "SELECT * FROM orders")
def scan_table(spark, sf_dir):
    """A table whose name starts another table's name: only its own folder is read."""
    root = scratch_path(spark, "lake")
    lake.write_parquet(table(spark, sf_dir, "orders"), lake.table_path(root, "core", "orders"))
    lake.write_parquet(table(spark, sf_dir, "customer"), lake.table_path(root, "core", "orders_customers"))
    return lake.read_table(spark, root, "core", "orders")


@query("scan_events", "SELECT * FROM events")
def scan_events(spark, sf_dir):
    return lake.read_table(spark, sf_dir, None, "events.parquet", schema=table(spark, sf_dir, "events").schema)


@query(
    "scan_named_files",
    """WITH bounds AS (SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events),
    placed AS (SELECT event_id, user_id, first + CAST((CAST(ts AS DATE) - first) // 10 * 10 AS INTEGER) AS file_date,
      first + CAST((last - first) // 2 AS INTEGER) AS mark FROM events, bounds)
    SELECT event_id, user_id, file_date FROM placed WHERE file_date >= mark""",
)
def scan_named_files(spark, sf_dir):
    """A folder of files named by ranges of ten days, from the first day of the data to its last, beside files of a
    sub-table, read from the middle day on."""
    root = scratch_path(spark, "named")
    events = table(spark, sf_dir, "events").selectExpr("event_id", "user_id", "cast(ts AS date) AS day")
    first, last = events.agg(F.min("day"), F.max("day")).first()
    starts = [first + timedelta(days=d) for d in range(0, (last - first).days + 1, 10)]
    for start in starts:
        end = start + timedelta(days=10)
        part = events.filter((F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(end))).drop("day")
        part.write.parquet(f"{root}/core/readings/readings_{start:%Y_%m_%d}_to_{end:%Y_%m_%d}.parquet")
    events.drop("day").write.parquet(f"{root}/core/readings/readings_extra_{last:%Y_%m_%d}.parquet")
    named = manifest.read_named_files(spark, root, "core", "readings")
    return lake.read_since(named, F.lit(first + (last - first) // 2), F.col("file_date"))


@query("scan_pruned", "SELECT l_suppkey FROM lineitem")
def scan_pruned(spark, sf_dir):
    return lake.read_table(spark, sf_dir, None, "lineitem.parquet", columns=["l_suppkey"])


# --- pages -------------------------------------------------------------------------------------------------------

# Order status and priority to the shape of the page.
PAGES = """CASE
    WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN
      to_json(named_struct('data', array(rec, other)))
    WHEN o_orderstatus = 'O' THEN to_json(named_struct('data', named_struct('only', array(rec, other))))
    WHEN o_orderpriority = '1-URGENT' THEN to_json(named_struct('data', rec, 'page', 1))
    WHEN o_orderpriority = '2-HIGH' THEN to_json(rec)
    WHEN o_orderpriority = '3-MEDIUM' THEN '{"data": [], "page": 1}'
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN '{"data": {}}'
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN concat('{"data": {"id": ', o_orderkey, '}}')
    ELSE concat('{"data": null, "id": ', o_orderkey, ', "total.price": 1.5}') END"""
RECORDS = """SELECT o_orderkey AS page, id, price, row FROM (
      SELECT o_orderkey, o_orderkey AS id, o_totalprice AS price, o_custkey AS row FROM orders
        WHERE o_orderstatus = 'O' OR o_orderpriority IN ('1-URGENT', '2-HIGH')
      UNION ALL SELECT o_orderkey, -o_orderkey, NULL, NULL FROM orders WHERE o_orderstatus = 'O'
      UNION ALL SELECT o_orderkey, o_orderkey, NULL, NULL FROM orders
        WHERE o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'
      UNION ALL SELECT o_orderkey, o_orderkey, 1.5, NULL FROM orders WHERE o_orderstatus <> 'O' AND o_orderpriority = '5-LOW')"""


def pages(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "*",
        "named_struct('id', o_orderkey, 'total.price', o_totalprice, 'place', named_struct('row', o_custkey)) AS rec",
        "named_struct('id', -o_orderkey, 'total.price', cast(NULL AS double), 'place', cast(NULL AS struct<row: bigint>)) AS other",
    )
    return orders.select(F.col("o_orderkey").alias("page"), F.expr(PAGES).alias("body"))


@query("envelope_unwrap", RECORDS)
def envelope_unwrap(spark, sf_dir):
    schema = "struct<id: bigint, `total.price`: double, place: struct<row: bigint>>"
    flat = envelope.records_to_columns(envelope.unwrap_envelope(pages(spark, sf_dir)), schema)
    return flat.selectExpr("page", "id", "total_price AS price", "place_row AS row")


@query("envelope_inferred", f"SELECT page, id, price, row FROM ({RECORDS})")
def envelope_inferred(spark, sf_dir):
    """Records of no declared type: one aggregation finds the columns."""
    records = envelope.unwrap_envelope(pages(spark, sf_dir))
    flat = envelope.records_to_columns(records, envelope.record_schema(records))
    return flat.selectExpr("page", "id", "total_price AS price", "place_row AS row")


# --- files -------------------------------------------------------------------------------------------------------


@query("parquet_roundtrip", "SELECT *, ts + INTERVAL 1 HOUR AS zoned FROM events")
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    events = table(spark, sf_dir, "events").withColumn("zoned", F.expr("cast(ts + INTERVAL 1 HOUR AS timestamp)"))
    lake.write_parquet(events, path)
    return spark.read.parquet(path)


@query("write_partitioned", "SELECT event_id, user_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN -value ELSE value END AS value, CAST(ts AS DATE) AS file_date FROM events")
def write_partitioned(spark, sf_dir):
    """All days written, then the later half written again with other values: those days are replaced."""
    path = scratch_path(spark, "days")
    events = table(spark, sf_dir, "events").selectExpr("event_id", "user_id", "value", "cast(ts AS date) AS file_date")
    lake.write_partitioned(events, path, cluster_by=["user_id"])
    later = events.filter("file_date >= DATE'2024-01-15'").withColumn("value", -F.col("value"))
    lake.write_partitioned(later, path, cluster_by=["user_id"])
    return spark.read.schema(events.schema).parquet(path)


@query(
    "warehouse_load",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, user_id AS vehicle_id, ts AS time, CAST(ts AS DATE) AS load_day,
      'time' AS kind FROM events
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_nationkey, NULL, NULL, 'oneshot' FROM supplier""",
)
def warehouse_load(spark, sf_dir):
    """A timed table loaded in two batches, the second twice (its days replace themselves); a one-shot table loaded
    twice (the second load is what stays). How each is loaded comes from the catalogue, by main table."""
    timed, once = scratch_path(spark, "timed"), scratch_path(spark, "oneshot")
    tables = catalogue(spark)
    by_day = warehouse.load_spec(tables, "fleet_safety_events")
    events = table(spark, sf_dir, "events").selectExpr(
        "cast(event_id AS string) AS event_id", "user_id AS vehicle_id", "ts AS time"
    )
    warehouse.load_table(events.filter("time < TIMESTAMP_NTZ'2024-01-11'"), timed, by_day)
    rest = events.filter("time >= TIMESTAMP_NTZ'2024-01-11'")
    warehouse.load_table(rest, timed, by_day, replace_days=True)
    warehouse.load_table(rest, timed, by_day, replace_days=True)
    whole = warehouse.load_spec(tables, "fleet_tags_drivers")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey AS string) AS event_id", "cast(s_nationkey AS bigint) AS vehicle_id"
    )
    warehouse.load_table(suppliers, once, whole)
    warehouse.load_table(suppliers, once, whole)
    loaded = warehouse.read_loaded(spark, timed).withColumn("kind", F.lit("time"))
    kept = warehouse.read_loaded(spark, once).withColumn("kind", F.lit("oneshot"))
    return loaded.unionByName(kept, allowMissingColumns=True)


LATE = """event_id, user_id AS vehicle_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS time,
    CAST(ts AS DATE) + CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS file_date"""


@query(
    "load_late_rows",
    f"SELECT *, CAST(time AS DATE) AS load_day FROM (SELECT {LATE} FROM events)",
)
def load_late_rows(spark, sf_dir):
    """Through the load stage in two batches, the second twice: files hold readings of the day before and rows
    without a time, and everything stays once."""
    flat, house = scratch_path(spark, "flat"), scratch_path(spark, "house")
    job = TableJob("safety", "fleet_safety_events")
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id AS vehicle_id", "CASE WHEN event_id % 50 <> 0 THEN ts END AS time",
        "date_add(CAST(ts AS DATE), CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) AS file_date",
    )
    lake.write_partitioned(events, f"{lake.table_path(flat, job.family, job.table)}/{job.table}")
    specs = {job.table: warehouse.LoadSpec("time", "time", ("vehicle_id",))}
    load_stage(spark, flat, house, [job], specs, end="2024-01-12")
    for _ in range(2):
        load_stage(spark, flat, house, [job], specs, start="2024-01-12")
    return spark.read.parquet(f"{house}/{job.table}")


@query(
    "load_twice_unpartitioned",
    "SELECT event_id, user_id AS vehicle_id, CAST(ts AS DATE) AS file_date FROM events",
)
def load_twice_unpartitioned(spark, sf_dir):
    """A table without partitioning field, loaded twice through the stage: the same rows."""
    flat, house = scratch_path(spark, "flat"), scratch_path(spark, "house")
    job = TableJob("alerts", "alerts_incidents")
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id AS vehicle_id", "CAST(ts AS DATE) AS file_date"
    )
    lake.write_partitioned(events, f"{lake.table_path(flat, job.family, job.table)}/{job.table}")
    for _ in range(2):
        load_stage(spark, flat, house, [job], {})
    return spark.read.parquet(f"{house}/{job.table}")


@query("load_oneshot_snapshots", "SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey % 3 > 0")
def load_oneshot_snapshots(spark, sf_dir):
    """Two snapshots of a one-shot table, a day apart: the newest is the table, and what it lacks is gone."""
    flat, house = scratch_path(spark, "flat"), scratch_path(spark, "house")
    job = TableJob("vehicles", "fleet_vehicles", "oneshot")
    folder = f"{lake.table_path(flat, job.family, job.table)}/{job.table}"
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    for day, kept in (("2024-01-01", "true"), ("2024-01-02", "s_suppkey % 3 > 0")):
        lake.write_partitioned(suppliers.filter(kept).withColumn("file_date", F.to_date(F.lit(day))), folder)
        load_stage(spark, flat, house, [job], {})
    return spark.read.parquet(f"{house}/{job.table}")


@query(
    "schema_evolution",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN l_tax END AS l_tax,
    CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN l_returnflag END AS l_returnflag FROM lineitem""",
)
def schema_evolution(spark, sf_dir):
    """Three appends, each later period with one more column."""
    path = scratch_path(spark, "evolving")
    lines = table(spark, sf_dir, "lineitem")
    spec = warehouse.LoadSpec("time")
    first, second = "TIMESTAMP_NTZ'1998-01-01'", "TIMESTAMP_NTZ'2000-01-01'"
    base = ["l_orderkey", "l_linenumber", "l_quantity"]
    warehouse.load_table(lines.filter(f"l_shipdate < {first}").select(*base), path, spec)
    warehouse.load_table(
        lines.filter(f"l_shipdate >= {first} AND l_shipdate < {second}").select(*base, "l_tax"), path, spec
    )
    warehouse.load_table(lines.filter(f"l_shipdate >= {second}").select(*base, "l_tax", "l_returnflag"), path, spec)
    return warehouse.read_loaded(spark, path)


@query(
    "conform_types",
    """SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS small, o_totalprice, o_orderpriority, o_totalprice > 1000 AS large,
    o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS time,
    '{"a": ' || o_custkey || ', "b": ["' || o_orderstatus || '"]}' AS nested FROM orders""",
)
def conform_types(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "cast(o_custkey AS int) AS small",
        "o_totalprice",
        "o_orderpriority",
        "o_totalprice > 1000 AS large",
        "o_orderdate",
        f"CASE WHEN o_orderstatus = 'P' THEN '?' ELSE {fixtures.iso('o_orderdate')} END AS time",
        "named_struct('b', array(o_orderstatus), 'a', o_custkey) AS nested",
    )
    return warehouse.conform_types(df, time_column="time")


@query(
    "list_files",
    "SELECT DISTINCT 'vehicle_stats' AS family, 'events' AS main_family, CAST(ts AS DATE) AS day FROM events",
)
def list_files(spark, sf_dir):
    """Folders of the days written, found by listing alone."""
    root = scratch_path(spark, "listing")
    events = table(spark, sf_dir, "events").withColumn("file_date", F.expr("cast(ts AS date)"))
    lake.write_partitioned(events, lake.table_path(root, "vehicle_stats", "events"))
    listed = lake.list_files(spark, root)
    parts = F.split("path", "/")
    day = F.to_date(F.regexp_extract("path", "file_date=([0-9-]+)", 1))
    return listed.select(parts[0].alias("family"), parts[1].alias("main_family"), day.alias("day")).distinct()


STAT_TYPE = "struct<id: string, name: string, engineRpm: array<struct<time: string, value: double>>>"


def stat_pages(spark, sf_dir):
    """Answers of one event each, and an answer without a record for the last day of the month."""
    day = "cast(ts AS date) AS file_date"
    reading = """array(named_struct('time', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), 'value', event_id + 0.5D))"""
    record = f"named_struct('id', cast(user_id AS string), 'name', concat('V', user_id), 'engineRpm', {reading})"
    name = "'fleet_vehicle_stats_engineRpm' AS table_name"
    pages = table(spark, sf_dir, "events").selectExpr(name, f"to_json(named_struct('data', array({record}))) AS body", day)
    none = table(spark, sf_dir, "region").limit(1).selectExpr(name, "'{\"data\": []}' AS body", "DATE'2024-03-31' AS file_date")
    return pages.union(none)


@query(
    "pipeline_two_runs",
    """SELECT CAST(user_id AS VARCHAR) AS vehicle_id, 'V' || user_id AS parc_id, date_trunc('second', ts) AS time,
    CAST(event_id + 0.5 AS DOUBLE) AS "engineRpm", DATE '2024-04-01' AS loaded_to, 1 AS empty_days FROM events""",
)
def pipeline_two_runs(spark, sf_dir):
    """Pages landed, transformed and loaded up to a day, then to the end, then once more from the first state.

    The pages of a day before the first end arrive only after the first run.
    """
    roots = run.Roots(*(scratch_path(spark, n) for n in ("raw", "flat", "warehouse")))
    states = [scratch_path(spark, "state") for _ in range(4)]
    jobs = [TableJob("vehicle_stats", "fleet_vehicle_stats_engineRpm", schema=STAT_TYPE)]
    pages = stat_pages(spark, sf_dir)
    early = pages.filter("file_date <> DATE'2024-01-14'")
    first, last = "2024-01-16", "2024-04-01"
    for before, after, given, end in ((0, 1, early, first), (1, 2, pages, last), (1, 3, pages, last)):
        state = run.run_pipeline(spark, roots, states[before], states[after], given, jobs, end)
    loaded = warehouse.read_loaded(spark, f"{roots.warehouse}/{jobs[0].table}")
    kept = state.select(
        "table_name", F.col("last_db_migration_time").alias("loaded_to"), F.size("date_no_data").alias("empty_days")
    )
    # The table's own folder names it: …/table/file_date=…/load_day=…/file.
    named = loaded.withColumn("table_name", F.element_at(F.split("_metadata.file_path", "/"), -4))
    return named.select("table_name", "vehicle_id", "parc_id", "time", "engineRpm").join(kept, "table_name").drop("table_name")


# --- streams -----------------------------------------------------------------------------------------------------


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_ingest(spark, sf_dir):
    """Half of the files, a run, the other half, a second run, and a third that finds nothing new."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "ingested", "progress"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    for part in ("ts < TIMESTAMP_NTZ'2024-01-16'", "ts >= TIMESTAMP_NTZ'2024-01-16'"):
        events.filter(part).write.mode("append").parquet(source)
        incremental.ingest(incremental.read_stream(spark, source, events.schema), target, checkpoint)
    incremental.ingest(incremental.read_stream(spark, source, events.schema), target, checkpoint)
    return spark.read.schema(events.schema).parquet(target)


@query("stream_dedup", "SELECT event_id, user_id, ts AS time FROM events")
def stream_dedup(spark, sf_dir):
    """Every event delivered in two files of one run; the second delivery leaves no row."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "distinct", "progress"))
    events = table(spark, sf_dir, "events").selectExpr("event_id", "user_id", "cast(ts AS timestamp) AS time")
    events.write.parquet(source)
    events.write.mode("append").parquet(source)
    stream = incremental.read_stream(spark, source, events.schema)
    incremental.ingest(incremental.deduplicated(stream, ["event_id"], "time", "1 day"), target, checkpoint)
    return spark.read.parquet(target)


@query("stream_late", "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def stream_late(spark, sf_dir):
    """The later half of the events, then the earlier half, then all of them again: none is lost or kept twice."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "distinct", "progress"))
    events = table(spark, sf_dir, "events").selectExpr("event_id", "user_id", "event_type", "cast(ts AS date) AS day")
    for part in ("day >= DATE'2024-01-16'", "day < DATE'2024-01-16' OR day IS NULL", "true"):
        events.filter(part).write.mode("append").parquet(source)
        stream = incremental.read_stream(spark, source, events.schema)
        incremental.ingest_distinct(stream, ["event_id"], "day", target, checkpoint)
    return spark.read.schema(events.schema).parquet(target).select(*events.columns)


SPLIT_VALUES = " UNION ALL ".join(
    [
        f"""SELECT '{feed}' AS part, asset_id, "{feed}ChangedAt" AS seen, CAST("{output}" AS VARCHAR) AS value
        FROM ({reefer_sql(feed)})"""
        for feed, (_, output, _) in READINGS.items()
    ]
    + [
        f"""SELECT 'reeferAlarms', asset_id, "reeferAlarmsChangedAt", "alarm_alarmCode" || '/' || alarm_severity
        FROM ({REEFER_ALARMS})"""
    ]
)


@query("stream_split", SPLIT_VALUES)
def stream_split(spark, sf_dir):
    """Raw refrigeration records through the declared steps to their eight sub-tables, as a stream."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "split", "progress"))
    raw = fixtures.reefers(spark, sf_dir)
    raw.write.parquet(source)
    incremental.split_stream(incremental.read_stream(spark, source, raw.schema), REEFERS, target, checkpoint)
    out = None
    for feed in (*READINGS, "reeferAlarms"):
        value = F.concat_ws("/", "alarm_alarmCode", "alarm_severity") if feed == "reeferAlarms" else F.col(READINGS[feed][1])
        if feed != "reeferAlarms" and READINGS[feed][2] == "BIGINT":
            value = value.cast("bigint")
        part = spark.read.parquet(f"{target}/ReeferStats_{feed}").select(
            F.lit(feed).alias("part"), "asset_id", F.col(f"{feed}ChangedAt").alias("seen"), value.cast("string").alias("value")
        )
        out = part if out is None else out.union(part)
    return out
