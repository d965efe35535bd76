"""Tables whose types and contents change as they come: stored schemas, rescued values, upserts, open requests, keys
from the lake, committed state, the run as a stream, row-wise errors and clustered files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lake_queries import fixtures
from lake_queries.fixtures import table
from lake_queries.registry import query
from telemetry_lake.operators import clustering
from telemetry_lake.plans import committed, due, evolving, ledger, progress, quarantine, requests
from telemetry_lake.plans.catalogue import catalogue
from telemetry_lake.plans.jobs import TableJob
from telemetry_lake.plans.run import Roots
from telemetry_lake.plans.steps import step
from telemetry_lake.session import scratch_path
from telemetry_lake.sources import envelope, rescue, upsert, versions
from telemetry_lake.sources.evolving import read_days, stored_schema
from telemetry_lake.sources.warehouse import LoadSpec
from telemetry_lake.streaming.run import run_batch, stream_run

RPM = "fleet_vehicle_stats_engineRpm"
THIRD = "CAST(CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE)) FROM events) AS BIGINT) % 3"


def roots_of(spark):
    return Roots(*(scratch_path(spark, n) for n in ("raw", "flat", "warehouse")))


def drifting_pages(spark, sf_dir):
    """A page per event: on every third day values are null, on the next ones whole, on the others fractions."""
    events = table(spark, sf_dir, "events").selectExpr("*", "cast(ts AS date) AS file_date")
    first = events.agg(F.min("file_date")).first()[0]
    third = F.datediff("file_date", F.lit(first)) % 3
    value = F.when(third == 1, F.col("event_id").cast("string")).when(
        third == 2, (F.col("event_id") + 0.5).cast("decimal(20,1)").cast("string")
    ).otherwise(F.lit("null"))
    body = F.concat(
        F.lit('{"data": [{"id": "'), F.col("user_id"), F.lit('", "name": "V'), F.col("user_id"),
        F.lit('", "engineRpm": [{"time": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('", "value": '), value,
        F.lit("}]}]}"),
    )
    return events.select(F.lit(RPM).alias("table_name"), body.alias("body"), "file_date", third.alias("third"))


DRIFTED = f"""SELECT CAST(user_id AS VARCHAR) AS vehicle_id, 'V' || user_id AS parc_id, date_trunc('second', ts) AS time,
    CASE {THIRD} WHEN 1 THEN CAST(event_id AS DOUBLE) WHEN 2 THEN event_id + 0.5::DOUBLE END AS "engineRpm",
    CAST(ts AS DATE) AS file_date FROM events"""


def loaded(spark, root):
    return read_days(spark, f"{root}/{RPM}").select("vehicle_id", "parc_id", "time", F.col("engineRpm").cast("double"), "file_date")


@query("land_drifting_types", f"SELECT DISTINCT *, 'void then bigint then double' AS widened FROM ({DRIFTED})")
def land_drifting_types(spark, sf_dir):
    """Null days, whole days and days of fractions land one after the other, are transformed and loaded; then one day is
    answered again with nothing, and once more with its rows."""
    roots, job, pages = roots_of(spark), TableJob("vehicle_stats", RPM), drifting_pages(spark, sf_dir)
    spec, seen = LoadSpec("time", "time", ("vehicle_id",)), []
    for third in (0, 1, 2):
        batch = pages.filter(F.col("third") == third)
        evolving.run_days(spark, roots.raw, roots.flat, roots.warehouse, batch, job, spec)
        flat = stored_schema(spark, f"{roots.flat}/vehicle_stats/{RPM}/{RPM}")[1]
        seen.append(flat["engineRpm"].dataType.simpleString())
    again = pages.filter("third = 1")
    none = again.select("table_name", F.lit('{"data": []}').alias("body"), "file_date").distinct()
    for batch in (none, again):
        evolving.run_days(spark, roots.raw, roots.flat, roots.warehouse, batch, job, spec)
    return loaded(spark, roots.warehouse).withColumn("widened", F.lit(" then ".join(seen)))


@query(
    "land_rescued",
    """SELECT o_orderkey AS page, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS id,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price,
    CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS place_row,
    CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'F' THEN NULL ELSE '{' || concat_ws(',',
      CASE WHEN o_orderstatus = 'P' THEN '"id":"P' || o_orderkey || '"' END,
      CASE WHEN o_orderstatus = 'F' THEN '"place.row":["' || o_custkey || '"],"place.seat":' || o_custkey END,
      CASE WHEN o_orderpriority = '1-URGENT' THEN '"price":"' || o_orderpriority || '"' END) || '}' END AS rescued FROM orders""",
)
def land_rescued(spark, sf_dir):
    """Records read with a declared type: pending ones have text as id, finished ones a list as row and a seat that the
    type lacks, urgent ones text as price. Columns keep what fits, the rest is beside them."""
    body = """to_json(named_struct('data', array(named_struct('id', o_orderkey, 'price', o_totalprice,
        'place', named_struct('row', o_custkey)))))"""
    pages = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS page", "o_orderstatus", "o_orderpriority", "o_custkey", f"{body} AS body")
    pending = F.regexp_replace("body", '"id":([0-9]+)', '"id":"P$1"')
    pages = pages.withColumn("body", F.when(F.col("o_orderstatus") == "P", pending).otherwise(F.col("body")))
    finished = F.regexp_replace("body", '"row":([0-9]+)', '"row":["$1"],"seat":$1')
    pages = pages.withColumn("body", F.when(F.col("o_orderstatus") == "F", finished).otherwise(F.col("body")))
    urgent = F.regexp_replace("body", '"price":[^,]+', '"price":"1-URGENT"')
    pages = pages.withColumn("body", F.when(F.col("o_orderpriority") == "1-URGENT", urgent).otherwise(F.col("body")))
    records = envelope.unwrap_envelope(pages.select("page", "body"))
    out = rescue.records_rescued(records, "id bigint, price double, place struct<row: bigint>")
    return out.withColumn("rescued", F.to_json("rescued"))


@query(
    "load_upsert",
    """SELECT user_id, CASE WHEN last THEN 'second' ELSE 'first' END AS batch, event_id, value, CASE WHEN last THEN event_type END AS kind
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n,
      event_id % 3 = 0 AS last FROM events) WHERE n = 1""",
)
def load_upsert(spark, sf_dir):
    """Events as deliveries of their user's state, in two batches that overlap in time; the second has one more column.
    Per user the newest delivery stays, whichever batch brought it; an empty batch and the first one again change nothing."""
    base = scratch_path(spark, "upserted")
    events = table(spark, sf_dir, "events").selectExpr(
        "user_id", "event_id", "value", "event_type", "struct(ts, event_id) AS delivered", "event_id % 3 = 0 AS last"
    )
    first = events.filter("NOT last").drop("event_type", "last").withColumn("batch", F.lit("first"))
    second = events.filter("last").withColumnRenamed("event_type", "kind").drop("last").withColumn("batch", F.lit("second"))
    for batch in (first, second, second.limit(0), first):
        upsert.upsert(batch, base, ["user_id"], "delivered", buckets=16)
    return upsert.read_upserted(spark, base).select("user_id", "batch", "event_id", "value", "kind")


@query(
    "requests_open",
    """WITH days AS (SELECT DISTINCT event_type AS t, CAST(ts AS DATE) AS d FROM events),
    spans AS (SELECT event_type AS t, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) + 1 AS b FROM events GROUP BY 1),
    hours AS (SELECT t, unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h FROM spans),
    done AS (SELECT DISTINCT event_type AS t, date_trunc('hour', ts) AS h FROM events),
    free AS (SELECT t, h, CAST(h AS DATE) AS d FROM hours WHERE (t, h) NOT IN (SELECT (t, h) FROM done)),
    runs AS (SELECT *, h - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY t, d ORDER BY h) AS g FROM free)
    SELECT t AS table_name, min(h) AS window_start, max(h) + INTERVAL 1 HOUR AS window_end FROM runs GROUP BY t, d, g""",
)
def requests_open(spark, sf_dir):
    """Every hour with an event is answered, in two commits that overlap; what is open of a plan of whole days is partial."""
    root = scratch_path(spark, "ledger")
    events = table(spark, sf_dir, "events").selectExpr("event_type AS table_name", "cast(ts AS timestamp) AS at", "event_id")
    hour = F.date_trunc("hour", "at")
    answered = events.select("table_name", "event_id", hour.alias("window_start"), (hour + F.expr("INTERVAL 1 HOUR")).alias("window_end"))
    for half in ("event_id % 2 = 0", "event_id % 3 > 0 OR event_id % 2 = 1"):
        ledger.record_answers(answered.filter(half).drop("event_id"), root)
    spans = events.groupBy("table_name").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    days = F.explode(F.sequence(F.date_trunc("day", "first"), F.date_trunc("day", "last"), F.expr("INTERVAL 1 DAY")))
    planned = spans.select("table_name", days.alias("window_start"))
    planned = planned.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 DAY"))
    return ledger.requests_open(spark, root, planned)


@query(
    "run_due_windows",
    """SELECT CAST(user_id AS VARCHAR) AS vehicle_id, 'V' || user_id AS parc_id, date_trunc('second', ts) AS time,
    event_id + 0.5::DOUBLE AS "engineRpm", CAST(ts AS DATE) AS file_date, 0::BIGINT AS still_open FROM events""",
)
def run_due_windows(spark, sf_dir):
    """A plan of half days: the first run gets answers to the mornings only and asks for the rest in the second one;
    the third finds nothing due. Both halves of a day stand beside each other in all tables."""
    roots, log, job = roots_of(spark), scratch_path(spark, "ledger"), TableJob("vehicle_stats", RPM)
    events = table(spark, sf_dir, "events").selectExpr("*", "cast(ts AS timestamp) AS at")
    half = F.date_trunc("day", "at") + F.when(F.hour("at") < 12, F.expr("INTERVAL 0 HOUR")).otherwise(F.expr("INTERVAL 12 HOUR"))
    reading = F.struct(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), (F.col("event_id") + 0.5).alias("value"))
    record = F.struct(
        F.col("user_id").cast("string").alias("id"), F.concat(F.lit("V"), "user_id").alias("name"), F.array(reading).alias("engineRpm")
    )
    made = events.select(half.alias("window_start"), F.to_json(F.struct(F.array(record).alias("data"))).alias("body"))
    spans = events.agg(F.date_trunc("day", F.min("at")).alias("a"), F.date_trunc("day", F.max("at")).alias("b"))
    halves = F.explode(F.sequence(F.col("a"), F.col("b") + F.expr("INTERVAL 12 HOUR"), F.expr("INTERVAL 12 HOUR")))
    planned = spans.select(F.lit(RPM).alias("table_name"), halves.alias("window_start"))
    planned = planned.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 12 HOUR"))

    def answers(hours):
        def answer(open_windows):
            asked = open_windows.filter(F.hour("window_start").isin(*hours))
            pages = asked.join(made, "window_start", "left")
            return pages.withColumn("body", F.coalesce("body", F.lit('{"data": []}')))

        return answer

    for hours in ((0,), (0, 12), (0, 12)):
        due.run_due(spark, roots, log, planned, answers(hours), [job], {job.table: LoadSpec("time", "time", ("vehicle_id",))})
    left = ledger.requests_open(spark, log, planned).count()
    return loaded(spark, roots.warehouse).withColumn("still_open", F.lit(left).cast("bigint"))


@query(
    "fanout_from_lake",
    """SELECT 'fleet_vehicles' AS source_table, CAST(s_suppkey AS VARCHAR) AS key, 'v1/fleet/vehicles/' || s_suppkey || '/safety/score' AS endpoint
    FROM supplier UNION ALL SELECT 'alerts_configurations', 'A' || c_custkey, NULL FROM customer""",
)
def fanout_from_lake(spark, sf_dir):
    """Keys of the catalogue's keyed requests, read from the raw tables that it names, and the requests of single keys."""
    raw, known = scratch_path(spark, "raw"), catalogue(spark)
    places = dict(known.filter("table_name IN ('fleet_vehicles', 'alerts_configurations')").select("table_name", "family").distinct().collect())
    vehicles = table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey AS string) AS id", "s_name AS name", "s_acctbal")
    alerts = table(spark, sf_dir, "customer").selectExpr("concat('A', c_custkey) AS id", "c_name AS name")
    for name, df in (("fleet_vehicles", vehicles.union(vehicles)), ("alerts_configurations", alerts)):
        base = "/".join([raw, *([places[name]] if places[name] else []), name])
        for number, part in enumerate(("id < 'A5'", "id >= 'A5'", "id IS NULL")):
            df.filter(part).write.parquet(f"{base}/file_date=2024-01-{number + 1:02d}")
    keys = due.lake_keys(spark, raw, known)
    asked = requests.fan_out(known, keys).selectExpr("'fleet_vehicles' AS source_table", "cast(key AS string) AS key", "endpoint")
    return keys.join(asked, ["source_table", "key"], "left").select("source_table", "key", "endpoint")


@query(
    "state_versions",
    """SELECT 'readings_u' || c_custkey AS table_name, CASE WHEN c_nationkey < 10 THEN DATE '2024-02-01' ELSE DATE '2024-03-01' END AS last_download_time,
    3::BIGINT AS version, 1::BIGINT AS lost FROM customer""",
)
def state_versions(spark, sf_dir):
    """A state committed by one run; then two runs start from it: one commits, the other fails and, begun anew from the
    newest version, adds its own tables to it."""
    root = scratch_path(spark, "state")
    tables = table(spark, sf_dir, "customer").selectExpr("concat('readings_u', c_custkey) AS table_name", "'time' AS download_type", "c_nationkey")
    one, two = (tables.filter(f).drop("c_nationkey") for f in ("c_nationkey < 10", "c_nationkey >= 10"))
    empty = spark.createDataFrame([], progress.STATE_TYPE)
    committed.commit(progress.upsert_state(empty, one, "last_download_time", F.lit("2024-01-01")), root, 0)
    number, state = committed.newest(spark, root)
    committed.commit(progress.upsert_state(state, one, "last_download_time", F.lit("2024-02-01")), root, number)
    lost = 0
    while True:
        try:
            committed.commit(progress.upsert_state(state, two, "last_download_time", F.lit("2024-03-01")), root, number)
            break
        except versions.Conflict:
            lost += 1
            number, state = committed.newest(spark, root)
    number, state = committed.newest(spark, root)
    shown = F.lit(number).cast("bigint").alias("version"), F.lit(lost).cast("bigint").alias("lost")
    return state.select("table_name", "last_download_time", *shown)


@query("stream_run", f"SELECT DISTINCT * FROM ({DRIFTED})")
def stream_run_query(spark, sf_dir):
    """Pages in four files, taken two at a time, days falling into several batches; a batch run again under its number,
    and a stream that finds nothing new, change nothing."""
    roots, job = roots_of(spark), TableJob("vehicle_stats", RPM)
    source, checkpoint = scratch_path(spark, "pages"), scratch_path(spark, "progress")
    specs = {RPM: LoadSpec("time", "time", ("vehicle_id",))}
    pages = drifting_pages(spark, sf_dir).select("table_name", "body", "file_date")
    for half in (0, 1):
        part = pages.filter(F.pmod(F.xxhash64("body"), F.lit(2)) == half)
        part.repartition(2, "body").write.mode("append").parquet(source)
        stream_run(spark, source, roots, [job], specs, checkpoint, max_files=2)
    again = pages.filter(F.pmod(F.xxhash64("body"), F.lit(2)) == 1)
    run_batch(again, 1, roots, [job], specs)
    stream_run(spark, source, roots, [job], specs, checkpoint)
    return loaded(spark, roots.warehouse)


@query(
    "steps_quarantine",
    """SELECT 'kept' AS part, CAST(o_orderkey AS VARCHAR) AS key, o_totalprice AS price, NULL::INTEGER AS step, NULL AS reason FROM orders
      WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'
    UNION ALL SELECT 'failed', CAST(o_orderkey AS VARCHAR), NULL, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END,
      CASE WHEN o_orderstatus = 'P' THEN 'price is no float: P' ELSE 'day is no datetime: 1-URGENT' END FROM orders
      WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'""",
)
def steps_quarantine(spark, sf_dir):
    """Prices of pending orders and days of urgent ones cannot be read; the other rows go through all steps."""
    raw = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS string) AS id",
        "CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE cast(o_totalprice AS string) END AS price",
        f"CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority ELSE {fixtures.iso('o_orderdate')} END AS day",
    )
    steps = [
        step("rename", mapping={"id": "key"}),
        step("cast", columns=["price"], dtype="float"),
        step("cast", columns=["day"], dtype="datetime"),
    ]
    kept, failed = quarantine.run_steps_rowwise(raw, steps)
    none = F.lit(None)
    left = failed.select(
        F.lit("failed").alias("part"), F.get_json_object("record", "$.key").alias("key"), none.cast("double").alias("price"), "step", "reason"
    )
    return kept.select(F.lit("kept").alias("part"), "key", "price", none.cast("int").alias("step"), none.cast("string").alias("reason")).union(left)


@query(
    "write_clustered",
    "SELECT *, true AS narrow FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem)",
)
def write_clustered(spark, sf_dir):
    """Line items in 64 files along a curve over part and supplier: a narrow range of either opens a small part of them,
    by the files' own least and greatest values."""
    path = scratch_path(spark, "clustered")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    clustering.write_clustered(rows, path, ["l_partkey", "l_suppkey"], files=64)
    written = spark.read.schema(rows.schema).parquet(path)
    ranges = written.groupBy("_metadata.file_name").agg(
        *[f(n).alias(f"{short}_{n}") for short, f in (("low", F.min), ("high", F.max)) for n in ("l_partkey", "l_suppkey")]
    )
    middle = rows.agg(F.percentile_approx("l_partkey", 0.5), F.percentile_approx("l_suppkey", 0.5)).first()
    opened = [
        F.count_if((F.col(f"low_{n}") <= value) & (F.col(f"high_{n}") >= value)) for n, value in zip(("l_partkey", "l_suppkey"), middle)
    ]
    files, by_part, by_supplier = ranges.agg(F.count(F.lit(1)), *opened).first()
    return written.withColumn("narrow", F.lit(max(by_part, by_supplier) * 2 < files))
