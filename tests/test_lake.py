"""Manifests, folders, warehouse loads, progress, planning, stages and streams."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from telemetry_lake.plans import catalogue as cat
from telemetry_lake.plans import gaps, progress, requests, run, tables
from telemetry_lake.plans.jobs import TableJob, land_stage, load_stage, transform_stage
from telemetry_lake.session import scratch_path
from telemetry_lake.sources import envelope, lake, manifest, warehouse
from telemetry_lake.sources.envelope import record_schema, records_to_columns, unwrap_envelope
from telemetry_lake.streaming import incremental

DAY = dt.date

# Sample paths and their parts.
FAULTS = "vehicle_stats/fleet_vehicle_stats_faultCodes/fleet_vehicle_stats_faultCodes"
PATHS = {
    "assets/fleet_assets/fleet_assets.parquet": ("fleet_assets", None, None, None),
    f"{FAULTS}_obdii_2024_02_01.parquet": ("fleet_vehicle_stats_faultCodes_obdii", DAY(2024, 2, 1), None, None),
    f"{FAULTS}_j1939_2024_02_01_to_2024_03_01.parquet": (
        "fleet_vehicle_stats_faultCodes_j1939",
        DAY(2024, 2, 1),
        DAY(2024, 3, 1),
        None,
    ),
    f"{FAULTS}_j1939_2024_02_01_to_2024_03_01_12.parquet": (
        "fleet_vehicle_stats_faultCodes_j1939",
        DAY(2024, 2, 1),
        DAY(2024, 3, 1),
        12,
    ),
    "assets/fleet_assets_reefers/ReeferStats_ambientAirTemperature_2024_01_31.parquet": (
        "ReeferStats_ambientAirTemperature",
        DAY(2024, 1, 31),
        None,
        None,
    ),
    "assets/fleet_assets/fleet_assets_2025_05_30.parquet": ("fleet_assets", DAY(2025, 5, 30), None, None),
    "fleet_assets_2025_05_30.parquet": (None, None, None, None),
    "assets/fleet_assets/fleet_assets_2025_05_30.csv": (None, None, None, None),
    "assets/fleet_assets/fleet_assets_2025_13_30.parquet": ("fleet_assets", None, None, None),
}


def paths_frame(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_sample_paths(spark):
    parsed = manifest.manifest(paths_frame(spark, PATHS)).collect()
    assert {r.path: (r.table_name, r.start_date, r.end_date, r["index"]) for r in parsed} == PATHS


def test_coverage_excludes_the_end_day(spark, rows):
    df = paths_frame(spark, ["a/t/t_2024_02_27_to_2024_03_01.parquet", "a/t/t_2024_03_05.parquet", "a/t/t.parquet",
                             "a/t/t_2024_03_05_to_2024_03_01.parquet", "a/t_2024_01_01/t.parquet"])
    days = rows(manifest.covered_days(df), "day")
    assert days == [(DAY(2024, 2, 27),), (DAY(2024, 2, 28),), (DAY(2024, 2, 29),), (DAY(2024, 3, 5),)]


def test_file_suffix(spark):
    names = {
        "fleet_drivers_2024_12_22.parquet": "2024_12_22.parquet",
        "fleet_drivers_2024_12_22_to_2024_12_25.parquet": "2024_12_22_to_2024_12_25.parquet",
        "fleet_drivers_2024_12_22_to_2024_12_25_02.parquet": "2024_12_22_to_2024_12_25_02.parquet",
        "fleet_drivers.parquet": None,
    }
    df = paths_frame(spark, names).select("path", lake.file_suffix(F.col("path")).alias("s"))
    assert {r.path: r.s for r in df.collect()} == names


# --- the built-in catalogue


def test_catalogue_counts(spark):
    df = cat.classify(cat.catalogue(spark))
    got = df.agg(*[F.count_if(flag).alias(flag) for flag in cat.FLAGS], F.count("*").alias("n"),
                 F.count_if(F.col("download_type") == "oneshot").alias("oneshot")).first()
    assert got.n == 50 and got.oneshot == 11
    assert got.is_vehicle_stats == 27 and got.is_exception_row == 4
    assert (got.is_exception_date, got.is_exception_only_start_date, got.is_exception_table) == (1, 1, 2)
    assert got.is_downloadable_oneshot == 11
    assert cat.select_class(cat.catalogue(spark), "is_exception_table").columns == cat.catalogue(spark).columns


def test_selections(spark, tmp_path):
    df = cat.catalogue(spark)
    listed = tmp_path / "tables.csv"
    listed.write_text("name,note\nfleet_tags,x\nunknown,y\n")
    assert cat.select_tables(spark, df, "ALL").count() == 50
    assert cat.select_tables(spark, df).count() == 34
    assert cat.select_tables(spark, df, "core").count() == 5
    assert [r.table_name for r in cat.select_tables(spark, df, tables_file=str(listed)).collect()] == ["fleet_tags"]
    with pytest.raises(ValueError, match="unknown category"):
        cat.select_tables(spark, df, "no")


def test_54_declared_tables():
    assert len(tables.TABLE_STEPS) + len(tables.SPLITS) == 54
    assert set(cat.MAIN_TABLE) - {"fleet_devices"} <= set(tables.TABLE_STEPS)


def test_default_requests(spark):
    state = spark.createDataFrame(
        [("fleet_vehicle_idling", "time", DAY(2024, 1, 9), None, None, None)], progress.STATE_TYPE
    )
    wanted = cat.catalogue(spark).select("table_name")
    plan = requests.build_plan(
        wanted, cat.catalogue(spark), state, F.to_date(F.lit("2024-01-08")), F.to_date(F.lit("2024-01-10"))
    )
    assert plan.count() == 50
    out = requests.window_requests(requests.fill_range(plan))
    got = {}
    for r in out.collect():
        got.setdefault(r.table_name, []).append((r.start_text, r.end_text, r.file_label))
    assert got["fleet_vehicle_idling"] == [("2024-01-09T00:00:00+00:00", "2024-01-09T23:59:59+00:00", "2024_01_09")]
    assert sorted(got["fleet_vehicle_stats_engineRpm"])[1][2] == "2024_01_09"
    assert sorted(got["fleet_vehicles_fuel_energy"])[0] == (
        "2024-01-08T00:00:00+00:00", "2024-01-08T23:59:59+00:00", "2024_01_08",
    )
    assert sorted(got["fleet_hos_daily_logs"])[0] == ("2024-01-08", "2024-01-08", "2024_01_08")
    assert sorted(got["fleet_assets_reefers"])[0] == ("1704672000000", "1704758399000", "2024_01_08")
    assert got["addresses"] == [(None, None, None)]
    assert got["fleet_safety_events_audit_logs"] == [(None, None, None)]
    audit = out.filter("table_name = 'fleet_safety_events_audit_logs'").first()
    assert audit.request_params == {"startTime": "2024-01-08T00:00:00+00:00"}


def test_all_requests_of_a_day(spark):
    ranged = cat.catalogue(spark).withColumns(
        {"last_download_time": F.to_date(F.lit("2024-02-01")), "end_date": F.to_date(F.lit("2024-02-02"))}
    )
    plan = requests.fill_range(ranged)
    keys = spark.range(60).selectExpr("'fleet_vehicles' AS source_table", "cast(id AS string) AS key")
    assert requests.all_requests(plan).count() == 48
    assert requests.all_requests(plan, keys).count() == 48 + 60
    lists = keys.union(keys.selectExpr("'alerts_configurations'", "key"))
    assert requests.all_requests(plan, lists).count() == 48 + 60 + 2


def test_unreadable_parameters_plan_nothing(spark):
    df = cat.catalogue(spark).filter("table_name = 'fleet_tags'").withColumn("params", F.lit("oops,a=1"))
    assert requests.window_requests(df).count() == 0


def test_fan_out_reaches_every_key_once(spark):
    keys = spark.range(120).selectExpr("'alerts_configurations' AS source_table", "concat('k', id) AS key")
    out = requests.fan_out_batches(cat.catalogue(spark), keys)
    sent = out.select(F.explode(F.split(F.regexp_extract("params", "configurationIds=(.*),startTime", 1), ",")).alias("k"))
    assert out.count() == 3 and sent.count() == 120 and sent.distinct().count() == 120


# --- progress and gaps


def test_missing_state_is_empty(spark):
    assert progress.read_state(spark, scratch_path(spark, "no-state")).count() == 0


def test_state_versions(spark):
    path = scratch_path(spark, "state")
    empty = progress.read_state(spark, path)
    updates = spark.createDataFrame([("a", None), ("b", "oneshot")], "table_name string, download_type string")
    progress.write_state(progress.upsert_state(empty, updates, "last_download_time", F.lit("2024-02-01")), path)
    again = progress.read_state(spark, path)
    assert {(r.table_name, r.download_type, r.last_download_time) for r in again.collect()} == {
        ("a", "time", DAY(2024, 2, 1)),
        ("b", "oneshot", DAY(2024, 2, 1)),
    }
    twice = progress.merge_no_data(
        progress.merge_no_data(again, spark.sql("SELECT 'a' AS table_name, DATE'2024-01-02' AS day")),
        spark.sql("SELECT 'a' AS table_name, explode(array(DATE'2024-01-02', DATE'2024-01-01')) AS day"),
    )
    assert twice.filter("table_name = 'a'").first().date_no_data == [DAY(2024, 1, 1), DAY(2024, 1, 2)]
    with pytest.raises(ValueError, match="unknown watermark"):
        progress.upsert_state(again, updates, "date_no_data", F.lit("2024-02-01"))


def test_state_from_json(spark, tmp_path):
    path = tmp_path / "state.json"
    path.write_text(
        '{"a": {"download_type": "time", "last_download_time": "01/02/2024", "date_no_data": ["03/01/2024"]}, "b": {"download_type": "oneshot"}}'
    )
    state = progress.import_state(spark, str(path))
    assert state.schema.simpleString() == progress.STATE_TYPE.simpleString()
    assert sorted(tuple(r) for r in state.collect()) == [
        ("a", "time", DAY(2024, 2, 1), None, None, [DAY(2024, 1, 3)]),
        ("b", "oneshot", None, None, None, None),
    ]


def test_watermark_day_is_done_again(spark):
    files = manifest.manifest(
        paths_frame(spark, ["f/t/t_2024_01_04.parquet", "f/t/t_2024_01_05.parquet", "f/t/t.parquet",
                            "f/t/t_2024_01_05_to_2024_01_04.parquet"])
    ).selectExpr("*", "'time' AS download_type", "table_name AS main_table")
    state = spark.createDataFrame(
        [("t", "time", None, DAY(2024, 1, 5), DAY(2024, 1, 5), None)], progress.STATE_TYPE
    )
    kept = {r.path.split("/")[-1] for r in progress.files_to_transform(files, state).collect()}
    assert kept == {"t_2024_01_05.parquet", "t.parquet"}
    loaded = {r.path.split("/")[-1] for r in progress.files_to_load(files, state).collect()}
    assert loaded == {"t_2024_01_05.parquet", "t.parquet", "t_2024_01_05_to_2024_01_04.parquet"}


def test_gaps_of_the_built_in_tables(spark, rows):
    files = manifest.manifest(
        paths_frame(
            spark,
            [
                "vehicle_stats/fleet_vehicle_stats_engineRpm/fleet_vehicle_stats_engineRpm_2024_01_02.parquet",
                "core/fleet_tags/fleet_tags_drivers_2024_01_02.parquet",
                "safety/fleet_safety_events/fleet_safety_events.parquet",
                "fuel_energy/fleet_vehicle_idling/fleet_vehicle_idling_2024_01_03_to_2024_01_03.parquet",
                f"{FAULTS}_obdii_2024_01_01_to_2024_01_03.parquet",
            ],
        )
    )
    state = spark.createDataFrame(
        [("fleet_vehicle_stats_engineRpm", "time", DAY(2024, 1, 1), None, None, [DAY(2024, 1, 4)])], progress.STATE_TYPE
    )
    missing = gaps.missing_days(
        cat.catalogue(spark), files, state, F.to_date(F.lit("2024-01-05")), F.to_date(F.lit("2023-12-31"))
    )
    assert rows(missing) == [
        *[("fleet_vehicle_idling", d) for d in (DAY(2023, 12, 31), *[DAY(2024, 1, i) for i in range(1, 5)])],
        ("fleet_vehicle_stats_engineRpm", DAY(2024, 1, 1)),
        ("fleet_vehicle_stats_engineRpm", DAY(2024, 1, 3)),
        ("fleet_vehicle_stats_faultCodes", DAY(2023, 12, 31)),
        ("fleet_vehicle_stats_faultCodes", DAY(2024, 1, 3)),
        ("fleet_vehicle_stats_faultCodes", DAY(2024, 1, 4)),
    ]
    again = gaps.replan_gaps(missing, cat.catalogue(spark))
    assert again.count() == 10
    first = requests.window_requests(requests.fill_range(again, "start_date", "end_date")).orderBy("start_text").first()
    assert first.start_text == "2023-12-31T00:00:00+00:00" and first.file_label == "2023_12_31"


# --- pages


def test_envelope_shapes(spark, rows):
    bodies = ['{"data":[{"id":1},{"id":2}]}', '{"data":{"k":[{"id":3}]}}', '{"data":{"id":4,"z":1}}', '{"id":5}',
              '{"data":[]}', '{"data":{}}', '{"data":null,"id":6}', '{"data":{"id":7}}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    records = unwrap_envelope(df)
    assert [r[0] for r in rows(records_to_columns(records, "struct<id: bigint>"))] == [1, 2, 3, 4, 5, 6, 7]
    flat = records_to_columns(records, record_schema(records))
    assert sorted(flat.columns) == ["data", "id", "z"] and flat.count() == 7
    broken = df.union(spark.sql("SELECT 'no json'"))
    assert unwrap_envelope(broken, malformed="drop").count() == 7
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        unwrap_envelope(broken).count()


# --- folders and warehouse


def test_only_later_days_are_read(spark):
    path = scratch_path(spark, "pruned")
    df = spark.range(300).selectExpr("id", "date_add(DATE'2024-01-01', cast(id / 100 AS int)) AS file_date")
    lake.write_partitioned(df, path)
    read = lake.read_since(spark.read.parquet(path), F.to_date(F.lit("2024-01-03")), F.col("file_date"))
    assert read.count() == 100
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(file_date" in plan
    assert len(read.inputFiles()) >= 1
    named = spark.read.parquet(path).filter(F.col("_metadata.file_path").contains("2024-01-02"))
    assert named.count() == 100


def test_scan_reads_only_its_columns(spark, sf_dir):
    df = lake.read_table(spark, sf_dir, None, "lineitem.parquet", columns=["l_suppkey"])
    assert "ReadSchema: struct<l_suppkey:bigint>" in df._jdf.queryExecution().executedPlan().toString()


def test_sub_tables_read_only_their_own_columns(spark, sf_dir):
    from lake_queries.fixtures import reefers

    path = scratch_path(spark, "reefers")
    reefers(spark, sf_dir).write.parquet(path)
    part = tables.split_and_transform(spark.read.parquet(path), "fleet_assets_reefers")["ReeferStats_setPoint"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :]
    assert "ReeferStats_setPoint" in schema and "ReeferStats_engineHours" not in schema


def test_one_row_per_key_before_the_shuffle(spark, sf_dir):
    from lake_queries import QUERIES

    plan = QUERIES["reefer_temperature"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_no_query_runs_python_or_cross_joins(spark, sf_dir):
    from lake_queries import QUERIES

    writing = {n for n in QUERIES if n.startswith(("stream_", "write_", "warehouse_", "schema_", "parquet_", "list_"))}
    for name in set(QUERIES) - writing - {"scan_table", "select_tables", "envelope_inferred"}:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for word in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)


def test_types_the_warehouse_does_not_know(spark):
    with pytest.raises(ValueError, match="binary.*column b"):
        warehouse.conform_types(spark.sql("SELECT cast('x' AS binary) AS b"))
    df = spark.sql("SELECT 1 AS i, 1.5D AS f, true AS b, 's' AS s, '2024-01-01' AS t, array(1) AS l")
    assert dict(warehouse.warehouse_schema(df, "t")) == {
        "i": "INTEGER", "f": "FLOAT", "b": "BOOLEAN", "s": "STRING", "t": "TIMESTAMP", "l": "STRING",
    }


def test_load_spec_of_sub_tables(spark):
    spec = warehouse.load_spec(cat.catalogue(spark), "fleet_vehicle_stats_faultCodes_obdii")
    assert spec == warehouse.LoadSpec("time", "time", ("vehicle_id",))
    assert warehouse.load_spec(cat.catalogue(spark), "fleet_tags_drivers") == warehouse.LoadSpec("oneshot")
    assert warehouse.load_spec(cat.catalogue(spark), "unknown") == warehouse.LoadSpec()


def test_appends_add_and_overwrites_replace(spark):
    path = scratch_path(spark, "loads")
    df = spark.range(5)
    for _ in range(2):
        warehouse.load_table(df, path, warehouse.LoadSpec("time"))
    assert spark.read.parquet(path).count() == 10
    warehouse.load_table(df, path, warehouse.LoadSpec("oneshot"))
    assert spark.read.parquet(path).count() == 5


def test_schema_of_the_newest_file(spark):
    root = scratch_path(spark, "newest")
    spark.range(1).selectExpr("id AS a").write.parquet(f"{root}/f/t/t_2024_01_01.parquet")
    spark.range(1).selectExpr("id AS a", "id AS b").write.parquet(f"{root}/f/t/t_2024_01_02.parquet")
    listed = lake.list_files(spark, root)
    assert lake.newest_schema(spark, root, listed).names == ["a", "b"]
    old = spark.read.parquet(f"{root}/f/t/t_2024_01_01.parquet")
    assert lake.conform_to_schema(old, lake.newest_schema(spark, root, listed)).columns == ["a", "b"]


# --- stages


def pages(spark, day, n):
    body = "to_json(named_struct('data', collect_list(named_struct('id', cast(id AS string), 'name', 'n', 'engineRpm', array(named_struct('time', concat('{0}', 'T00:00:00Z'), 'value', id), named_struct('time', concat('{0}', 'T00:00:00Z'), 'value', id))))))"
    return spark.range(n).groupBy().agg(F.expr(body.format(day)).alias("body")).withColumn("file_date", F.to_date(F.lit(day)))


def test_land_transform_load_and_run_again(spark):
    raw, flat, house = (scratch_path(spark, n) for n in ("raw", "flat", "house"))
    table = "fleet_vehicle_stats_engineRpm"
    job = TableJob("vehicle_stats", table)
    land_stage(pages(spark, "2024-01-01", 3).union(pages(spark, "2024-01-02", 4)), raw, job)
    specs = {table: warehouse.load_spec(cat.catalogue(spark), table)}
    transform_stage(spark, raw, flat, [job])
    load_stage(spark, flat, house, [job], specs, replace_days=True)
    loaded = spark.read.parquet(f"{house}/{table}")
    assert loaded.count() == 7 and set(loaded.columns) == {"vehicle_id", "parc_id", "time", "engineRpm", "load_day", "file_date"}
    later = TableJob("vehicle_stats", table, watermark="2024-01-02")
    land_stage(pages(spark, "2024-01-02", 5), raw, job)
    transform_stage(spark, raw, flat, [later])
    load_stage(spark, flat, house, [later], specs, replace_days=True)
    again = spark.read.parquet(f"{house}/{table}")
    assert {(str(r.load_day), r.n) for r in again.groupBy("load_day").agg(F.count("*").alias("n")).collect()} == {
        ("2024-01-01", 3),
        ("2024-01-02", 5),
    }


def test_loads_need_a_way_to_replace(spark):
    df = spark.sql("SELECT 1 AS id, DATE'2024-01-01' AS file_date")
    path = scratch_path(spark, "whole")
    with pytest.raises(ValueError, match="batch_day"):
        warehouse.load_table(df, path, warehouse.LoadSpec("time"), replace_days=True)
    for _ in range(2):
        warehouse.load_table(df, path, warehouse.LoadSpec("time"), batch_day="file_date")
    assert spark.read.parquet(path).count() == 1


def test_named_files_outside_the_watermark_are_not_opened(spark):
    root = scratch_path(spark, "named")
    for name in ("t_2024_01_01", "t_2024_01_02", "t_2024_01_03_7", "t_sub_2024_01_03", "t"):
        spark.range(2).coalesce(1).write.parquet(f"{root}/f/t/{name}.parquet")
    df = manifest.read_named_files(spark, root, "f", "t", schema="id bigint")
    assert df.count() == 8
    later = lake.read_since(df, F.to_date(F.lit("2024-01-02")), F.col("file_date"))
    assert sorted((r.file_date or DAY(1, 1, 1)) for r in later.collect()) == [
        DAY(1, 1, 1), DAY(1, 1, 1), DAY(2024, 1, 2), DAY(2024, 1, 2), DAY(2024, 1, 3), DAY(2024, 1, 3),
    ]
    scan = later._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 3


def test_fuel_report_takes_its_day_at_landing(spark):
    raw, flat = (scratch_path(spark, n) for n in ("raw", "flat"))
    body = '{"data": {"vehicleReports": [{"vehicle": {"id": "1", "name": "V", "externalIds": {"x.serial": "s"}}, "energyUsedKwh": 2}]}}'
    df = spark.createDataFrame([(body, DAY(2024, 2, 1))], "body string, file_date date")
    schema = "struct<vehicle: struct<id: string, name: string, externalIds: struct<`x.serial`: string>>, energyUsedKwh: double>"
    job = TableJob("fuel_energy", "fleet_vehicles_fuel_energy", schema=schema, external_system="x")
    land_stage(df, raw, job)
    stored = TableJob("fuel_energy", "fleet_vehicles_fuel_energy")
    transform_stage(spark, raw, flat, [stored])
    row = spark.read.parquet(f"{flat}/fuel_energy/fleet_vehicles_fuel_energy/fleet_vehicles_fuel_energy").first()
    assert (row.vehicle_id, row.parc_id, row.energyUsedKwh, str(row.date)) == ("1", "V", 2.0, "2024-02-01 00:00:00")
    assert "vehicle_externalIds_x_serial" not in row


def test_split_tables_through_the_stages(spark, sf_dir):
    from lake_queries import fixtures

    raw, flat, house = (scratch_path(spark, n) for n in ("raw", "flat", "house"))
    name = "fleet_vehicle_stats_faultCodes"
    df = fixtures.fault_codes(spark, sf_dir).withColumn("file_date", F.to_date(F.lit("2024-01-01")))
    lake.write_partitioned(df, lake.table_path(raw, "vehicle_stats", name))
    written = transform_stage(spark, raw, flat, [TableJob("vehicle_stats", name)])
    assert [w.split("/")[-1] for w in written] == [f"{name}_obdii", f"{name}_j1939"]
    expected = tables.split_and_transform(tables.transform_table(fixtures.fault_codes(spark, sf_dir), name), name)
    for part in expected:
        assert spark.read.parquet(f"{flat}/vehicle_stats/{name}/{part}").count() == expected[part].count()
    job = TableJob("vehicle_stats", f"{name}_obdii", parent=name)
    load_stage(spark, flat, house, [job], {})
    assert spark.read.parquet(f"{house}/{name}_obdii").count() == expected[f"{name}_obdii"].count()


# --- streams


def test_batches_do_not_replace_each_other_and_repeats_do_not_add(spark):
    source, target, checkpoint = (scratch_path(spark, n) for n in ("source", "target", "checkpoint"))
    schema = "id bigint, kind string"
    for start in (0, 10):
        spark.range(start, start + 10).selectExpr("id", "'k' AS kind").coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            stream = incremental.read_stream(spark, source, schema, max_files=1)
            incremental.write_tables(stream, lambda b: {"a": b, "b": b.filter("id > 4")}, target, checkpoint, ["kind"])
    assert spark.read.parquet(f"{target}/a").count() == 20
    assert spark.read.parquet(f"{target}/b").count() == 15
    assert len(glob.glob(f"{target.removeprefix('file:')}/a/kind=k/batch_id=*")) == 2


def test_split_stream_runs_the_declared_steps(spark, sf_dir):
    from lake_queries import fixtures

    source, target, checkpoint = (scratch_path(spark, n) for n in ("source", "target", "checkpoint"))
    raw = fixtures.tags(spark, sf_dir)
    raw.write.parquet(source)
    incremental.split_stream(incremental.read_stream(spark, source, raw.schema), "fleet_tags", target, checkpoint)
    expected = tables.split_and_transform(tables.transform_table(raw, "fleet_tags"), "fleet_tags")
    for name, part in expected.items():
        assert spark.read.parquet(f"{target}/{name}").count() == part.count()


def test_late_rows_are_kept_and_repetitions_are_not(spark):
    source, target, checkpoint = (scratch_path(spark, n) for n in ("source", "target", "checkpoint"))
    schema = "id bigint, day date, note string"
    for rows in (
        [(1, DAY(2024, 1, 9), "a"), (1, DAY(2024, 1, 9), "again"), (None, None, "n")],
        [(2, DAY(2020, 1, 1), "late"), (1, DAY(2024, 1, 9), "again"), (None, None, "again")],
        [],
    ):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        incremental.ingest_distinct(incremental.read_stream(spark, source, schema), ["id"], "day", target, checkpoint)
    got = spark.read.parquet(target).select("id", "day")
    assert sorted(map(str, got.collect())) == sorted(
        map(str, spark.createDataFrame([(1, DAY(2024, 1, 9)), (2, DAY(2020, 1, 1)), (None, None)], "id bigint, day date").collect())
    )


def test_records_that_are_not_all_objects_raise(spark):
    df = spark.createDataFrame([('{"data": [{"a": 1}, 5]}',)], "body string")
    records = envelope.unwrap_envelope(df)
    with pytest.raises(ValueError, match="not all objects"):
        envelope.record_schema(records)
    bad = envelope.unwrap_envelope(spark.createDataFrame([('{"data": [{"a": "x"}]}',)], "body string"))
    assert envelope.records_to_columns(bad, "struct<a: bigint>", unfit="null").first().a is None
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        envelope.records_to_columns(bad, "struct<a: bigint>").collect()


@pytest.mark.parametrize("salts", [0, 4])
def test_redelivered_rows_leave_no_second_row(spark, salts):
    """One key is delivered as often as all others together."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("source", "target", "checkpoint"))
    hot = spark.range(100).selectExpr("0L AS id", "TIMESTAMP'2024-01-01' AS time")
    df = spark.range(100).selectExpr("id", "TIMESTAMP'2024-01-01' + make_dt_interval(0, id) AS time").union(hot)
    for _ in range(2):
        df.repartition(6).write.mode("append").parquet(source)
        read = incremental.read_stream(spark, source, df.schema)
        stream = incremental.deduplicated(read, ["id"], "time", "10 days", salts)
        incremental.ingest(stream, target, checkpoint)
    assert spark.read.parquet(target).count() == 100


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        scratch_path(spark, "x")
        named = spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(named.rstrip("/"))
    assert not os.path.exists(scratch_path(spark, "x").removeprefix("file:"))


# --- whole runs


def test_run_lands_days_that_arrive_late(spark, rows, tmp_path):
    job = TableJob(
        "vehicle_stats",
        "fleet_vehicle_stats_engineRpm",
        watermark="2024-01-01",
        schema="struct<id: string, name: string, engineRpm: array<struct<time: string, value: double>>>",
    )
    roots = run.Roots(*(f"{tmp_path}/{n}" for n in ("raw", "flat", "warehouse")))
    state = [f"{tmp_path}/state{i}" for i in range(6)]

    def pages(*days):
        body = '{"data": [{"id": "%d", "name": "V", "engineRpm": [{"time": "2024-01-%02dT00:00:00Z", "value": 1.5}]}]}'
        made = [(job.table, body % (d, d) if d < 9 else '{"data": []}', DAY(2024, 1, d % 9 or 9)) for d in days]
        return spark.createDataFrame(made, "table_name string, body string, file_date date")

    def loaded():
        return rows(spark.read.parquet(f"{roots.warehouse}/{job.table}"), "vehicle_id")

    def missing(path):
        return [d.day for _, d in rows(run.open_days(spark, path))]

    run.run_pipeline(spark, roots, state[0], state[1], pages(1, 3, 6), [job], "2024-01-05")
    assert missing(state[1]) == [2, 4]
    # Day 2 arrives in the second run, day 4 is answered without a record (13 - 9), days 5 and 7 stay missing.
    for after in (2, 3):
        new = run.run_pipeline(spark, roots, state[1], state[after], pages(2, 13, 6), [job], "2024-01-08")
        assert loaded() == [("1",), ("2",), ("3",), ("6",)]
        assert missing(state[after]) == [5, 7]
        assert [r["date_no_data"] for r in new.collect()] == [[DAY(2024, 1, 4)]]
    # A run that stopped after landing: the next one from the same state transforms and loads the day.
    land_stage(pages(5).drop("table_name"), roots.raw, job)
    run.run_pipeline(spark, roots, state[3], state[4], pages(8), [job], "2024-01-09")
    assert loaded() == [("1",), ("2",), ("3",), ("5",), ("6",), ("8",)]
    assert missing(state[4]) == [7]
