"""Stored schemas, rescued values, upserts, the request ledger, committed state, quarantine and clustering."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.operators import clustering, numbering
from telemetry_lake.plans import committed, due, evolving, ledger, progress, quarantine
from telemetry_lake.plans.jobs import TableJob
from telemetry_lake.plans.run import Roots
from telemetry_lake.plans.steps import step
from telemetry_lake.sources import evolving as types
from telemetry_lake.sources import rescue, upsert, versions
from telemetry_lake.sources.warehouse import LoadSpec
from telemetry_lake.streaming.run import stream_run

DAY = dt.date


def ddl(text):
    return T.DataType.fromDDL(text)


# --- the lattice


@pytest.mark.parametrize(
    "first, second, met",
    [
        ("void", "bigint", "bigint"),
        ("int", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("decimal(4,1)", "bigint", "double"),
        ("double", "string", "string"),
        ("boolean", "bigint", "string"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("struct<a: bigint>", "struct<b: string, a: double>", "struct<a: double, b: string>"),
        ("struct<a: bigint>", "array<bigint>", "string"),
        ("array<struct<a: void>>", "array<struct<a: boolean>>", "array<struct<a: boolean>>"),
        ("variant", "bigint", "string"),
    ],
)
def test_types_meet(spark, first, second, met):
    # Meeting is symmetric (but for the order of fields), and both sides are below what they meet at.
    got = types.widen(ddl(first), ddl(second))
    assert got.simpleString() == ddl(met).simpleString()
    for one in (first, second):
        assert types.widen(got, ddl(one)) == got


def pages(spark, *made):
    return spark.createDataFrame([(json.dumps({"data": rows}), DAY(2024, 1, d)) for d, rows in made], "body string, file_date date")


def roots(tmp_path):
    return [f"{tmp_path}/{n}" for n in ("raw", "flat", "warehouse")]


def test_days_of_all_types(spark, tmp_path, rows):
    raw, flat, wh = roots(tmp_path)
    job, spec = TableJob("f", "own"), LoadSpec("time", None, ("id",))

    def run(*made):
        evolving.run_days(spark, raw, flat, wh, pages(spark, *made), job, spec)
        return types.read_days(spark, f"{wh}/own")

    first = run((1, [{"id": "a", "v": None, "o": {"x": 1}, "l": [{"p": None}]}]), (2, []))
    assert dict(first.dtypes)["v"] == "string" and types.stored_schema(spark, f"{flat}/f/own/own")[1]["v"].dataType == T.NullType()
    second = run((2, [{"id": "b", "v": 3, "o": {"x": 1.5}, "l": [{"p": 2}]}]))
    assert dict(second.dtypes)["v"] == "bigint" and dict(second.dtypes)["o_x"] == "double"
    third = run((3, [{"id": "c", "v": 2.5, "o": {"x": True}, "n": {"deep": [1]}}]), (1, []))
    # Day 1 was answered with nothing the second time.
    assert rows(third, "id", "v", "o_x", "l") == [("b", 3.0, "1.5", '[{"p": 2}]'), ("c", 2.5, "true", None)]
    # The same again leaves the same table, and no new schema.
    number = types.stored_schema(spark, f"{wh}/own")[0]
    assert rows(run((3, [{"id": "c", "v": 2.5, "o": {"x": True}, "n": {"deep": [1]}}])), "id") == [("b",), ("c",)]
    assert types.stored_schema(spark, f"{wh}/own")[0] == number
    only = types.read_days(spark, f"{wh}/own", days=[DAY(2024, 1, 2)])
    assert [r.id for r in only.collect()] == ["b"] and all("file_date=2024-01-02" in f for f in only.inputFiles()[:1])


def test_days_of_nothing_at_all(spark, tmp_path):
    raw, flat, wh = roots(tmp_path)
    evolving.run_days(spark, raw, flat, wh, pages(spark, (1, [])), TableJob("f", "own"), LoadSpec())
    assert types.read_days(spark, f"{raw}/f/own").count() == 0
    assert types.read_days(spark, f"{wh}/none").count() == 0


def test_tables_that_split_drift_too(spark, tmp_path, rows):
    raw, flat, wh = roots(tmp_path)
    job, spec = TableJob("assets", "fleet_assets_reefers"), LoadSpec()
    value = "ReeferStats"
    for day, hours in ((1, 5), (2, 5.5)):
        made = {"assetType": "r", "id": day, "name": "n", value: {"engineHours": [{"changedAtMs": 1000 * day, "engineHours": hours}]}}
        evolving.run_days(spark, raw, flat, wh, pages(spark, (day, [made])), job, spec)
    loaded = types.read_days(spark, f"{wh}/ReeferStats_engineHours")
    assert [(int(i), hours) for i, hours in rows(loaded, "asset_id", "engineHours")] == [(1, 5.0), (2, 5.5)]
    assert types.stored_schema(spark, f"{wh}/ReeferStats_setPoint")[0] == 0


def test_two_writers_widen_one_schema(spark, tmp_path, monkeypatch):
    base, real, raced = f"{tmp_path}/t", versions.commit, []

    def commit(spark, root, after, content):
        if not raced:
            raced.append(1)
            real(spark, root, after, T.StructType([T.StructField("b", T.LongType())]).json())
        return real(spark, root, after, content)

    monkeypatch.setattr(versions, "commit", commit)
    number, schema = types.merge_schema(spark, base, ddl("struct<a: bigint>"))
    assert number == 2 and schema.names == ["b", "a"]


# --- rescued values


def test_nothing_is_lost(spark):
    made = [
        {"id": 1, "price": 2.5, "place": {"row": 3}},
        {"id": "x", "price": "cheap", "place": {"row": 3.5, "seat": "A"}, "extra": {"a": [1]}},
        {"id": 1.5, "price": 2, "place": 7, "l": [1, "b"]},
        [1],
        None,
        {"id": None, "l": [1, None, 3], "zz": None, "place.row": 4, "place": {"row": "r"}},
        5,
        {"id": 12345678901234567890, "place": {}},
    ]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(made)], "k int, j string")
    records = df.select("k", F.parse_json("j").alias("record"))
    out = rescue.records_rescued(records, "id bigint, price double, place struct<row: bigint>, l array<bigint>")
    got = {r.k: r for r in out.withColumn("rescued", F.to_json("rescued")).collect()}
    left = {k: json.loads(r.rescued) if r.rescued else None for k, r in got.items()}
    assert left == {
        0: None,
        1: {"id": "x", "price": "cheap", "place.row": 3.5, "place.seat": "A", "extra": {"a": [1]}},
        2: {"id": 1.5, "place": 7, "l": [1, "b"]},
        3: {"$": [1]},
        4: None,
        5: {"place\\.row": 4, "place.row": "r"},
        6: {"$": 5},
        7: {"id": 12345678901234567890},
    }
    assert (got[0].id, got[0].price, got[0].place_row, got[2].price, got[5].l) == (1, 2.5, 3, 2.0, [1, None, 3])
    wider = rescue.restore(out, "id string, extra struct<a: array<bigint>>").withColumn("rescued", F.to_json("rescued"))
    again = {r.k: r for r in wider.collect()}
    assert again[1].id == "x" and again[1].extra.a == [1] and "extra" not in again[1].rescued and again[7].rescued is None


# --- upserts


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path, rows):
    base = f"{tmp_path}/t"
    kind = "id bigint, at bigint, v string"
    first = spark.createDataFrame([(i, 5, "a") for i in range(200)] + [(None, 5, "n"), (1, 5, "a")], kind)
    assert upsert.upsert(first, base, ["id"], "at", buckets=32) == 1
    before = set(upsert.read_upserted(spark, base).inputFiles())
    batch = spark.createDataFrame([(3, 6, "new"), (4, 4, "stale"), (5, 5, "equal"), (None, None, "x"), (900, 1, "fresh")], kind)
    assert upsert.upsert(batch, base, ["id"], "at") == 2
    after = set(upsert.read_upserted(spark, base).inputFiles())
    touched = {r[0] for r in batch.select(upsert.bucket_of(["id"], 32)).collect()}
    assert len(before - after) <= len(touched) < 32 and before & after
    assert all(any(f"__bucket={b}/" in f for b in touched) for f in (before ^ after))
    got = {r.id: r.v for r in upsert.read_upserted(spark, base).collect()}
    assert (got[3], got[4], got[5], got[900], got[None], got[7]) == ("new", "a", "equal", "fresh", "n", "a") and len(got) == 202
    # A wider type and a new column.
    upsert.upsert(spark.createDataFrame([(3, 7, 1.5, True)], "id bigint, at bigint, w double, b boolean"), base, ["id"], "at")
    row = upsert.read_upserted(spark, base).filter("id = 3").first()
    assert (row.v, row.w, row.b) == (None, 1.5, True) and upsert.read_upserted(spark, base).count() == 202


def test_upsert_that_loses_the_race_starts_anew(spark, tmp_path, monkeypatch):
    base, real, raced = f"{tmp_path}/t", versions.commit, []
    kind = "id bigint, at bigint"

    def commit(spark, root, after, content):
        if not raced:
            raced.append(1)
            upsert.upsert(spark.createDataFrame([(1, 9), (2, 1)], kind), base, ["id"], "at", buckets=4)
        return real(spark, root, after, content)

    monkeypatch.setattr(versions, "commit", commit)
    assert upsert.upsert(spark.createDataFrame([(1, 5), (3, 1)], kind), base, ["id"], "at", buckets=4) == 2
    assert sorted(map(tuple, upsert.read_upserted(spark, base).collect())) == [(1, 9), (2, 1), (3, 1)]


# --- the ledger


def brute_open(planned, answered):
    """Minutes of every plan that no answer covers, as runs."""
    out = []
    for t, a, b in planned:
        free = [m for m in range(a, b) if not any(t == u and x <= m < y for u, x, y in answered)]
        for m in free:
            if out and out[-1][0] == t and out[-1][2] == m and out[-1][3] == (a, b):
                out[-1][2] = m + 1
            else:
                out.append([t, m, m + 1, (a, b)])
    return sorted((t, x, y) for t, x, y, _ in out)


def test_open_windows_against_minutes(spark, tmp_path):
    import random

    draw = random.Random(3)
    base = dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc)

    def windows(made):
        at = lambda m: base + dt.timedelta(minutes=60 * m)
        return spark.createDataFrame([(t, at(a), at(b)) for t, a, b in made], ledger.LEDGER_TYPE)

    def spans(count, longest):
        made = []
        for _ in range(count):
            a = draw.randrange(0, 24 * 70)
            made.append((draw.choice("xy"), a, a + draw.randrange(0, longest)))
        return made

    planned, answered = spans(12, 500), spans(60, 40)
    planned = list({p: 1 for p in planned if p[2] > p[1]})
    assert ledger.record_answers(windows(answered[:40]), f"{tmp_path}/l") == 1
    assert ledger.record_answers(windows(answered[20:]), f"{tmp_path}/l") == 2
    hours = lambda v: int((v - base.replace(tzinfo=None)).total_seconds() // 3600)
    got = [(r[0], hours(r[1]), hours(r[2])) for r in ledger.requests_open(spark, f"{tmp_path}/l", windows(planned)).collect()]
    assert sorted(got) == brute_open(planned, answered)
    merged = [(r[0], hours(r[1]), hours(r[2])) for r in ledger.read_ledger(spark, f"{tmp_path}/l")[1].collect()]
    covered = {(t, m) for t, a, b in answered for m in range(a, b)}
    assert {(t, m) for t, a, b in merged for m in range(a, b)} == covered
    ends = {(t, b) for t, _, b in merged}
    assert not ends & {(t, a) for t, a, _ in merged}
    assert ledger.requests_open(spark, f"{tmp_path}/none", windows(planned)).count() == len(planned)


def test_a_run_asks_for_what_is_open(spark, tmp_path):
    kind = "table_name string, window_start timestamp, window_end timestamp"
    at = lambda h: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=h)
    planned = spark.createDataFrame([("own", at(0), at(24))], kind)
    asked = []

    def answer(upto):
        def give(open_windows):
            asked.append([(r.window_start.hour, r.window_end.hour) for r in open_windows.collect()])
            made = [("own", json.dumps({"data": [{"id": upto}]}), at(upto - 6), at(upto))]
            return spark.createDataFrame(made, "table_name string, body string, window_start timestamp, window_end timestamp")

        return give

    where = Roots(*roots(tmp_path))
    for upto in (6, 18, 12):
        due.run_due(spark, where, f"{tmp_path}/l", planned, answer(upto), [TableJob("f", "own")], {})
    assert asked == [[(0, 0)], [(6, 0)], [(6, 12), (18, 0)]]
    assert sorted(r.id for r in types.read_days(spark, f"{where.warehouse}/own").collect()) == [6, 12, 18]


# --- committed state


def test_of_two_writers_one_commits(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = f"{tmp_path}/s"
    state = spark.createDataFrame([], progress.STATE_TYPE)
    names = spark.createDataFrame([("a", "time")], "table_name string, download_type string")
    assert committed.commit(progress.upsert_state(state, names, "last_download_time", F.lit("2024-01-01")), root, 0) == 1

    def write(_):
        try:
            return committed.commit(committed.newest(spark, root)[1], root, 1)
        except versions.Conflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(write, range(4)))
    assert sorted(done, key=str) == [2, None, None, None]
    assert committed.newest(spark, root)[0] == 2 and committed.at(spark, root, 1).count() == 1
    assert not [n for n in versions.child_names(spark, f"{root}/_versions") if n.startswith(".") and not n.endswith(".crc")]


def test_keys_come_from_whatever_has_landed(spark, tmp_path, rows):
    config = "struct<exception_type: string, constraint: string, table_name: string, table_column_name: string>"
    known = spark.sql(
        f"""SELECT * FROM VALUES ('f', 'a', NULL), ('f', 'b', NULL), (NULL, 'c', NULL),
        ('g', 'w', named_struct('x', 'table', 'y', 'dynamic_url', 'z', 'a', 'c', 'key')),
        ('g', 'x', named_struct('x', 'table', 'y', 'dynamic_url', 'z', 'b', 'c', 'key')),
        ('g', 'y', named_struct('x', 'table', 'y', 'dynamic_url', 'z', 'gone', 'c', 'key'))
        AS t(family, table_name, exception_config)"""
    ).withColumn("exception_config", F.col("exception_config").cast(config))
    spark.createDataFrame([("1", 2), ("1", 3), (None, 4)], "key string, other int").write.parquet(f"{tmp_path}/f/a")
    evolving.land_days(pages(spark, (1, [{"id": 7, "z": 1}]), (2, [{"id": "t"}])), str(tmp_path), TableJob("f", "b"))
    keys = due.lake_keys(spark, str(tmp_path), known)
    assert rows(keys) == [("a", "1"), ("b", "7"), ("b", "t")]
    assert "ReadSchema: struct<key:string>" in keys._jdf.queryExecution().executedPlan().toString()


# --- the run as a stream, quarantine, clustering, positions


def test_a_stream_that_stops_goes_on(spark, tmp_path, rows, monkeypatch):
    import telemetry_lake.streaming.run as stream

    where, job = Roots(*roots(tmp_path)), TableJob("f", "own")
    source, log = f"{tmp_path}/pages", f"{tmp_path}/log"

    def arrive(*made):
        pages(spark, *made).select(F.lit("own").alias("table_name"), "body", "file_date").write.mode("append").parquet(source)

    arrive((1, [{"id": 1, "v": 1}]))
    stream_run(spark, source, where, [job], {}, log)
    arrive((1, [{"id": 2, "v": 2.5}]), (2, [{"id": 3, "v": None}]))
    real = stream.run_days

    def stopped(*args):
        real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(stream, "run_days", stopped)
    with pytest.raises(Exception, match="lost"):
        stream_run(spark, source, where, [job], {}, log)
    monkeypatch.setattr(stream, "run_days", real)
    for _ in range(2):
        stream_run(spark, source, where, [job], {}, log)
        assert rows(types.read_days(spark, f"{where.warehouse}/own"), "id", "v") == [(1, 1.0), (2, 2.5), (3, None)]


def test_rows_that_fail_leave_with_their_reasons(spark):
    df = spark.createDataFrame([("1", "2024-01-01T00:00:00Z", 5), ("x", "?", 6), (None, "?", 7)], "a string, t string, n int")
    steps = [step("cast", columns=["a", "none"], dtype="int"), step("drop", columns=["n"]), step("cast", columns=["t"], dtype="datetime")]
    kept, failed = quarantine.run_steps_rowwise(df, steps)
    assert [r.a for r in kept.collect()] == [1]
    got = sorted((r.step, r.operation, r.reason, json.loads(r.record).get("n")) for r in failed.collect())
    assert got == [(1, "cast", "a is no int: x", 6), (3, "cast", "t is no datetime: ?", None)]
    assert quarantine.run_steps_rowwise(df, [])[1].count() == 0


def test_the_curve_keeps_bits_in_turn(spark):
    row = spark.range(1).select(clustering.interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("z")).first()
    assert row.z == 0b100111
    df = spark.createDataFrame([(None, "b", DAY(2024, 1, 1)), (1, None, None), (2, "", DAY(2024, 2, 1))], "a int, b string, c date")
    assert df.select(clustering.curve_position(df, ["a", "b", "c"])).distinct().count() == 3
    assert df.limit(0).select(clustering.curve_position(df.limit(0), ["a"])).count() == 0


def test_positions_follow_the_order(spark):
    df = spark.createDataFrame([(i % 3 or None, f"{i:03d}") for i in range(100)] + [(1, "001")], "g int, v string")
    got = numbering.order_rows(df, [F.col("g"), F.col("v").desc()], "at", ["g"]).collect()
    for group in (None, 1, 2):
        own = sorted((r["at"], r.v) for r in got if r.g == group)
        assert [a for a, _ in own] == list(range(len(own))) and [v for _, v in own] == sorted((v for _, v in own), reverse=True)
    assert sorted(r["at"] for r in numbering.order_rows(df, [F.col("v")], "at").collect()) == list(range(101))
