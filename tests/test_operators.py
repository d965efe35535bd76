"""Edge rules of the operators."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions import text, time
from telemetry_lake.functions.names import clean_name
from telemetry_lake.operators import columns, nested, numbering, rows as rowops
from telemetry_lake.operators.split import SubTable, split_table
from telemetry_lake.plans.steps import Step, register, run_steps, step


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


# --- columns


def test_rename_swaps_and_refuses_duplicates(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    assert columns.rename_columns(df, {"a": "b", "b": "a", "c": "d"}).columns == ["b", "a"]
    with pytest.raises(ValueError, match="duplicate.*b"):
        columns.rename_columns(df, {"a": "b"})


def test_names_that_differ_in_case_only(spark):
    df = spark.sql("SELECT 1 AS light_on, 2 AS light_On")
    assert columns.drop_columns(df, ["light_on"]).columns == ["light_On"]


def test_clean_names(spark):
    assert clean_name("é.b-c d") == "é_b_c_d"
    with pytest.raises(ValueError, match="a_b"):
        columns.clean_columns(spark.sql("SELECT 1 AS `a.b`, 2 AS `a-b`"))


def test_strict_cast_raises_and_lenient_does_not(spark):
    df = spark.sql("SELECT 'x' AS v")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        columns.cast_columns(df, ["v"], "float").collect()
    assert columns.cast_columns(df, ["v"], "float", lenient=True).first()[0] is None


def test_timestamps_with_and_without_fraction(spark, rows):
    df = spark.sql(
        "SELECT explode(array('2024-01-01T00:00:00Z', '2024-01-01T00:00:00.5Z', '2024-01-01T02:00:00+02:00', '')) AS t"
    )
    out = columns.zoneless_timestamps(columns.cast_columns(df, ["t", "absent"], "datetime"))
    assert [str(r[0]) for r in out.collect()] == [
        "2024-01-01 00:00:00",
        "2024-01-01 00:00:00.500000",
        "2024-01-01 00:00:00",
        "None",
    ]


def test_epoch_needs_its_column_and_keeps_fractions(spark):
    with pytest.raises(ValueError, match="changedAtMs"):
        columns.epoch_columns(spark.range(1), ["changedAtMs"])
    assert str(one(spark, time.zoneless(time.epoch_to_timestamp(F.lit(1.5), T.DoubleType(), "ms")))) == (
        "1970-01-01 00:00:00.001500"
    )
    assert one(spark, time.epoch_to_timestamp(F.lit(2**62), T.LongType(), "ms")) is None


def test_strftime_patterns():
    assert time.java_pattern("%d/%m/%Y %H:%M:%S.%f") == "dd/MM/yyyy HH:mm:ss.SSSSSS"
    assert time.java_pattern("day %j%%") == "'day 'DDD%"
    with pytest.raises(ValueError):
        time.java_pattern("%Q")


def test_external_ids_of_the_named_system_are_dropped(spark):
    from telemetry_lake.plans.tables import default_steps

    df = spark.sql(
        "SELECT 1 AS id, 2 AS externalIds_x_serial, 3 AS externalIds_y_vin, 4 AS vehicle_externalIds_x_vin, 5 AS externalIds_x_name"
    )
    assert run_steps(df, default_steps("x")).columns == ["vehicle_id", "externalIds_y_vin", "externalIds_x_name"]
    assert len(run_steps(df, default_steps()).columns) == 5


# --- rows


def test_drop_nulls_without_listed_column(spark):
    df = spark.sql("SELECT 1 AS a, cast(NULL AS int) AS b")
    assert rowops.drop_null_rows(df, ["c"]).count() == 1
    assert rowops.drop_null_rows(df, ["c"], strict=True).count() == 0
    assert rowops.drop_null_rows(df, ["a", "b"]).count() == 1
    assert rowops.drop_null_rows(df, ["b"]).count() == 0
    assert rowops.drop_null_rows(df).count() == 0


def test_distinct_keeps_nested_types_and_equates_nulls(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, array(named_struct('a', 1, 'b', NULL)), map('x', 1, 'y', 2)),
        (1, array(named_struct('a', 1, 'b', NULL)), map('y', 2, 'x', 1)), (NULL, NULL, NULL), (NULL, NULL, NULL) t(k, l, m)"""
    )
    out = rowops.distinct_rows(df)
    assert out.count() == 2
    assert out.schema == df.schema


def test_distinct_on_is_fixed_by_its_order(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, 5, 'b'), (1, 5, 'a'), (1, 7, 'c'), (NULL, 1, 'x'), (NULL, 0, 'y') t(k, v, s)")
    assert rows(rowops.distinct_on(df, ["k"])) == [(1, 5, "a"), (None, 0, "y")]
    assert rows(rowops.distinct_on(df, ["k"], [F.col("v").desc()])) == [(1, 7, "c"), (None, 1, "x")]
    with pytest.raises(ValueError, match="absent"):
        rowops.distinct_on(df, ["absent"])


def test_distinct_on_scope(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-01'), (1, DATE'2024-01-02'), (1, DATE'2024-01-02') t(k, file_date)")
    assert rowops.distinct_on(df, ["k"], scope=["file_date"]).count() == 2
    assert rowops.distinct_on(df, ["k"], scope=["other"]).count() == 1


@pytest.mark.parametrize(
    ("kind", "expected"), [("b", [0, 0, 1, 0]), ("z", [1, 1, 1, 0]), (None, [1, 1, 1, 0])]
)
def test_conditional_update(spark, kind, expected):
    df = spark.sql(
        "SELECT * FROM VALUES ('t1', 'e', 'a', 0), ('t2', 'e', NULL, 0), ('t3', 'e', 'b', 0), ('t4', 'f', 'b', 0) t(table_name, endpoint, kind, is_processed)"
    )
    match = None if kind is None else F.col("kind") == kind
    out = rowops.conditional_update(df, "e", 1, match).orderBy("table_name")
    assert [r.is_processed for r in out.collect()] == expected


def test_conditional_update_of_a_single_row_ignores_the_match(spark):
    df = spark.sql("SELECT 't' AS table_name, 'e' AS endpoint, 'a' AS kind, 0 AS is_processed")
    assert rowops.conditional_update(df, "e", 2, F.col("kind") == "b").first().is_processed == 2


# --- nested


def test_explode_rules(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, array(1, 2)), (2, array()), (3, NULL), (4, array(NULL)) t(k, l)")
    assert rows(nested.explode(df, "l")) == [(1, 1), (1, 2), (2, None), (3, None), (4, None)]
    assert nested.explode(df, "absent") is df
    assert nested.explode(df, "k") is df
    assert rows(nested.explode_coerced(df, "k"), "k") == [(1,), (2,), (3,), (4,)]


def test_repeated_items_do_not_change_distinct_combinations(spark, rows):
    df = spark.sql("SELECT array(named_struct('x', 1), named_struct('x', 1)) AS a, array(2, 2, NULL, NULL) AS b, 3 AS c")

    def combined(frame):
        return rows(rowops.distinct_rows(nested.explode(nested.explode(frame, "a"), "b")))

    slim = nested.unique_items(nested.unique_items(nested.unique_items(df, "a"), "b"), "c")
    assert combined(slim) == combined(df)
    assert slim.first().b == [2, None] and nested.unique_items(df, "absent") is df


def test_normalize_rules(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', named_struct('b', 1), 'l', array(1)) AS o, 5 AS scalar")
    assert nested.normalize(df, "o", prefix="p_").columns == ["id", "scalar", "p_a_b", "p_l"]
    assert nested.normalize(df, "scalar").columns == ["id", "o"]
    assert nested.normalize(df, "o", keep=["id"], sep="-").columns == ["id", "a-b", "l"]
    with pytest.raises(ValueError, match="absent"):
        nested.normalize(df, "absent")
    with pytest.raises(ValueError, match="duplicate.*id"):
        nested.normalize(spark.sql("SELECT 1 AS id, named_struct('id', 2) AS o"), "o")


def test_flatten_refuses_collisions(spark):
    with pytest.raises(ValueError, match="a_b"):
        nested.flatten(spark.sql("SELECT named_struct('b', 1) AS a, 2 AS a_b"))


def test_split_skips_absent_columns(spark):
    df = spark.sql("SELECT 1 AS id, 2 AS x_a, 3 AS x_b, 4 AS y")
    parts = split_table(
        df,
        ["id", "gone", "lost"],
        {"x": SubTable(prefix="x_"), "y": SubTable(columns=["gone", "lost", "y"]), "none": SubTable(columns=["gone"])},
    )
    assert {n: p.columns for n, p in parts.items()} == {"x": ["id", "x_a", "x_b"], "y": ["id", "y"], "none": ["id"]}


def test_canonical_json_as_a_json_library_writes_it(spark):
    import json

    df = spark.sql(
        """SELECT named_struct('b', array(named_struct('y', 'dé😀"\\\\\\n', 'x', 1.5D)), 'a', cast(NULL AS int), 'c', true) AS v"""
    )
    got = df.select(text.canonical_json(F.col("v"), df.schema["v"].dataType)).first()[0]
    assert got == json.dumps({"b": [{"y": "dé😀\"\\\n", "x": 1.5}], "a": None, "c": True}, sort_keys=True)


@pytest.mark.parametrize("value", [0.0, -1.5, 1e-5, 1.25e-4, 0.001, 12345678.0, 1e15, 1e16, -8.844355410081172e18, 6e300, 2.0**70])
def test_canonical_json_of_doubles(spark, value):
    import json

    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(text.canonical_json(F.col("v"), df.schema["v"].dataType)).first()[0] == json.dumps(value)


# --- positions and batches


def test_positions_are_whole_with_a_hot_group(spark):
    """One group holds most keys: positions stay 0..n-1, every batch but the last is full."""
    df = spark.range(5000).selectExpr(
        "CASE WHEN id < 4000 THEN 'hot' WHEN id < 4900 THEN concat('g', id DIV 100) END AS g", "id AS k"
    )
    numbered = numbering.number_rows(df, "k", ["g"])
    checked = numbered.groupBy("g").agg(
        F.count("*").alias("n"), F.min("position").alias("lo"), F.max("position").alias("hi"), F.countDistinct("position").alias("d")
    )
    assert all(r.n == r.d and r.lo == 0 and r.hi == r.n - 1 for r in checked.collect())
    batches = numbering.batch_keys(df, "k", 50, ["g"])
    assert batches.filter("g = 'hot'").select(F.sum(F.size("keys")), F.count("*")).first() == (4000, 80)
    assert batches.select(F.explode("keys")).distinct().count() == 5000


# --- text and time functions


@pytest.mark.parametrize(
    ("params", "expected"),
    [
        ("a=1,b=2", {"a": "1", "b": "2"}),
        ("a=1,2,3,b=x=y", {"a": "1,2,3", "b": "x=y"}),
        ("a=1,b=2,a=3,4", {"a": "1,3,4", "b": "2"}),
        ("a=", {"a": ""}),
        ("limit=512, createdAfterTime=2025", {"limit": "512", " createdAfterTime": "2025"}),
        ("", {}),
        (None, None),
        ("novalue", None),
        ("x,a=1", None),
    ],
)
def test_parse_params(spark, params, expected):
    assert one(spark, text.parse_params(F.lit(params).cast("string"))) == expected


def test_windows_of_reversed_and_empty_ranges(spark):
    from telemetry_lake.plans.requests import slice_windows

    df = spark.sql(
        """SELECT * FROM VALUES (1, TIMESTAMP'2024-01-03', TIMESTAMP'2024-01-01'), (2, TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-01'),
        (3, TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-02 12:00:00'), (4, TIMESTAMP'2024-01-01', NULL) t(id, start, end)"""
    )
    out = columns.zoneless_timestamps(slice_windows(df)).orderBy("window_start").collect()
    assert [(r.id, str(r.window_start), str(r.window_end)) for r in out] == [
        (3, "2024-01-01 00:00:00", "2024-01-01 23:59:59"),
        (3, "2024-01-02 00:00:00", "2024-01-02 12:00:00"),
    ]


def test_days_never_count_down(spark):
    def day(s):
        return F.to_date(F.lit(s))

    assert one(spark, time.days_between(day("2024-01-03"), day("2024-01-01"))) == []
    assert len(one(spark, time.days_between(day("2024-02-28"), day("2024-03-02")))) == 3


# --- steps


def test_unknown_step_raises_when_declared():
    with pytest.raises(ValueError, match="unknown operation"):
        step("no_such_thing")


def test_frame_methods_and_own_operations_are_steps(spark):
    register("double_ids", lambda df, by: df.withColumn("id", F.col("id") * by))
    out = run_steps(spark.range(3), [step("double_ids", by=2), Step("limit", {"num": 2})])
    assert [r.id for r in out.orderBy("id").collect()] == [0, 2]
    with pytest.raises(ValueError, match="exists"):
        register("double_ids", lambda df: df)


def test_error_policy(spark):
    steps = [step("rename", mapping={"id": "k"}), step("normalize", column="absent"), step("drop", columns=["k"])]
    with pytest.raises(ValueError):
        run_steps(spark.range(1), steps)
    assert run_steps(spark.range(1), steps, on_error="keep").columns == ["k"]
    with pytest.raises(ValueError, match="policy"):
        run_steps(spark.range(1), steps, on_error="ignore")
