"""Projections, casts, filters, duplicate removal, unions and text or date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lake_queries.fixtures import iso, table
from lake_queries.registry import query
from telemetry_lake.functions import text, time
from telemetry_lake.operators import columns, numbering, rows
from telemetry_lake.plans.requests import slice_windows
from telemetry_lake.plans.steps import run_steps
from telemetry_lake.plans.tables import default_steps


# --- projections and casts -------------------------------------------------------------------------------------


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def drop_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return columns.drop_columns(orders, ["o_orderstatus", "no_such_column", "^o_(total|order)pri"])


@query(
    "rename_columns",
    """SELECT o_orderkey AS o_custkey, o_custkey AS o_orderkey, o_orderstatus AS status, o_totalprice, o_orderdate,
    o_orderpriority FROM orders""",
)
def rename_columns(spark, sf_dir):
    swap = {"o_orderkey": "o_custkey", "o_custkey": "o_orderkey", "o_orderstatus": "status", "absent": "x"}
    return columns.rename_columns(table(spark, sf_dir, "orders"), swap)


@query("set_column", "SELECT c_custkey, '2024-02-01' AS date, '5' AS n, CAST(NULL AS VARCHAR) AS none FROM customer")
def set_column(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey")
    for name, value in (("date", "2024-02-01"), ("n", 5), ("none", None)):
        df = columns.set_column(df, name, value)
    return df


@query(
    "cast_columns",
    """SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS balance,
    CAST(c_nationkey AS BIGINT) AS nation, CAST(NULL AS BIGINT) AS segment, c_acctbal > 0 AS positive FROM customer""",
)
def cast_columns(spark, sf_dir):
    df = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_nationkey",
        "c_acctbal AS balance",
        "cast(c_nationkey AS string) AS nation",
        "c_mktsegment AS segment",
        "cast(c_acctbal > 0 AS string) AS positive",
    )
    df = columns.cast_columns(df, ["c_nationkey", "absent"], "float")
    df = columns.cast_columns(df, ["balance"], "str")
    df = columns.cast_columns(df, ["nation"], "int")
    df = columns.cast_columns(df, ["positive"], "bool")
    return columns.cast_columns(df, ["segment"], "int", lenient=True)


@query(
    "cast_timestamp",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN date_trunc('second', ts)
    ELSE ts END AS time, ts AS kept, date_trunc('day', ts) AS day, make_timestamp(event_id) AS counted FROM events""",
)
def cast_timestamp(spark, sf_dir):
    df = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"""CASE event_type WHEN 'view' THEN 'not a time' WHEN 'click' THEN date_format(ts, "yyyy-MM-dd HH:mm:ss")
            ELSE {iso('ts')} END AS time""",
        "ts AS kept",
        "cast(ts AS date) AS day",
        "event_id * 1000 AS counted",
    )
    return columns.cast_columns(df, ["time", "kept", "day", "counted"], "datetime")


@query(
    "format_timestamp",
    """SELECT event_id, strftime(ts, '%d/%m/%Y at %H:%M:%S') AS time,
    CASE WHEN event_type <> 'view' THEN strftime(ts, '%Y_%m_%d') END AS day FROM events""",
)
def format_timestamp(spark, sf_dir):
    df = table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{iso('ts')} AS time", f"CASE WHEN event_type = 'view' THEN '?' ELSE {iso('ts')} END AS day"
    )
    df = columns.cast_columns(df, ["time"], "datetime", strftime="%d/%m/%Y at %H:%M:%S")
    return columns.cast_columns(df, ["day"], "datetime", strftime="%Y_%m_%d")


@query(
    "epoch_to_timestamp",
    """SELECT l_orderkey, l_linenumber,
    make_timestamp(l_orderkey * 1000000) AS seconds,
    make_timestamp(l_orderkey * 1000) AS millis,
    make_timestamp(l_orderkey * 1000 + 500) AS fractions,
    CASE WHEN l_returnflag <> 'R' THEN make_timestamp(l_partkey * 1000) END AS texts,
    CAST(NULL AS TIMESTAMP) AS too_large
    FROM lineitem""",
)
def epoch_to_timestamp(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_orderkey AS seconds",
        "l_orderkey AS millis",
        "l_orderkey + 0.5D AS fractions",
        "CASE WHEN l_returnflag = 'R' THEN 'bad' ELSE cast(l_partkey AS string) END AS texts",
        "9000000000000000000 + l_linenumber AS too_large",
    )
    df = columns.epoch_columns(df, ["seconds"], "s")
    return columns.epoch_columns(df, ["millis", "fractions", "texts", "too_large"], "ms")


@query(
    "project_prefix",
    "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem",
)
def project_prefix(spark, sf_dir):
    return columns.pick_columns(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "absent", "l_linenumber"], prefix="l_ship"
    )


@query(
    "project_list",
    "SELECT l_orderkey, l_tax, l_discount FROM lineitem",
)
def project_list(spark, sf_dir):
    return columns.pick_columns(
        table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_tax", "absent", "gone", "l_discount"]
    )


@query(
    "default_block",
    """SELECT DISTINCT CAST(user_id AS VARCHAR) AS vehicle_id, 'V' || user_id AS parc_id,
    event_type AS "externalIds_erp_vin", CASE WHEN event_type <> 'view' THEN date_trunc('hour', ts) END AS time FROM events""",
)
def default_block(spark, sf_dir):
    df = table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS id",
        "concat('V', user_id) AS name",
        "props AS externalIds_fleet_serial",
        "props AS externalIds_fleet_vin",
        "props AS vehicle_externalIds_fleet_serial",
        "props AS vehicle_externalIds_fleet_vin",
        "event_type AS externalIds_erp_vin",
        f"CASE WHEN event_type = 'view' THEN '' ELSE {iso('date_trunc(\"hour\", ts)')} END AS time",
    )
    return run_steps(df, default_steps("fleet"))


@query(
    "clean_columns",
    """SELECT l_orderkey AS "order_key", l_tax AS "tax___", l_discount AS "remisé_a_b", l_quantity AS l_quantity
    FROM lineitem""",
)
def clean_columns(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS `order.key`", "l_tax AS `tax (%`", "l_discount AS `remisé-a/b`", "l_quantity"
    )
    return columns.clean_columns(df)


# --- filters -----------------------------------------------------------------------------------------------------


@query("filter_expr", "SELECT * FROM orders WHERE o_totalprice > 200000 AND o_orderstatus IN ('O', 'P')")
def filter_expr(spark, sf_dir):
    return rows.filter_rows(table(spark, sf_dir, "orders"), "o_totalprice > 200000 AND o_orderstatus IN ('O', 'P')")


@query(
    "filter_guarded",
    """SELECT 'filtered' AS run, o_orderkey FROM orders WHERE o_totalprice > 200000
    UNION ALL SELECT 'guarded', o_orderkey FROM orders""",
)
def filter_guarded(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    filtered = rows.filter_rows(orders, "o_totalprice > 200000", ["o_totalprice"])
    guarded = rows.filter_rows(orders, "o_totalprice > 200000 AND absent = 1", ["o_totalprice", "absent"])
    return filtered.selectExpr("'filtered' AS run", "o_orderkey").union(
        guarded.selectExpr("'guarded' AS run", "o_orderkey")
    )


NULLS = """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN l_partkey END AS a,
    CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS b FROM lineitem"""


def with_nulls(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CASE WHEN l_returnflag = 'A' THEN l_partkey END AS a",
        "CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS b",
    )


@query("dropna_all", f"SELECT * FROM ({NULLS}) WHERE NOT (a IS NULL AND b IS NULL)")
def dropna_all(spark, sf_dir):
    return rows.drop_null_rows(with_nulls(spark, sf_dir), ["a", "absent", "b"])


@query("dropna_any", f"SELECT * FROM ({NULLS}) WHERE a IS NOT NULL AND b IS NOT NULL")
def dropna_any(spark, sf_dir):
    return rows.drop_null_rows(with_nulls(spark, sf_dir))


@query("dropna_none_listed", f"SELECT * FROM ({NULLS})")
def dropna_none_listed(spark, sf_dir):
    return rows.drop_null_rows(with_nulls(spark, sf_dir), ["absent"])


@query(
    "conditional_update",
    """WITH r AS (SELECT o_orderkey AS request_id, 'fleet/' || o_orderpriority AS endpoint, o_orderstatus AS kind FROM orders)
    SELECT request_id, endpoint, kind,
    CASE WHEN endpoint = 'fleet/2-HIGH' AND kind = 'P' AND request_id =
        (SELECT min(request_id) FROM r WHERE endpoint = 'fleet/2-HIGH' AND kind = 'P') THEN 1
      WHEN endpoint = 'fleet/5-LOW' THEN 1 ELSE 0 END AS is_processed FROM r""",
)
def conditional_update(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS request_id",
        "concat('fleet/', o_orderpriority) AS endpoint",
        "concat('limit=512,type=', o_orderstatus) AS params",
        "o_orderstatus AS kind",
        "0 AS is_processed",
    )

    def of_kind(kind):
        return F.try_element_at(text.parse_params(F.col("params")), F.lit("type")) == kind

    df = rows.conditional_update(df, "fleet/2-HIGH", 1, of_kind("P"), ["request_id"])
    df = rows.conditional_update(df, "fleet/5-LOW", 1, of_kind("absent"), ["request_id"])
    return df.drop("params")


# --- duplicates --------------------------------------------------------------------------------------------------


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate, CASE WHEN l_tax > 0.04 THEN l_tax END AS tax FROM lineitem")
def distinct_rows(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag", "l_linestatus", "l_shipdate", "CASE WHEN l_tax > 0.04 THEN l_tax END AS tax"
    )
    return rows.distinct_rows(df)


@query(
    "distinct_on_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_quantity, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n = 1""",
)
def distinct_on_key(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return rows.distinct_on(df, ["l_orderkey", "l_linenumber"], ["l_quantity"])


@query(
    "distinct_nested",
    """SELECT DISTINCT l_returnflag, '{"flag": "' || l_returnflag || '", "line": ' || l_linenumber || '}' AS obj,
    '[' || l_linenumber || ', ' || CASE WHEN l_tax > 0.04 THEN CAST(l_linenumber AS VARCHAR) ELSE 'null' END || ']' AS lst,
    '{"a": "' || l_linestatus || '", "b": "x"}' AS mp
    FROM lineitem""",
)
def distinct_nested(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag",
        "named_struct('line', l_linenumber, 'flag', l_returnflag) AS obj",
        "array(l_linenumber, CASE WHEN l_tax > 0.04 THEN l_linenumber END) AS lst",
        """CASE WHEN l_tax > 0.02 THEN map('a', l_linestatus, 'b', 'x') ELSE map('b', 'x', 'a', l_linestatus) END AS mp""",
    )
    typed = rows.distinct_nested(df)
    return typed.select(*[text.serialize_nested(f.name, f.dataType) for f in typed.schema.fields])


@query(
    "distinct_serialized",
    """SELECT DISTINCT l_returnflag, '{"big": ' || (l_linenumber * 10000000) || '.0, "flag": "' || l_linestatus || '", "line": '
    || l_linenumber || ', "small": ' || l_linenumber || 'e-05}' AS obj FROM lineitem""",
)
def distinct_serialized(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag",
        "named_struct('line', l_linenumber, 'flag', l_linestatus, 'big', l_linenumber * 1e7D, 'small', l_linenumber / 1e5D) AS obj",
    )
    return rows.distinct_nested(df, serialize=True)


@query("distinct_keys", "SELECT DISTINCT l_suppkey FROM lineitem")
def distinct_keys(spark, sf_dir):
    return rows.distinct_keys(table(spark, sf_dir, "lineitem"), "l_suppkey")


def batched(inner: str, group: str, key: str, size: int, name: str) -> str:
    """Keys in MD5 order, cut into lists of ``size`` per group."""
    return f"""SELECT {group}, (n - 1) // {size} AS batch, string_agg({key}, '|' ORDER BY {key}) AS {name}
      FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY md5({key}), {key}) AS n FROM ({inner}))
      GROUP BY ALL"""


@query(
    "reverse_mapping",
    batched("SELECT DISTINCT p_brand, p_name FROM part", "p_brand", "p_name", 10_000, "keys"),
)
def reverse_mapping(spark, sf_dir):
    mapped = numbering.reverse_mapping(table(spark, sf_dir, "part"), "p_name", "p_brand", 10_000)
    return mapped.withColumn("keys", F.array_join("keys", "|"))


# --- unions ------------------------------------------------------------------------------------------------------


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    UNION ALL SELECT p_partkey, NULL, NULL, NULL FROM part""",
)
def union_by_name(spark, sf_dir):
    return rows.union_by_name(
        table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"),
        table(spark, sf_dir, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id"),
        table(spark, sf_dir, "part").selectExpr("p_partkey AS id"),
    )


# --- text and dates ----------------------------------------------------------------------------------------------

PARAMS = """CASE o_orderpriority
    WHEN '1-URGENT' THEN concat('Types=', o_custkey, ',startTime=', o_orderkey)
    WHEN '2-HIGH' THEN concat('ids=', o_custkey, ',', o_orderkey, ',end=a=b')
    WHEN '3-MEDIUM' THEN concat('k=', o_custkey, ',z=', ',k=', o_orderkey, ',', o_orderstatus)
    WHEN '4-NOT SPECIFIED' THEN '' ELSE 'limit=512' END"""


@query(
    "parse_params",
    """SELECT o_orderkey, CASE o_orderpriority
    WHEN '1-URGENT' THEN 'Types=' || o_custkey || ',startTime=' || o_orderkey
    WHEN '2-HIGH' THEN 'end=a=b,ids=' || o_custkey || ',' || o_orderkey
    WHEN '3-MEDIUM' THEN 'k=' || o_custkey || ',' || o_orderkey || ',' || o_orderstatus || ',z='
    WHEN '4-NOT SPECIFIED' THEN '' ELSE 'limit=512' END AS params FROM orders""",
)
def parse_params(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(PARAMS).alias("params"))
    return df.withColumn("params", text.params_text(text.parse_params(F.col("params"))))


RANGES = """CASE
    WHEN o_orderstatus = 'O' THEN concat('startTime=', date_format(o_orderdate, 'dd/MM/yyyy'), ',endTime=',
        date_format(o_orderdate + INTERVAL 3 DAY, 'dd/MM/yyyy'), ',startMs=1,endMs=2')
    WHEN o_orderstatus = 'F' THEN concat('startDate=', date_format(o_orderdate, 'yyyy-MM-dd'), ',endDate=',
        date_format(o_orderdate + INTERVAL 3 DAY, 'yyyy-MM-dd'))
    WHEN o_orderpriority = '1-URGENT' THEN concat('startMs=', unix_millis(cast(o_orderdate AS timestamp)),
        ',endMs=', unix_millis(cast(o_orderdate + INTERVAL 3 DAY AS timestamp)))
    WHEN o_orderpriority = '2-HIGH' THEN 'startTime=01/01/2024,endTime='
    ELSE 'limit=512' END"""
KIND = """CASE WHEN o_orderstatus = 'O' THEN 'datetime' WHEN o_orderstatus = 'F' THEN 'date'
    WHEN o_orderpriority = '1-URGENT' THEN 'timestamp_ms' END"""


def ranged(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.expr(RANGES).alias("params"))
    df = df.withColumn("parsed", text.parse_params(F.col("params")))
    return df.withColumn("kind", text.date_param_kind(F.col("parsed"))).drop("params")


@query("date_param_kind", f"SELECT o_orderkey, {KIND} AS kind FROM orders")
def date_param_kind(spark, sf_dir):
    return ranged(spark, sf_dir).select("o_orderkey", "kind")


@query(
    "parse_bounds",
    f"""SELECT o_orderkey, kind, CASE WHEN kind IS NOT NULL THEN o_orderdate END AS range_start,
    CASE WHEN kind IS NOT NULL THEN o_orderdate + INTERVAL 3 DAY END AS range_end
    FROM (SELECT o_orderkey, o_orderdate, {KIND} AS kind FROM orders)""",
)
def parse_bounds(spark, sf_dir):
    kind = F.col("kind")
    return ranged(spark, sf_dir).select(
        "o_orderkey",
        "kind",
        *[
            time.parse_bound(text.date_param(F.col("parsed"), kind, side), kind).alias(f"range_{side}")
            for side in ("start", "end")
        ],
    )


@query(
    "render_bounds",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS datetime,
    strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S+00:00') AS whole,
    strftime(ts, '%Y-%m-%d') AS date, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS millis FROM events""",
)
def render_bounds(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        time.render_bound(at, F.lit("datetime")).alias("datetime"),
        time.render_bound(F.date_trunc("minute", at), F.lit("datetime")).alias("whole"),
        time.render_bound(at, F.lit("date")).alias("date"),
        time.render_bound(at, F.lit("timestamp_ms")).alias("millis"),
    )


@query(
    "date_reformat",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y_%m_%d') AS under,
    CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS checked FROM orders""",
)
def date_reformat(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'dd/MM/yyyy') AS d", "date_format(o_orderdate, 'dd.MM.yyyy') AS p", "o_orderstatus"
    )
    return df.select(
        "o_orderkey",
        time.reformat_date(F.col("d")).alias("day"),
        time.reformat_date(F.col("p"), ".", "_").alias("under"),
        time.reformat_date(F.when(F.col("o_orderstatus") == "P", "99/99/2024").otherwise(F.col("d"))).alias("checked"),
    )


@query(
    "epoch_convert",
    """SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
    CAST(trunc(o_totalprice * 1000) AS BIGINT) AS millis, o_orderkey / 1000 AS fraction FROM orders""",
)
def epoch_convert(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        time.date_to_epoch(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("seconds"),
        time.seconds_to_millis(F.col("o_totalprice")).alias("millis"),
        time.millis_to_seconds(F.col("o_orderkey")).alias("fraction"),
    )


@query(
    "date_label",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN strftime(ts, '%Y_%m_%d')
    ELSE strftime(ts, '%Y_%m_%d') || '_to_' || strftime(ts + INTERVAL 2 DAY, '%Y_%m_%d') END AS label FROM events""",
)
def date_label(spark, sf_dir):
    start = F.col("ts").cast("timestamp")
    step = F.when(F.col("event_type").isin("click", "view"), 1).otherwise(2)
    return table(spark, sf_dir, "events").select(
        "event_id",
        time.date_label(start, start + F.expr("INTERVAL 2 DAYS"), step).alias("label"),
    )


@query(
    "path_build",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE c_mktsegment || '/' || c_name END AS folder,
    'fleet/' || c_custkey || '/score' AS endpoint FROM customer""",
)
def path_build(spark, sf_dir):
    family = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.table_folder(family, F.col("c_name")).alias("folder"),
        text.fill_template(F.lit("fleet/{vehicleId}/score"), F.lit("vehicleId"), F.col("c_custkey").cast("string")).alias(
            "endpoint"
        ),
    )


SLICE_RANGE = """o_orderkey, o_orderdate + INTERVAL 6 HOUR AS start,
    CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE o_orderdate + INTERVAL 5 DAY END AS "end" """


@query(
    "interval_slices",
    f"""SELECT o_orderkey, delta_days, s AS window_start,
      least(s + to_days(delta_days) - INTERVAL 1 SECOND, "end") AS window_end
    FROM (SELECT *, unnest(generate_series(start, "end" - INTERVAL 1 MICROSECOND, to_days(delta_days))) AS s
      FROM (SELECT {SLICE_RANGE}, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS delta_days FROM orders)
      WHERE start < "end")""",
)
def interval_slices(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "cast(o_orderdate + INTERVAL 6 HOUR AS timestamp) AS start",
        "cast(CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE o_orderdate + INTERVAL 5 DAY END AS timestamp) AS end",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS delta_days",
    )
    return slice_windows(df, delta_days=F.col("delta_days")).drop("start", "end")
