"""Request planning as data: catalogue rows and progress to one row per request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.names import quoted
from telemetry_lake.functions.text import date_param, date_param_kind, fill_template, parse_params, table_folder
from telemetry_lake.functions.time import (
    DAY_FORMAT,
    date_label,
    iso_text,
    parse_bound,
    render_bound,
    window_end,
    window_starts,
)
from telemetry_lake.operators.numbering import batch_keys, number_rows
from telemetry_lake.operators.rows import union_by_name
from telemetry_lake.plans.gaps import HISTORY_START

# Fixed value: keys carried by one request.
KEYS_PER_REQUEST = 50


def build_plan(
    requested: DataFrame,
    catalogue: DataFrame,
    state: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Catalogue rows of the requested tables with the range each has to fetch.

    A ``time`` table known to the state starts at its download watermark, any other at ``start`` (or at the
    beginning of history); the type comes from the catalogue, else the state, else it is ``time``. Tables the
    catalogue does not know are left out, and one asked for several times is planned once. The start is kept as
    ``last_download_time``.
    """
    first = F.to_date(F.lit(HISTORY_START)) if start is None else start.cast("date")
    last = F.current_date() if end is None else end.cast("date")
    known = state.select(
        F.col("table_name").alias("__state_table"),
        F.col("download_type").alias("__state_type"),
        F.col("last_download_time").alias("__mark"),
    )
    wanted = requested.select("table_name").distinct()
    columns = [quoted(n) for n in catalogue.columns if n not in ("download_type", "table_name")]
    return (
        catalogue.join(wanted, "table_name", "left_semi")
        .join(known, F.col("table_name") == F.col("__state_table"), "left")
        .select(
            "table_name",
            *columns,
            F.coalesce("download_type", "__state_type", F.lit("time")).alias("download_type"),
            F.coalesce(F.when(F.col("__state_type") == "time", F.col("__mark")), first).alias("last_download_time"),
            last.alias("end_date"),
        )
    )


def fill_range(plan: DataFrame, start: str = "last_download_time", end: str = "end_date") -> DataFrame:
    """Write a plan's range into its parameter texts, in the form each kind of parameter has."""
    template = F.col("params")
    by_date = template.contains("startDate=")
    by_millis = template.contains("startMs=")

    def bound(name: str) -> Column:
        at = quoted(name).cast("timestamp")
        return (
            F.when(by_date, F.date_format(at, "yyyy-MM-dd"))
            .when(by_millis, F.unix_millis(at).cast("string"))
            .otherwise(F.date_format(at, DAY_FORMAT))
        )

    filled = F.replace(template, F.lit("{start_iso}"), iso_text(quoted(start).cast("timestamp")))
    filled = F.replace(filled, F.lit("{start}"), bound(start))
    filled = F.replace(filled, F.lit("{end}"), bound(end))
    return plan.withColumn("params", filled)


def slice_windows(
    df: DataFrame, start: str = "start", end: str = "end", delta_days: Column | None = None
) -> DataFrame:
    """One row per window of ``delta_days`` (1 if missing) in ``[start, end)``; a window ends one second
    before the next, or at ``end``. Rows with an empty or reversed range give no windows."""
    step = F.coalesce(delta_days, F.lit(1)) if delta_days is not None else F.lit(1)
    sliced = df.withColumn("window_start", F.explode(window_starts(quoted(start), quoted(end), step)))
    return sliced.withColumn("window_end", window_end(F.col("window_start"), quoted(end), step))


def _templates(catalogue: DataFrame, lists: bool) -> DataFrame:
    """Catalogue rows that need keys of another table, one per request or in lists."""
    config = F.col("exception_config")
    in_list = F.coalesce(config["is_list"], F.lit(1)) != 0
    return catalogue.filter(
        (config["exception_type"] == "table")
        & (config["constraint"] == "dynamic_url")
        & (in_list if lists else ~in_list)
    )


def _with_templates(keys: DataFrame, templates: DataFrame) -> DataFrame:
    """Add the templates that take keys of each row's ``source_table``.

    Templates are catalogue rows, a handful at most: Spark's size check sends them to the keys, which do not move.
    """
    by_source = templates.withColumn("source_table", F.col("exception_config.table_name"))
    kept = [n for n in keys.columns if n != "source_table"]
    return keys.join(by_source, "source_table").select(*[quoted(n) for n in (*kept, *templates.columns)])


def fan_out(catalogue: DataFrame, keys: DataFrame) -> DataFrame:
    """One request per key of another table, with the key's position.

    ``keys`` is (source_table, key), distinct; catalogue rows whose exception takes single keys are filled.
    """
    numbered = number_rows(keys, "key", ["source_table"], "key_index")
    return _fill_key(_with_templates(numbered, _templates(catalogue, lists=False)), F.col("key").cast("string"))


def fan_out_batches(catalogue: DataFrame, keys: DataFrame, size: int = KEYS_PER_REQUEST) -> DataFrame:
    """One request per list of at most ``size`` keys, joined by commas; every key is in exactly one list."""
    batches = batch_keys(keys, "key", size, ["source_table"], batch="key_batch")
    filled = _fill_key(_with_templates(batches, _templates(catalogue, lists=True)), F.array_join("keys", ","))
    return filled.drop("keys")


def _fill_key(df: DataFrame, value: Column) -> DataFrame:
    config = F.col("exception_config")
    name, place = config["exception_param_name"], config["key_to_apply_on"]
    return df.withColumns(
        {
            n: F.when(place == n, fill_template(F.col(n), name, value)).otherwise(F.col(n))
            for n in ("endpoint", "params")
        }
    )


def _with_range(plan: DataFrame) -> DataFrame:
    """Add the parsed parameters, the kind of range they hold, its bounds, and the request's folder."""
    params = F.when(F.col("params").isNull(), _no_params()).otherwise(parse_params(F.col("params")))
    # A list of one keeps the filter above the parsing, which would otherwise run in both.
    parsed = plan.withColumn("request_params", F.explode(F.array(params))).filter("request_params IS NOT NULL")
    parsed = parsed.withColumn("kind", date_param_kind(F.col("request_params")))
    kind = F.col("kind")
    bounds = {
        f"range_{side}": parse_bound(date_param(F.col("request_params"), kind, side), kind) for side in ("start", "end")
    }
    return parsed.withColumns({**bounds, "folder": table_folder(F.col("family"), F.col("table_name"))})


def window_requests(plan: DataFrame) -> DataFrame:
    """Plan rows with filled parameters to one row per request window.

    Adds the parsed parameters, the window bounds as the request carries them, the label of the file the
    answer goes to and its folder. Rows without a date range give one request without bounds; rows whose
    parameters cannot be read (a value before any key) give none. Tables that take dates but need times (see the
    exceptions) carry times.
    """
    parsed = _with_range(plan)
    kind = F.col("kind")
    step = F.coalesce("delta_days", F.lit(1))
    windows = F.when(kind.isNull(), F.array(F.lit(None).cast("timestamp"))).otherwise(
        window_starts(F.col("range_start"), F.col("range_end"), step)
    )
    config = F.col("exception_config")
    rendered_as = F.when(
        (F.col("is_exception") == 1)
        & (config["exception_type"] == "date")
        & (config["constraint"] == "is_data_but_datetime"),
        F.lit("datetime"),
    ).otherwise(kind)
    sliced = parsed.withColumn("window_start", F.explode(windows)).withColumn(
        "window_end", window_end(F.col("window_start"), F.col("range_end"), step)
    )
    return sliced.withColumns(
        {
            "start_text": render_bound(F.col("window_start"), rendered_as),
            "end_text": render_bound(F.col("window_end"), rendered_as),
            "file_label": date_label(F.col("window_start"), F.col("window_end"), step),
        }
    ).drop("range_start", "range_end")


def keyed_requests(plan: DataFrame, keys: DataFrame) -> DataFrame:
    """Requests of the tables that need keys of another table.

    Tables that take one key each are asked once per key for the whole range, the key's position ending the
    file label; tables that take lists are asked per list and window, the list's number ending the label.
    """
    singles = _with_range(fan_out(plan, keys))
    kind = F.col("kind")
    label = date_label(F.col("range_start"), F.col("range_end"), F.coalesce("delta_days", F.lit(1)))
    asked_once = singles.withColumns(
        {
            "window_start": F.col("range_start"),
            "window_end": F.col("range_end"),
            "start_text": render_bound(F.col("range_start"), kind),
            "end_text": render_bound(F.col("range_end"), kind),
            "file_label": F.concat_ws("_", label, "key_index"),
        }
    ).drop("range_start", "range_end", "key_index", "key")
    per_list = window_requests(fan_out_batches(plan, keys))
    numbered = per_list.withColumn("file_label", F.concat_ws("_", "file_label", "key_batch")).drop("key_batch")
    return union_by_name(asked_once, numbered)


def all_requests(plan: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Every request of a plan: windows of the ordinary tables, and keyed requests if keys are given."""
    on_table = F.coalesce(F.col("exception_config")["exception_type"] == "table", F.lit(False)) & (
        F.col("is_exception") == 1
    )
    ordinary = window_requests(plan.filter(~on_table))
    return ordinary if keys is None else union_by_name(ordinary, keyed_requests(plan, keys))


def _no_params() -> Column:
    return F.create_map().cast("map<string,string>")
