"""One table to several sub-tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from telemetry_lake.operators.columns import pick_columns
from telemetry_lake.operators.rows import distinct_on, distinct_rows, filter_rows


@dataclass(frozen=True)
class SubTable:
    """What one output of a split holds."""

    columns: Sequence[str] = ()
    prefix: str | None = None
    drop_duplicates: bool = False
    subset: Sequence[str] | None = None
    query: str | None = None


def split_table(df: DataFrame, shared: Sequence[str], outputs: Mapping[str, SubTable]) -> dict[str, DataFrame]:
    """Sub-tables by name. Each is a lazy projection of the parent: over Parquet every output reads only its own
    columns, so nothing is cached; write an expensive parent first (see ``sources.lake.write_partitioned``)."""
    result = {}
    for name, spec in outputs.items():
        part = pick_columns(df, shared, spec.columns, spec.prefix)
        if spec.drop_duplicates:
            part = distinct_on(part, spec.subset) if spec.subset else distinct_rows(part)
        if spec.query:
            part = filter_rows(part, spec.query)
        result[name] = part
    return result
