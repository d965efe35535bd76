"""Declared transforms: a table's transform is a list of named steps run in order on one DataFrame."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from telemetry_lake.operators import columns, nested, rows

log = logging.getLogger(__name__)

# Name of a step to the operator it runs.
OPERATIONS: dict[str, Callable[..., DataFrame]] = {
    "cast": columns.cast_columns,
    "clean": columns.clean_columns,
    "distinct": rows.distinct_rows,
    "distinct_nested": rows.distinct_nested,
    "distinct_on": rows.distinct_on,
    "drop": columns.drop_columns,
    "drop_nulls": rows.drop_null_rows,
    "epoch": columns.epoch_columns,
    "explode": nested.explode,
    "explode_coerced": nested.explode_coerced,
    "filter": rows.filter_rows,
    "flatten": nested.flatten,
    "normalize": nested.normalize,
    "normalize_list": nested.normalize_list,
    "pick": columns.pick_columns,
    "prefix": columns.add_prefix,
    "rename": columns.rename_columns,
    "set": columns.set_column,
    "unique_items": nested.unique_items,
}


@dataclass(frozen=True)
class Step:
    """One operation and its arguments; an unknown name raises when the step is declared."""

    operation: str
    arguments: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not (self.operation in OPERATIONS or hasattr(DataFrame, self.operation)):
            raise ValueError(f"unknown operation: {self.operation}")

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.operation in OPERATIONS:
            return OPERATIONS[self.operation](df, **self.arguments)
        return getattr(df, self.operation)(**self.arguments)


def step(operation: str, **arguments: object) -> Step:
    return Step(operation, arguments)


def register(name: str, operation: Callable[..., DataFrame]) -> None:
    """Make an own ``DataFrame -> DataFrame`` operator available to declared steps."""
    if name in OPERATIONS:
        raise ValueError(f"operation exists: {name}")
    OPERATIONS[name] = operation


def run_steps(df: DataFrame, steps: Sequence[Step], on_error: str = "raise") -> DataFrame:
    """Run steps in order. ``on_error="keep"`` stops at a step that cannot be planned, logs it and returns the
    table so far; errors in the data surface when Spark runs the job, whatever the policy."""
    if on_error not in ("raise", "keep"):
        raise ValueError(f"unknown policy: {on_error}")
    for number, current in enumerate(steps, start=1):
        try:
            df = df.transform(current)
        except Exception as error:
            if on_error == "raise":
                raise
            log.error("step %d (%s) failed, later steps skipped: %s", number, current.operation, error)
            return df
    return df
