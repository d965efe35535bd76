"""Which request windows are answered, and which are still open: interval sets kept per table.

A window is ``[window_start, window_end)``. Windows are cut at month ends, so that sets meet per key and calendar month:
no key's whole history is in one task, however many windows it has had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_lake.functions.names import quoted
from telemetry_lake.plans import committed
from telemetry_lake.sources.versions import Conflict

START, END = "window_start", "window_end"
LEDGER_TYPE = "table_name string, window_start timestamp, window_end timestamp"


def by_month(windows: DataFrame) -> DataFrame:
    """Windows cut at the starts of months, with their ``month``; empty, reversed and open-ended ones give nothing."""
    first = F.date_trunc("month", START)
    last = F.date_trunc("month", F.col(END) - F.expr("INTERVAL 1 MICROSECOND"))
    months = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    cut = windows.filter(F.col(START) < F.col(END)).withColumn("month", months)
    return cut.withColumns(
        {START: F.greatest(START, "month"), END: F.least(F.col(END), F.col("month") + F.expr("INTERVAL 1 MONTH"))}
    )


def _islands(windows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Windows of each group that touch or overlap as one (gaps and islands)."""
    ordered = Window.partitionBy(*[quoted(n) for n in by]).orderBy(START, END)
    before = F.max(END).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col(START) > before), 1).otherwise(0)
    numbered = windows.withColumn("__begins", begins).withColumn("__island", F.sum("__begins").over(ordered))
    return numbered.groupBy(*[quoted(n) for n in by], "__island").agg(
        F.min(START).alias(START), F.max(END).alias(END)
    ).drop("__island")


def merge_windows(windows: DataFrame, by: Sequence[str] = ("table_name",)) -> DataFrame:
    """The same times covered by the fewest windows, per key. Null keys are a key of their own.

    Equal windows are merged before they are shuffled by key, those of a month next, and the months' ends last.
    """
    monthly = by_month(windows.select(*[quoted(n) for n in by], START, END)).distinct()
    return _islands(_islands(monthly, [*by, "month"]).drop("month"), by)


def subtract_windows(planned: DataFrame, answered: DataFrame, by: Sequence[str] = ("table_name",)) -> DataFrame:
    """Times of planned windows that no answered window covers, at any step: the open parts, whole or partial.

    All columns of ``planned`` stay; parts of one planned window that touch are one row. ``by`` columns are not null in
    an answered window that counts.
    """
    names = [quoted(n) for n in by]
    held = _islands(by_month(answered.select(*names, START, END)).distinct(), [*by, "month"])
    # Answered windows of a key and month, in order and apart from each other.
    listed = held.groupBy(*names, "month").agg(F.array_sort(F.collect_list(F.struct(START, END))).alias("__held"))
    pieces = by_month(planned.withColumns({"__from": F.col(START), "__to": F.col(END)}))
    met = pieces.join(listed, [*by, "month"], "left")
    none = F.array().cast("array<struct<window_start: timestamp, window_end: timestamp>>")
    taken = F.coalesce("__held", none)

    def free(held: Column) -> Column:
        """Between every answered window and the next, as far as it lies in the piece."""
        begins = F.concat(F.array(F.col(START)), held[END])
        ends = F.concat(held[START], F.array(F.col(END)))
        cut = F.zip_with(
            begins, ends, lambda a, b: F.struct(F.greatest(a, F.col(START)).alias(START), F.least(b, F.col(END)).alias(END))
        )
        return F.filter(cut, lambda gap: gap[START] < gap[END])

    others = [n for n in planned.columns if n not in (START, END)]
    kept = [quoted(n) for n in others]
    gaps = met.withColumn("__gap", F.explode(free(taken))).select(*kept, "__from", "__to", f"__gap.{START}", f"__gap.{END}")
    whole = _islands(gaps, [*others, "__from", "__to"])
    return whole.select(*[quoted(n) for n in planned.columns])


def read_ledger(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """Number of the newest version and its answered windows; 0 and none for a new ledger."""
    number, found = committed.newest(spark, root, LEDGER_TYPE)
    return number, found if found is not None else spark.createDataFrame([], LEDGER_TYPE)


def record_answers(answered: DataFrame, root: str) -> int:
    """Add answered windows to the ledger and commit it; a writer that comes second adds to what the first committed."""
    spark = answered.sparkSession
    while True:
        number, held = read_ledger(spark, root)
        merged = merge_windows(held.unionByName(answered.select("table_name", START, END)))
        try:
            return committed.commit(merged, root, number)
        except Conflict:
            continue


def requests_open(spark: SparkSession, root: str, planned: DataFrame) -> DataFrame:
    """Planned windows less those that the ledger has as answered."""
    return subtract_windows(planned, read_ledger(spark, root)[1])
