"""Date spans and fixed-length windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions.scalars import ColumnOrName, column


def backfill_span(as_of: ColumnOrName) -> tuple[Column, Column]:
    """(first day, last day) of the rolling backfill; 29 February clamps to the 28th."""
    last = F.date_sub(column(as_of).cast("date"), fixed.BACKFILL_LAG_DAYS)
    return F.add_months(last, -fixed.BACKFILL_MONTHS), last


def trailing_days(value: ColumnOrName, as_of: Column, days: int) -> Column:
    """Predicate: the date lies in the ``days`` inclusive days that end on ``as_of``."""
    day = column(value).cast("date")
    end = as_of.cast("date")
    return day.between(F.date_sub(end, days - 1), end)


def window_index(value: ColumnOrName, start: Column, days: int) -> Column:
    """Number of the fixed-length window (from 0) a date falls in."""
    return F.floor(F.datediff(column(value).cast("date"), start.cast("date")) / F.lit(days)).cast("int")


def windows(spark: SparkSession, start: Column, end: Column, days: int) -> DataFrame:
    """Contiguous windows of at most ``days`` inclusive days that cover [start, end]."""
    step = F.expr(f"INTERVAL {int(days)} DAYS")
    first, last = start.cast("date"), end.cast("date")
    return (
        spark.range(1)
        .select(F.posexplode(F.sequence(first, last, step)).alias("window_no", "window_start"), last.alias("_last"))
        .select(
            "window_no",
            "window_start",
            F.least(F.date_add("window_start", days - 1), "_last").alias("window_end"),
        )
    )
