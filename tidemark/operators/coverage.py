"""Which days and windows hold data, and which do not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates


def window_counts(df: DataFrame, date_col: str, start: Column, end: Column, days: int) -> DataFrame:
    """Rows per fixed-length window, windows without rows included.

    Rows are counted per window before they meet the window list, so the join is
    one row per window.
    """
    day = F.col(date_col).cast("date")
    counted = (
        df.where(day.between(start.cast("date"), end.cast("date")))
        .groupBy(dates.window_index(date_col, start, days).alias("window_no"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    every = dates.windows(df.sparkSession, start, end, days)
    return every.join(counted, "window_no", "left").withColumn("rows", F.coalesce("_rows", F.lit(0))).drop("_rows")


def missing_days(entities: DataFrame, df: DataFrame, keys: Sequence[str], date_col: str, start: Column, end: Column) -> DataFrame:
    """(key, day) pairs in [start, end] without a row; one generated row per pair, no cross join."""
    days = F.explode(F.sequence(start.cast("date"), end.cast("date"), F.expr("INTERVAL 1 DAY")))
    expected = entities.select(*keys).distinct().withColumn("day", days)
    day = F.col(date_col).cast("date")
    actual = df.where(day.between(start.cast("date"), end.cast("date"))).select(*keys, day.alias("day")).distinct()
    return expected.join(actual, [*keys, "day"], "left_anti")


def gaps(entities: DataFrame, df: DataFrame, keys: Sequence[str], date_col: str, start: Column, end: Column) -> DataFrame:
    """Runs of consecutive days in [start, end] without a row, as (key, first_day, last_day, days).

    The days that are there, and the days around the span, are each followed to the
    next one; no calendar is built.  A key's rows are made distinct days before they
    meet, so one task holds at most the days of the span for it.
    """
    first, last = start.cast("date"), end.cast("date")
    borders = entities.select(*keys).distinct().withColumn("day", F.explode(F.array(F.date_sub(first, 1), F.date_add(last, 1))))
    day = F.col(date_col).cast("date")
    present = df.where(day.between(first, last)).select(*keys, day.alias("day")).distinct()
    known = present.join(entities.select(*keys).distinct(), list(keys), "left_semi")
    following = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    runs = borders.unionByName(known).withColumn("_next", following).where(F.datediff("_next", "day") > 1)
    return runs.select(
        *keys,
        F.date_add("day", 1).alias("first_day"),
        F.date_sub("_next", 1).alias("last_day"),
        (F.datediff("_next", "day") - 1).alias("days"),
    )
