"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import ColumnOrName, column


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key.  The order must be total, or the pick is arbitrary.

    ``row_number() = 1`` is planned with a group limit before the shuffle: each
    task sends at most one row per key, so a key that holds a third of all rows
    costs one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnOrName]) -> DataFrame:
    """Last row per key by ``order_by``; NULL sorts first, so any value beats it."""
    return keep_first(df, keys, [column(c).desc_nulls_last() for c in order_by])


def latest_values(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], take: Sequence[str]) -> DataFrame:
    """A few columns of the last row per key, by partial aggregation (few keys, many rows)."""
    picked = F.max_by(F.struct(*take), F.struct(*order_by)).alias("_picked")
    return df.groupBy(*keys).agg(picked).select(*keys, "_picked.*")


def distinct_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
