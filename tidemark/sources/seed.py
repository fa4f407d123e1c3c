"""Inline seed rows for hand-kept dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import fixed_values as fixed
from tidemark.functions.scalars import conform


def seed_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Literal rows, given as text or values, cast strictly to ``schema``."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in schema.fieldNames()])
    as_text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    return conform(spark.createDataFrame(as_text, text), schema)


def seed_locations(spark: SparkSession) -> DataFrame:
    return seed_rows(spark, fixed.SEED_LOCATIONS, schemas.STAGED_LOCATIONS.schema)
