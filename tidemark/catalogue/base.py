"""What the catalogue modules share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str) -> Column:
    """Literal wall-clock instant, independent of the session zone."""
    return F.lit(text).cast("timestamp_ntz")


def double(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def shown(df: DataFrame) -> DataFrame:
    """Dates and instants as ISO text and decimals as doubles, so that two engines' rows compare."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "date":
            col = F.col(f.name).cast("string")
        elif kind.startswith("timestamp"):
            wall = F.col(f.name) if kind == "timestamp_ntz" else F.to_utc_timestamp(f.name, F.current_timezone())
            col = F.date_format(wall, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            col = F.col(f.name).cast("double")
        else:
            col = F.col(f.name)
        out.append(col.alias(f.name))
    return df.select(*out)
