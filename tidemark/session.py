"""Session settings the library relies on, and the shared folder for lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that change results (ANSI casts raise, instants are UTC) or keep
#: skewed shuffles even at run time (AQE).  Sizes are left to the cluster.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local folder only where the session names none (tests, a laptop); on a cluster
    the setting is needed, as a machine-local folder is not seen by other executors.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tidemark-")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Spark removes the shuffle files of an execution as soon as it has ended, not when the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Executions inside leave no shuffle files; a plan that is run again makes its own."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut."""
    return written_in_turn([df], name)


def written_in_turn(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of all parts, of one schema, as one table in the shared folder; each part is a job of its own.

    Nothing reads what was shuffled for a part once it is written, so these files go before the next step makes its own.
    """
    path = None
    for part in parts:
        spark = part.sparkSession
        path = path or fresh_folder(spark, name)
        with _shuffles_released(spark):
            part.write.mode("append").parquet(path)
    return spark.read.schema(part.schema).parquet(path)
