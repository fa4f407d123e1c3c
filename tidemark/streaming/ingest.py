"""Continuous landing folders: new files in, the same merges per micro-batch."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import flatten
from tidemark.plans import feeds
from tidemark.session import checkpoint_root
from tidemark.sources.documents import stream_documents
from tidemark.sources.store import HistoryTable, already_applied


def _own(wh: feeds.Warehouse, folder: str) -> str:
    """Name of one (warehouse, landing folder) pair: streams share neither progress nor batch numbers."""
    return hashlib.sha256(f"{wh.root}\n{folder}".encode()).hexdigest()[:16]


def _start(wh: feeds.Warehouse, folder: str, name: str, checkpoint: str | None, max_files: int | None, apply: Callable) -> StreamingQuery:
    own = f"{name}-{_own(wh, folder)}"
    writer = stream_documents(wh.spark, folder, max_files).writeStream.foreachBatch(apply).queryName(own)
    location = f"{(checkpoint or checkpoint_root(wh.spark)).rstrip('/')}/{own}"
    return writer.option("checkpointLocation", location).trigger(availableNow=True).start()


def _newest(docs: DataFrame) -> int | None:
    """Newest fetch time of a micro-batch, in microseconds; None if it is empty."""
    return docs.agg(F.max(F.unix_micros("fetched_at"))).first()[0]


def _instant(newest: int, batch: tuple[str, int], table: HistoryTable, *others: HistoryTable) -> Column:
    """Merge instant of a batch: its newest fetch time, but after everything merged before.

    Files that land late still count (the last load wins).  A batch that failed after
    ``table`` was published goes on at the instant it had.
    """
    m = table.manifest()
    if already_applied(m, batch):
        micros = m["marks"]["latest"]
    else:
        micros = max(newest, *(t.manifest()["marks"].get("latest", 0) + 1 for t in (table, *others)))
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def apply_weather(wh: feeds.Warehouse, folder: str) -> Callable[[DataFrame, int], None]:
    """What a micro-batch of weather documents does; a batch number that was applied before changes nothing."""

    def apply(docs: DataFrame, batch_id: int) -> None:
        batch = (f"weather-{_own(wh, folder)}", batch_id)
        newest = _newest(docs)
        if newest is None:
            return
        wh.staged_weather.upsert(flatten.weather_rows(docs), batch)
        feeds.historize_weather(wh, _instant(newest, batch, wh.weather_daily), batch=batch)

    return apply


def apply_events(wh: feeds.Warehouse, folder: str) -> Callable[[DataFrame, int], None]:
    """What a micro-batch of event lists does; a batch number that was applied before changes nothing."""

    def apply(docs: DataFrame, batch_id: int) -> None:
        batch = (f"events-{_own(wh, folder)}", batch_id)
        newest = _newest(docs)
        if newest is None:
            return
        wh.staged_events.upsert(flatten.event_rows(docs), batch)
        feeds.historize_events(wh, _instant(newest, batch, wh.space_events), batch=batch)

    return apply


def apply_approaches(wh: feeds.Warehouse, folder: str) -> Callable[[DataFrame, int], None]:
    """What a micro-batch of approach feeds does: facts, then their dimension at the same instant."""

    def apply(docs: DataFrame, batch_id: int) -> None:
        batch = (f"approaches-{_own(wh, folder)}", batch_id)
        newest = _newest(docs)
        if newest is None:
            return
        wh.staged_approaches.upsert(flatten.approach_rows(docs), batch)
        as_of = _instant(newest, batch, wh.close_approaches, wh.asteroids)
        feeds.historize_approaches(wh, as_of, batch=batch)

    return apply


def ingest_weather(wh: feeds.Warehouse, folder: str, checkpoint: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Stage and version newly landed weather documents until none are left."""
    return _start(wh, folder, "ingest_weather", checkpoint, max_files, apply_weather(wh, folder))


def ingest_events(wh: feeds.Warehouse, folder: str, checkpoint: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Stage and version newly landed event lists until none are left."""
    return _start(wh, folder, "ingest_events", checkpoint, max_files, apply_events(wh, folder))


def ingest_approaches(wh: feeds.Warehouse, folder: str, checkpoint: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Stage and version newly landed approach feeds, then their dimension."""
    return _start(wh, folder, "ingest_approaches", checkpoint, max_files, apply_approaches(wh, folder))


def running_success_rate(calls: DataFrame, late: str = "1 day", span: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Success rate per source over sliding windows; calls later than ``late`` are left out."""
    window = F.window("called_at", span, slide)
    counted = calls.withWatermark("called_at", late).groupBy(window.alias("w"), "source_name").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.coalesce(F.col("success"), F.lit(False))).alias("successes")
    )
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "source_name",
        "calls",
        "successes",
        (F.col("successes") / F.col("calls")).alias("rate"),
    )
