"""The runs: landed documents -> staging -> history -> audit, one function per feed."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import fixed_values as fixed
from tidemark.functions.scalars import at, is_positive, label, value_range, with_lineage
from tidemark.operators import audit, constraints, flatten, joins, merge
from tidemark.session import written
from tidemark.sources.documents import read_documents
from tidemark.sources.seed import seed_locations as seed_location_rows
from tidemark.sources.store import HistoryTable, Log, Snapshot, already_applied


@dataclass
class Warehouse:
    """The tables of all feeds below one root folder."""

    spark: SparkSession
    root: str

    def _staging(self, table) -> Snapshot:
        return Snapshot(self.spark, f"{self.root}/staging/{table.name}", table)

    def _history(self, table) -> HistoryTable:
        return HistoryTable(self.spark, f"{self.root}/history/{table.name}", table)

    @property
    def staged_weather(self):
        return self._staging(schemas.STAGED_WEATHER)

    @property
    def staged_events(self):
        return self._staging(schemas.STAGED_EVENTS)

    @property
    def staged_approaches(self):
        return self._staging(schemas.STAGED_APPROACHES)

    @property
    def staged_locations(self):
        return self._staging(schemas.STAGED_LOCATIONS)

    @property
    def locations(self):
        return self._history(schemas.LOCATIONS)

    @property
    def asteroids(self):
        return self._history(schemas.ASTEROIDS)

    @property
    def weather_daily(self):
        return self._history(schemas.WEATHER_DAILY)

    @property
    def space_events(self):
        return self._history(schemas.SPACE_EVENTS)

    @property
    def close_approaches(self):
        return self._history(schemas.CLOSE_APPROACHES)

    @property
    def call_log(self):
        return Log(self.spark, f"{self.root}/logs/call_log", schemas.CALL_LOG, "called_at")

    @property
    def findings(self):
        return Log(self.spark, f"{self.root}/logs/findings", schemas.FINDINGS, "detected_at")

    @property
    def key_reference(self):
        table = schemas.Staging("key_reference", "name STRING, keys ARRAY<STRING>", ("name",))
        return self._staging(table)


# --- dimensions ---------------------------------------------------------------


def seed_locations(wh: Warehouse, as_of, rows: DataFrame | None = None) -> dict:
    """Stage the seed rows, then version them."""
    wh.staged_locations.upsert(rows if rows is not None else seed_location_rows(wh.spark))
    return wh.locations.merge(wh.staged_locations.read(), as_of)


def derive_asteroids(wh: Warehouse, as_of, conflict: str = "latest", batch=None) -> dict:
    """Version the descriptive attributes found in the staged approach feed.

    Only asteroids staged since the last derivation can have changed; the others are
    filtered out before anything shuffles.  The attributes are written once, as the merge
    reads its input more than once.
    """
    staged, marks = wh.staged_approaches, {"staged": wh.staged_approaches.version}
    since = wh.asteroids.manifest()["marks"].get("staged", 0)
    feed = staged.read()
    if since:
        feed = feed.join(staged.read(since).select("asteroid_id").distinct(), "asteroid_id", "left_semi")
    attributes = merge.latest_attributes(
        feed,
        ["asteroid_id"],
        ["name", "estimated_diameter_m_max", "is_potentially_hazardous"],
        ["close_approach_date"],
        conflict,
    )
    if not already_applied(wh.asteroids.manifest(), batch):
        attributes = written(attributes, "attributes")
    return wh.asteroids.merge(attributes, as_of, batch, marks)


# --- facts --------------------------------------------------------------------


def weather_facts(staged: DataFrame, locations: DataFrame, run_id: str | None) -> DataFrame:
    """Staged rows under their current location key, with the derived columns."""
    resolved = joins.resolve_current(staged, locations, "location_id", ["location_key"])
    derived = resolved.select(
        "location_key",
        "date",
        "temp_min",
        "temp_max",
        value_range("temp_min", "temp_max").cast("decimal(5,2)").alias("temp_range"),
        "precipitation_mm",
        is_positive("precipitation_mm").alias("is_rain_day"),
        "wind_speed_max",
        "weather_code",
        label("weather_code", fixed.WEATHER_LABELS, fixed.UNKNOWN_LABEL).alias("weather_condition"),
        "fetched_at",
    )
    return with_lineage(derived, run_id)


def approach_facts(staged: DataFrame, run_id: str | None) -> DataFrame:
    measures = ("asteroid_id", "close_approach_date", "miss_distance_km", "relative_velocity_kph", "fetched_at")
    return with_lineage(staged.select(*measures), run_id)


# --- runs ---------------------------------------------------------------------


def stage_weather(wh: Warehouse, folder, batch=None, **replay) -> dict:
    return wh.staged_weather.upsert(flatten.weather_rows(read_documents(wh.spark, folder, **replay)), batch)


def stage_events(wh: Warehouse, folder, batch=None, **replay) -> dict:
    return wh.staged_events.upsert(flatten.event_rows(read_documents(wh.spark, folder, **replay)), batch)


def stage_approaches(wh: Warehouse, folder, batch=None, **replay) -> dict:
    return wh.staged_approaches.upsert(flatten.approach_rows(read_documents(wh.spark, folder, **replay)), batch)


def historize_weather(wh: Warehouse, as_of, run_id=None, batch=None) -> dict:
    """Version what was staged since the last merge.

    Older slices were merged before and cannot change anything, unless a location
    got a new key since: then all staged rows are looked at again.
    """
    marks = {"staged": wh.staged_weather.version, "locations": wh.locations.version}
    seen = wh.weather_daily.manifest()["marks"]
    since = seen.get("staged", 0) if seen.get("locations") == marks["locations"] else 0
    facts = weather_facts(wh.staged_weather.read(since), wh.locations.current(), run_id)
    return wh.weather_daily.merge(facts, as_of, batch, marks)


def historize_events(wh: Warehouse, as_of, run_id=None, batch=None) -> dict:
    since = wh.space_events.manifest()["marks"].get("staged", 0)
    marks = {"staged": wh.staged_events.version}
    return wh.space_events.merge(with_lineage(wh.staged_events.read(since), run_id), as_of, batch, marks)


def historize_approaches(wh: Warehouse, as_of, run_id=None, batch=None) -> dict:
    """Facts first, then the dimension derived from the same feed, at the same instant."""
    since = wh.close_approaches.manifest()["marks"].get("staged", 0)
    marks = {"staged": wh.staged_approaches.version}
    counts = wh.close_approaches.merge(approach_facts(wh.staged_approaches.read(since), run_id), as_of, batch, marks)
    derive_asteroids(wh, as_of, batch=batch)
    return counts


def load_weather(wh: Warehouse, folder, as_of, run_id=None, **replay) -> dict:
    stage_weather(wh, folder, **replay)
    return historize_weather(wh, as_of, run_id)


def counted_weather_load(wh: Warehouse, folder, as_of, run_id=None, **replay) -> constraints.StageCounts:
    """:func:`load_weather` with the rows in and out of each stage: documents read, days parsed, staged, resolved, and by merge state.

    The points are counted by the two jobs that stage and merge; nothing is read again for them.
    """
    counts = constraints.StageCounts()
    docs = counts.at("documents", read_documents(wh.spark, folder, **replay))
    rows = counts.at("parsed", flatten.weather_rows(docs))
    counts.add({"staged": wh.staged_weather.upsert(rows)["rows"]})
    counts.add(historize_weather(wh, as_of, run_id))
    return counts


def load_events(wh: Warehouse, folder, as_of, run_id=None, **replay) -> dict:
    stage_events(wh, folder, **replay)
    return historize_events(wh, as_of, run_id)


def load_approaches(wh: Warehouse, folder, as_of, run_id=None, **replay) -> dict:
    stage_approaches(wh, folder, **replay)
    return historize_approaches(wh, as_of, run_id)


def backfill(wh: Warehouse, weather, events, approaches, as_of, run_id=None) -> dict:
    """Stage every historical document of all feeds in one scan each, then one merge each."""
    stage_weather(wh, weather, historical=True)
    stage_events(wh, events, historical=True)
    stage_approaches(wh, approaches, historical=True)
    return {
        "weather": historize_weather(wh, as_of, run_id),
        "events": historize_events(wh, as_of, run_id),
        "approaches": historize_approaches(wh, as_of, run_id),
    }


def rejected(load: Callable[[], object]) -> str | None:
    """Error class of a load that fails on its data; None if it goes through.

    A value that does not fit its type, or a document of the wrong shape, stops the job that lands
    the batch, so nothing of it is published.  The class is the innermost one of the error.
    """
    try:
        load()
    except (PySparkException, Py4JJavaError) as error:
        found = re.findall(r"\[([A-Z][A-Z_]+)(?:\.[A-Z_]+)*\]", str(error))
        if not found:
            raise
        return found[-1]
    return None


# --- audit --------------------------------------------------------------------


def audit_checks(wh: Warehouse, as_of, run_id: str | None = None, docs: DataFrame | None = None) -> dict:
    """The checks by name; each reads tables only, so they run whatever the load did.

    ``docs`` (name, value, fetched_at, file_name) adds the key-drift check.
    """
    t = at(as_of)

    def found(rows, name, table, text):
        return audit.findings(rows, name, fixed.CHECKS[name], table, text, t, run_id)

    def absence():
        rows = audit.absent_on(wh.locations.current(), wh.weather_daily.current(), "location_key", "date", t)
        text = F.format_string("No current weather row on %s for location %s (%s).", F.to_date(t).cast("string"), "location_id", "name")
        return found(rows, "absence_weather_daily", "weather_daily", text)

    def anomaly():
        rows = audit.trailing_anomaly(wh.weather_daily.current(), ["location_key"], "date", "temp_max")
        text = F.format_string(
            f"temp_max %s on %s (location_key %s) is more than {fixed.ANOMALY_SIGMAS} deviations from the mean of the {fixed.ANOMALY_DAYS} days before.",
            F.col("temp_max").cast("string"), F.col("date").cast("string"), "location_key",
        )
        return found(rows, "anomaly_temp_max", "weather_daily", text)

    def unlogged_runs():
        rows = audit.unmatched_keys(wh.weather_daily.read(), wh.call_log.read(), {"pipeline_run_id": "pipeline_run_id"})
        text = F.format_string("weather_daily run %s has no entry in the call log.", "pipeline_run_id")
        return found(rows, "xtable_weather_run_id", "weather_daily", text)

    def uncovered_asteroids():
        rows = audit.unmatched_keys(wh.close_approaches.current(), wh.asteroids.current(), {"asteroid_id": "asteroid_id"})
        text = F.format_string("asteroid_id %s has current approaches but no current dimension row.", "asteroid_id")
        return found(rows, "xtable_asteroid_dimension_coverage", "close_approaches", text)

    def unresolved_locations():
        rows = audit.unmatched_keys(wh.staged_weather.read(), wh.locations.current(), {"location_id": "location_id"})
        text = F.format_string("location_id %s is staged but has no current dimension row.", "location_id")
        return found(rows, "xtable_location_dimension_coverage", "staging_weather", text)

    def reliability():
        rows = audit.low_success_rate(wh.call_log.read(), t)
        text = F.format_string(
            f"Source %s has a 7-day success rate of %s (< {fixed.SUCCESS_RATE_FLOOR}).", "source_name", F.col("success_rate_7d").cast("string")
        )
        return found(rows, "trend_api_success_rate", "call_log", text)

    checks = {
        "absence_weather_daily": absence,
        "anomaly_temp_max": anomaly,
        "xtable_weather_run_id": unlogged_runs,
        "xtable_asteroid_dimension_coverage": uncovered_asteroids,
        "xtable_location_dimension_coverage": unresolved_locations,
        "trend_api_success_rate": reliability,
    }
    if docs is not None:
        checks["schema_drift"] = lambda: audit.drift_findings(audit.key_drift(docs, wh.key_reference.read()), t, run_id)
    return checks


def run_audit(wh: Warehouse, as_of, run_id: str | None = None, docs: DataFrame | None = None) -> list[str]:
    """Append the findings of every check; afterwards learn the keys of new document kinds."""
    failed = audit.run_checks(audit_checks(wh, as_of, run_id, docs), wh.findings.append)
    if docs is not None:
        reference = wh.key_reference.read() if wh.key_reference.version else None
        wh.key_reference.upsert(audit.bootstrap_reference(docs, reference))
    return failed
