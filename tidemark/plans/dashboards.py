"""Report views over current rows.  Each is a plain DataFrame; ``as_of`` stands for now.

Column names of the views are fixed: they are those of the published panels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import at, bucket, period_start, severity_rank
from tidemark.operators import audit, joins
from tidemark.operators.dedupe import latest_values


def _since(df: DataFrame, col: str, as_of, days: int):
    t = at(as_of, df.schema[col].dataType)
    return F.col(col) > t - F.expr(f"INTERVAL {int(days)} DAYS")


@dataclass(frozen=True)
class Panel:
    """The filters all views share: days from ``start`` to ``end``, and locations by name.

    They are put on the rows before anything is grouped, so they reach the scan.
    """

    start: str | None = None
    end: str | None = None
    locations: Sequence[str] | None = None

    def days(self, df: DataFrame, date_col: str) -> DataFrame:
        day = F.col(date_col).cast("date")
        if self.start is not None:
            df = df.where(day >= F.lit(self.start).cast("date"))
        if self.end is not None:
            df = df.where(day <= F.lit(self.end).cast("date"))
        return df

    def places(self, locations: DataFrame, name: str = "name") -> DataFrame:
        return joins.date_and_key_filter(locations, key_col=name, keys=self.locations)


EVERYTHING = Panel()

# --- weather ------------------------------------------------------------------


def temperature_series(weather: DataFrame, locations: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    named = panel.days(joins.current(weather), "date").join(
        panel.places(joins.current(locations)).select("location_key", F.col("name").alias("location")), "location_key"
    )
    return named.select("date", "location", "temp_min", "temp_max").orderBy(F.asc_nulls_last("date"), "location")


def monthly_total(fact: DataFrame, dim: DataFrame, key: str, date_col: str, value_col: str, name_col: str, out: str) -> DataFrame:
    """Sum per month and name: summed per key first, so the join is one row per key and month."""
    per_key = fact.groupBy(key, period_start("month", date_col).alias("month")).agg(F.sum(value_col).alias("_part"))
    named = per_key.join(dim.select(key, name_col), key)
    return named.groupBy("month", name_col).agg(F.sum("_part").alias(out))


def monthly_precipitation(weather: DataFrame, locations: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    names = panel.places(joins.current(locations)).select("location_key", F.col("name").alias("location"))
    totals = monthly_total(panel.days(joins.current(weather), "date"), names, "location_key", "date", "precipitation_mm", "location", "precip_mm")
    return totals.orderBy("month", "location")


def current_temperature(weather: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    """Latest temperature and the newest fetch over all current rows."""
    return panel.days(joins.current(weather), "date").agg(
        F.max_by("temp_max", F.struct("date", "source_fetched_at", "location_key")).alias("temp_max"),
        F.max("source_fetched_at").alias("last_updated"),
    )


def latest_temperature_by_location(weather: DataFrame, locations: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    last = latest_values(panel.days(joins.current(weather), "date"), ["location_key"], ["date", "source_fetched_at"], ["temp_max"])
    places = panel.places(joins.current(locations)).select("location_key", F.col("name").alias("location"), "lat", "lon")
    return last.join(places, "location_key").select("location", "lat", "lon", "temp_max")


# --- close approaches -----------------------------------------------------------


def approaches_by_distance(approaches: DataFrame, asteroids: DataFrame, slice_unit: str | None = None, panel: Panel = EVERYTHING) -> DataFrame:
    """Current approaches with the attributes in force when they were opened, nearest first."""
    attributes = ["name", "estimated_diameter_m_max", "is_potentially_hazardous"]
    joined = joins.effective_join(
        panel.days(joins.current(approaches), "close_approach_date"), asteroids, "asteroid_id", "open_date", attributes, slice_unit
    )
    return joined.select(
        "asteroid_id", "name", "close_approach_date", "miss_distance_km", "relative_velocity_kph",
        "estimated_diameter_m_max", "is_potentially_hazardous",
    ).orderBy(F.asc_nulls_last("miss_distance_km"), "asteroid_id", "close_approach_date")


def approaches_with_current_attributes(approaches: DataFrame, asteroids: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    attributes = ["name", "estimated_diameter_m_max", "is_potentially_hazardous"]
    return joins.resolve_current(panel.days(joins.current(approaches), "close_approach_date"), asteroids, "asteroid_id", attributes)


def distance_velocity_scatter(approaches: DataFrame, asteroids: DataFrame) -> DataFrame:
    joined = joins.effective_join(
        joins.current(approaches), asteroids, "asteroid_id", take=["estimated_diameter_m_max"]
    )
    return joined.select("miss_distance_km", "relative_velocity_kph", "estimated_diameter_m_max")


def weekly_count(df: DataFrame, date_col: str, out: str) -> DataFrame:
    return df.groupBy(period_start("week", date_col).alias("week")).agg(F.count(F.lit(1)).alias(out))


def weekly_approaches(approaches: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    return weekly_count(panel.days(joins.current(approaches), "close_approach_date"), "close_approach_date", "approaches").orderBy("week")


def closest_in_next_days(approaches: DataFrame, as_of, days: int = 7) -> DataFrame:
    """One row: the nearest approach from ``as_of`` on, within ``days`` days."""
    day = F.to_date(at(as_of))
    soon = joins.current(approaches).where(F.col("close_approach_date").between(day, F.date_add(day, days)))
    ranked = soon.orderBy(F.asc_nulls_last("miss_distance_km"), "close_approach_date", "asteroid_id")
    return ranked.limit(1)


# --- space weather --------------------------------------------------------------


def weekly_by_class(df: DataFrame, date_col: str, class_col: str, out: str) -> DataFrame:
    letter = F.left(F.col(class_col), F.lit(1)).alias("class")
    return df.groupBy(period_start("week", date_col).alias("week"), letter).agg(F.count(F.lit(1)).alias(out))


def weekly_flares(events: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    flares = panel.days(joins.current(events), "event_time").where("event_type = 'FLR'")
    return weekly_by_class(flares, "event_time", "flare_class", "flares").orderBy("week", "class")


def bucket_counts(df: DataFrame, col: str, low, high, count: int, band: str, out: str) -> DataFrame:
    banded = df.where(F.col(col).isNotNull())
    return banded.groupBy(bucket(col, low, high, count).cast("int").alias(band)).agg(F.count(F.lit(1)).alias(out))


def storms_by_band(events: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    storms = panel.days(joins.current(events), "event_time").where("event_type = 'GST'")
    return bucket_counts(storms, "kp_index", 0, 9, 9, "kp_band", "storms").orderBy("kp_band")


def recent(df: DataFrame, time_col: str, tie_break: str, limit: int) -> DataFrame:
    """The newest rows; a bounded sort per task, then one of ``limit`` rows each."""
    return df.orderBy(F.desc_nulls_last(time_col), tie_break).limit(limit)


def recent_ejections(events: DataFrame, limit: int = 50, panel: Panel = EVERYTHING) -> DataFrame:
    """Newest mass ejections with the storm they are linked to, where it is known."""
    now = joins.current(events)
    newest = recent(panel.days(now.where("event_type = 'CME'"), "event_time"), "event_time", "event_id", limit)
    # only the storms that the newest point to; that side is at most ``limit`` rows
    linked_ids = newest.select(F.col("linked_event_id").alias("event_id")).where("event_id IS NOT NULL").distinct()
    storms = now.where("event_type = 'GST'").join(linked_ids, "event_id", "left_semi")
    joined = joins.linked(
        newest, "linked_event_id", "event_id", {"event_time": "storm_time", "kp_index": "storm_kp_index"}, storms
    )
    columns = ["event_time", "source_location", "speed_kms", "linked_event_id", "storm_time", "storm_kp_index"]
    return joined.orderBy(F.desc_nulls_last("event_time"), "event_id").select(*columns)


def most_severe_in_last_days(events: DataFrame, as_of, days: int = 7) -> DataFrame:
    """One row: the strongest flare or storm; flares by score, storms by Kp."""
    t = at(as_of, events.schema["event_time"].dataType)
    last = joins.current(events).where(_since(events, "event_time", as_of, days) & (F.col("event_time") <= t))
    severity = F.coalesce("flare_severity_score", "kp_index")
    ranked = last.withColumn("severity_value", severity).where("severity_value IS NOT NULL")
    return ranked.orderBy(F.desc("severity_value"), F.desc("event_time"), "event_id").limit(1)


# --- call health ------------------------------------------------------------------


def hourly_latency(calls: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    hour = F.date_trunc("hour", "called_at").cast(calls.schema["called_at"].dataType).alias("ts")
    return panel.days(calls, "called_at").groupBy(hour, "source_name").agg(F.avg("response_time_ms").alias("avg_ms")).orderBy("ts", "source_name")


def success_rate_pct(calls: DataFrame, as_of, days: int = 7) -> DataFrame:
    rated = audit.success_rate(calls, as_of, days)
    return rated.select("source_name", (F.lit(100.0) * F.col("successes") / F.col("calls")).alias("success_rate_pct"))


def headroom(calls: DataFrame) -> DataFrame:
    """Newest known rate-limit headroom per source."""
    known = calls.where("rate_limit_remaining IS NOT NULL")
    return latest_values(known, ["source_name"], ["called_at", "rate_limit_remaining"], ["rate_limit_remaining", "called_at"])


def retry_trend(calls: DataFrame, panel: Panel = EVERYTHING) -> DataFrame:
    day = F.to_date("called_at").alias("day")
    return panel.days(calls, "called_at").groupBy(day, "source_name").agg(F.sum("retry_count").alias("retries")).orderBy("day", "source_name")


def recent_findings(findings: DataFrame, limit: int = 100, panel: Panel = EVERYTHING) -> DataFrame:
    """Findings by urgency, newest first."""
    order = [severity_rank("severity"), F.desc_nulls_last("detected_at"), F.asc("check_name"), F.asc("description")]
    columns = ["detected_at", "severity", "check_name", "related_table", "description"]
    return panel.days(findings, "detected_at").orderBy(*order).limit(limit).select(*columns)


def findings_by_check(findings: DataFrame, prefix: str = "") -> DataFrame:
    """Findings per check; prefix ``schema_drift_`` gives the drift signal per source."""
    return findings.where(F.col("check_name").startswith(prefix)).groupBy("check_name").agg(F.count(F.lit(1)).alias("findings"))
