"""Table declarations: columns, keys, tracked columns and rules of every feed table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tidemark.functions import fixed_values as fixed
from tidemark.operators.constraints import Rule, between, non_negative, not_null, one_of


class Declared:
    """Columns are kept as DDL text, parsed where a session exists."""

    ddl: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


def hash_slice(key: str, count: int = 64) -> str:
    return f"lpad(hex(pmod(hash({key}), {count})), 2, '0')"


def month_slice(key: str) -> str:
    """Month an event id begins with; the id does not change, so neither does its slice."""
    return f"coalesce(nullif(regexp_extract({key}, '^[0-9]{{4}}-[0-9]{{2}}', 0), ''), 'other')"


@dataclass(frozen=True)
class Staging(Declared):
    """Overwrite-in-place snapshot, one row per key.

    ``slice_by`` is a SQL expression over the key columns; a write reads and
    rewrites only the slices its batch touches.
    """

    name: str
    ddl: str
    keys: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    slice_by: str = "'all'"
    defaults: dict = field(default_factory=dict)


@dataclass(frozen=True)
class History(Declared):
    """Close-and-insert table, sliced like staging."""

    name: str
    ddl: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    surrogate: str | None = None
    slice_by: str = "'all'"
    defaults: dict = field(default_factory=dict)



# Columns, types and limits below are those of the published tables.
VERSION_DDL = "open_date TIMESTAMP, close_date TIMESTAMP"

# --- staging ---------------------------------------------------------------

STAGED_WEATHER = Staging(
    "staging_weather",
    (
        "location_id INT, date DATE, temp_min DECIMAL(5,2), temp_max DECIMAL(5,2), "
        "precipitation_mm DECIMAL(6,2), wind_speed_max DECIMAL(6,2), weather_code INT, fetched_at TIMESTAMP"
    ),
    ("location_id", "date"),
    not_null("location_id", "date", "fetched_at"),
    "date_format(date, 'yyyy-MM')",
)
STAGED_EVENTS = Staging(
    "staging_events",
    (
        "event_id STRING, event_type STRING, event_time TIMESTAMP, source_location STRING, "
        "speed_kms DECIMAL(8,2), kp_index DECIMAL(4,2), flare_class STRING, "
        "flare_severity_score DECIMAL(6,2), linked_event_id STRING, fetched_at TIMESTAMP"
    ),
    ("event_id",),
    not_null("event_id", "event_type", "fetched_at"),
    month_slice("event_id"),
)
STAGED_APPROACHES = Staging(
    "staging_approaches",
    (
        "asteroid_id STRING, close_approach_date DATE, name STRING, miss_distance_km DECIMAL(12,2), "
        "relative_velocity_kph DECIMAL(10,2), estimated_diameter_m_max DECIMAL(8,2), "
        "is_potentially_hazardous BOOLEAN, fetched_at TIMESTAMP"
    ),
    ("asteroid_id", "close_approach_date"),
    not_null("asteroid_id", "close_approach_date", "fetched_at"),
    "date_format(close_approach_date, 'yyyy-MM')",
)
STAGED_LOCATIONS = Staging(
    "staging_locations",
    "location_id INT, name STRING, lat DECIMAL(8,5), lon DECIMAL(8,5), timezone STRING",
    ("location_id",),
    not_null("location_id", "name", "lat", "lon"),
)

# --- history ---------------------------------------------------------------

LOCATIONS = History(
    "locations",
    (
        "location_key BIGINT, location_id INT, name STRING, lat DECIMAL(8,5), lon DECIMAL(8,5), "
        f"timezone STRING, {VERSION_DDL}"
    ),
    ("location_id",),
    ("name", "lat", "lon", "timezone"),
    not_null("location_id", "name", "lat", "lon", "open_date")
    + (between("lat", -90, 90), between("lon", -180, 180)),
    surrogate="location_key",
)
ASTEROIDS = History(
    "asteroids",
    (
        "asteroid_key BIGINT, asteroid_id STRING, name STRING, estimated_diameter_m_max DECIMAL(8,2), "
        f"is_potentially_hazardous BOOLEAN, {VERSION_DDL}"
    ),
    ("asteroid_id",),
    ("name", "estimated_diameter_m_max", "is_potentially_hazardous"),
    not_null("asteroid_id", "name", "is_potentially_hazardous", "open_date")
    + (Rule("diameter_positive", "estimated_diameter_m_max > 0"),),
    surrogate="asteroid_key",
    slice_by=hash_slice("asteroid_id"),
)
WEATHER_DAILY = History(
    "weather_daily",
    (
        "location_key BIGINT, date DATE, temp_min DECIMAL(5,2), temp_max DECIMAL(5,2), temp_range DECIMAL(5,2), "
        "precipitation_mm DECIMAL(6,2), is_rain_day BOOLEAN, wind_speed_max DECIMAL(6,2), weather_code INT, "
        f"weather_condition STRING, source_fetched_at TIMESTAMP, pipeline_run_id STRING, {VERSION_DDL}"
    ),
    ("location_key", "date"),
    ("temp_min", "temp_max", "precipitation_mm", "wind_speed_max", "weather_code"),
    not_null("location_key", "date", "is_rain_day", "source_fetched_at", "open_date")
    + (
        Rule("date_in_forecast", f"date <= date_add(to_date(open_date), {fixed.FORECAST_DAYS})"),
        Rule("temp_min_floor", "temp_min > -100"),
        Rule("temp_max_ceiling", "temp_max < 100"),
        Rule("temp_order", "temp_max >= temp_min"),
        non_negative("precipitation_mm"),
        non_negative("wind_speed_max"),
    ),
    slice_by="date_format(date, 'yyyy-MM')",
    defaults={"is_rain_day": False},
)
SPACE_EVENTS = History(
    "space_events",
    (
        "event_id STRING, event_type STRING, event_time TIMESTAMP, source_location STRING, "
        "speed_kms DECIMAL(8,2), kp_index DECIMAL(4,2), flare_class STRING, flare_severity_score DECIMAL(6,2), "
        f"linked_event_id STRING, source_fetched_at TIMESTAMP, pipeline_run_id STRING, {VERSION_DDL}"
    ),
    ("event_id",),
    (
        "event_type",
        "event_time",
        "source_location",
        "speed_kms",
        "kp_index",
        "flare_class",
        "flare_severity_score",
        "linked_event_id",
    ),
    not_null("event_id", "event_type", "event_time", "source_fetched_at", "open_date")
    + (one_of("event_type", fixed.EVENT_TYPES), non_negative("speed_kms"), between("kp_index", 0, 9)),
    slice_by=month_slice("event_id"),
)
CLOSE_APPROACHES = History(
    "close_approaches",
    (
        "asteroid_id STRING, close_approach_date DATE, miss_distance_km DECIMAL(12,2), "
        "relative_velocity_kph DECIMAL(10,2), source_fetched_at TIMESTAMP, pipeline_run_id STRING, "
        f"{VERSION_DDL}"
    ),
    ("asteroid_id", "close_approach_date"),
    ("miss_distance_km", "relative_velocity_kph"),
    not_null("asteroid_id", "close_approach_date", "source_fetched_at", "open_date")
    + (non_negative("miss_distance_km"), non_negative("relative_velocity_kph")),
    slice_by="date_format(close_approach_date, 'yyyy-MM')",
)

# --- logs ------------------------------------------------------------------

CALL_LOG = Staging(
    "call_log",
    (
        "source_name STRING, called_at TIMESTAMP, response_time_ms INT, http_status_code INT, success BOOLEAN, "
        "retry_count INT, records_returned INT, rate_limit_remaining INT, pipeline_run_id STRING"
    ),
    (),
    not_null("source_name", "called_at", "success")
    + (non_negative("response_time_ms"), non_negative("retry_count")),
    defaults={"retry_count": 0},
)
FINDINGS = Staging(
    "audit_findings",
    (
        "check_name STRING, severity STRING, related_table STRING, description STRING, "
        "detected_at TIMESTAMP, pipeline_run_id STRING"
    ),
    (),
    not_null("check_name", "severity", "description", "detected_at") + (one_of("severity", fixed.SEVERITIES),),
)

# --- raw documents (every field optional, numbers read as text) --------------

WEATHER_DOCUMENT = (
    "daily STRUCT<time: ARRAY<STRING>, temperature_2m_max: ARRAY<STRING>, temperature_2m_min: ARRAY<STRING>, "
    "precipitation_sum: ARRAY<STRING>, wind_speed_10m_max: ARRAY<STRING>, weather_code: ARRAY<STRING>>"
)
EVENT_DOCUMENT = (
    "ARRAY<STRUCT<activityID: STRING, gstID: STRING, flrID: STRING, startTime: STRING, beginTime: STRING, "
    "peakTime: STRING, sourceLocation: STRING, classType: STRING, "
    "cmeAnalyses: ARRAY<STRUCT<isMostAccurate: STRING, speed: STRING>>, "
    "allKpIndex: ARRAY<STRUCT<kpIndex: STRING>>, linkedEvents: ARRAY<STRUCT<activityID: STRING>>>>"
)
APPROACH_DOCUMENT = (
    "element_count STRING, near_earth_objects MAP<STRING, ARRAY<STRUCT<id: STRING, name: STRING, "
    "is_potentially_hazardous_asteroid: STRING, "
    "estimated_diameter: STRUCT<meters: STRUCT<estimated_diameter_max: STRING>>, "
    "close_approach_data: ARRAY<STRUCT<close_approach_date: STRING, "
    "miss_distance: STRUCT<kilometers: STRING>, "
    "relative_velocity: STRUCT<kilometers_per_hour: STRING>>>>>>"
)
