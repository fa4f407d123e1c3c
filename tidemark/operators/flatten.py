"""Nested documents -> flat rows.

Input: one row per document with ``value`` (text) and the file-name context of
:mod:`tidemark.sources.documents`.  Numbers are read as text, so one bad item does
not blank a whole array.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import fixed_values as fixed
from tidemark.functions.scalars import blank_to_null, class_score, conform, instant, number, truthy
from tidemark.operators.dedupe import keep_last

POSITION = "_position"


def zip_arrays(df: DataFrame, index: Column, arms: Mapping[str, Column], index_name: str) -> DataFrame:
    """One row per element of ``index``; arms that are short or missing give NULL.

    The outer form plus a filter: the plain one infers a ``size(index) > 0`` filter
    that is pushed below the parse and parses every document again.
    """
    carried = df.columns
    wide = df.select(
        *carried,
        *[arm.alias(f"_arm_{name}") for name, arm in arms.items()],
        F.posexplode_outer(index).alias(POSITION, index_name),
    )
    return wide.where(F.col(POSITION).isNotNull()).select(
        *carried, POSITION, index_name, *[F.get(f"_arm_{name}", F.col(POSITION)).alias(name) for name in arms]
    )


CORRUPT = "_corrupt"


def parse_object(docs: DataFrame, schema: str, payload: str, others_are_empty: bool = False) -> DataFrame:
    """Add ``_payload``: one field of a JSON object document.

    A document that is not JSON, or not of this shape, fails the batch; with
    ``others_are_empty`` a JSON document that is no object just has no payload.
    """
    parsed = docs.withColumn(
        "_doc", F.from_json("value", f"{schema}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})
    )
    bad = F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull()
    if others_are_empty:
        bad = bad & (F.col("value").rlike(r"^\s*\{") | F.try_parse_json("value").isNull())
    payload_col = F.col(f"_doc.{payload}")
    return parsed.select(*docs.columns, F.when(bad, unreadable("value")).otherwise(payload_col).alias("_payload"))


def unreadable(value: str) -> Column:
    return F.raise_error(F.concat(F.lit("unreadable document: "), F.left(F.col(value), F.lit(80))))


def parse_list(docs: DataFrame, schema: str) -> DataFrame:
    """Add ``_payload``: the elements of a JSON list document; other JSON has none.

    The first character decides, as a lone object would be read as a list of one.
    """
    parsed = docs.withColumn("_doc", F.from_json("value", schema))
    is_list = F.col("value").rlike(r"^\s*\[")
    bad = F.when(is_list, F.col("_doc").isNull()).otherwise(F.try_parse_json("value").isNull())
    payload = F.when(bad, unreadable("value")).when(is_list, F.col("_doc"))
    return parsed.select(*docs.columns, payload.alias("_payload"))


def weather_rows(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Parallel daily arrays -> one typed row per (location, date), last one kept.

    ``carry`` names columns of ``docs`` that the rows keep, such as ``historical``.
    """
    daily = parse_object(docs, schemas.WEATHER_DOCUMENT, "daily").select(
        F.col("first_token").alias("location_id"), "fetched_at", "file_name", *carry, F.col("_payload").alias("_daily")
    )
    arms = {
        "temp_min": F.col("_daily.temperature_2m_min"),
        "temp_max": F.col("_daily.temperature_2m_max"),
        "precipitation_mm": F.col("_daily.precipitation_sum"),
        "wind_speed_max": F.col("_daily.wind_speed_10m_max"),
        "weather_code": F.col("_daily.weather_code"),
    }
    rows = zip_arrays(daily, F.col("_daily.time"), arms, "date")
    measures = ("temp_min", "temp_max", "precipitation_mm", "wind_speed_max")
    typed = rows.withColumns({m: number(m) for m in measures} | {"weather_code": blank_to_null("weather_code")})
    keys = schemas.STAGED_WEATHER.keys
    typed = conform(typed, schemas.STAGED_WEATHER.schema, only=keys)  # narrow sort and shuffle keys
    last = keep_last(typed, keys, ["fetched_at", "file_name", POSITION])
    kept = [f for f in last.schema.fields if f.name in carry]
    return conform(last, T.StructType([*schemas.STAGED_WEATHER.schema.fields, *kept]))


def most_accurate_speed(analyses: Column) -> Column:
    """Speed of the first analysis flagged accurate, else of the first one.

    The whole struct is chosen, so an accurate analysis without a speed gives NULL.
    """
    flagged = F.filter(analyses, lambda a: truthy(a["isMostAccurate"]))
    return number(F.coalesce(F.get(flagged, F.lit(0)), F.get(analyses, F.lit(0)))["speed"])


def peak(items: Column, field: str) -> Column:
    """Largest readable number of one field over an array of structs."""
    return F.array_max(F.transform(items, lambda item: number(item[field])))


def first_field(items: Column, field: str) -> Column:
    return F.get(items, F.lit(0))[field]


def event_rows(docs: DataFrame) -> DataFrame:
    """Event lists of all types -> one sparse typed row per event id, last one kept.

    An unknown event type fails the batch; a document that is no list has no rows.
    """
    kind = F.upper("first_token")
    known = F.when(kind.isin(*fixed.EVENT_TYPES), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("unknown event type: "), kind)).cast("boolean")
    )
    events = (
        parse_list(docs.where(known), schemas.EVENT_DOCUMENT)
        .select(kind.alias("event_type"), "fetched_at", "file_name", F.posexplode_outer("_payload").alias(POSITION, "e"))
        .where(F.col(POSITION).isNotNull())
    )
    rows = sparse_events(events).where(F.col("event_id").isNotNull())
    last = keep_last(rows, ["event_id"], ["fetched_at", "file_name", POSITION])
    return conform(last, schemas.STAGED_EVENTS.schema)


def sparse_events(events: DataFrame) -> DataFrame:
    """Route each event by type into one row type; columns of other types stay NULL."""
    is_type = {t: F.col("event_type") == t for t in fixed.EVENT_TYPES}
    cme, gst, flr = (is_type[t] for t in fixed.EVENT_TYPES)
    start = blank_to_null("e.startTime")
    return events.select(
        blank_to_null(F.when(cme, F.col("e.activityID")).when(gst, F.col("e.gstID")).when(flr, F.col("e.flrID"))).alias(
            "event_id"
        ),
        "event_type",
        instant(
            F.when(flr, F.coalesce(blank_to_null("e.beginTime"), blank_to_null("e.peakTime"))).otherwise(start)
        ).alias("event_time"),
        F.when(cme | flr, blank_to_null("e.sourceLocation")).alias("source_location"),
        F.when(cme, most_accurate_speed(F.col("e.cmeAnalyses"))).alias("speed_kms"),
        F.when(gst, peak(F.col("e.allKpIndex"), "kpIndex")).alias("kp_index"),
        F.when(flr, blank_to_null("e.classType")).alias("flare_class"),
        F.when(flr, class_score("e.classType")).alias("flare_severity_score"),
        blank_to_null(first_field(F.col("e.linkedEvents"), "activityID")).alias("linked_event_id"),
        "fetched_at",
        "file_name",
        POSITION,
    )


def approach_rows(docs: DataFrame) -> DataFrame:
    """Date-keyed feed -> one typed row per (asteroid, approach date), last one kept.

    Only approaches filed under their own date count.
    """
    feed = parse_object(docs, schemas.APPROACH_DOCUMENT, "near_earth_objects", others_are_empty=True)
    dated = feed.select("fetched_at", "file_name", F.explode_outer("_payload").alias("_date", "_objects")).where(
        "_date IS NOT NULL"
    )
    objects = dated.select("fetched_at", "file_name", "_date", F.posexplode("_objects").alias("_object_no", "o"))
    passes = objects.select(
        "fetched_at", "file_name", "_date", "_object_no", "o", F.posexplode("o.close_approach_data").alias("_pass_no", "p")
    ).where("p.close_approach_date = _date")
    rows = passes.select(
        blank_to_null("o.id").alias("asteroid_id"),
        F.col("_date").alias("close_approach_date"),
        blank_to_null("o.name").alias("name"),
        number("p.miss_distance.kilometers").alias("miss_distance_km"),
        number("p.relative_velocity.kilometers_per_hour").alias("relative_velocity_kph"),
        number("o.estimated_diameter.meters.estimated_diameter_max").alias("estimated_diameter_m_max"),
        truthy("o.is_potentially_hazardous_asteroid").alias("is_potentially_hazardous"),
        "fetched_at",
        "file_name",
        "_object_no",
        "_pass_no",
    )
    last = keep_last(
        rows, ["asteroid_id", "close_approach_date"], ["fetched_at", "file_name", "_object_no", "_pass_no"]
    )
    return conform(last, schemas.STAGED_APPROACHES.schema)


def records_returned(docs: DataFrame, source: str) -> DataFrame:
    """Records per document, as the call log counts them."""
    counts: dict[str, Column] = {
        "weather": F.coalesce(F.size(F.from_json("value", schemas.WEATHER_DOCUMENT)["daily"]["time"]), F.lit(0)),
        "events": F.coalesce(F.json_array_length("value"), F.lit(0)),
        "approaches": F.coalesce(
            F.from_json("value", schemas.APPROACH_DOCUMENT)["element_count"].try_cast("int"), F.lit(0)
        ),
    }
    return docs.select("file_name", counts[source].alias("records_returned"))

