"""Feeds landed as files and read back from there: scans, replays, streams, whole runs and their failures.

Every query lands its documents in the shared folder first, one file each, daily pulls and
historical ones side by side, and then only knows the folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalogue.base import Query, moment, shown, table
from tidemark.catalogue.reports import CALLS_CTE, calls
from tidemark.operators import audit, constraints, flatten, joins
from tidemark.plans import feeds
from tidemark.session import fresh_folder
from tidemark.sources import documents
from tidemark.streaming import ingest


def instant(text: str) -> Column:
    return moment(text).cast("timestamp")


def stamp(time: Column) -> Column:
    return F.date_format(time, "yyyyMMdd'T'HHmmss'Z'")


def placed(docs: DataFrame, folder: str) -> None:
    """Land (value, file_name, historical) rows below ``folder``."""
    documents.land_documents(docs.where("NOT historical"), f"{folder}/daily")
    documents.land_documents(docs.where("historical"), f"{folder}/historical")


def odd(spark, rows: list[tuple[str, str]], historical: bool = False) -> DataFrame:
    """Further documents, given as (value, file_name)."""
    made = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(n).alias("file_name")) for v, n in rows])
    return spark.range(1).select(F.inline(made)).withColumn("historical", F.lit(historical))


# --- weather ------------------------------------------------------------------------------

#: The historical pull holds the days before LAST, the daily pulls those from FIRST on; it is the newer one.
FIRST, LAST, PULLED = "1998-01-01", "1999-01-01", "2000-01-01 00:00:00"


def weather_pulls(spark, sf) -> DataFrame:
    """A document per location and year: the day's lines of 40 groups of suppliers.

    Every third location sends no wind.  Daily pulls are a degree warmer, but for each fifth location.
    """
    lines = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 40 + 1).alias("location"), F.col("l_shipdate").cast("date").alias("d"), "l_quantity", "l_linenumber")
    days = lines.groupBy("location", "d").agg(
        F.max("l_quantity").cast("int").alias("high"), (F.min("l_quantity") - 20).cast("int").alias("low"),
        F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("code"),
    )
    old, new = F.array_compact(F.array(F.when(F.col("d") < LAST, True))), F.array_compact(F.array(F.when(F.col("d") >= FIRST, False)))
    both = days.withColumn("historical", F.explode(F.concat(old, new)))
    both = both.withColumn("high", F.col("high") + F.when(~F.col("historical") & (F.col("location") % 5 != 0), 1).otherwise(0))
    # at most the days of a year meet in a group
    grouped = both.groupBy("location", "historical", F.trunc("d", "year").alias("year")).agg(
        F.array_sort(F.collect_list(F.struct("d", "high", "low", "n", "code"))).alias("days")
    )
    each = lambda f: F.transform("days", f)
    daily = F.struct(
        each(lambda x: x["d"].cast("string")).alias("time"), each(lambda x: x["high"]).alias("temperature_2m_max"), each(lambda x: x["low"].cast("string")).alias("temperature_2m_min"),
        each(lambda x: x["n"] * 0.25).alias("precipitation_sum"), F.when(F.col("location") % 3 != 0, each(lambda x: x["n"])).alias("wind_speed_10m_max"), each(lambda x: x["code"]).alias("weather_code"),
    )
    fetched = F.when(F.col("historical"), instant(PULLED)).otherwise(F.date_add("year", 366).cast("timestamp"))
    parts = [F.col("location").cast("string"), F.when(F.col("historical"), F.col("year").cast("string")), stamp(fetched)]
    return grouped.select(F.to_json(F.struct(daily.alias("daily"))).alias("value"), F.concat(F.concat_ws("_", *parts), F.lit(".json")).alias("file_name"), "historical")


WEATHER_CTE = f"""
days AS (
  SELECT l_suppkey % 40 + 1 AS location_id, CAST(l_shipdate AS DATE) AS d, CAST(max(l_quantity) AS INTEGER) AS high, CAST(min(l_quantity) - 20 AS INTEGER) AS low,
         count(*) AS n, max(l_linenumber) AS code, CAST(date_trunc('year', l_shipdate) AS DATE) + 366 AS year_fetched
  FROM lineitem GROUP BY ALL),
pulls AS (
  SELECT location_id, d, high, low, n, code, TIMESTAMP '{PULLED}' AS fetched, true AS historical FROM days WHERE d < DATE '{LAST}'
  UNION ALL
  SELECT location_id, d, high + CASE WHEN location_id % 5 <> 0 THEN 1 ELSE 0 END, low, n, code, year_fetched, false FROM days WHERE d >= DATE '{FIRST}')
"""
WEATHER_COLUMNS = """CAST(location_id AS INTEGER) AS location_id, strftime(d, '%Y-%m-%d') AS date, CAST(low AS DOUBLE) AS temp_min, CAST(high AS DOUBLE) AS temp_max, n * 0.25e0 AS precipitation_mm,
       CASE WHEN location_id % 3 <> 0 THEN CAST(n AS DOUBLE) END AS wind_speed_max, CAST(code AS INTEGER) AS weather_code, strftime(fetched, '%Y-%m-%d %H:%M:%S') AS fetched_at"""


def landed_weather_folder(spark, sf, *more: DataFrame) -> str:
    folder = fresh_folder(spark, "landing-weather")
    docs = weather_pulls(spark, sf)
    for part in more:
        docs = docs.unionByName(part)
    placed(docs, folder)
    return folder


def landed_weather(spark, sf):
    """Daily and historical documents in one scan; a day in both comes from the newer pull, with its flag."""
    docs = documents.read_documents(spark, landed_weather_folder(spark, sf))
    return shown(flatten.weather_rows(docs, carry=["historical"]))


LANDED_WEATHER_SQL = f"""
WITH {WEATHER_CTE}
SELECT {WEATHER_COLUMNS}, historical FROM pulls QUALIFY row_number() OVER (PARTITION BY location_id, d ORDER BY fetched DESC) = 1
"""

REPLAY = "1999-05-15 00:00:00", "2001-08-15 00:00:00"


def replayed_weather(spark, sf):
    """Pulls fetched within two bounds; unreadable documents fetched outside them are not opened, so they do no harm."""
    spoilt = odd(spark, [("no json", "7_19990101T000000Z.json"), ("{", "8_20020601T000000Z.json")])
    folder = landed_weather_folder(spark, sf, spoilt)
    docs = documents.read_documents(spark, folder, fetched_from=instant(REPLAY[0]), fetched_to=instant(REPLAY[1]), historical=False)
    return shown(flatten.weather_rows(docs))


REPLAY_SQL = f"""
WITH {WEATHER_CTE}
SELECT {WEATHER_COLUMNS} FROM pulls WHERE NOT historical AND fetched BETWEEN TIMESTAMP '{REPLAY[0]}' AND TIMESTAMP '{REPLAY[1]}'
"""

# --- event lists and dated feeds ---------------------------------------------------------------------


def event_pulls(spark, sf) -> DataFrame:
    """A list of at most 400 events per type and range of ids; every seventh event also lies, moved, in an older historical pull."""
    kind = F.when(F.col("event_type") == "view", "CME").when(F.col("event_type") == "click", "GST").otherwise("FLR")
    rows = table(spark, sf, "events").select(
        "event_id", kind.alias("kind"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'").alias("time"), "user_id", F.col("value").cast("int").alias("speed"),
        F.floor(F.col("event_id") / 400).alias("chunk"), F.explode(F.when(F.col("event_id") % 7 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("historical"),
    )
    of = lambda k, c: F.when(F.col("kind") == k, c)
    event_id, user = F.col("event_id").cast("string"), F.col("user_id")
    moved = F.when(F.col("historical"), F.lit("moved")).otherwise(F.concat(F.lit("S"), user))
    event = F.struct(
        of("CME", event_id).alias("activityID"), of("GST", event_id).alias("gstID"), of("FLR", F.when(F.col("event_id") % 11 != 0, event_id).otherwise("")).alias("flrID"),
        F.when(F.col("kind") != "FLR", F.col("time")).alias("startTime"), of("FLR", F.when(user % 2 == 0, "").otherwise(F.col("time"))).alias("beginTime"),
        of("FLR", F.lit("2024-02-01T00:00:30Z")).alias("peakTime"), F.when(F.col("kind") != "GST", moved).alias("sourceLocation"),
        of("FLR", F.concat(F.lit("M"), user % 10, F.lit("."), user % 7)).alias("classType"),
        of("CME", F.array(F.struct(F.lit(True).alias("isMostAccurate"), F.col("speed").alias("speed")))).alias("cmeAnalyses"),
        of("GST", F.array(F.struct((user % 9 + F.lit(0.5)).alias("kpIndex")))).alias("allKpIndex"),
    )
    grouped = rows.groupBy("kind", "chunk", "historical").agg(F.array_sort(F.collect_list(F.struct("event_id", event.alias("e")))).alias("events"))
    fetched = F.when(F.col("historical"), "20240201T000000Z").otherwise("20240301T000000Z")
    name = F.concat_ws("_", "kind", F.format_string("part%d", "chunk"), fetched)
    return grouped.select(F.to_json(F.transform("events", lambda x: x["e"])).alias("value"), F.concat(name, F.lit(".json")).alias("file_name"), "historical")


def landed_events_folder(spark, sf, *more: DataFrame) -> str:
    folder = fresh_folder(spark, "landing-events")
    docs = event_pulls(spark, sf)
    for part in more:
        docs = docs.unionByName(part)
    placed(docs, folder)
    return folder


def landed_events(spark, sf):
    """Event lists of all types from one folder, the type told by the name; documents that are no list have no rows."""
    lone = '{"activityID":"lone","startTime":"2024-01-01T00:00Z","cmeAnalyses":[]}'
    others = odd(spark, [(lone, "CME_x1_20240301T000000Z.json"), ('"text"', "gst_x2_20240301T000000Z.json"), ("[]", "FLR_x3_20240301T000000Z.json"), ("7", "FLR_x4_20240301T000000Z.json")], True)
    return shown(flatten.event_rows(documents.read_documents(spark, landed_events_folder(spark, sf, others))))


LANDED_EVENTS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE event_type WHEN 'view' THEN 'CME' WHEN 'click' THEN 'GST' ELSE 'FLR' END AS event_type,
       CASE WHEN event_type NOT IN ('view', 'click') AND user_id % 2 = 0 THEN '2024-02-01 00:00:30' ELSE strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') END AS event_time,
       CASE WHEN event_type <> 'click' THEN 'S' || user_id END AS source_location, CASE WHEN event_type = 'view' THEN floor(value) END AS speed_kms,
       CASE WHEN event_type = 'click' THEN user_id % 9 + 0.5e0 END AS kp_index,
       CASE WHEN event_type NOT IN ('view', 'click') THEN 'M' || (user_id % 10) || '.' || (user_id % 7) END AS flare_class,
       CASE WHEN event_type NOT IN ('view', 'click') THEN round(4 + ((user_id % 10) + (user_id % 7) / 10e0) / 10e0, 2) END AS flare_severity_score,
       CAST(NULL AS VARCHAR) AS linked_event_id, '2024-03-01 00:00:00' AS fetched_at
FROM events WHERE event_type IN ('view', 'click') OR event_id % 11 <> 0
"""

APPROACH_PULLED = "2002-01-01 00:00:00"


def approach_pulls(spark, sf) -> DataFrame:
    """A feed per range of 200 order numbers: an asteroid per customer under its order's date, every ninth under a foreign date too."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", day.alias("day"), F.floor(F.col("o_orderkey") / 200).alias("chunk"),
        F.explode(F.when(F.col("o_orderkey") % 9 == 0, F.array(day, F.lit("1900-01-01"))).otherwise(F.array(day))).alias("filed"), F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("km"),
    )
    k = F.col("o_orderkey")
    flyby = F.struct(
        F.col("day").alias("close_approach_date"), F.struct(F.col("km").alias("kilometers")).alias("miss_distance"),
        F.struct((k % 100000 + F.lit(0.5)).cast("string").alias("kilometers_per_hour")).alias("relative_velocity"),
    )
    meters = F.struct((F.lit(10) + k % 7).alias("estimated_diameter_max"))
    rock = F.struct(
        F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("("), k % 5, F.lit(")")).alias("name"), F.when(k % 3 != 0, k % 3 == 1).alias("is_potentially_hazardous_asteroid"),
        F.when(k % 4 != 0, F.struct(meters.alias("meters"))).alias("estimated_diameter"), F.array(flyby).alias("close_approach_data"),
    )
    dated = orders.groupBy("chunk", "filed").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", rock.alias("o")))).alias("found"))
    whole = dated.groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("filed", F.transform("found", lambda x: x["o"])))).alias("near_earth_objects"), F.sum(F.size("found")).alias("element_count"))
    fetched = instant(APPROACH_PULLED) + F.make_dt_interval(secs=F.col("chunk"))
    name = F.concat(F.format_string("part%d_", "chunk"), stamp(fetched), F.lit(".json"))
    return whole.select(F.to_json(F.struct("element_count", "near_earth_objects")).alias("value"), name.alias("file_name"), (F.col("chunk") % 2 == 0).alias("historical"))


APPROACH_CTE = f"""
o AS (
  SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS asteroid_id, strftime(o_orderdate, '%Y-%m-%d') AS d, CAST(floor(o_orderkey / 200) AS BIGINT) AS chunk,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS km, o_orderkey % 100000 + 0.5e0 AS kph, '(' || o_orderkey % 5 || ')' AS name, o_orderkey % 3 = 1 AS hazard,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(10 + o_orderkey % 7 AS DOUBLE) END AS diameter FROM orders)
"""


def landed_approaches_folder(spark, sf, *more: DataFrame) -> str:
    folder = fresh_folder(spark, "landing-approaches")
    docs = approach_pulls(spark, sf)
    for part in more:
        docs = docs.unionByName(part)
    placed(docs, folder)
    return folder


def landed_approaches(spark, sf):
    """Date-keyed feeds from files; documents that are no object, or lack the map, have no rows."""
    others = odd(spark, [("[]", "x1_20030101T000000Z.json"), ("3.5", "x2_20030101T000000Z.json"), ('{"element_count":0}', "x3_20030101T000000Z.json")])
    return shown(flatten.approach_rows(documents.read_documents(spark, landed_approaches_folder(spark, sf, others))))


LANDED_APPROACHES_SQL = f"""
WITH {APPROACH_CTE}
SELECT asteroid_id, d AS close_approach_date, name, km AS miss_distance_km, kph AS relative_velocity_kph, diameter AS estimated_diameter_m_max, hazard AS is_potentially_hazardous,
       strftime(TIMESTAMP '{APPROACH_PULLED}' + to_seconds(chunk), '%Y-%m-%d %H:%M:%S') AS fetched_at
FROM o QUALIFY row_number() OVER (PARTITION BY asteroid_id, d ORDER BY k DESC) = 1
"""

# --- several feeds in one scan ---------------------------------------------------------------------------


def landed_key_drift(spark, sf):
    """Two feeds, one scan, compared with known keys: as known, with a key too many, and never seen."""
    folders = {"weather": landed_weather_folder(spark, sf), "space_weather": landed_events_folder(spark, sf)}
    known = spark.sql(
        "SELECT * FROM VALUES ('weather', array('daily', 'hourly')), ('space_weather_CME', array('activityID', 'cmeAnalyses', 'sourceLocation', 'startTime')),"
        " ('space_weather_GST', array('gstID', 'startTime')) AS t(name, keys)"
    )
    drift = audit.key_drift(documents.named_documents(spark, folders), known)
    listed = [F.array_join(c, ",").alias(c) for c in ("keys", "missing", "added")]
    return drift.select("name", "documents", *listed, "severity")


LANDED_DRIFT_SQL = f"""
WITH {WEATHER_CTE},
w AS (SELECT count(DISTINCT (location_id, date_trunc('year', d), historical)) AS n FROM pulls),
e AS (SELECT CASE event_type WHEN 'view' THEN 'CME' WHEN 'click' THEN 'GST' ELSE 'FLR' END AS kind, event_id // 400 AS chunk, event_id % 7 = 0 AS twice FROM events),
n AS (SELECT kind, count(DISTINCT chunk) + count(DISTINCT chunk) FILTER (twice) AS n FROM e GROUP BY kind)
SELECT 'weather' AS name, n AS documents, 'daily' AS keys, 'hourly' AS missing, '' AS added, 'warning' AS severity FROM w
UNION ALL SELECT 'space_weather_CME', n, 'activityID,cmeAnalyses,sourceLocation,startTime', '', '', NULL FROM n WHERE kind = 'CME'
UNION ALL SELECT 'space_weather_GST', n, 'allKpIndex,gstID,startTime', '', 'allKpIndex', 'info' FROM n WHERE kind = 'GST'
UNION ALL SELECT 'space_weather_FLR', n, 'beginTime,classType,flrID,peakTime,sourceLocation', NULL, NULL, 'info' FROM n WHERE kind = 'FLR'
"""

# --- runs and streams ----------------------------------------------------------------------------------------

SEEDED = "1990-01-01 00:00:00"


def seeded(spark) -> feeds.Warehouse:
    """A warehouse that knows the forty locations."""
    wh = feeds.Warehouse(spark, fresh_folder(spark, "warehouse"))
    zero = F.lit(0).cast("decimal(8,5)")
    rows = spark.range(1, 41).select(F.col("id").cast("int").alias("location_id"), F.format_string("place %d", "id").alias("name"), zero.alias("lat"), zero.alias("lon"), F.lit("UTC").alias("timezone"))
    feeds.seed_locations(wh, instant(SEEDED), rows)
    return wh


def weather_versions(wh: feeds.Warehouse) -> DataFrame:
    facts = wh.weather_daily.read().join(wh.locations.current().select("location_key", "location_id"), "location_key")
    return shown(facts.select("location_id", "date", "temp_min", "temp_max", "temp_range", "precipitation_mm", "is_rain_day", "open_date", "close_date"))


def streamed_weather(spark, sf):
    """A file stream started twice from one checkpoint, with a landing before each start."""
    wh, folder, check = seeded(spark), fresh_folder(spark, "landing-stream"), fresh_folder(spark, "checkpoint")
    docs = weather_pulls(spark, sf)
    for historical in (True, False):
        placed(docs.where(F.col("historical") == historical), folder)
        ingest.ingest_weather(wh, folder, check).awaitTermination()
    return weather_versions(wh)


def replayed_batches(spark, sf):
    """Micro-batches as a stream delivers them after failures: each twice, and the first once more at the end."""
    wh, folder = seeded(spark), landed_weather_folder(spark, sf)
    apply = ingest.apply_weather(wh, folder)
    for number, historical in ((0, True), (0, True), (1, False), (1, False), (0, True)):
        apply(documents.read_documents(spark, folder, historical=historical), number)
    return weather_versions(wh)


#: The second batch happens at its newest pull.
VERSIONS_SQL = f"""
WITH {WEATHER_CTE},
t AS (SELECT strftime(max(fetched), '%Y-%m-%d %H:%M:%S') AS t2 FROM pulls WHERE NOT historical),
m AS (SELECT location_id, d, low, n, max(high) FILTER (historical) AS before, max(high) FILTER (NOT historical) AS after FROM pulls GROUP BY ALL),
v AS (
  SELECT *, before AS high, '{PULLED}' AS open_date, CASE WHEN after <> before THEN t2 END AS close_date FROM m, t WHERE before IS NOT NULL
  UNION ALL
  SELECT *, after, t2, NULL FROM m, t WHERE after IS NOT NULL AND before IS DISTINCT FROM after)
SELECT CAST(location_id AS INTEGER) AS location_id, strftime(d, '%Y-%m-%d') AS date, CAST(low AS DOUBLE) AS temp_min, CAST(high AS DOUBLE) AS temp_max, CAST(high - low AS DOUBLE) AS temp_range,
       n * 0.25e0 AS precipitation_mm, true AS is_rain_day, open_date, close_date
FROM v
"""


def stage_row_counts(spark, sf):
    """Rows in and out of each stage of two runs, counted by the runs themselves."""
    wh, folder = seeded(spark), landed_weather_folder(spark, sf)
    first = feeds.counted_weather_load(wh, folder, instant(PULLED), "run 1", historical=True).rows(spark)
    second = feeds.counted_weather_load(wh, folder, instant("2003-01-01 00:00:00"), "run 2", historical=False).rows(spark)
    return first.withColumn("run", F.lit("run 1")).unionByName(second.withColumn("run", F.lit("run 2")))


STAGE_COUNTS_SQL = f"""
WITH {WEATHER_CTE},
c AS (SELECT historical, count(DISTINCT (location_id, date_trunc('year', d))) AS docs, count(*) AS rows FROM pulls GROUP BY historical),
r AS (SELECT CASE WHEN historical THEN 'run 1' ELSE 'run 2' END AS run, historical, docs, rows,
             (SELECT count(*) FROM days WHERE NOT historical AND d BETWEEN DATE '{FIRST}' AND DATE '{LAST}' - 1 AND location_id % 5 = 0) AS same,
             (SELECT count(*) FROM days WHERE NOT historical AND d BETWEEN DATE '{FIRST}' AND DATE '{LAST}' - 1 AND location_id % 5 <> 0) AS closed FROM c)
SELECT run, CAST(step AS INTEGER) AS step, stage, CAST(CASE stage WHEN 'documents' THEN docs WHEN 'parsed' THEN rows WHEN 'staged' THEN rows WHEN 'kept' THEN same WHEN 'closed' THEN closed ELSE rows - same END AS BIGINT) AS rows
FROM r, (VALUES (1, 'documents'), (2, 'parsed'), (3, 'staged'), (4, 'kept'), (5, 'closed'), (6, 'opened')) AS s(step, stage)
"""

AUDITED = "2001-11-20 06:00:00"


def audit_after_failed_load(spark, sf):
    """A load breaks a rule half-way through; the audit after it reads tables only and finds what stood before.

    Findings go through the log.  Location keys are numbers of the run, so they are cut from the texts.
    """
    wh, folder = seeded(spark), landed_weather_folder(spark, sf)
    feeds.load_weather(wh, folder, instant(PULLED), "run 1", historical=True)
    wh.call_log.append(calls(spark, sf).withColumns({"called_at": F.expr("called_at - INTERVAL 806 DAYS").cast("timestamp"), "records_returned": F.lit(1), "http_status_code": F.lit(200), "pipeline_run_id": F.lit("run 0")}))
    hot = odd(spark, [('{"daily":{"time":["2001-11-20"],"temperature_2m_max":[1],"temperature_2m_min":[2]}}', "3_20011120T000000Z.json")])
    placed(hot, folder)
    try:
        feeds.load_weather(wh, folder, instant(AUDITED), "run 2", historical=False)
        raise AssertionError("a batch that breaks a rule was merged")
    except constraints.ConstraintError:
        failed = feeds.run_audit(wh, instant(AUDITED), "run 2")
    assert not failed, failed
    found = wh.findings.read().select("check_name", "severity", "related_table", F.regexp_replace("description", r" \(location_key \d+\)", "").alias("description"), "detected_at", "pipeline_run_id")
    return shown(found)


AUDIT_SQL = f"""
WITH {WEATHER_CTE}, {CALLS_CTE},
p AS (SELECT * FROM pulls WHERE historical),
w AS (SELECT *, count(high) OVER f AS m, CAST(sum(high) OVER f AS HUGEINT) AS s, CAST(sum(high * high) OVER f AS HUGEINT) AS q FROM p
      WINDOW f AS (PARTITION BY location_id ORDER BY d RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)),
rates AS (
  SELECT source_name, count(*) FILTER (success) / count(*) AS rate FROM calls WHERE called_at - INTERVAL 806 DAYS > TIMESTAMP '{AUDITED}' - INTERVAL 7 DAYS GROUP BY source_name),
found AS (
  SELECT 'absence_weather_daily' AS check_name, 'warning' AS severity, 'weather_daily' AS related_table,
         'No current weather row on 2001-11-20 for location ' || i || ' (place ' || i || ').' AS description FROM range(1, 41) AS r(i)
  UNION ALL
  SELECT 'anomaly_temp_max', 'warning', 'weather_daily', 'temp_max ' || high || '.00 on ' || strftime(d, '%Y-%m-%d') || ' is more than 3 deviations from the mean of the 7 days before.'
  FROM w WHERE m > 1 AND (m - 1) * (m * high - s) * (m * high - s) > 9 * m * (m * q - s * s)
  UNION ALL
  SELECT 'xtable_weather_run_id', 'warning', 'weather_daily', 'weather_daily run run 1 has no entry in the call log.'
  UNION ALL
  SELECT 'trend_api_success_rate', 'critical', 'call_log', 'Source ' || source_name || ' has a 7-day success rate of ' || CAST(round(rate, 3) AS VARCHAR) || ' (< 0.9).' FROM rates WHERE rate < 0.9)
SELECT *, '{AUDITED}' AS detected_at, 'run 2' AS pipeline_run_id FROM found
"""

T1, T2 = "2003-01-01 00:00:00", "2003-02-01 00:00:00"


def approaches_at_opening(spark, sf):
    """Two runs of the feed, facts and derived dimension at one instant each: every fact with the attributes in force when it was opened."""
    wh, folder = feeds.Warehouse(spark, fresh_folder(spark, "warehouse")), landed_approaches_folder(spark, sf)
    feeds.load_approaches(wh, folder, instant(T1), "run 1", historical=True)
    feeds.load_approaches(wh, folder, instant(T2), "run 2", historical=False)
    joined = joins.effective_join(wh.close_approaches.read(), wh.asteroids.read(), "asteroid_id", take=["name", "estimated_diameter_m_max", "is_potentially_hazardous"])
    return shown(joined.select("asteroid_id", "close_approach_date", "miss_distance_km", "relative_velocity_kph", "name", "estimated_diameter_m_max", "is_potentially_hazardous", "open_date", "close_date"))


OPENING_SQL = f"""
WITH {APPROACH_CTE},
s AS (SELECT *, chunk % 2 AS run FROM o QUALIFY row_number() OVER (PARTITION BY chunk % 2, asteroid_id, d ORDER BY k DESC) = 1),
a AS (SELECT * FROM s WHERE run = 0), b AS (SELECT * FROM s WHERE run = 1),
both_runs AS (SELECT * FROM b UNION ALL SELECT * FROM a ANTI JOIN b USING (asteroid_id, d)),
one AS (SELECT asteroid_id, name, diameter, hazard FROM a QUALIFY row_number() OVER (PARTITION BY asteroid_id ORDER BY d DESC) = 1),
two AS (SELECT asteroid_id, name, diameter, hazard FROM both_runs QUALIFY row_number() OVER (PARTITION BY asteroid_id ORDER BY d DESC) = 1),
f AS (
  SELECT a.asteroid_id, a.d, a.km, a.kph, '{T1}' AS open_date, CASE WHEN b.k IS NOT NULL AND (a.km <> b.km OR a.kph <> b.kph) THEN '{T2}' END AS close_date
  FROM a LEFT JOIN b ON a.asteroid_id = b.asteroid_id AND a.d = b.d
  UNION ALL
  SELECT b.asteroid_id, b.d, b.km, b.kph, '{T2}', NULL FROM b LEFT JOIN a ON a.asteroid_id = b.asteroid_id AND a.d = b.d WHERE a.k IS NULL OR a.km <> b.km OR a.kph <> b.kph)
SELECT f.asteroid_id, d AS close_approach_date, km AS miss_distance_km, kph AS relative_velocity_kph, coalesce(two.name, one.name) AS name,
       CASE WHEN two.asteroid_id IS NOT NULL THEN two.diameter ELSE one.diameter END AS estimated_diameter_m_max, coalesce(two.hazard, one.hazard) AS is_potentially_hazardous, open_date, close_date
FROM f LEFT JOIN one ON one.asteroid_id = f.asteroid_id AND open_date = '{T1}' LEFT JOIN two ON two.asteroid_id = f.asteroid_id AND open_date = '{T2}'
"""

#: Batches that cannot be typed: what is wrong, and the document.
BAD = [
    ("number out of range", '{"daily":{"time":["1995-06-01"],"temperature_2m_max":[12345.6]}}'),
    ("no date", '{"daily":{"time":["June"],"temperature_2m_max":[1]}}'),
    ("no whole number", '{"daily":{"time":["1995-06-01"],"weather_code":["fog"]}}'),
    ("no JSON", "<html>"),
    ("no object", '[{"daily":{}}]'),
]


def rejected_batches(spark, sf):
    """Batches of good documents with one that cannot be typed: each fails as a whole, and the staged rows stay as they were."""
    wh, good = seeded(spark), landed_weather_folder(spark, sf)
    feeds.stage_weather(wh, good, historical=True)
    rows = []
    for what, text in BAD:
        bad = fresh_folder(spark, "landing-bad")
        placed(odd(spark, [(text, "2_20020101T000000Z.json")]), bad)
        error = feeds.rejected(lambda: feeds.stage_weather(wh, [f"{good}/daily", bad]))
        rows.append((what, error, wh.staged_weather.version))
    tried = spark.createDataFrame(rows, "batch string, error_class string, version int")
    kept = wh.staged_weather.read()
    rows_kept, degrees_kept = kept.agg(F.count(F.lit(1))).scalar(), kept.agg(F.sum("temp_max").cast("double")).scalar()
    return tried.select("*", rows_kept.alias("rows_kept"), degrees_kept.alias("degrees_kept"))


REJECTED_SQL = f"""
WITH {WEATHER_CTE}
SELECT batch, error_class, CAST(1 AS INTEGER) AS version, (SELECT count(*) FROM pulls WHERE historical) AS rows_kept, (SELECT CAST(sum(high) AS DOUBLE) FROM pulls WHERE historical) AS degrees_kept
FROM (VALUES ('number out of range', 'NUMERIC_VALUE_OUT_OF_RANGE'), ('no date', 'CAST_INVALID_INPUT'), ('no whole number', 'CAST_INVALID_INPUT'),
             ('no JSON', 'USER_RAISED_EXCEPTION'), ('no object', 'USER_RAISED_EXCEPTION')) AS t(batch, error_class)
"""

#: Calls up to CUT land first, all but each tenth; the others follow.
CUT = "2024-01-20 00:00:00"


def late_calls(spark, sf):
    """Daily success rates as a stream in append mode: windows behind the watermark are written and their state goes, calls later than that are left out."""
    out, folder, check = (fresh_folder(spark, n) for n in ("rates", "landing-calls", "checkpoint"))
    rows = timed_calls(spark, sf)
    first = (F.col("called_at") < instant(CUT)) & (F.col("event_id") % 10 != 0)
    for part in (rows.where(first), rows.where(~first)):
        part.drop("event_id").write.mode("append").json(folder)
        stream = spark.readStream.schema(schemas.CALL_LOG.schema).json(folder)
        rates = ingest.running_success_rate(stream, late="1 day", span="1 day", slide="1 day")
        query = rates.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
        query.awaitTermination()
    return shown(spark.read.schema(rates.schema).parquet(out))


def timed_calls(spark, sf) -> DataFrame:
    """Events read as calls, with their ids; times in whole milliseconds, as a watermark counts."""
    return table(spark, sf, "events").select(
        "event_id", F.expr("concat('source_', user_id % 7)").alias("source_name"), F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("called_at"),
        (F.col("event_type") != "error").alias("success"), F.lit(0).alias("retry_count"),
    )


LATE_SQL = f"""
WITH c AS (SELECT 'source_' || (user_id % 7) AS source_name, date_trunc('milliseconds', ts) AS t, event_type <> 'error' AS success, ts < TIMESTAMP '{CUT}' AND event_id % 10 <> 0 AS first FROM events),
m AS (SELECT max(t) FILTER (first) - INTERVAL 1 DAY AS mark, max(t) - INTERVAL 1 DAY AS last_mark FROM c),
w AS (SELECT *, date_trunc('day', t) AS s, date_trunc('day', t) + INTERVAL 1 DAY AS e FROM c, m)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(e, '%Y-%m-%d %H:%M:%S') AS window_end, source_name, count(*) AS calls, count(*) FILTER (success) AS successes,
       count(*) FILTER (success) / count(*) AS rate
FROM w WHERE (first OR e > mark) AND e <= last_mark GROUP BY s, e, source_name
"""

QUERIES = {
    "landed_weather": Query(landed_weather, LANDED_WEATHER_SQL),
    "landed_events": Query(landed_events, LANDED_EVENTS_SQL),
    "landed_approaches": Query(landed_approaches, LANDED_APPROACHES_SQL),
    "replayed_weather": Query(replayed_weather, REPLAY_SQL),
    "streamed_weather": Query(streamed_weather, VERSIONS_SQL),
    "replayed_batches": Query(replayed_batches, VERSIONS_SQL),
    "late_calls": Query(late_calls, LATE_SQL),
    "stage_row_counts": Query(stage_row_counts, STAGE_COUNTS_SQL),
    "audit_after_failed_load": Query(audit_after_failed_load, AUDIT_SQL),
    "landed_key_drift": Query(landed_key_drift, LANDED_DRIFT_SQL),
    "approaches_at_opening": Query(approaches_at_opening, OPENING_SQL),
    "rejected_batches": Query(rejected_batches, REJECTED_SQL),
}
