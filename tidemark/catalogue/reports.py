"""Report views, fed with orders, lines and events in place of the feeds' facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalogue.base import Query, double, moment, shown, table
from tidemark.operators import joins
from tidemark.plans import dashboards

AS_OF = "2024-01-31 00:00:00"

# --- call log -----------------------------------------------------------------------------


def calls(spark, sf) -> DataFrame:
    """Events read as a log of calls."""
    return table(spark, sf, "events").select(
        F.expr("concat('source_', user_id % 7)").alias("source_name"),
        F.col("ts").alias("called_at"),
        F.expr("cast(round(value * 100) AS INT)").alias("response_time_ms"),
        (F.col("event_type") != "error").alias("success"),
        F.expr("cast(user_id % 4 AS INT)").alias("retry_count"),
        F.expr("cast(nullif(event_id % 10, 3) AS INT)").alias("rate_limit_remaining"),
    )


CALLS_CTE = """
calls AS (SELECT 'source_' || (user_id % 7) AS source_name, ts AS called_at, CAST(round(value * 100) AS INTEGER) AS response_time_ms,
                 event_type <> 'error' AS success, CAST(user_id % 4 AS INTEGER) AS retry_count, CAST(nullif(event_id % 10, 3) AS INTEGER) AS rate_limit_remaining FROM events)
"""


def hourly_latency(spark, sf):
    return shown(dashboards.hourly_latency(calls(spark, sf)))


LATENCY_SQL = f"""
WITH {CALLS_CTE}
SELECT strftime(date_trunc('hour', called_at), '%Y-%m-%d %H:%M:%S') AS ts, source_name, avg(response_time_ms) AS avg_ms FROM calls GROUP BY ALL
"""


def success_rate(spark, sf):
    return dashboards.success_rate_pct(calls(spark, sf), AS_OF)


def success_rate_30d(spark, sf):
    return dashboards.success_rate_pct(calls(spark, sf), AS_OF, 30)


def rate_sql(days: int) -> str:
    return f"""
WITH {CALLS_CTE}
SELECT source_name, 100e0 * count(*) FILTER (WHERE success) / count(*) AS success_rate_pct FROM calls
WHERE called_at > TIMESTAMP '2024-01-31' - INTERVAL {days} DAYS GROUP BY 1
"""


def rate_headroom(spark, sf):
    return shown(dashboards.headroom(calls(spark, sf)))


HEADROOM_SQL = f"""
WITH {CALLS_CTE}
SELECT source_name, rate_limit_remaining, strftime(called_at, '%Y-%m-%d %H:%M:%S') AS called_at FROM (
  SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY called_at DESC, rate_limit_remaining DESC) AS r FROM calls WHERE rate_limit_remaining IS NOT NULL)
WHERE r = 1
"""


def retry_trend(spark, sf):
    return shown(dashboards.retry_trend(calls(spark, sf)))


RETRY_SQL = f"""
WITH {CALLS_CTE}
SELECT strftime(called_at, '%Y-%m-%d') AS day, source_name, CAST(sum(retry_count) AS BIGINT) AS retries FROM calls GROUP BY ALL
"""

# --- roll-ups -----------------------------------------------------------------------------------


def monthly_total(spark, sf):
    """Revenue per month and nation: summed per supplier before the suppliers are joined."""
    names = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", F.col("l_extendedprice").cast("decimal(15,2)").alias("price"))
    dim = names.select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("nation"))
    return shown(dashboards.monthly_total(lines, dim, "l_suppkey", "l_shipdate", "price", "nation", "revenue"))


MONTHLY_SQL = """
SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month, n_name AS nation, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL
"""


def weekly_count(spark, sf):
    return shown(dashboards.weekly_count(table(spark, sf, "orders"), "o_orderdate", "orders"))


WEEKLY_SQL = "SELECT strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week, count(*) AS orders FROM orders GROUP BY ALL"


def weekly_by_class(spark, sf):
    return shown(dashboards.weekly_by_class(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority", "orders"))


BY_CLASS_SQL = """
SELECT strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week, left(o_orderpriority, 1) AS class, count(*) AS orders FROM orders GROUP BY ALL
"""


def bucket_histogram(spark, sf):
    """Ten bands; the upper edge falls in the band above the last."""
    return dashboards.bucket_counts(table(spark, sf, "lineitem"), "l_quantity", 0, 50, 10, "band", "lines")


HISTOGRAM_SQL = """
SELECT CAST(CASE WHEN l_quantity < 0 THEN 0 WHEN l_quantity >= 50 THEN 11 ELSE floor(l_quantity / 5) + 1 END AS INTEGER) AS band, count(*) AS lines FROM lineitem GROUP BY 1
"""


def filtered_total(spark, sf):
    """The shared date and key filter before a roll-up."""
    lines = joins.date_and_key_filter(table(spark, sf, "lineitem"), "l_shipdate", "1997-01-01", "1998-12-31", "l_returnflag", ["A", "N"])
    return lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), double(F.sum(F.col("l_extendedprice").cast("decimal(15,2)"))).alias("revenue"))


FILTERED_SQL = """
SELECT l_returnflag, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS revenue FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31' AND l_returnflag IN ('A', 'N') GROUP BY 1
"""



def filtered_series(spark, sf):
    """A view with the shared panel filter: days and places."""
    panel = dashboards.Panel("1997-01-01", "1997-12-31", [f"Supplier#{n:09d}" for n in range(1, 8)])
    return shown(dashboards.temperature_series(weather_like(spark, sf), places(spark, sf), panel))


FILTERED_SERIES_SQL = """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, s_name AS location, l_quantity AS temp_min, l_extendedprice AS temp_max
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linestatus <> 'F' AND s_suppkey % 10 <> 0
AND CAST(l_shipdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND s_name IN ('Supplier#000000001', 'Supplier#000000002',
  'Supplier#000000003', 'Supplier#000000004', 'Supplier#000000005', 'Supplier#000000006', 'Supplier#000000007')
"""

# --- series, latest, top-k ---------------------------------------------------------------------


def weather_like(spark, sf) -> DataFrame:
    """Per supplier line: a daily reading, current unless its line is finished."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("location_key"), F.col("l_shipdate").cast("date").alias("date"), F.col("l_quantity").alias("temp_min"),
        F.col("l_extendedprice").alias("temp_max"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_fetched_at"),
        F.expr("if(l_linestatus = 'F', l_shipdate, NULL)").alias("close_date"),
    )


def places(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("location_key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("lat"), F.col("s_acctbal").alias("lon"),
        F.expr("if(s_suppkey % 10 = 0, TIMESTAMP_NTZ'2020-01-01 00:00:00', NULL)").alias("close_date"),
    )


def temperature_series(spark, sf):
    return shown(dashboards.temperature_series(weather_like(spark, sf), places(spark, sf)))


SERIES_SQL = """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, s_name AS location, l_quantity AS temp_min, l_extendedprice AS temp_max
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linestatus <> 'F' AND s_suppkey % 10 <> 0
"""


def current_temperature(spark, sf):
    return dashboards.current_temperature(weather_like(spark, sf))


CURRENT_TEMP_SQL = """
SELECT arg_max(l_extendedprice, (CAST(l_shipdate AS DATE), l_orderkey * 10 + l_linenumber, l_suppkey)) AS temp_max, max(l_orderkey * 10 + l_linenumber) AS last_updated
FROM lineitem WHERE l_linestatus <> 'F'
"""


def latest_by_location(spark, sf):
    return dashboards.latest_temperature_by_location(weather_like(spark, sf), places(spark, sf))


LATEST_BY_SQL = """
SELECT s_name AS location, s_nationkey AS lat, s_acctbal AS lon, l_extendedprice AS temp_max FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey * 10 + l_linenumber DESC) AS r FROM lineitem WHERE l_linestatus <> 'F')
JOIN supplier ON s_suppkey = l_suppkey WHERE r = 1 AND s_suppkey % 10 <> 0
"""


def space_like(spark, sf) -> DataFrame:
    """Events read as flares, storms and ejections."""
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.expr("CASE event_type WHEN 'purchase' THEN 'CME' WHEN 'view' THEN 'GST' ELSE 'FLR' END").alias("event_type"),
        F.col("ts").alias("event_time"), F.expr("concat('S', user_id)").alias("source_location"),
        F.expr("if(event_type = 'purchase', value, NULL)").alias("speed_kms"),
        F.expr("if(event_type = 'view', nullif(cast(user_id % 19 AS DOUBLE) / 2, 4), NULL)").alias("kp_index"),
        F.expr("if(event_type IN ('click', 'signup'), concat(substr('ABCMX', cast(user_id % 5 AS INT) + 1, 1), '1.0'), NULL)").alias("flare_class"),
        F.expr("if(event_type IN ('click', 'signup'), user_id % 5 + 1.1D, NULL)").alias("flare_severity_score"),
        F.expr("if(event_id % 2 = 0, cast(event_id - 1 AS STRING), NULL)").alias("linked_event_id"),
        F.expr("if(event_type = 'error', ts, NULL)").alias("close_date"),
    )


SPACE_CTE = """
space AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CASE event_type WHEN 'purchase' THEN 'CME' WHEN 'view' THEN 'GST' ELSE 'FLR' END AS event_type, ts AS event_time,
         'S' || user_id AS source_location, CASE WHEN event_type = 'purchase' THEN value END AS speed_kms,
         CASE WHEN event_type = 'view' THEN nullif((user_id % 19) / 2e0, 4) END AS kp_index,
         CASE WHEN event_type IN ('click', 'signup') THEN substr('ABCMX', CAST(user_id % 5 AS INTEGER) + 1, 1) || '1.0' END AS flare_class,
         CASE WHEN event_type IN ('click', 'signup') THEN user_id % 5 + 1.1e0 END AS flare_severity_score,
         CASE WHEN event_id % 2 = 0 THEN CAST(event_id - 1 AS VARCHAR) END AS linked_event_id
  FROM events WHERE event_type <> 'error')
"""


def weekly_flares(spark, sf):
    return shown(dashboards.weekly_flares(space_like(spark, sf)))


FLARES_SQL = f"""
WITH {SPACE_CTE}
SELECT strftime(date_trunc('week', event_time), '%Y-%m-%d') AS week, left(flare_class, 1) AS class, count(*) AS flares FROM space WHERE event_type = 'FLR' GROUP BY ALL
"""


def storms_by_band(spark, sf):
    return dashboards.storms_by_band(space_like(spark, sf))


STORMS_SQL = f"""
WITH {SPACE_CTE}
SELECT CAST(least(floor(kp_index) + 1, 10) AS INTEGER) AS kp_band, count(*) AS storms FROM space WHERE event_type = 'GST' AND kp_index IS NOT NULL GROUP BY 1
"""


def recent_ejections(spark, sf):
    return shown(dashboards.recent_ejections(space_like(spark, sf)))


EJECTIONS_SQL = f"""
WITH {SPACE_CTE}
SELECT strftime(a.event_time, '%Y-%m-%d %H:%M:%S') AS event_time, a.source_location, a.speed_kms, a.linked_event_id,
       strftime(b.event_time, '%Y-%m-%d %H:%M:%S') AS storm_time, b.kp_index AS storm_kp_index
FROM (SELECT * FROM space WHERE event_type = 'CME' ORDER BY event_time DESC, event_id LIMIT 50) a
LEFT JOIN space b ON b.event_id = a.linked_event_id AND b.event_type = 'GST'
"""


def top_recent(spark, sf):
    events = table(spark, sf, "events").where("event_type = 'purchase'")
    return shown(dashboards.recent(events, "ts", "event_id", 50).select("ts", "event_id", "user_id", "value"))


TOP_SQL = """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_id, user_id, value FROM events WHERE event_type = 'purchase' ORDER BY events.ts DESC, event_id LIMIT 50
"""


def most_severe_7d(spark, sf):
    return shown(dashboards.most_severe_in_last_days(space_like(spark, sf), AS_OF).drop("close_date"))


SEVERE_SQL = f"""
WITH {SPACE_CTE}
SELECT * REPLACE (strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time), coalesce(flare_severity_score, kp_index) AS severity_value FROM space
WHERE space.event_time > TIMESTAMP '2024-01-24' AND space.event_time <= TIMESTAMP '2024-01-31' AND coalesce(flare_severity_score, kp_index) IS NOT NULL
ORDER BY coalesce(flare_severity_score, kp_index) DESC, space.event_time DESC, event_id LIMIT 1
"""


def closest_next_7d(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("asteroid_id"), F.col("o_orderdate").cast("date").alias("close_approach_date"),
        F.col("o_totalprice").alias("miss_distance_km"), F.expr("if(o_orderstatus = 'F', o_orderdate, NULL)").alias("close_date"),
    )
    return shown(dashboards.closest_in_next_days(orders, moment("1998-06-15 09:00:00")).drop("close_date"))


CLOSEST_SQL = """
SELECT o_orderkey AS asteroid_id, strftime(o_orderdate, '%Y-%m-%d') AS close_approach_date, o_totalprice AS miss_distance_km FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-15' AND DATE '1998-06-22' AND o_orderstatus <> 'F' ORDER BY o_totalprice, o_orderdate, o_orderkey LIMIT 1
"""

QUERIES = {
    "monthly_total": Query(monthly_total, MONTHLY_SQL),
    "weekly_count": Query(weekly_count, WEEKLY_SQL),
    "weekly_by_class": Query(weekly_by_class, BY_CLASS_SQL),
    "weekly_flares": Query(weekly_flares, FLARES_SQL),
    "bucket_histogram": Query(bucket_histogram, HISTOGRAM_SQL),
    "storms_by_band": Query(storms_by_band, STORMS_SQL),
    "filtered_total": Query(filtered_total, FILTERED_SQL),
    "filtered_series": Query(filtered_series, FILTERED_SERIES_SQL),
    "hourly_latency": Query(hourly_latency, LATENCY_SQL),
    "success_rate": Query(success_rate, rate_sql(7)),
    "success_rate_30d": Query(success_rate_30d, rate_sql(30)),
    "rate_headroom": Query(rate_headroom, HEADROOM_SQL),
    "retry_trend": Query(retry_trend, RETRY_SQL),
    "temperature_series": Query(temperature_series, SERIES_SQL),
    "current_temperature": Query(current_temperature, CURRENT_TEMP_SQL),
    "latest_by_location": Query(latest_by_location, LATEST_BY_SQL),
    "recent_ejections": Query(recent_ejections, EJECTIONS_SQL),
    "top_recent": Query(top_recent, TOP_SQL),
    "most_severe_7d": Query(most_severe_7d, SEVERE_SQL),
    "closest_next_7d": Query(closest_next_7d, CLOSEST_SQL),
}
