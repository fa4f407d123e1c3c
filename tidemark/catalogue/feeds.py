"""Documents, flat files and scalars.

Documents are written from single rows, so none grows with a key; the parsers are
those of the feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalogue.base import Query, moment, shown, table
from tidemark.functions import scalars
from tidemark.functions.fixed_values import UNKNOWN_LABEL, WEATHER_LABELS
from tidemark.operators import flatten, merge
from tidemark.operators.dedupe import keep_last
from tidemark.plans import dashboards
from tidemark.plans.feeds import weather_facts
from tidemark.session import fresh_folder, written, written_in_turn
from tidemark.sources import documents, flatfile

STAMP = "date_format({0}, \"yyyyMMdd'T'HHmmss'Z'\")"


#: Documents of one task.  What a task sorts grows with its documents, so there are more tasks, not larger ones.
DOCUMENTS_PER_TASK = 100_000


def named(df: DataFrame, file_name: str, value: str, *keys: str) -> DataFrame:
    """(value, file_name) plus the context of the name, from SQL expressions.

    Dealt out by the keys that make up the name, as the files of a landing folder are by theirs, however
    few row groups the table has.  The rows move, and the documents are written where they are parsed.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // DOCUMENTS_PER_TASK))
    return documents.name_context(df.repartition(tasks, *keys).selectExpr(f"{value} AS value", f"{file_name} AS file_name"))


# --- parallel arrays --------------------------------------------------------------


#: Documents that are staged and merged at once; about 200 bytes each are on disk while their rows move.
DOCUMENTS_PER_SHARE = 30_000_000


def shares(spark, sf) -> list[Column]:
    """Conditions on lineitem that share out the documents by their location, whole locations each.

    A document's location is the supplier in its name; those without a name have none.  The names are not
    written for it, as each share looks at all rows of the table.
    """
    number = max(1, -(-table(spark, sf, "lineitem").count() // DOCUMENTS_PER_SHARE))
    has_name = " AND ".join(f"{c} IS NOT NULL" for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"))
    share = F.pmod(F.xxhash64(F.expr(f"if({has_name}, l_suppkey, NULL)")), F.lit(number))
    return [share == i for i in range(number)]


def weather_documents(spark, sf, share: Column | None = None):
    """One document per lineitem (of a share): four days from the ship date on, the third given twice."""
    day = "cast(date_add(cast(l_shipdate AS DATE), {0}) AS STRING)"
    q, n = "cast(l_quantity AS INT)", "l_linenumber"
    value = (
        "concat('{\"daily\":{\"time\":[\"', " + day.format(0) + ", '\",\"', " + day.format(1) + ", '\",\"', "
        + day.format(2) + ", '\",\"', " + day.format(2) + ", '\"],\"temperature_2m_max\":[', "
        f"{q}, ',\"', {q} + 1, '.25\",\"n/a\",', {q} + 3, '],\"temperature_2m_min\":[', {q} - 5, ',null,', {q} - 7, "
        f"'],\"precipitation_sum\":[', {q}, '.5]', if({n} = 7, '', concat(',\"wind_speed_10m_max\":[0,', {n}, ',2,3]')), "
        f"',\"weather_code\":[', {n}, ',\"', {n} + 50, '\",null]}}}}')"
    )
    name = "concat(l_suppkey, '_', l_orderkey, '-', l_linenumber, '-', l_partkey, '_', " + STAMP.format("l_shipdate") + ", '.json')"
    lines = table(spark, sf, "lineitem")
    return named(lines if share is None else lines.where(share), name, value, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def flatten_parallel_arrays(spark, sf):
    return shown(flatten.weather_rows(weather_documents(spark, sf)))


PARALLEL_SQL = """
WITH docs AS (
  SELECT l_suppkey, l_shipdate, l_linenumber AS n, CAST(l_quantity AS INTEGER) AS q,
         l_suppkey || '_' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '_'
           || strftime(l_shipdate, '%Y%m%dT%H%M%SZ') || '.json' AS file_name
  FROM lineitem),
item AS (
  SELECT l_suppkey AS location_id, strftime(l_shipdate + least(p, 2) * INTERVAL 1 DAY, '%Y-%m-%d') AS date,
         CASE p WHEN 0 THEN q - 5 WHEN 2 THEN q - 7 END AS temp_min,
         CASE p WHEN 0 THEN q WHEN 1 THEN q + 1.25 WHEN 3 THEN q + 3 END AS temp_max,
         CASE p WHEN 0 THEN q + 0.5 END AS precipitation_mm,
         CASE WHEN n <> 7 THEN CASE p WHEN 0 THEN 0 WHEN 1 THEN n WHEN 2 THEN 2 ELSE 3 END END AS wind_speed_max,
         CASE p WHEN 0 THEN n WHEN 1 THEN n + 50 END AS weather_code,
         l_shipdate AS fetched, file_name, p
  FROM docs, (VALUES (0), (1), (2), (3)) AS pos(p)),
last AS (
  SELECT *, row_number() OVER (PARTITION BY location_id, date ORDER BY fetched DESC, file_name DESC, p DESC) AS r FROM item)
SELECT location_id, date, CAST(temp_min AS DOUBLE) AS temp_min, CAST(temp_max AS DOUBLE) AS temp_max,
       CAST(precipitation_mm AS DOUBLE) AS precipitation_mm, CAST(wind_speed_max AS DOUBLE) AS wind_speed_max,
       weather_code, strftime(fetched, '%Y-%m-%d %H:%M:%S') AS fetched_at
FROM last WHERE r = 1
"""


def zip_arrays(spark, sf):
    """The array zip alone: index drives the length, a short arm gives NULL."""
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.sequence(F.lit(1), F.col("l_linenumber")).alias("_index"),
        F.array("l_quantity", "l_extendedprice", "l_tax").alias("_arm"),
    )
    rows = flatten.zip_arrays(df, F.col("_index"), {"arm": F.col("_arm")}, "item_no")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "item_no", "arm")


ZIP_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(i AS INTEGER) AS item_no,
       CASE i WHEN 1 THEN l_quantity WHEN 2 THEN l_extendedprice WHEN 3 THEN l_tax END AS arm
FROM lineitem, (VALUES (1), (2), (3), (4), (5), (6), (7)) AS t(i) WHERE i <= l_linenumber
"""

# --- event lists --------------------------------------------------------------------


def ejection_documents(spark, sf):
    """Per order: three ejections, the first id delivered twice, the second without id on some."""
    start = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm'Z'\")"
    p, k = "cast(o_totalprice AS INT) % 3000", "o_orderkey"

    def event(event_id, analyses, tail):
        return f"'{{\"activityID\":', {event_id}, ',\"startTime\":\"', {start}, '\",\"cmeAnalyses\":', {analyses}, {tail}, '}}'"

    first = event(f"'\"', {k}, '-A\"'", "'[{\"isMostAccurate\":false,\"speed\":1}]'", "''")
    flagged = f"concat('[{{\"isMostAccurate\":false,\"speed\":', {p}, '}},{{\"isMostAccurate\":true,\"speed\":', if({k} % 4 = 0, 'null', concat('\"', {p} + 7, '.5\"')), '}}]')"
    second = event(f"if({k} % 5 = 0, '\"\"', concat('\"', {k}, '-B\"'))", flagged, "',\"sourceLocation\":\"\"'")
    third = event(f"'\"', {k}, '-A\"'", f"if({k} % 3 = 0, '[]', concat('[{{\"speed\":', {p}, '}},{{\"speed\":0}}]'))",
                  f"concat(',\"sourceLocation\":\"N', {k} % 90, '\",\"linkedEvents\":[{{\"activityID\":\"', {k}, '-B\"}}]')")
    value = f"concat('[', {first}, ',', {second}, ',', {third}, ']')"
    return named(table(spark, sf, "orders"), f"concat('CME_', {k}, '_', {STAMP.format('o_orderdate')}, '.json')", value, "o_orderkey")


def flatten_event_list(spark, sf):
    rows = flatten.event_rows(ejection_documents(spark, sf))
    return shown(rows.select("event_id", "event_type", "event_time", "source_location", "speed_kms", "linked_event_id"))


EVENT_LIST_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_orderdate AS d, CAST(floor(o_totalprice) AS BIGINT) % 3000 AS p FROM orders)
SELECT k || '-A' AS event_id, 'CME' AS event_type, strftime(d, '%Y-%m-%d %H:%M:%S') AS event_time, 'N' || (k % 90) AS source_location,
       CASE WHEN k % 3 <> 0 THEN CAST(p AS DOUBLE) END AS speed_kms, k || '-B' AS linked_event_id FROM o
UNION ALL
SELECT k || '-B', 'CME', strftime(d, '%Y-%m-%d %H:%M:%S'), NULL, CASE WHEN k % 4 <> 0 THEN p + 7.5e0 END, NULL FROM o WHERE k % 5 <> 0
"""


def storm_documents(spark, sf):
    value = (
        "concat('[{\"gstID\":\"', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '\",\"startTime\":\"2024-01-01T00:00Z\",\"allKpIndex\":', "
        "if(l_linenumber = 7, 'null', concat('[{\"kpIndex\":', l_linenumber, '.33},{\"kpIndex\":null},{\"kpIndex\":\"', cast(l_quantity AS INT) % 10, '\"},{\"kpIndex\":\"high\"},{}]')), '}]')"
    )
    name = "concat('gst_', l_orderkey, '-', l_linenumber, '-', l_partkey, '_', " + STAMP.format("l_shipdate") + ", '.json')"
    return named(table(spark, sf, "lineitem"), name, value, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def array_peak(spark, sf):
    schema = "ARRAY<STRUCT<gstID: STRING, allKpIndex: ARRAY<STRUCT<kpIndex: STRING>>>>"
    events = flatten.parse_list(storm_documents(spark, sf), schema).select(F.explode_outer("_payload").alias("e"))
    return events.select(F.col("e.gstID").alias("event_id"), flatten.peak(F.col("e.allKpIndex"), "kpIndex").alias("kp_index"))


PEAK_SQL = """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS event_id,
       CASE WHEN l_linenumber <> 7 THEN greatest(l_linenumber + 0.33e0, CAST(l_quantity AS INTEGER) % 10) END AS kp_index
FROM lineitem
"""


def mixed_documents(spark, sf):
    """Per event row: a document of one of the three types, by event kind."""
    kind = "CASE event_type WHEN 'view' THEN 'CME' WHEN 'click' THEN 'gst' ELSE 'FLR' END"
    time = "date_format(ts, \"yyyy-MM-dd'T'HH:mm'Z'\")"
    letter = "substr('ABCMXZ', cast(user_id % 6 AS INT) + 1, 1)"
    value = f"""CASE {kind}
      WHEN 'CME' THEN concat('[{{"activityID":"', event_id, '","startTime":"', {time}, '","sourceLocation":"S', user_id, '","cmeAnalyses":[{{"isMostAccurate":true,"speed":', cast(value AS INT), '}}]}}]')
      WHEN 'gst' THEN concat('[{{"gstID":"', event_id, '","startTime":"', {time}, '","sourceLocation":"x","allKpIndex":[{{"kpIndex":', user_id % 9, '.5}}]}}]')
      WHEN 'FLR' THEN concat('[{{"flrID":', if(event_type = 'error', 'null', concat('"', event_id, '"')), ',"beginTime":"', if(user_id % 2 = 0, '', {time}), '","peakTime":"2024-02-01T00:00:30Z","classType":"', {letter}, user_id % 10, '.', user_id % 7, '","linkedEvents":[{{"activityID":"', event_id - 1, '"}}]}}]')
    END"""
    name = f"concat({kind}, '_', event_id, '_', {STAMP.format('ts')}, '.json')"
    return named(table(spark, sf, "events"), name, value, "event_id")


def event_union(spark, sf):
    return shown(flatten.event_rows(mixed_documents(spark, sf)))


EVENT_UNION_SQL = """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'CME' AS event_type, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS event_time,
       'S' || user_id AS source_location, floor(value) AS speed_kms, CAST(NULL AS DOUBLE) AS kp_index, CAST(NULL AS VARCHAR) AS flare_class,
       CAST(NULL AS DOUBLE) AS flare_severity_score, CAST(NULL AS VARCHAR) AS linked_event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS fetched_at
FROM events WHERE event_type = 'view'
UNION ALL
SELECT CAST(event_id AS VARCHAR), 'GST', strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S'), NULL, NULL, user_id % 9 + 0.5e0, NULL, NULL, NULL,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')
FROM events WHERE event_type = 'click'
UNION ALL
SELECT CAST(event_id AS VARCHAR), 'FLR',
       CASE WHEN user_id % 2 = 0 THEN '2024-02-01 00:00:30' ELSE strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') END,
       NULL, NULL, NULL, substr('ABCMXZ', CAST(user_id % 6 AS INTEGER) + 1, 1) || (user_id % 10) || '.' || (user_id % 7),
       CASE WHEN user_id % 6 < 5 THEN round(user_id % 6 + 1 + ((user_id % 10) + (user_id % 7) / 10e0) / 10e0, 2) END,
       CAST(event_id - 1 AS VARCHAR), strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')
FROM events WHERE event_type IN ('signup', 'purchase')
"""

# --- date-keyed maps ------------------------------------------------------------------


def approach_documents(spark, sf):
    """Per order: two dates, an asteroid per customer under each, one approach filed under a foreign date."""
    day = "date_format(o_orderdate + INTERVAL {0} DAY, 'yyyy-MM-dd')"
    price = "cast(cast(o_totalprice AS DECIMAL(12,2)) AS STRING)"

    def item(day_no, km, hazard, diameter):
        d = day.format(day_no)
        return (
            f"concat('\"', {d}, '\":[{{\"id\":\"', o_custkey, '\",\"name\":\"(', o_orderpriority, ')\"', {hazard}, {diameter}, ',\"close_approach_data\":["
            f"{{\"close_approach_date\":\"', {d}, '\",\"miss_distance\":{{\"kilometers\":\"', {km}, '\"}},\"relative_velocity\":{{\"kilometers_per_hour\":\"', o_orderkey % 100000, '.5\"}}}},"
            f"{{\"close_approach_date\":\"1900-01-01\",\"miss_distance\":{{\"kilometers\":\"1\"}}}}]}}]')"
        )

    hazard = "if(o_orderkey % 3 = 0, '', concat(',\"is_potentially_hazardous_asteroid\":', o_orderkey % 3 = 1))"
    diameter = "if(o_orderkey % 4 = 0, '', ',\"estimated_diameter\":{\"meters\":{\"estimated_diameter_max\":12.345}}')"
    first = item(0, price, hazard, diameter)
    second = item(1, "if(o_orderkey % 2 = 0, 'far', '10')", hazard, diameter)
    value = f"concat('{{\"element_count\":2,\"near_earth_objects\":{{', {first}, ',', {second}, '}}}}')"
    name = f"concat({day.format(0)}, '_', lpad(o_orderkey, 15, '0'), '_', {STAMP.format('o_orderdate')}, '.json')"
    return named(table(spark, sf, "orders"), name, value, "o_orderkey")


def flatten_keyed_map(spark, sf):
    return shown(flatten.approach_rows(approach_documents(spark, sf)))


KEYED_MAP_SQL = """
WITH item AS (
  SELECT o_custkey, o_orderkey AS k, o_orderpriority, o_orderdate, i,
         strftime(o_orderdate + i * INTERVAL 1 DAY, '%Y-%m-%d') AS d,
         CASE WHEN i = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) WHEN o_orderkey % 2 = 1 THEN 10e0 END AS km
  FROM orders, (VALUES (0), (1)) AS t(i)),
last AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, d ORDER BY o_orderdate DESC, k DESC) AS r FROM item)
SELECT CAST(o_custkey AS VARCHAR) AS asteroid_id, d AS close_approach_date, '(' || o_orderpriority || ')' AS name,
       km AS miss_distance_km, k % 100000 + 0.5e0 AS relative_velocity_kph,
       CASE WHEN k % 4 <> 0 THEN 12.35e0 END AS estimated_diameter_m_max, k % 3 = 1 AS is_potentially_hazardous,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS fetched_at
FROM last WHERE r = 1
"""


def records_per_document(spark, sf):
    docs = flatten.records_returned(ejection_documents(spark, sf), "events")
    feeds = flatten.records_returned(approach_documents(spark, sf), "approaches")
    daily = flatten.records_returned(weather_documents(spark, sf), "weather")
    parts = [d.select(F.lit(s).alias("source"), "records_returned") for s, d in (("events", docs), ("approaches", feeds), ("weather", daily))]
    counted = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return counted.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("records_returned").alias("records"))


RECORDS_SQL = """
SELECT 'events' AS source, count(*) AS documents, CAST(3 * count(*) AS BIGINT) AS records FROM orders
UNION ALL SELECT 'approaches', count(*), CAST(2 * count(*) AS BIGINT) FROM orders
UNION ALL SELECT 'weather', count(*), CAST(4 * count(*) AS BIGINT) FROM lineitem
"""

# --- names, flat files ------------------------------------------------------------------


def filename_context(spark, sf):
    name = f"concat(o_custkey, if(o_orderkey % 2 = 0, '', '_2024-01-31'), '_', {STAMP.format('o_orderdate')}, '.json')"
    df = table(spark, sf, "orders").selectExpr("o_orderkey", f"{name} AS file_name")
    return shown(documents.name_context(df)).drop("file_name")


FILENAME_SQL = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS first_token, CASE WHEN o_orderkey % 2 = 1 THEN '2024-01-31' END AS window_start,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS fetched_at
FROM orders
"""


def flatfile_roundtrip(spark, sf):
    """Text with delimiter, quote, newline, backslash and outer blanks, out and back."""
    df = table(spark, sf, "part").select(
        "p_partkey",
        F.expr("concat(' ', p_name, '|\"', p_brand, '\"', if(p_partkey % 3 = 0, chr(10), chr(92)), p_type, ' ')").alias("p_name"),
        F.expr("if(p_partkey % 5 = 0, '', p_brand)").alias("p_brand"),
        F.expr("if(p_partkey % 7 = 0, NULL, p_size)").alias("p_size"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("p_retailprice"),
    )
    path = fresh_folder(spark, "flat")
    flatfile.write_flat(df, path, df.columns)
    return shown(flatfile.read_flat(spark, path, df.schema))


FLATFILE_SQL = """
SELECT p_partkey, ' ' || p_name || '|"' || p_brand || '"' || CASE WHEN p_partkey % 3 = 0 THEN chr(10) ELSE chr(92) END || p_type || ' ' AS p_name,
       CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS p_brand, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS p_size,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS p_retailprice
FROM part
"""

# --- scalars ------------------------------------------------------------------------------


def json_props(spark, sf):
    text = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select("event_id", scalars.number(text).alias("k"), scalars.truthy(text).alias("k_set"))


JSON_SQL = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, json_extract_string(props, '$.k') <> '0' AS k_set FROM events
"""


def tolerant_number(spark, sf):
    text = F.expr(
        "CASE l_linenumber WHEN 1 THEN cast(l_quantity AS STRING) WHEN 2 THEN '' WHEN 3 THEN 'n/a' WHEN 4 THEN concat(' ', cast(l_quantity AS INT), ' ')"
        " WHEN 5 THEN concat(cast(l_quantity AS INT), 'd') WHEN 6 THEN concat('-', cast(l_quantity AS INT), 'e1') END"
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalars.number(text).alias("number"))


NUMBER_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE l_linenumber WHEN 1 THEN l_quantity WHEN 4 THEN l_quantity WHEN 6 THEN -10 * l_quantity END AS number
FROM lineitem
"""


def class_score(spark, sf):
    text = F.expr(
        "CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN substr('abcmxz', p_size % 6 + 1, 1)"
        " ELSE concat(substr('ABCMXZ', p_size % 6 + 1, 1), p_partkey % 30, '.', p_size % 10) END"
    )
    return table(spark, sf, "part").select("p_partkey", text.alias("class"), scalars.class_score(text).alias("score"))


CLASS_SQL = """
WITH c AS (
  SELECT p_partkey, p_size % 6 + 1 AS rank, CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN substr('abcmxz', p_size % 6 + 1, 1)
         ELSE substr('ABCMXZ', p_size % 6 + 1, 1) || (p_partkey % 30) || '.' || (p_size % 10) END AS class FROM part)
SELECT p_partkey, class,
       CASE WHEN class <> '' AND rank < 6 THEN round(rank + coalesce(TRY_CAST(substr(class, 2) AS DOUBLE), 0) / 10e0, 2) END AS score
FROM c
"""


def code_label(spark, sf):
    code = F.expr("if(p_partkey % 9 = 0, NULL, p_size)")
    return table(spark, sf, "part").select("p_partkey", scalars.label(code, WEATHER_LABELS, UNKNOWN_LABEL).alias("label"))


#: Spelled out, so that a wrong label in the library shows.
LABEL_CASES = """
WHEN 0 THEN 'Clear sky' WHEN 1 THEN 'Mainly clear' WHEN 2 THEN 'Partly cloudy' WHEN 3 THEN 'Overcast'
WHEN 45 THEN 'Fog' WHEN 48 THEN 'Depositing rime fog'
WHEN 51 THEN 'Light drizzle' WHEN 53 THEN 'Moderate drizzle' WHEN 55 THEN 'Dense drizzle'
WHEN 56 THEN 'Light freezing drizzle' WHEN 57 THEN 'Dense freezing drizzle'
WHEN 61 THEN 'Slight rain' WHEN 63 THEN 'Moderate rain' WHEN 65 THEN 'Heavy rain'
WHEN 66 THEN 'Light freezing rain' WHEN 67 THEN 'Heavy freezing rain'
WHEN 71 THEN 'Slight snowfall' WHEN 73 THEN 'Moderate snowfall' WHEN 75 THEN 'Heavy snowfall' WHEN 77 THEN 'Snow grains'
WHEN 80 THEN 'Slight rain showers' WHEN 81 THEN 'Moderate rain showers' WHEN 82 THEN 'Violent rain showers'
WHEN 85 THEN 'Slight snow showers' WHEN 86 THEN 'Heavy snow showers'
WHEN 95 THEN 'Thunderstorm' WHEN 96 THEN 'Thunderstorm with slight hail' WHEN 99 THEN 'Thunderstorm with heavy hail'
ELSE 'Unknown'
"""

LABEL_SQL = f"SELECT p_partkey, CASE CASE WHEN p_partkey % 9 <> 0 THEN p_size END {LABEL_CASES} END AS label FROM part"


def code_lookup(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_custkey", "c_nationkey + int(c_custkey % 3) AS code")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return scalars.code_lookup(customers, "code", nations, "label", UNKNOWN_LABEL)


LOOKUP_SQL = """
SELECT c_custkey, CAST(c_nationkey + c_custkey % 3 AS INTEGER) AS code, coalesce(n_name, 'Unknown') AS label
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey + c_custkey % 3
"""


def derived_measures(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("rain", F.expr("nullif(l_discount, 0.05)"))
    low, high = F.col("l_quantity").cast("decimal(12,2)"), F.col("l_extendedprice").cast("decimal(12,2)")
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalars.value_range(low, high).cast("double").alias("value_range"),
        scalars.is_positive("rain").alias("is_positive"),
    )


MEASURES_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS value_range,
       coalesce(nullif(l_discount, 0.05), 0) > 0 AS is_positive
FROM lineitem
"""


def parse_instants(spark, sf):
    """Minute and second precision, an offset, and text that is no instant."""
    text = F.expr(
        "CASE event_id % 4 WHEN 0 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm'Z'\") WHEN 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
        " WHEN 2 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm'+01:00'\") ELSE 'soon' END"
    )
    return table(spark, sf, "events").select("event_id", F.unix_seconds(scalars.instant(text, strict=False)).alias("epoch"))


INSTANT_SQL = """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(epoch(date_trunc('minute', ts)) AS BIGINT)
       WHEN 1 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) WHEN 2 THEN CAST(epoch(date_trunc('minute', ts)) AS BIGINT) - 3600 END AS epoch
FROM events
"""


def keep_last_row(spark, sf):
    df = table(spark, sf, "lineitem")
    others = [c for c in df.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    return shown(keep_last(df, ["l_orderkey", "l_linenumber"], ["l_shipdate", *others]))


KEEP_LAST_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
        l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS r FROM lineitem)
WHERE r = 1
"""

# --- one feed end to end ---------------------------------------------------------------------


def weather_history(spark, sf) -> DataFrame:
    """Documents -> staged rows -> facts under their location key -> versions.

    Every third location already holds a dry reading for its days, which the batch closes.  Days and versions
    of a location meet nothing of another, so many documents are staged and merged one share of the locations
    after the other, and the files that rows move by do not grow with all documents.
    """
    of_shares = shares(spark, sf)
    if len(of_shares) == 1:
        return share_history(spark, sf)
    return written_in_turn((share_history(spark, sf, share) for share in of_shares), "history")


def share_history(spark, sf, share: Column | None = None) -> DataFrame:
    """The history of the locations of one share, or of all."""
    # staged once: the rows are both the earlier state and the batch, and unique on the key
    staged = written(flatten.weather_rows(weather_documents(spark, sf, share)), "staged")
    facts = weather_facts(staged, locations(spark, sf), "run-1")
    earlier = facts.where("location_key % 3 = 0 AND precipitation_mm IS NOT NULL").withColumns(
        {"precipitation_mm": F.lit(0).cast("decimal(6,2)"), "is_rain_day": F.lit(False), "pipeline_run_id": F.lit("run-0")}
    )
    opened = earlier.withColumns({"open_date": moment(EARLIER), "close_date": F.lit(None).cast("timestamp_ntz")})
    table = schemas.WEATHER_DAILY
    return merge.scd2_merge(opened, facts, table.keys, table.tracked, moment(LATER), check_unique=False)


EARLIER, LATER = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def locations(spark, sf) -> DataFrame:
    """Suppliers as locations; every tenth is no longer current."""
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("location_id"), (F.col("s_suppkey") + 1000).alias("location_key"), F.col("s_name").alias("name"),
        F.expr("if(s_suppkey % 10 = 0, TIMESTAMP_NTZ'2020-01-01 00:00:00', NULL)").alias("close_date"),
    )


def weather_history_rows(spark, sf):
    return shown(weather_history(spark, sf))


def weather_to_monthly(spark, sf):
    """Documents -> staged rows -> first versions -> monthly precipitation report."""
    facts = weather_facts(flatten.weather_rows(weather_documents(spark, sf)), locations(spark, sf), "run-1")
    table = schemas.WEATHER_DAILY
    history = merge.scd2_merge(None, facts, table.keys, table.tracked, moment(LATER), check_unique=False)
    return shown(dashboards.monthly_precipitation(history, locations(spark, sf)))


HISTORY_CTE = f"""
staged AS ({PARALLEL_SQL}),
facts AS (
  SELECT location_id + 1000 AS location_key, date, temp_min, temp_max, temp_max - temp_min AS temp_range, precipitation_mm,
         coalesce(precipitation_mm, 0) > 0 AS is_rain_day, wind_speed_max, weather_code,
         CASE weather_code {LABEL_CASES} END AS weather_condition,
         fetched_at AS source_fetched_at
  FROM staged WHERE location_id % 10 <> 0),
history AS (
  SELECT * REPLACE (0e0 AS precipitation_mm, false AS is_rain_day), 'run-0' AS pipeline_run_id, '{EARLIER}' AS open_date, '{LATER}' AS close_date
  FROM facts WHERE location_key % 3 = 0 AND precipitation_mm IS NOT NULL
  UNION ALL
  SELECT *, 'run-1', '{LATER}', NULL FROM facts)
"""
HISTORY_SQL = f"WITH {HISTORY_CTE} SELECT * FROM history"
TO_MONTHLY_SQL = f"""
WITH {HISTORY_CTE}
SELECT left(date, 7) || '-01' AS month, s_name AS location, CAST(sum(CAST(precipitation_mm AS DECIMAL(15,2))) AS DOUBLE) AS precip_mm
FROM history JOIN supplier ON s_suppkey + 1000 = location_key WHERE close_date IS NULL GROUP BY ALL
"""

QUERIES = {
    "weather_to_monthly": Query(weather_to_monthly, TO_MONTHLY_SQL),
    "weather_history": Query(weather_history_rows, HISTORY_SQL),
    "flatten_parallel_arrays": Query(flatten_parallel_arrays, PARALLEL_SQL),
    "zip_arrays": Query(zip_arrays, ZIP_SQL),
    "flatten_event_list": Query(flatten_event_list, EVENT_LIST_SQL),
    "array_peak": Query(array_peak, PEAK_SQL),
    "event_union": Query(event_union, EVENT_UNION_SQL),
    "flatten_keyed_map": Query(flatten_keyed_map, KEYED_MAP_SQL),
    "records_per_document": Query(records_per_document, RECORDS_SQL),
    "filename_context": Query(filename_context, FILENAME_SQL),
    "flatfile_roundtrip": Query(flatfile_roundtrip, FLATFILE_SQL),
    "json_props": Query(json_props, JSON_SQL),
    "tolerant_number": Query(tolerant_number, NUMBER_SQL),
    "class_score": Query(class_score, CLASS_SQL),
    "code_label": Query(code_label, LABEL_SQL),
    "code_lookup": Query(code_lookup, LOOKUP_SQL),
    "derived_measures": Query(derived_measures, MEASURES_SQL),
    "parse_instants": Query(parse_instants, INSTANT_SQL),
    "keep_last": Query(keep_last_row, KEEP_LAST_SQL),
}
