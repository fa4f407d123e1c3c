"""Whole runs through the store and the logs: landed rows, staged, merged, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalogue.base import Query, moment, shown, table
from tidemark.catalogue.feeds import EVENT_UNION_SQL, mixed_documents
from tidemark.catalogue.reports import CALLS_CTE, calls
from tidemark.operators import constraints, flatten
from tidemark.plans import feeds
from tidemark.session import fresh_folder, written
from tidemark.sources import documents
from tidemark.streaming import ingest

T1, T2, T3 = "2024-06-01 00:00:00", "2024-07-01 00:00:00", "2024-08-01 00:00:00"


def warehouse(spark) -> feeds.Warehouse:
    return feeds.Warehouse(spark, fresh_folder(spark, "warehouse"))


def dated_events(spark, sf) -> DataFrame:
    """Event rows, parsed once, under ids that begin with a date: five months, by the number of the event."""
    rows = flatten.event_rows(mixed_documents(spark, sf)).drop("first_token", "window_start")
    month = F.add_months(F.lit("2024-01-01").cast("date"), (F.col("event_id").cast("bigint") % 5).cast("int"))
    return written(rows.withColumn("event_id", F.concat_ws("-", month.cast("string"), "event_id")), "events")


def store_two_batches(spark, sf):
    """Events in two batches through staging into history; the second moves some storms, brings new ids and touches three of five months.

    A batch that breaks a rule in between leaves staging and history as they were.
    """
    wh, rows = warehouse(spark), dated_events(spark, sf)
    number = F.substring_index("event_id", "-", -1).cast("bigint")
    wh.staged_events.upsert(rows.where(number % 3 != 0))
    feeds.historize_events(wh, moment(T1).cast("timestamp"), "run 1")
    broken = rows.withColumn("fetched_at", F.when(F.col("event_type") != "GST", F.col("fetched_at")))
    try:
        wh.staged_events.upsert(broken)
        raise AssertionError("a batch that breaks a rule was staged")
    except constraints.ConstraintError:
        pass
    before = wh.space_events.manifest()["current"]
    moved = F.when(F.col("event_type") == "GST", F.col("kp_index") + F.when(F.col("kp_index") < 5, 1).otherwise(0)).otherwise(F.col("kp_index"))
    wh.staged_events.upsert(rows.where(number % 5 < 3).withColumn("kp_index", moved.cast("decimal(4,2)")))
    feeds.historize_events(wh, moment(T2).cast("timestamp"), "run 2")
    feeds.historize_events(wh, moment(T3).cast("timestamp"), "run 3")  # nothing new is staged
    after = wh.space_events.manifest()["current"]
    rewritten = F.array(*[F.lit(s) for s in sorted(after) if after[s] != before.get(s)]).cast("array<string>")
    kept = ["event_id", "event_type", "event_time", "kp_index", "flare_class", "pipeline_run_id", "open_date", "close_date"]
    return shown(wh.space_events.read().select(*kept).withColumn("rewritten_slice", F.array_contains(rewritten, F.left("event_id", F.lit(7)))))


TWO_BATCHES_SQL = f"""
WITH e AS ({EVENT_UNION_SQL}),
n AS (SELECT * REPLACE ('2024-0' || (1 + CAST(event_id AS BIGINT) % 5) || '-01-' || event_id AS event_id), CASE WHEN event_type = 'GST' AND kp_index < 5 THEN kp_index + 1 ELSE kp_index END AS moved,
             CAST(event_id AS BIGINT) % 3 <> 0 AS early, CAST(event_id AS BIGINT) % 5 < 3 AS late FROM e)
SELECT event_id, event_type, event_time, kp_index, flare_class, 'run 1' AS pipeline_run_id, '{T1}' AS open_date,
       CASE WHEN late AND kp_index IS DISTINCT FROM moved THEN '{T2}' END AS close_date, late AS rewritten_slice FROM n WHERE early
UNION ALL
SELECT event_id, event_type, event_time, moved, flare_class, 'run 2', '{T2}', NULL, true FROM n WHERE late AND (NOT early OR kp_index IS DISTINCT FROM moved)
"""


def landed_calls(spark, sf) -> str:
    """Call records as landed JSON lines; every fifth has no retry count."""
    path = fresh_folder(spark, "calls")
    rows = calls(spark, sf).withColumn("called_at", F.date_format("called_at", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    rows.withColumn("retry_count", F.when(F.col("response_time_ms") % 5 != 0, F.col("retry_count"))).write.json(path)
    return path


def call_log(spark, sf):
    """Landed call records, good and failed, appended to the log and read back."""
    wh = warehouse(spark)
    wh.call_log.append(documents.read_call_records(spark, landed_calls(spark, sf)))
    rows = wh.call_log.read()
    return rows.groupBy("source_name", "success").agg(
        F.count(F.lit(1)).alias("calls"), F.count_distinct("id").alias("ids"), F.sum("retry_count").alias("retries"), F.sum("response_time_ms").alias("total_ms")
    )


CALL_LOG_SQL = f"""
WITH {CALLS_CTE}
SELECT source_name, success, count(*) AS calls, count(*) AS ids, CAST(sum(CASE WHEN response_time_ms % 5 <> 0 THEN retry_count ELSE 0 END) AS BIGINT) AS retries,
       CAST(sum(response_time_ms) AS BIGINT) AS total_ms
FROM calls GROUP BY 1, 2
"""


def running_rate(spark, sf):
    """The running success rate as a stream over landed call records, until none are left."""
    schema = schemas.CALL_LOG.schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").json(landed_calls(spark, sf))
    out = fresh_folder(spark, "rates")
    rates = ingest.running_success_rate(stream, late="400 days", span="7 days", slide="7 days")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    query = rates.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", fresh_folder(spark, "stream")).trigger(availableNow=True).start()
    query.awaitTermination()
    return shown(spark.read.parquet(out))


RATE_SQL = f"""
WITH {CALLS_CTE}, w AS (SELECT *, CAST(floor(epoch(called_at) / 604800) AS BIGINT) * 604800 AS s FROM calls)
SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, strftime(make_timestamp((s + 604800) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
       source_name, count(*) AS calls, count(*) FILTER (success) AS successes, count(*) FILTER (success) / count(*) AS rate
FROM w GROUP BY s, source_name
"""

QUERIES = {
    "store_two_batches": Query(store_two_batches, TWO_BATCHES_SQL),
    "call_log": Query(call_log, CALL_LOG_SQL),
    "running_rate": Query(running_rate, RATE_SQL),
}
