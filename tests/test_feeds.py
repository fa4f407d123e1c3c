"""Whole runs: landed files to versioned tables, audits, reports and streams."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.fixtures import STAMP, approach, cme, land, weather
from tidemark import schemas
from tidemark.operators.constraints import ConstraintError
from tidemark.plans import dashboards, feeds
from tidemark.sources import documents
from tidemark.sources.flatfile import read_flat, write_flat
from tidemark.streaming import ingest

T1, T2, T3 = "2026-08-01 00:00:00", "2026-08-02 00:00:00", "2026-08-03 00:00:00"


def utc(text):
    return F.lit(text).cast("timestamp")


def current_rows(table, *columns):
    return sorted(tuple(r) for r in table.current().select(*columns).collect())


def test_seed_and_reseed_locations(warehouse):
    assert feeds.seed_locations(warehouse, T1)["opened"] == 5
    assert feeds.seed_locations(warehouse, T2) == {"kept": 5, "closed": 0, "opened": 0}
    moved = warehouse.staged_locations.read().withColumn("timezone", F.expr("if(location_id = 3, 'UTC', timezone)"))
    assert feeds.seed_locations(warehouse, T3, moved) == {"kept": 4, "closed": 1, "opened": 1}
    keys = sorted(r.location_key for r in warehouse.locations.read().collect())
    assert keys == [1, 2, 3, 4, 5, 6]


def test_weather_run_versions_only_what_changed(warehouse, tmp_path):
    feeds.seed_locations(warehouse, T1)
    land(tmp_path / "d1", f"1_{STAMP}.json", weather(["2026-07-29", "2026-07-30"], [24, 25], [14, 15], [0, 1.5], [9, 9], [3, 61]))
    land(tmp_path / "d1", f"9_{STAMP}.json", weather(["2026-07-29"], [1]))  # unknown location
    assert feeds.load_weather(warehouse, str(tmp_path / "d1"), T1, "r1")["opened"] == 2
    land(tmp_path / "d2", "1_20260731T000000Z.json", weather(["2026-07-30", "2026-08-02"], [26, 27], [15, 16], [1.5], [9], [61]))
    counts = feeds.load_weather(warehouse, str(tmp_path / "d2"), T2, "r2")
    assert (counts["closed"], counts["opened"]) == (1, 2)
    rows = warehouse.weather_daily.read().orderBy("date", "open_date").collect()
    assert [(str(r.date), r.temp_max, r.is_rain_day, r.weather_condition, r.pipeline_run_id, r.close_date is None) for r in rows] == [
        ("2026-07-29", D("24.00"), False, "Overcast", "r1", True),
        ("2026-07-30", D("25.00"), True, "Slight rain", "r1", False),
        ("2026-07-30", D("26.00"), True, "Slight rain", "r2", True),
        ("2026-08-02", D("27.00"), False, "Unknown", "r2", True),
    ]
    assert rows[0].temp_range == D("10.00")
    again = feeds.historize_weather(warehouse, T3, "r3")
    assert again == {"kept": 0, "closed": 0, "opened": 0}, "nothing staged since"


def test_untouched_slices_are_neither_read_nor_rewritten(warehouse, tmp_path):
    feeds.seed_locations(warehouse, T1)
    land(tmp_path / "d1", f"1_{STAMP}.json", weather(["2026-05-01", "2026-06-01"], [1, 2]))
    feeds.load_weather(warehouse, str(tmp_path / "d1"), T1)
    before = warehouse.weather_daily.manifest()["current"]
    land(tmp_path / "d2", "1_20260801T000000Z.json", weather(["2026-06-01"], [3]))
    assert feeds.load_weather(warehouse, str(tmp_path / "d2"), T2) == {"kept": 0, "closed": 1, "opened": 1}
    after = warehouse.weather_daily.manifest()["current"]
    assert after["2026-05"] == before["2026-05"] and after["2026-06"] != before["2026-06"]
    files = warehouse.weather_daily.current().inputFiles()
    assert all("_part=current" in f for f in files) and len(files) == 2


def test_new_location_version_brings_all_its_days_under_the_new_key(warehouse, tmp_path):
    feeds.seed_locations(warehouse, T1)
    folder = land(tmp_path / "d", f"1_{STAMP}.json", weather(["2026-05-01", "2026-06-01"], [1, 2]))
    feeds.load_weather(warehouse, folder, T1)
    moved = warehouse.staged_locations.read().withColumn("name", F.expr("if(location_id = 1, 'Elsewhere', name)"))
    feeds.seed_locations(warehouse, T2, moved)
    assert feeds.historize_weather(warehouse, T3)["opened"] == 2


def test_a_bad_row_keeps_the_whole_batch_out(warehouse, tmp_path):
    feeds.seed_locations(warehouse, T1)
    folder = land(tmp_path / "d", f"1_{STAMP}.json", weather(["2026-07-29", "2026-07-30"], [24, 5], [14, 15]))
    with pytest.raises(ConstraintError) as caught:
        feeds.load_weather(warehouse, folder, T1)
    assert caught.value.counts == {"temp_order": 1}
    assert warehouse.weather_daily.version == 0 and warehouse.weather_daily.read().count() == 0
    land(tmp_path / "d", "1_20260731T000000Z.json", weather(["2026-07-30"], [25], [15]))
    assert feeds.load_weather(warehouse, str(tmp_path / "d"), T2)["opened"] == 2, "the corrected pull lands"


def test_forecast_horizon_and_null_checks(warehouse, tmp_path):
    feeds.seed_locations(warehouse, T1)
    folder = land(tmp_path / "d", f"1_{STAMP}.json", weather(["2026-08-17", "2026-08-18"], [None, None]))
    with pytest.raises(ConstraintError) as caught:
        feeds.load_weather(warehouse, folder, T1)
    assert caught.value.counts == {"date_in_forecast": 1}


def test_events_run_and_missing_time_fails_at_the_second_level(warehouse, tmp_path):
    land(tmp_path / "d", f"CME_{STAMP}.json", [cme("c1", [{"speed": 400}], linkedEvents=[{"activityID": "g1"}]), cme("c2", [])])
    land(tmp_path / "d", f"GST_{STAMP}.json", [{"gstID": "g1", "startTime": "2026-07-22T03:00Z", "allKpIndex": [{"kpIndex": 9}]}])
    land(tmp_path / "d", f"FLR_{STAMP}.json", [{"flrID": "f1", "beginTime": "2026-07-28T03:00Z", "classType": "X1.5"}])
    assert feeds.load_events(warehouse, str(tmp_path / "d"), T1, "r1")["opened"] == 4
    events = warehouse.space_events.current()
    recent = dashboards.recent_ejections(events).collect()
    assert [(r.linked_event_id, r.storm_kp_index) for r in recent] == [("g1", D("9.00")), (None, None)]
    assert [tuple(r) for r in dashboards.storms_by_band(events).collect()] == [(10, 1)]
    assert dashboards.most_severe_in_last_days(events, utc(T1)).first().event_id == "f1"
    land(tmp_path / "e", f"CME_{STAMP}.json", [cme("c3", [], start=None)])
    feeds.stage_events(warehouse, str(tmp_path / "e"))
    with pytest.raises(ConstraintError) as caught:
        feeds.historize_events(warehouse, T2)
    assert caught.value.counts == {"event_time_not_null": 1}


def test_approaches_run_derives_the_dimension_at_the_same_instant(warehouse, tmp_path):
    feed = {"element_count": 1, "near_earth_objects": {"2026-07-30": [approach("1", "2026-07-30", 500, diameter=10)]}}
    land(tmp_path / "d1", f"2026-07-30_{STAMP}.json", feed)
    feeds.load_approaches(warehouse, str(tmp_path / "d1"), T1, "r1")
    later = {"near_earth_objects": {"2026-08-05": [approach("1", "2026-08-05", 300, diameter=20), approach("2", "2026-08-05", 900)]}}
    land(tmp_path / "d2", "2026-08-05_20260801T000000Z.json", later)
    assert feeds.load_approaches(warehouse, str(tmp_path / "d2"), T2, "r2") == {"kept": 0, "closed": 0, "opened": 2}
    joined = dashboards.approaches_by_distance(warehouse.close_approaches.read(), warehouse.asteroids.read()).collect()
    assert [(r.asteroid_id, r.miss_distance_km, r.estimated_diameter_m_max) for r in joined] == [
        ("1", D("300.00"), D("20.00")), ("1", D("500.00"), D("10.00")), ("2", D("900.00"), D("10.50")),
    ]
    assert current_rows(warehouse.asteroids, "asteroid_id", "asteroid_key") == [("1", 2), ("2", 3)] or current_rows(
        warehouse.asteroids, "asteroid_id", "asteroid_key"
    ) == [("1", 3), ("2", 2)]
    assert dashboards.closest_in_next_days(warehouse.close_approaches.current(), utc(T2)).first().miss_distance_km == D("300.00")
    now = dashboards.approaches_with_current_attributes(warehouse.close_approaches.read(), warehouse.asteroids.read())
    assert {r.estimated_diameter_m_max for r in now.where("asteroid_id = '1'").collect()} == {D("20.00")}


def test_backfill_reads_all_historical_documents_once(warehouse, tmp_path):
    feeds.seed_locations(warehouse, T1)
    w = land(tmp_path / "w", f"1_2024-07-27_{STAMP}.json", weather(["2024-07-27", "2024-07-28"], [1, 2]), historical=True)
    land(tmp_path / "w", f"2_{STAMP}.json", weather(["2026-07-29"], [1]))  # a daily pull, not part of it
    e = land(tmp_path / "e", f"CME_2024-07-27_{STAMP}.json", [cme("c1", [])], historical=True)
    land(tmp_path / "e", f"CME_2024-08-26_{STAMP}.json", [cme("c1", [{"speed": 1}]), cme("c2", [])], historical=True)
    a = land(tmp_path / "a", f"2024-07-27_{STAMP}.json", {"near_earth_objects": {"2024-07-27": [approach("1", "2024-07-27", 5)]}}, historical=True)
    counts = feeds.backfill(warehouse, w, e, a, T1, "r1")
    assert {k: v["opened"] for k, v in counts.items()} == {"weather": 2, "events": 2, "approaches": 1}


def test_audit_finds_what_is_wrong_and_survives_a_broken_check(warehouse, tmp_path, spark):
    feeds.seed_locations(warehouse, T1)
    days = [f"2026-07-{d:02d}" for d in range(20, 29)]
    land(tmp_path / "w", f"1_{STAMP}.json", weather(days + ["2026-08-01"], [20, 21, 20, 21, 20, 21, 20, 90, 20, 20]))
    feeds.load_weather(warehouse, str(tmp_path / "w"), T1, "r1")
    calls = [("weather", dt.datetime(2026, 7, 31), 100, 200, i > 1, 0, 1, None, "r0") for i in range(10)]
    warehouse.call_log.append(spark.createDataFrame(calls, schemas.CALL_LOG.schema))
    docs = documents.read_documents(spark, str(tmp_path / "w")).withColumn("name", F.lit("weather"))
    assert feeds.run_audit(warehouse, utc(T1), "r1", docs) == []
    found = {}
    for r in warehouse.findings.read().collect():
        found.setdefault(r.check_name, []).append((r.severity, r.description))
    assert len(found["absence_weather_daily"]) == 4
    assert len(found["anomaly_temp_max"]) == 1 and "90.00 on 2026-07-27" in found["anomaly_temp_max"][0][1]
    assert found["xtable_weather_run_id"] == [("warning", "weather_daily run r1 has no entry in the call log.")]
    assert found["trend_api_success_rate"][0] == ("critical", "Source weather has a 7-day success rate of 0.8 (< 0.9).")
    assert found["schema_drift_weather"] == [("info", "First keys seen for weather: [daily].")]
    assert dashboards.recent_findings(warehouse.findings.read()).first().severity == "critical"

    land(tmp_path / "x", "1_20260802T000000Z.json", '{"hourly": {}}')
    land(tmp_path / "x", "2_20260802T000000Z.json", "not json")
    docs = documents.read_documents(spark, str(tmp_path / "x")).withColumn("name", F.lit("weather"))
    checks = feeds.audit_checks(warehouse, utc(T2), "r2", docs)
    checks = {"broken": lambda: spark.sql("SELECT raise_error('no') AS check_name"), "schema_drift": checks["schema_drift"]}
    from tidemark.operators import audit

    sunk = []
    assert audit.run_checks(checks, lambda df: sunk.extend(df.collect())) == ["broken"]
    assert sorted((r.severity, r.description) for r in sunk) == [
        ("warning", "Keys changed for weather: missing=[daily], added=[hourly]."),
        ("warning", "Unreadable document of weather."),
    ]


def test_logs_reject_bad_rows_and_ignore_empty_batches(warehouse, spark):
    empty = spark.createDataFrame([], schemas.CALL_LOG.schema)
    warehouse.call_log.append(empty)
    assert warehouse.call_log.read().count() == 0
    bad = spark.createDataFrame([(None, dt.datetime(2026, 7, 31), 1, 200, True, 0, 1, None, None)], schemas.CALL_LOG.schema)
    with pytest.raises(ConstraintError):
        warehouse.call_log.append(bad)
    good = spark.createDataFrame([("s", dt.datetime(2026, 7, 31), 1, 500, False, 2, None, None, None)] * 2, schemas.CALL_LOG.schema)
    warehouse.call_log.append(good)
    assert warehouse.call_log.read().select("id").distinct().count() == 2


def test_flat_file_keeps_text_and_fails_on_bad_values(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("a INT, b STRING, c DECIMAL(5,2)")
    df = spark.createDataFrame([(1, ' x|y "z"\n\\ ', D("1.50")), (2, "", None), (3, None, None)], schema)
    write_flat(df, str(tmp_path / "f"), ["a", "b", "c"])
    got = sorted(read_flat(spark, str(tmp_path / "f"), schema).collect())
    assert [tuple(r) for r in got] == [(1, ' x|y "z"\n\\ ', D("1.50")), (2, None, None), (3, None, None)]
    with pytest.raises(Exception):
        read_flat(spark, str(tmp_path / "f"), T.StructType.fromDDL("a INT, b INT, c DECIMAL(5,2)")).collect()
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "x.psv").write_text("1|a|123456\n")
    with pytest.raises(Exception):
        read_flat(spark, str(tmp_path / "g"), schema).collect()


def test_streams_ingest_each_file_once(warehouse, tmp_path):
    feeds.seed_locations(warehouse, "2026-07-01 00:00:00")
    check = str(tmp_path / "checkpoints")
    land(tmp_path / "w", "1_20260730T000000Z.json", weather(["2026-07-29"], [24]))
    ingest.ingest_weather(warehouse, str(tmp_path / "w"), check).awaitTermination()
    land(tmp_path / "w", "1_20260731T000000Z.json", weather(["2026-07-29", "2026-07-30"], [25, 26]))
    ingest.ingest_weather(warehouse, str(tmp_path / "w"), check).awaitTermination()
    ingest.ingest_weather(warehouse, str(tmp_path / "w"), check).awaitTermination()
    rows = warehouse.weather_daily.read().orderBy("date", "open_date").collect()
    assert [(str(r.date), r.temp_max, r.close_date is None) for r in rows] == [
        ("2026-07-29", D("24.00"), False), ("2026-07-29", D("25.00"), True), ("2026-07-30", D("26.00"), True),
    ]
    marks = warehouse.weather_daily.manifest()["marks"]
    assert [v for k, v in marks.items() if k.startswith("batch:weather-")] == [1]
    land(tmp_path / "w", "1_20260701T000000Z.json", weather(["2026-07-29"], [1]))  # fetched long ago, landed last
    ingest.ingest_weather(warehouse, str(tmp_path / "w"), check).awaitTermination()
    versions = warehouse.weather_daily.read().where("date = '2026-07-29'").orderBy("open_date").collect()
    assert [(r.temp_max, r.close_date is None) for r in versions] == [(D("24.00"), False), (D("25.00"), False), (D("1.00"), True)]
    land(tmp_path / "w2", "2_20260731T000000Z.json", weather(["2026-07-29"], [7]))  # another folder, its own batch 0
    ingest.ingest_weather(warehouse, str(tmp_path / "w2"), check).awaitTermination()
    assert warehouse.weather_daily.current().count() == 3

    land(tmp_path / "e", f"CME_{STAMP}.json", [cme("c1", [])])
    ingest.ingest_events(warehouse, str(tmp_path / "e"), check).awaitTermination()
    assert warehouse.space_events.current().count() == 1
    land(tmp_path / "a", f"2026-07-30_{STAMP}.json", {"near_earth_objects": {"2026-07-30": [approach("1", "2026-07-30", 5)]}})
    ingest.ingest_approaches(warehouse, str(tmp_path / "a"), check).awaitTermination()
    assert warehouse.asteroids.current().count() == warehouse.close_approaches.current().count() == 1


def test_replayed_stream_batch_is_not_applied_twice(warehouse, tmp_path):
    feeds.seed_locations(warehouse, "2026-07-01 00:00:00")
    folder = land(tmp_path / "w", "1_20260730T000000Z.json", weather(["2026-07-29"], [24]))
    feeds.stage_weather(warehouse, folder, ("weather", 0))
    feeds.historize_weather(warehouse, T1, batch=("weather", 0))
    versions = (warehouse.staged_weather.version, warehouse.weather_daily.version)
    feeds.stage_weather(warehouse, folder, ("weather", 0))
    feeds.historize_weather(warehouse, T2, batch=("weather", 0))
    assert (warehouse.staged_weather.version, warehouse.weather_daily.version) == versions


def test_running_success_rate_stream(spark, tmp_path):
    rows = [("s", dt.datetime(2026, 7, 1, h), h > 0) for h in range(4)] + [("s", dt.datetime(2026, 7, 30), True)]
    spark.createDataFrame(rows, "source_name string, called_at timestamp, success boolean").write.parquet(str(tmp_path / "calls"))
    stream = spark.readStream.schema("source_name string, called_at timestamp, success boolean").parquet(str(tmp_path / "calls"))
    rates = ingest.running_success_rate(stream, span="1 day")
    query = rates.writeStream.format("memory").queryName("rates").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    got = {str(r.window_start): (r.calls, r.successes, r.rate) for r in spark.table("rates").collect()}
    assert got == {"2026-07-01 00:00:00": (4, 3, 0.75), "2026-07-30 00:00:00": (1, 1, 1.0)}


def test_a_day_of_events_touches_one_slice(warehouse, spark):
    def rows(first, n):
        return spark.range(n).selectExpr(
            f"concat(date_format(date_add(date'2026-01-01', cast({first} + id % 2 AS int)), \"yyyy-MM-dd\"), 'T00:00:00-CME-', id) AS event_id",
            "'CME' AS event_type", "timestamp'2026-01-01 00:00:00' AS event_time", "'x' AS source_location", "cast(1 AS decimal(8,2)) AS speed_kms",
            "cast(NULL AS decimal(4,2)) AS kp_index", "cast(NULL AS string) AS flare_class", "cast(NULL AS decimal(6,2)) AS flare_severity_score",
            "cast(NULL AS string) AS linked_event_id", "timestamp'2026-08-01 00:00:00' AS fetched_at",
        )

    for first in (0, 40, 80):
        warehouse.staged_events.upsert(rows(first, 30))
    feeds.historize_events(warehouse, utc(T1), "r1")
    before = warehouse.staged_events.manifest(), warehouse.space_events.manifest()
    warehouse.staged_events.upsert(rows(83, 300))
    feeds.historize_events(warehouse, utc(T2), "r2")
    after = warehouse.staged_events.manifest(), warehouse.space_events.manifest()
    for old, new in zip(before, after):
        assert [s for s in new["current"] if new["current"][s] != old["current"].get(s)] == ["2026-03"]
    assert warehouse.space_events.current().count() == 390


def test_documents_of_several_feeds_have_names(spark, tmp_path):
    land(tmp_path / "w", f"1_{STAMP}.json", {"daily": {}})
    land(tmp_path / "e", f"CME_2026-07-01_{STAMP}.json", [])
    land(tmp_path / "e", f"gst_2026-07-01_{STAMP}.json", [])
    docs = documents.named_documents(spark, {"weather": str(tmp_path / "w"), "space": str(tmp_path / "e")})
    assert docs.columns == ["name", "value", "fetched_at", "file_name"]
    assert sorted(r.name for r in docs.collect()) == ["space_CME", "space_GST", "weather"]


def test_call_records_of_both_outcomes(spark, warehouse, tmp_path):
    lines = ['{"source_name":"a","called_at":"2026-07-01T00:00:00Z","success":true,"response_time_ms":5,"unknown":1}',
             '{"source_name":"a","called_at":"2026-07-01T00:00:01Z","success":false,"http_status_code":500,"retry_count":3}']
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "calls.jsonl").write_text("\n".join(lines))
    warehouse.call_log.append(documents.read_call_records(spark, str(tmp_path / "c")))
    assert sorted((r.success, r.retry_count) for r in warehouse.call_log.read().collect()) == [(False, 3), (True, 0)]
    (tmp_path / "c" / "bad.jsonl").write_text("no json")
    with pytest.raises(Exception):
        warehouse.call_log.append(documents.read_call_records(spark, str(tmp_path / "c")))
    assert warehouse.call_log.read().count() == 2
