"""Documents to rows: every edge the payloads show."""

import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.fixtures import STAMP, approach, cme, land, weather
from tidemark.catalogue import feeds as catalogue_feeds
from tidemark.functions import scalars
from tidemark.operators import flatten
from tidemark.sources.documents import read_documents


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def test_weather_arms_short_missing_text_and_junk(spark, tmp_path):
    doc = weather(["2026-07-29", "2026-07-30"], [24.1, "25.0"], [14.0, None], [0.0, "x"], [18.4], [3, 61])
    folder = land(tmp_path, f"1_{STAMP}.json", doc)
    first, second = rows(flatten.weather_rows(read_documents(spark, folder)), "date")
    assert (first["location_id"], str(first["date"]), first["temp_max"], first["wind_speed_max"]) == (1, "2026-07-29", D("24.10"), D("18.40"))
    assert (second["temp_max"], second["temp_min"], second["precipitation_mm"], second["wind_speed_max"], second["weather_code"]) == (D("25.00"), None, None, None, 61)
    assert first["fetched_at"].isoformat().startswith("2026-07-30T14:05:12")


def test_weather_repeated_day_keeps_last_and_missing_daily_gives_no_rows(spark, tmp_path):
    land(tmp_path, f"1_{STAMP}.json", weather(["2026-07-29", "2026-07-29"], [1, 2]))
    land(tmp_path, f"2_{STAMP}.json", {"hourly": {}})
    got = rows(flatten.weather_rows(read_documents(spark, str(tmp_path))), "date")
    assert [(r["location_id"], r["temp_max"]) for r in got] == [(1, D("2.00"))]


def test_weather_later_pull_wins_over_overlapping_files(spark, tmp_path):
    land(tmp_path, "1_20260730T000000Z.json", weather(["2026-07-29"], [1]))
    land(tmp_path, "1_2026-07-01_20260731T000000Z.json", weather(["2026-07-29"], [2]), historical=True)
    docs = read_documents(spark, str(tmp_path))
    assert [r["temp_max"] for r in rows(flatten.weather_rows(docs), "date")] == [D("2.00")]
    window = docs.where("historical").select(F.col("window_start").cast("string")).first()[0]
    assert window == "2026-07-01"


def test_weather_code_that_is_no_integer_fails_the_batch(spark, tmp_path):
    land(tmp_path, f"1_{STAMP}.json", weather(["2026-07-29"], [1], code=[3.5]))
    with pytest.raises(Exception, match="3.5"):
        flatten.weather_rows(read_documents(spark, str(tmp_path))).collect()


def test_decimal_overflow_fails_the_batch(spark, tmp_path):
    land(tmp_path, f"1_{STAMP}.json", weather(["2026-07-29"], [123456]))
    with pytest.raises(Exception, match="123456"):
        flatten.weather_rows(read_documents(spark, str(tmp_path))).collect()


def test_replay_selects_pulls_by_fetch_time(spark, tmp_path):
    land(tmp_path, "1_20260730T000000Z.json", weather(["2026-07-29"], [1]))
    land(tmp_path, "1_20260801T000000Z.json", weather(["2026-07-29"], [2]))
    docs = read_documents(spark, str(tmp_path), fetched_to=F.lit("2026-07-31 00:00:00").cast("timestamp"))
    assert [r["temp_max"] for r in rows(flatten.weather_rows(docs), "date")] == [D("1.00")]


def test_ejection_speed_choice(spark, tmp_path):
    docs = [
        cme("flagged", [{"isMostAccurate": False, "speed": 400}, {"isMostAccurate": True, "speed": 612.5}]),
        cme("first", [{"isMostAccurate": False, "speed": 400}, {"speed": 500}]),
        cme("null-speed", [{"speed": 1}, {"isMostAccurate": True, "speed": None}]),
        cme("empty", []),
        cme("none", None, linkedEvents=[{"activityID": "2026-07-22-GST-001"}], sourceLocation=""),
        cme("", []),
        cme(None, []),
    ]
    folder = land(tmp_path, f"CME_{STAMP}.json", docs)
    got = {r["event_id"]: r for r in rows(flatten.event_rows(read_documents(spark, folder)), "event_id")}
    assert {k: v["speed_kms"] for k, v in got.items()} == {
        "flagged": D("612.50"), "first": D("400.00"), "null-speed": None, "empty": None, "none": None,
    }
    assert got["none"]["linked_event_id"] == "2026-07-22-GST-001"
    assert got["none"]["source_location"] is None
    assert got["none"]["event_time"].isoformat().startswith("2026-07-20T12:34:00")


def test_storm_peak_and_flare_time(spark, tmp_path):
    land(tmp_path, f"GST_{STAMP}.json", [
        {"gstID": "g1", "startTime": "2026-07-22T03:00Z", "allKpIndex": [{"kpIndex": 5.67}, {"kpIndex": None}, {"kpIndex": 7.0}], "linkedEvents": None},
        {"gstID": "g2", "startTime": "2026-07-22T03:00Z", "allKpIndex": []},
    ])
    land(tmp_path, f"flr_{STAMP}.json", [
        {"flrID": "f1", "beginTime": "", "peakTime": "2026-07-19T08:10Z", "classType": "X1.5", "sourceLocation": ""},
        {"flrID": "f1", "beginTime": "2026-07-19T08:00Z", "classType": "M9.9"},
    ])
    got = {r["event_id"]: r for r in rows(flatten.event_rows(read_documents(spark, str(tmp_path))), "event_id")}
    assert (got["g1"]["kp_index"], got["g2"]["kp_index"]) == (D("7.00"), None)
    assert (got["f1"]["flare_class"], got["f1"]["flare_severity_score"]) == ("M9.9", D("4.99"))


def test_event_documents_that_are_no_list_and_unknown_types(spark, tmp_path):
    land(tmp_path / "ok", f"CME_{STAMP}.json", cme("lone", []))
    land(tmp_path / "ok", f"CME_20260731T000000Z.json", [])
    assert flatten.event_rows(read_documents(spark, str(tmp_path / "ok"))).count() == 0
    land(tmp_path / "bad", f"XYZ_{STAMP}.json", [])
    with pytest.raises(Exception, match="unknown event type: XYZ"):
        flatten.event_rows(read_documents(spark, str(tmp_path / "bad"))).collect()


def test_approaches_only_under_their_own_date(spark, tmp_path):
    other = {"close_approach_date": "2031-01-01", "miss_distance": {"kilometers": "1"}, "relative_velocity": {}}
    feed = {
        "element_count": 3,
        "near_earth_objects": {
            "2026-07-30": [
                approach("1", "2026-07-30", "4500000.25", extra=[other]),
                approach("2", "2026-07-30", 5, hazard=None),
                approach("2", "2026-07-30", 6, hazard=None),
                {"id": "3", "name": "no approaches"},
            ]
        },
    }
    land(tmp_path, f"2026-07-30_{STAMP}.json", feed)
    land(tmp_path, "2026-07-31_20260731T000000Z.json", [1, 2])
    got = rows(flatten.approach_rows(read_documents(spark, str(tmp_path))), "asteroid_id")
    assert [(r["asteroid_id"], r["miss_distance_km"], r["is_potentially_hazardous"]) for r in got] == [
        ("1", D("4500000.25"), True), ("2", D("6.00"), False),
    ]


def test_records_returned(spark, tmp_path):
    land(tmp_path / "w", f"1_{STAMP}.json", weather(["2026-07-29", "2026-07-30"], [1]))
    land(tmp_path / "e", f"CME_{STAMP}.json", [cme("a", [])])
    land(tmp_path / "a", f"2026-07-30_{STAMP}.json", {"element_count": 7})
    counts = [
        flatten.records_returned(read_documents(spark, str(tmp_path / d)), s).first()["records_returned"]
        for d, s in (("w", "weather"), ("e", "events"), ("a", "approaches"))
    ]
    assert counts == [2, 1, 7]


@pytest.mark.parametrize(
    "text,score",
    [("A1.0", 1.1), ("M9.9", 4.99), ("X1.5", 5.15), ("X28", 7.8), ("m2.3", 4.23), ("M", 4.0), ("Mabc", 4.0), ("Z1", None), ("", None), (None, None)],
)
def test_class_score(spark, text, score):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(scalars.class_score("c")).first()[0] == score


def test_tolerant_numbers(spark):
    values = [("1.5", 1.5), ("2", 2.0), ("", None), (None, None), ("x", None), ("1d", None), ("2.5f", None), (" 3 ", 3.0), ("1e3", 1000.0), ("-4", -4.0)]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(scalars.number("v")).collect()]
    assert got == [w for _, w in values]


def test_truthy_text(spark):
    values = [("true", True), ("false", False), (None, False), ("", False), ("0", False), ("1", True), ("[]", False)]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(values)], "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(scalars.truthy("v")).collect()] == [w for _, w in values]


def test_labels_and_lookup_agree(spark):
    labels = {0: "zero", 3: "three"}
    df = spark.createDataFrame([(0,), (3,), (9,), (None,)], "code int")
    direct = df.select("code", scalars.label("code", labels, "Unknown").alias("l"))
    looked = scalars.code_lookup(df, "code", spark.createDataFrame(list(labels.items()), "c int, l string"), "l", "Unknown")
    assert sorted(map(str, direct.collect())) == sorted(map(str, looked.select("code", "l").collect()))


def test_buckets(spark):
    df = spark.createDataFrame([(0.0,), (0.99,), (1.0,), (8.99,), (9.0,), (-1.0,)], "v double")
    assert [r[0] for r in df.select(scalars.bucket("v", 0, 9, 9)).collect()] == [1, 1, 2, 9, 10, 0]


@pytest.mark.parametrize("text", ["nope", '{"daily":', "[1, 2]", '{"daily": 5}', "null"])
def test_weather_documents_of_another_shape_fail_the_batch(spark, tmp_path, text):
    folder = land(tmp_path, f"1_{STAMP}.json", text)
    with pytest.raises(Exception, match="unreadable document"):
        flatten.weather_rows(read_documents(spark, folder)).collect()


@pytest.mark.parametrize("text", ["nope", '[{"gstID": "g"},', "[1, 2]"])
def test_broken_event_lists_fail_the_batch(spark, tmp_path, text):
    folder = land(tmp_path, f"GST_{STAMP}.json", text)
    with pytest.raises(Exception, match="unreadable document"):
        flatten.event_rows(read_documents(spark, folder)).collect()


@pytest.mark.parametrize("text,fails", [("nope", True), ('{"near_earth_objects": 5}', True), ("null", False), ("[]", False), ("{}", False)])
def test_approach_documents_of_another_shape(spark, tmp_path, text, fails):
    rows = flatten.approach_rows(read_documents(spark, land(tmp_path, f"2026-07-30_{STAMP}.json", text)))
    if fails:
        with pytest.raises(Exception, match="unreadable document"):
            rows.collect()
    else:
        assert rows.count() == 0


def test_documents_are_parsed_once(spark, tmp_path):
    """No filter that repeats the parse is inferred below the explode."""
    folder = land(tmp_path, f"1_{STAMP}.json", weather(["2026-07-29"], [1]))
    docs = read_documents(spark, folder)
    for rows in (flatten.weather_rows(docs), flatten.event_rows(docs), flatten.approach_rows(docs)):
        plan = rows.select("fetched_at")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_fetch_time_bounds_prune_files(spark, tmp_path):
    land(tmp_path, "1_20260730T000000Z.json", weather(["2026-07-29"], [1]))
    land(tmp_path, "1_20260801T000000Z.json", "not even json")
    docs = read_documents(spark, str(tmp_path), fetched_to=F.lit("2026-07-31 00:00:00").cast("timestamp"))
    assert flatten.weather_rows(docs).count() == 1


def test_documents_of_rows_are_written_where_they_are_parsed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue_feeds, "DOCUMENTS_PER_TASK", 10, raising=False)
    rows = spark.range(200).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id % 5 AS l_suppkey", "cast(id % 7 + 1 AS INT) AS l_linenumber", "cast(id % 50 AS DOUBLE) AS l_quantity",
        "timestamp_ntz'2024-02-27 10:00:00' AS l_shipdate",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    docs = catalogue_feeds.weather_documents(spark, str(tmp_path))
    assert docs.rdd.getNumPartitions() == 20 and docs.count() == 200
    above = docs._jdf.queryExecution().executedPlan().toString().partition("Exchange")[0]
    assert '"daily"' in above  # rows move, not documents
    assert json.loads(docs.where("file_name LIKE '0_0-%'").first().value)["daily"]["time"] == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-02-29"]


def test_text_that_starts_as_no_number_is_not_cast(spark):
    texts = ["n/a", "high", "nan", " -Infinity ", "+inf", "INF\n", "7", "\t-1.5e1 ", "1d", "0x1p3", "0x1p3d", "infd", ":1", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalars.number("t").alias("n"))
    inf = float("inf")
    assert [str(r.n) for r in df.collect()] == [str(v) for v in (None, None, float("nan"), -inf, inf, inf, 7.0, -15.0, None, 8.0, None, None, None, None, None)]
    assert " < :)" in df._jdf.queryExecution().analyzed().toString()


def test_history_by_shares_of_locations_is_the_whole_history(spark, tmp_path, monkeypatch):
    rows = spark.range(300).selectExpr(
        "if(id % 50 = 1, NULL, id) AS l_orderkey", "id AS l_partkey", "if(id % 60 = 7, NULL, id % 11) AS l_suppkey", "cast(id % 7 + 1 AS INT) AS l_linenumber",
        "cast(id % 50 AS DOUBLE) AS l_quantity", "timestampadd(DAY, cast(id % 13 AS INT), timestamp_ntz'2024-02-20 10:00:00') AS l_shipdate",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(11).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    folder, steps = str(tmp_path), []
    whole = sorted(map(str, catalogue_feeds.weather_history(spark, folder).collect()))
    staged = flatten.weather_rows(catalogue_feeds.weather_documents(spark, folder)).collect()

    written = catalogue_feeds.written
    monkeypatch.setattr(catalogue_feeds, "written", lambda df, name: steps.append(written(df, name)) or steps[-1])
    monkeypatch.setattr(catalogue_feeds, "DOCUMENTS_PER_SHARE", 70, raising=False)
    history = catalogue_feeds.weather_history(spark, folder)
    assert len(steps) == 5 and all(step.count() < len(staged) for step in steps)
    assert sorted(str(r) for step in steps for r in step.collect()) == sorted(map(str, staged))  # no key in two shares, nor a row in none
    assert whole and sorted(map(str, history.collect())) == whole
