"""Landed files: names from folders, one scan for several feeds, packing, replays, counts, rejected loads."""

import json

import pytest
from pyspark.sql import functions as F

from tests.fixtures import STAMP, approach, cme, land, weather
from tidemark.operators import constraints, flatten
from tidemark.plans import feeds
from tidemark.sources import documents, store
from tidemark.streaming import ingest

T1, T2 = "2026-08-01 00:00:00", "2026-08-02 00:00:00"


def landed(spark, folder, docs):
    rows = spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v), n) for n, v in docs.items()], "value string, file_name string")
    documents.land_documents(rows, str(folder))
    return str(folder)


def test_landed_documents_have_their_names(spark, tmp_path):
    docs = {"1_20260730T140512Z.json": {"a": 1}, "2_2024-01-31_20260731T140512Z.json": "line 1\nline 2", "CME_20260730T000000Z.json": []}
    folder = landed(spark, tmp_path / "x", docs)
    land(tmp_path / "x", "3_20260730T140512Z.json", {"plain": "file"}, historical=True)
    rows = {r.file_name: r for r in documents.read_documents(spark, folder).collect()}
    assert set(rows) == {*docs, "3_20260730T140512Z.json"}
    assert rows["2_2024-01-31_20260731T140512Z.json"].value.rstrip("\n") == "line 1\nline 2"
    assert str(rows["2_2024-01-31_20260731T140512Z.json"].window_start) == "2024-01-31"
    assert [n for n, r in rows.items() if r.historical] == ["3_20260730T140512Z.json"]
    assert str(rows["CME_20260730T000000Z.json"].fetched_at) == "2026-07-30 00:00:00"


def test_small_files_are_packed(spark, tmp_path):
    folder = landed(spark, tmp_path / "x", {f"{k}_{STAMP}.json": weather(["2026-07-29"], [k]) for k in range(60)})
    docs = documents.read_documents(spark, folder)
    assert docs.count() == 60 and docs.rdd.getNumPartitions() <= 8


def test_carried_columns_stay_with_the_newest_pull(spark, tmp_path):
    land(tmp_path / "x", "1_2024-07-27_20260801T000000Z.json", weather(["2026-07-28", "2026-07-29"], [1, 2]), historical=True)
    land(tmp_path / "x", "1_20260730T000000Z.json", weather(["2026-07-29", "2026-07-30"], [3, 4]))
    rows = flatten.weather_rows(documents.read_documents(spark, str(tmp_path / "x")), carry=["historical"])
    assert sorted((str(r.date), int(r.temp_max), r.historical) for r in rows.collect()) == [("2026-07-28", 1, True), ("2026-07-29", 2, True), ("2026-07-30", 4, False)]


def executed_scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan text")


def test_several_feeds_are_one_scan(spark, tmp_path):
    w = landed(spark, tmp_path / "w", {f"1_{STAMP}.json": {"daily": {}}})
    e = land(tmp_path / "e", f"CME_{STAMP}.json", [cme("c1")])
    land(tmp_path / "e", f"gst_{STAMP}.json", [], historical=True)
    docs = documents.named_documents(spark, {"weather": w, "space": "file://" + e})
    assert executed_scans(docs) == 1
    assert sorted(r.name for r in docs.collect()) == ["space_CME", "space_GST", "weather"]


def test_a_replay_opens_only_its_files(spark, tmp_path):
    for day in range(1, 29):
        land(tmp_path / "x", f"1_202607{day:02d}T000000Z.json", weather([f"2026-07-{day:02d}"], [day]) if 10 <= day <= 12 else "no json")
    utc = lambda t: F.lit(t).cast("timestamp")
    docs = documents.read_documents(spark, str(tmp_path / "x"), fetched_from=utc("2026-07-10 00:00:00"), fetched_to=utc("2026-07-12 00:00:00"))
    assert flatten.weather_rows(docs).count() == 3
    execution = docs._jdf.queryExecution()
    list(docs.toLocalIterator())
    (scan,) = [x for x in (execution.sparkPlan().collectLeaves().apply(k) for k in range(1)) if "FileScan" in x.toString()]
    assert scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters()).head().files().size() == 3


def test_each_stage_is_counted(warehouse, spark, tmp_path):
    feeds.seed_locations(warehouse, T1)
    land(tmp_path / "d", f"1_{STAMP}.json", weather(["2026-07-29", "2026-07-30", "2026-07-30"], [24, 25, 26]))
    land(tmp_path / "d", f"9_{STAMP}.json", weather(["2026-07-29"], [1]))  # a location nobody knows
    counts = feeds.counted_weather_load(warehouse, str(tmp_path / "d"), T1, "r1").rows(spark)
    assert [(r.step, r.stage, r.rows) for r in counts.orderBy("step").collect()] == [
        (1, "documents", 2), (2, "parsed", 3), (3, "staged", 3), (4, "kept", 0), (5, "closed", 0), (6, "opened", 2),
    ]


def test_rejected_loads_name_their_error_and_others_raise(warehouse, tmp_path):
    good = land(tmp_path / "g", f"1_{STAMP}.json", weather(["2026-07-29"], [24]))
    assert feeds.rejected(lambda: feeds.stage_weather(warehouse, good)) is None
    for k, (text, error) in enumerate([(weather(["2026-07-29"], [99999.5]), "NUMERIC_VALUE_OUT_OF_RANGE"), (weather(["soon"], [1]), "CAST_INVALID_INPUT"), ("<html>", "USER_RAISED_EXCEPTION")]):
        bad = land(tmp_path / f"b{k}", f"1_{STAMP}.json", text)
        assert feeds.rejected(lambda bad=bad: feeds.stage_weather(warehouse, bad)) == error
    assert warehouse.staged_weather.version == 1
    with pytest.raises(ZeroDivisionError):
        feeds.rejected(lambda: 1 / 0)


def test_a_batch_applied_twice_changes_nothing(warehouse, spark, tmp_path):
    folder = land(tmp_path / "a", f"2026-07-30_{STAMP}.json", {"near_earth_objects": {"2026-07-30": [approach("1", "2026-07-30", 5)]}})
    land(tmp_path / "e", f"CME_{STAMP}.json", [cme("c1", [])])
    for apply, where, tables in (
        (ingest.apply_approaches(warehouse, folder), folder, ("close_approaches", "asteroids", "staged_approaches")),
        (ingest.apply_events(warehouse, str(tmp_path / "e")), str(tmp_path / "e"), ("space_events", "staged_events")),
    ):
        docs = documents.read_documents(spark, where)
        apply(docs, 0)
        before = [getattr(warehouse, t).version for t in tables]
        apply(docs, 0)
        apply(docs.limit(0), 1)
        assert [getattr(warehouse, t).version for t in tables] == before


def test_counts_of_a_stopped_run_are_not_made_up(spark):
    counts = constraints.StageCounts()
    counts.add({"staged": 3})
    counts.at("read", spark.range(5)).write.format("noop").mode("overwrite").save()
    assert [(r.stage, r.rows) for r in counts.rows(spark).orderBy("step").collect()] == [("staged", 3), ("read", 5)]


def test_a_landing_starts_no_process_per_file_and_repeats_safely(spark, tmp_path):
    docs = {"1_20260730T140512Z.json": "[1]", "a=b%c_20260730T140512Z.json": "line 1\nline 2"}
    for _ in range(2):
        folder = landed(spark, tmp_path / "x", docs)
    files = [p.relative_to(tmp_path / "x").as_posix() for p in (tmp_path / "x").rglob("*") if p.is_file()]
    assert len(files) == 2 and not [f for f in files if f.endswith(".crc")]
    assert sorted(f.split("/")[0] for f in files) == ["document=1_20260730T140512Z.json", "document=a%3Db%25c_20260730T140512Z.json"]
    assert sorted(r.value for r in documents.read_documents(spark, folder).collect()) == ["[1]\n", "line 1\nline 2\n"]


def test_landed_names_are_those_of_a_partitioned_write(spark, tmp_path):
    names = ["".join(map(chr, range(1, 128))).replace("/", "") + "/.json", "é ü.json", "", None]
    rows = spark.createDataFrame([("v", n) for n in names] + [(None, "empty.json")], "value string, file_name string")
    documents.land_documents(rows, str(tmp_path / "x"))
    rows.withColumnRenamed("file_name", "document").write.partitionBy("document").text(str(tmp_path / "y"))

    def texts(folder):
        return sorted((p.parent.name, p.read_text()) for p in folder.rglob("*.txt"))

    assert {n for n, _ in texts(tmp_path / "x")} == {n for n, _ in texts(tmp_path / "y")}
    assert set(texts(tmp_path / "x")) == {(n, "\n" if n == "document=empty.json" else "v\n") for n, _ in texts(tmp_path / "y")}


def test_listing_takes_a_few_tasks_however_many_documents(spark, tmp_path):
    folder = landed(spark, tmp_path / "x", {f"{k}_{STAMP}.json": {} for k in range(60)})
    spark.sparkContext.setJobGroup("listing", "")
    try:
        docs = documents.read_documents(spark, folder)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism
    assert docs.count() == 60


def test_many_documents_are_read_by_a_few_tasks_per_core(spark, tmp_path):
    cores, key = spark.sparkContext.defaultParallelism, "spark.sql.files.maxPartitionBytes"
    names = [f"CME_part{k}_{STAMP}.json" for k in range(10 * cores)]
    folder = landed(spark, tmp_path / "x", {n: [cme(n, [])] for n in names})
    before = spark.conf.get(key)
    spark.conf.set(key, "1")  # a file per task, as 32 are where files are many
    try:
        docs = documents.read_documents(spark, folder)
        assert docs.rdd.getNumPartitions() == 8 * cores
        assert sorted(r.event_id for r in flatten.event_rows(docs).collect()) == sorted(names)
    finally:
        spark.conf.set(key, before)


def test_the_derived_dimension_is_computed_once(warehouse, spark, tmp_path, monkeypatch):
    plans, merge = [], store.HistoryTable.merge

    def seen(self, incoming, *args, **named):
        plans.append(incoming._jdf.queryExecution().analyzed().toString())
        return merge(self, incoming, *args, **named)

    monkeypatch.setattr(store.HistoryTable, "merge", seen)
    for k, (day, at) in enumerate([("2026-07-29", T1), ("2026-07-30", T2)]):
        rocks = [approach("1", day, 5, name=f"A{k}"), approach(str(k + 2), day, 6, name="B")]
        feeds.stage_approaches(warehouse, land(tmp_path / f"{k}", f"{day}_{STAMP}.json", {"near_earth_objects": {day: rocks}}))
        feeds.derive_asteroids(warehouse, at)
    assert len(plans) == 2 and not [p for p in plans if "Window" in p or "Join" in p]  # the merge reads it twice
    assert sorted((r.asteroid_id, r.name) for r in warehouse.asteroids.current().collect()) == [("1", "A1"), ("2", "B"), ("3", "B")]
