"""Merge scenarios and properties, for both merge plans."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import audit, constraints, joins, merge
from tidemark.operators.constraints import ConstraintError, Rule, not_null

HISTORY = "k INT, a STRING, b DECIMAL(5,2), note STRING, open_date TIMESTAMP_NTZ, close_date TIMESTAMP_NTZ"
BATCH = "k INT, a STRING, b DECIMAL(5,2), note STRING"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def batch(spark, *rows):
    from decimal import Decimal

    return spark.createDataFrame([(k, a, None if b is None else Decimal(b), n) for k, a, b, n in rows], BATCH)


def do(history, incoming, t, broadcasts):
    return merge.scd2_merge(history, incoming, ["k"], ["a", "b"], at(t))


def seen(df):
    rows = [(r.k, r.a, None if r.b is None else float(r.b), r.note, str(r.open_date), str(r.close_date)) for r in df.collect()]
    return sorted(rows, key=str)


@pytest.fixture(params=["10MB", "-1"], ids=["default", "no broadcasts"])
def broadcasts(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_load_opens_every_key_at_once(spark, broadcasts):
    got = seen(do(None, batch(spark, (1, "x", "1", "n"), (2, None, None, "n")), T1, broadcasts))
    assert got == [(1, "x", 1.0, "n", T1, "None"), (2, None, None, "n", T1, "None")]


def test_rerun_changes_nothing_not_even_untracked_columns(spark, broadcasts):
    first = do(None, batch(spark, (1, "x", "1", "old"), (2, None, None, "old")), T1, broadcasts)
    again = do(first, batch(spark, (1, "x", "1", "new"), (2, None, None, "new")), T2, broadcasts)
    assert seen(again) == seen(first)


def test_change_closes_and_opens_at_one_instant(spark, broadcasts):
    first = do(None, batch(spark, (1, "x", "1", "old"), (2, "y", "2", "old")), T1, broadcasts)
    got = seen(do(first, batch(spark, (1, "z", "1", "new")), T2, broadcasts))
    assert got == [(1, "x", 1.0, "old", T1, T2), (1, "z", 1.0, "new", T2, "None"), (2, "y", 2.0, "old", T1, "None")]


def test_null_is_a_value_for_the_change_test(spark, broadcasts):
    first = do(None, batch(spark, (1, "x", None, "o"), (2, None, "1", "o"), (3, None, None, "o")), T1, broadcasts)
    got = do(first, batch(spark, (1, "x", "5", "n"), (2, None, None, "n"), (3, None, None, "n")), T2, broadcasts)
    assert sorted((r.k, r.note) for r in joins.current(got).collect()) == [(1, "n"), (2, "n"), (3, "o")]


def test_key_with_only_closed_versions_opens_again_and_closed_rows_stay(spark, broadcasts):
    old = spark.sql(f"SELECT 1 k, 'x' a, CAST(1 AS DECIMAL(5,2)) b, 'o' note, TIMESTAMP_NTZ'{T1}' open_date, TIMESTAMP_NTZ'{T2}' close_date")
    got = seen(do(old, batch(spark, (1, "x", "1", "n")), T3, broadcasts))
    assert got == [(1, "x", 1.0, "n", T3, "None"), (1, "x", 1.0, "o", T1, T2)]


def test_time_must_move_on_for_a_change(spark, broadcasts):
    first = do(None, batch(spark, (1, "x", "1", "o")), T2, broadcasts)
    with pytest.raises(Exception, match="as_of must be later"):
        do(first, batch(spark, (1, "y", "1", "n")), T2, broadcasts).collect()


def test_duplicate_keys_in_a_batch_fail(spark, broadcasts):
    first = do(None, batch(spark, (1, "x", "1", "o")), T1, broadcasts)
    with pytest.raises(Exception, match="duplicate key in batch"):
        do(first, batch(spark, (2, "y", "1", "n"), (2, "z", "1", "n")), T2, broadcasts).collect()


def test_random_batches_keep_the_invariants(spark, broadcasts):
    """Both plans equal a plain dictionary model; versions tile time without overlap."""
    rng = random.Random(7)
    model, history = [], None
    for step in range(4):
        t = f"2024-0{step + 1}-01 00:00:00"
        rows = {k: (rng.choice(["x", "y", None]), rng.choice(["1", "2", None])) for k in rng.sample(range(12), 8)}
        for k, (a, b) in rows.items():
            b = None if b is None else float(b)
            now = next((v for v in model if v[0] == k and v[5] is None), None)
            if now and (now[1], now[2]) == (a, b):
                continue
            if now:
                now[5] = t
            model.append([k, a, b, f"s{step}", t, None])
        history = do(history, batch(spark, *[(k, a, b, f"s{step}") for k, (a, b) in rows.items()]), t, broadcasts)
        history = spark.createDataFrame(history.collect(), HISTORY)
        assert seen(history) == sorted(((*v[:4], str(v[4]), str(v[5])) for v in model), key=str)
    assert constraints.current_unique_violations(history, ["k"]).count() == 0
    overlap = history.alias("p").join(
        history.alias("q"), F.expr("p.k = q.k AND p.open_date < q.open_date AND (p.close_date IS NULL OR p.close_date > q.open_date)")
    )
    assert overlap.count() == 0


def test_plans_have_no_cartesian_or_python_step(spark):
    history = do(None, batch(spark, (1, "x", "1", "o")), T1, False)
    incoming = batch(spark, (1, "y", "1", "n"))
    for flag in (True, False):
        plan = do(history, incoming, T2, flag)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
        assert plan.count("FullOuter") == 1


def test_surrogates_continue_without_gaps(spark):
    first = merge.scd2_merge(None, batch(spark, *[(k, "x", "1", "o") for k in range(50)]), ["k"], ["a"], at(T1), surrogate="id")
    assert sorted(r.id for r in first.collect()) == list(range(1, 51))
    second = merge.scd2_merge(
        first, batch(spark, *[(k, "x" if k % 2 else "y", "1", "n") for k in range(60)]), ["k"], ["a"], at(T2), surrogate="id"
    )
    ids = {(r.k, str(r.open_date)): r.id for r in second.collect()}
    assert len(ids) == 85 and sorted(ids.values()) == list(range(1, 86))
    kept = {(r.k, str(r.open_date)): r.id for r in first.collect()}
    assert all(ids[key] == value for key, value in kept.items())


def test_upsert_is_last_load_wins_and_idempotent(spark):
    one, two = batch(spark, (1, "x", "1", "new"), (2, "y", "1", "new")), batch(spark, (1, "z", "1", "older"))
    merged = merge.scd1_upsert(one, two, ["k"])
    assert sorted((r.k, r.a) for r in merged.collect()) == [(1, "z"), (2, "y")]
    assert sorted(merge.scd1_upsert(merged, two, ["k"]).collect()) == sorted(merged.collect())
    assert merge.scd1_upsert(None, two, ["k"]).count() == 1


def test_derived_attributes_take_the_last_row_or_fail(spark):
    feed = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "x")], "id string, day int, name string")
    last = merge.latest_attributes(feed, ["id"], ["name"], ["day"])
    assert sorted(tuple(r) for r in last.collect()) == [("a", "z"), ("b", "x")]
    with pytest.raises(Exception, match="duplicate key"):
        merge.latest_attributes(feed, ["id"], ["name"], ["day"], conflict="fail").collect()


def test_constraints_count_null_as_passing_and_raise_with_counts(spark):
    df = spark.createDataFrame([(1, -5), (2, None), (None, 7)], "k int, v int")
    rules = not_null("k") + (Rule("v_positive", "v > 0"),)
    assert {r.rule_name: r.violations for r in constraints.violation_counts(df, rules).collect()} == {"k_not_null": 1, "v_positive": 1}
    with pytest.raises(ConstraintError) as caught:
        constraints.enforce(df, rules)
    assert caught.value.counts == {"k_not_null": 1, "v_positive": 1}
    assert constraints.enforce(df.where("k = 2"), rules).count() == 1


def test_spread_join_keeps_every_pair_once(spark):
    left = spark.range(1000).selectExpr("id", "if(id < 700, 1, cast(id % 5 AS INT)) AS k")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(str, left.join(right, ["k"], how).collect()))
        assert sorted(map(str, joins.spread_join(left, right, ["k"], how, 8).collect())) == plain


def test_effective_join_has_no_cartesian_and_slices_agree(spark):
    dim = spark.sql("SELECT id k, concat('v', n) v, TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(n * 20) open_date, "
                    "if(n = 9, NULL, TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(n * 20 + 20)) close_date FROM range(3) LATERAL VIEW explode(sequence(0, 9)) AS n")
    fact = spark.sql("SELECT id % 4 k, id f, TIMESTAMP_NTZ'2023-12-20 00:00:00' + make_dt_interval(id) open_date FROM (SELECT int(id) id FROM range(400))")
    plain = joins.effective_join(fact, dim, "k", take=["v"])
    sliced = joins.effective_join(fact, dim, "k", take=["v"], slice_unit="MONTH")
    assert sorted(plain.collect()) == sorted(sliced.collect())
    want = sum(1 for i in range(400) if i % 4 < 3 and i >= 12)
    assert plain.count() == want
    assert "NestedLoop" not in plain._jdf.queryExecution().executedPlan().toString()


def test_anomaly_matches_brute_force_with_gaps_ties_and_slice_borders(spark):
    import datetime as dt
    import statistics
    from decimal import Decimal

    rng = random.Random(3)
    rows, start = [], dt.date(2020, 1, 1)
    for key in range(3):
        for day in range(0, 120):
            if rng.random() < 0.7:
                value = rng.choice([10, 10, 10, 11, 30]) if key else 10 + (day == 60)
                rows.append((key, start + dt.timedelta(day), Decimal(value)))
    df = spark.createDataFrame(rows, "k int, date date, v decimal(5,2)")
    want = set()
    for key, day, value in rows:
        past = [float(v) for k, d, v in rows if k == key and 1 <= (day - d).days <= 7]
        if len(past) >= 2 and abs(float(value) - statistics.fmean(past)) > 3 * statistics.stdev(past) + 1e-9:
            want.add((key, day))
    for slice_days in (10, 365):
        exact = audit.trailing_anomaly(df, ["k"], "date", "v", slice_days=slice_days)
        assert {(r.k, r.date) for r in exact.collect()} == want
        summed = audit.trailing_anomaly(df, ["k"], "date", "v", slice_days=slice_days, repeated_days=True)
        assert {(r.k, r.date) for r in summed.collect()} == want
        as_double = df.withColumn("v", F.col("v").cast("double"))
        for repeated in (False, True):
            rough = audit.trailing_anomaly(as_double, ["k"], "date", "v", slice_days=slice_days, repeated_days=repeated)
            assert {(r.k, r.date) for r in rough.collect()} == want
    assert want


def test_anomaly_with_many_rows_a_day_keeps_every_flagged_row(spark):
    import datetime as dt

    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(10)]
    rows = [(1, d, 10 + i % 3) for d in days for i in range(20)] + [(1, days[9], 90), (1, days[9], 90), (1, days[9], -70)]
    df = spark.createDataFrame(rows, "k int, date date, v int")
    flagged = audit.trailing_anomaly(df, ["k"], "date", "v", repeated_days=True)
    assert sorted(r.v for r in flagged.collect()) == [-70, 90, 90]
    assert sorted(r.v for r in audit.trailing_anomaly(df, ["k"], "date", "v").collect()) == [-70, 90, 90]


@pytest.mark.parametrize("kind", ["bigint", "decimal(18,2)", "double", "int"])
def test_anomaly_of_large_values_and_equal_days(spark, kind):
    """Values near 10^9 with small spread, a constant stretch, and one outlier of each."""
    rows = spark.range(60).selectExpr(
        "id % 2 AS k", "date_add(date'2024-01-01', cast(id div 2 AS int)) AS d",
        f"cast(1000000000 + if(id % 2 = 0, (id div 2) % 3, 0) + if(id IN (50, 51), 40, 0) AS {kind}) AS v",
    )
    for repeated in (False, True):
        got = audit.trailing_anomaly(rows, ["k"], "d", "v", days=7, repeated_days=repeated).collect()
        assert sorted((r.k, r.d.day) for r in got) == [(0, 26), (1, 26)]


def test_anomaly_of_a_hot_key_does_not_overflow(spark):
    """One key with many rows on each of few days; the mean of a day is the middle of its range."""
    rows = spark.range(3_000_000).selectExpr(
        "1 AS k", "date_add(date'2024-01-01', cast(id % 6 AS int)) AS d",
        "cast(if(id = 5, 99999999999, 9000000000 + id % 1000) AS decimal(18,2)) AS v",
    )
    got = audit.trailing_anomaly(rows, ["k"], "d", "v", repeated_days=True).collect()
    assert [(r.k, str(r.d), int(r.v)) for r in got] == [(1, "2024-01-06", 99999999999)]


def test_sliced_join_loses_no_late_fact(spark):
    dim = spark.sql("SELECT 1 AS k, 'a' AS v, timestamp'2024-01-01 00:00:00' AS open_date, cast(NULL AS timestamp) AS close_date")
    fact = spark.sql("SELECT 1 AS k, timestamp'2044-06-01 00:00:00' AS open_date")
    assert joins.effective_join(fact, dim, "k", take=["v"], slice_unit="MONTH").count() == 1


def test_unlinked_rows_are_dealt_by_the_salt(spark):
    events = spark.range(100).selectExpr("id", "if(id % 7 = 0, id + 1, NULL) AS link", "id AS value")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.linked(events, "link", "id", {"value": "other"})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(link" in plan and "_salt" in plan.split("hashpartitioning(link")[1].split(")")[0]


def test_a_merge_moves_each_key_once(spark, broadcasts):
    first = do(None, batch(spark, (1, "x", "1", "old"), (None, "y", "2", "old")), T1, broadcasts)
    step = do(first, batch(spark, (1, "z", "1", "new"), (None, "y", "2", "new"), (3, "w", None, "new")), T2, broadcasts)
    sides = re.findall(r"struct\((\w+)[^\n]* AS _(?:old|new)#", step._jdf.queryExecution().executedPlan().toString())
    assert sides and set(sides) == {"a"}
    assert seen(step) == sorted(
        [
            (1, "x", 1.0, "old", T1, T2), (1, "z", 1.0, "new", T2, "None"), (3, "w", None, "new", T2, "None"),
            (None, "y", 2.0, "old", T1, "None"), (None, "y", 2.0, "new", T2, "None"),
        ],
        key=str,
    )


def test_a_merge_of_keys_alone(spark, broadcasts):
    """No column is left beside the key, and the key itself may be tracked."""
    first = merge.scd2_merge(None, spark.range(0, 3), ["id"], [], at(T1))
    again = merge.scd2_merge(first, spark.range(1, 5), ["id"], ["id"], at(T2))
    assert sorted((r.id, str(r.open_date), r.close_date) for r in again.collect()) == [(i, T1 if i < 3 else T2, None) for i in range(5)]


def test_a_written_table_leaves_no_shuffle_files(spark):
    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return set(re.findall(r"shuffle_(\d+)_", blocks))

    before, setting = shuffles(), spark.conf.get(session.RELEASE)
    table = session.written(spark.range(1000).selectExpr("id % 7 AS k", "id AS v").repartition(5, "k").groupBy("v").count(), "moved")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(session.RELEASE) == setting
    assert table.count() == 1000
