"""Constraints, coverage and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalogue.base import Query, moment, shown, table
from tidemark.catalogue.reports import AS_OF, CALLS_CTE, calls
from tidemark.functions import dates
from tidemark.operators import audit, constraints, coverage, joins
from tidemark.operators.constraints import Rule, between, non_negative, not_null, one_of
from tidemark.plans import dashboards

# --- constraints ----------------------------------------------------------------------

RULES = not_null("l_orderkey", "l_tax") + (
    between("l_quantity", 3, 48),
    non_negative("l_extendedprice"),
    one_of("l_returnflag", ("A", "N")),
    Rule("discount_positive", "l_discount > 0"),
    Rule("tax_order", "l_discount >= l_tax"),
    Rule("date_horizon", "l_shipdate <= TIMESTAMP_NTZ'2001-06-01 00:00:00' + INTERVAL 16 DAYS"),
)
RULE_SQL = {
    "l_orderkey_not_null": "l_orderkey IS NOT NULL",
    "l_tax_not_null": "l_tax IS NOT NULL",
    "l_quantity_range": "l_quantity BETWEEN 3 AND 48",
    "l_extendedprice_non_negative": "l_extendedprice >= 0",
    "l_returnflag_known": "l_returnflag IN ('A', 'N')",
    "discount_positive": "l_discount > 0",
    "tax_order": "l_discount >= l_tax",
    "date_horizon": "l_shipdate <= TIMESTAMP '2001-06-17'",
}


def checked_lines(spark, sf) -> DataFrame:
    """Lines with a NULL tax where the tax is 0: NULL passes a check but not NOT NULL."""
    return table(spark, sf, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))


LINES_CTE = "t AS (SELECT * REPLACE (nullif(l_tax, 0) AS l_tax) FROM lineitem)"


def constraint_violations(spark, sf):
    return constraints.violation_counts(checked_lines(spark, sf), RULES)


VIOLATIONS_SQL = f"WITH {LINES_CTE} " + " UNION ALL ".join(
    f"SELECT '{name}' AS rule_name, count(*) FILTER (WHERE NOT coalesce({p}, true)) AS violations FROM t" for name, p in RULE_SQL.items()
)


def violating_rows(spark, sf):
    broken = constraints.violating_rows(checked_lines(spark, sf), RULES)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return broken.select(*keys, F.array_join("broken_rules", ",").alias("broken_rules"))


BROKEN = ", ".join(f"CASE WHEN NOT coalesce({p}, true) THEN '{name}' END" for name, p in RULE_SQL.items())
VIOLATING_SQL = f"""
WITH {LINES_CTE}, b AS (SELECT *, concat_ws(',', {BROKEN}) AS broken_rules FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, broken_rules FROM b WHERE broken_rules <> ''
"""


def unique_violations(spark, sf):
    return constraints.unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


UNIQUE_SQL = "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"


def current_unique_violations(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("close_date", F.expr("if(l_linestatus = 'F', l_shipdate, NULL)"))
    return constraints.current_unique_violations(lines, ["l_orderkey", "l_linenumber"])


CURRENT_UNIQUE_SQL = "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem WHERE l_linestatus <> 'F' GROUP BY ALL HAVING count(*) > 1"


def shifted_orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.expr("if(o_orderkey % 10 = 0, NULL, o_custkey + 3)").alias("o_custkey"))


def fk_violations(spark, sf):
    return constraints.foreign_key_violations(shifted_orders(spark, sf), table(spark, sf, "customer"), {"o_custkey": "c_custkey"})


FK_SQL = """
SELECT o_orderkey, o_custkey + 3 AS o_custkey FROM orders WHERE o_orderkey % 10 <> 0 AND o_custkey + 3 NOT IN (SELECT c_custkey FROM customer)
"""


def missing_rows(spark, sf):
    """Anti join that also reports rows whose key is NULL."""
    return joins.missing_in(shifted_orders(spark, sf), table(spark, sf, "customer"), {"o_custkey": "c_custkey"})


MISSING_SQL = """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey + 3 END AS o_custkey FROM orders)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = t.o_custkey)
"""


def defaults(spark, sf):
    df = checked_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_tax")
    return constraints.with_defaults(df, {"l_tax": 0.0})


DEFAULTS_SQL = f"WITH {LINES_CTE} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(l_tax, 0) AS l_tax FROM t"

# --- coverage -----------------------------------------------------------------------------


def window_coverage(spark, sf):
    """Orders per 30-day window over a span wider than the data."""
    start, end = F.lit("1994-10-01").cast("date"), F.lit("2001-12-31").cast("date")
    return shown(coverage.window_counts(table(spark, sf, "orders"), "o_orderdate", start, end, 30))


WINDOW_SQL = """
WITH w AS (SELECT CAST(n AS INTEGER) AS window_no, DATE '1994-10-01' + CAST(30 * n AS INTEGER) AS window_start FROM range(0, 89) AS r(n)),
c AS (SELECT date_diff('day', DATE '1994-10-01', CAST(o_orderdate AS DATE)) // 30 AS window_no, count(*) AS n FROM orders GROUP BY 1)
SELECT window_no, strftime(window_start, '%Y-%m-%d') AS window_start, strftime(least(window_start + 29, DATE '2001-12-31'), '%Y-%m-%d') AS window_end, coalesce(n, 0) AS rows
FROM w LEFT JOIN c USING (window_no) WHERE window_start <= DATE '2001-12-31'
"""


def backfill_windows(spark, sf):
    """The rolling backfill span that ends shortly before the last order, in windows, with its orders."""
    orders = table(spark, sf, "orders")
    newest = orders.agg(F.max("o_orderdate").cast("date")).scalar()
    start, end = dates.backfill_span(newest)
    return shown(coverage.window_counts(orders, "o_orderdate", start, end, 30))


BACKFILL_SQL = """
WITH s AS (SELECT CAST(max(o_orderdate) AS DATE) - 5 AS last FROM orders),
b AS (SELECT last, CAST(last - INTERVAL 24 MONTH AS DATE) AS first FROM s),
w AS (SELECT CAST(n AS INTEGER) AS window_no, first + CAST(30 * n AS INTEGER) AS window_start, last FROM b, range(0, 26) AS r(n)),
c AS (SELECT date_diff('day', first, CAST(o_orderdate AS DATE)) // 30 AS window_no, count(*) AS n FROM orders, b
      WHERE CAST(o_orderdate AS DATE) BETWEEN first AND last GROUP BY 1)
SELECT window_no, strftime(window_start, '%Y-%m-%d') AS window_start, strftime(least(window_start + 29, last), '%Y-%m-%d') AS window_end, coalesce(n, 0) AS rows
FROM w LEFT JOIN c USING (window_no) WHERE window_start <= last
"""


def rolling_window(spark, sf):
    """Rows of the last seven inclusive days."""
    events = table(spark, sf, "events")
    kept = events.where(dates.trailing_days("ts", moment("2024-01-31 00:00:00"), 7))
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


ROLLING_SQL = """
SELECT event_type, count(*) AS rows FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-25' AND DATE '2024-01-31' GROUP BY 1
"""


FIRST_DAY, LAST_DAY = "2024-01-01", "2024-02-02"


def coverage_gaps(spark, sf):
    events = table(spark, sf, "events")
    return shown(coverage.missing_days(events, events, ["user_id"], "ts", F.lit(FIRST_DAY), F.lit(LAST_DAY)))


GAPS_SQL = """
SELECT user_id, strftime(d, '%Y-%m-%d') AS day
FROM (SELECT DISTINCT user_id FROM events) AS u, generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) AS s(d)
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND date_trunc('day', e.ts) = d)
"""


def gap_runs(spark, sf):
    """Runs of consecutive days without events."""
    events = table(spark, sf, "events")
    return shown(coverage.gaps(events, events, ["user_id"], "ts", F.lit(FIRST_DAY), F.lit(LAST_DAY)))


RUNS_SQL = f"""
WITH g AS ({GAPS_SQL}),
i AS (SELECT user_id, CAST(day AS DATE) AS d, CAST(day AS DATE) - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM g)
SELECT user_id, strftime(min(d), '%Y-%m-%d') AS first_day, strftime(max(d), '%Y-%m-%d') AS last_day, CAST(count(*) AS INTEGER) AS days FROM i GROUP BY user_id, island
"""


def absence(spark, sf):
    """Customers without a current order on one day."""
    day = F.lit("1998-06-15")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("location_key"), "c_name", F.lit(None).cast("timestamp").alias("close_date"))
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("location_key"), F.col("o_orderdate").cast("date").alias("date"),
        F.expr("if(o_orderstatus = 'F', o_orderdate, NULL)").alias("close_date"),
    )
    return audit.absent_on(customers, orders, "location_key", "date", day.cast("date")).select("location_key", "c_name")


ABSENCE_SQL = """
SELECT c_custkey AS location_key, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-06-15' AND o_orderstatus <> 'F')
"""


def expected_rows(spark, sf):
    """Suppliers x days that should have a line but do not (days of one month)."""
    days = F.explode(F.sequence(F.lit("1998-06-01").cast("date"), F.lit("1998-06-30").cast("date")))
    expected = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), days.alias("day"))
    shipped = F.col("l_shipdate")
    month = table(spark, sf, "lineitem").where((shipped >= moment("1998-06-01 00:00:00")) & (shipped < moment("1998-07-01 00:00:00")))
    actual = month.select("l_suppkey", shipped.cast("date").alias("day")).distinct()
    return shown(audit.absent(expected, actual, ["l_suppkey", "day"]))


EXPECTED_SQL = """
SELECT s_suppkey AS l_suppkey, strftime(d, '%Y-%m-%d') AS day
FROM supplier, generate_series(TIMESTAMP '1998-06-01', TIMESTAMP '1998-06-30', INTERVAL 1 DAY) AS s(d)
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_shipdate = d)
"""

# --- anomaly ---------------------------------------------------------------------------------


def daily_peaks(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date").alias("date")
    return lines.groupBy("l_suppkey", day).agg(F.max(F.col("l_extendedprice").cast("decimal(12,2)")).alias("peak"))


def trailing_anomaly(spark, sf):
    return shown(audit.trailing_anomaly(daily_peaks(spark, sf), ["l_suppkey"], "date", "peak"))


ANOMALY_SQL = """
WITH p AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, max(CAST(l_extendedprice AS DECIMAL(12,2))) AS peak FROM lineitem GROUP BY ALL),
c AS (SELECT *, CAST(peak * 100 AS HUGEINT) AS x FROM p),
w AS (SELECT *, count(x) OVER f AS n, CAST(sum(x) OVER f AS HUGEINT) AS s, CAST(sum(x * x) OVER f AS HUGEINT) AS q FROM c
      WINDOW f AS (PARTITION BY l_suppkey ORDER BY date RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT l_suppkey, strftime(date, '%Y-%m-%d') AS date, CAST(peak AS DOUBLE) AS peak FROM w
WHERE (n - 1) * (n * x - s) * (n * x - s) > 9 * n * (n * q - s * s)
"""



def trailing_anomaly_rows(spark, sf):
    """The same over all lines of a supplier, many of them on one day."""
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )
    return shown(audit.trailing_anomaly(lines, ["l_suppkey"], "date", "price", sigmas=2, repeated_days=True))


ANOMALY_ROWS_SQL = """
WITH c AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS date, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
                  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS HUGEINT) AS x FROM lineitem),
w AS (SELECT *, count(x) OVER f AS n, CAST(sum(x) OVER f AS HUGEINT) AS s, CAST(sum(x * x) OVER f AS HUGEINT) AS q FROM c
      WINDOW f AS (PARTITION BY l_suppkey ORDER BY date RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, strftime(date, '%Y-%m-%d') AS date, CAST(price AS DOUBLE) AS price FROM w
WHERE (n - 1) * (n * x - s) * (n * x - s) > 4 * n * (n * q - s * s)
"""

# --- cross-table, reliability --------------------------------------------------------------------


def xtable_missing(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.expr("if(l_linenumber = 7, NULL, l_suppkey + l_linenumber)").alias("l_suppkey"))
    return audit.unmatched_keys(lines, table(spark, sf, "supplier"), {"l_suppkey": "s_suppkey"})


XTABLE_SQL = """
SELECT DISTINCT l_suppkey + l_linenumber AS l_suppkey FROM lineitem
WHERE l_linenumber <> 7 AND l_suppkey + l_linenumber NOT IN (SELECT s_suppkey FROM supplier)
"""


def rate_below_threshold(spark, sf):
    return audit.low_success_rate(calls(spark, sf), AS_OF, floor=0.8)


BELOW_SQL = f"""
WITH {CALLS_CTE}
SELECT source_name, round(count(*) FILTER (WHERE success) / count(*), 3) AS success_rate_7d FROM calls
WHERE called_at > TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS GROUP BY 1 HAVING count(*) FILTER (WHERE success) / count(*) < 0.8
"""

# --- key drift -------------------------------------------------------------------------------------


def drift_documents(spark, sf) -> DataFrame:
    """Per event: its properties, with keys added, replaced or broken by event kind and number."""
    value = F.expr(
        "CASE WHEN event_type = 'view' THEN props WHEN event_type = 'click' THEN concat('[', props, ',{\"z\":1}]')"
        " WHEN event_type = 'error' THEN if(event_id % 2 = 0, props, '{\"j\":1,\"a\":2}')"
        " WHEN event_type = 'signup' THEN if(event_id % 3 = 0, '{\"k\":', '{\"k\":1,\"new\":2}') ELSE if(event_id % 2 = 0, '[]', props) END"
    )
    return table(spark, sf, "events").select(F.col("event_type").alias("name"), value.alias("value"), F.col("ts").alias("fetched_at"), F.col("event_id").cast("string").alias("file_name"))


def drift_reference(spark, sf) -> DataFrame:
    kinds = table(spark, sf, "events").select(F.col("event_type").alias("name")).distinct()
    return kinds.where("name <> 'purchase'").withColumn("keys", F.array(F.lit("k")))


def _drift(spark, sf) -> DataFrame:
    return audit.key_drift(drift_documents(spark, sf), drift_reference(spark, sf))


def key_drift(spark, sf):
    text = lambda c: F.array_join(c, ",").alias(c)
    return _drift(spark, sf).select("name", text("keys"), "unreadable", "documents", text("missing"), text("added"), "severity")


DRIFT_CTE = """
d AS (SELECT event_type AS name, CASE WHEN event_type IN ('view', 'click') THEN 'k' WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'k' ELSE 'a,j' END
             WHEN event_type = 'signup' THEN CASE WHEN event_id % 3 <> 0 THEN 'k,new' END WHEN event_id % 2 <> 0 THEN 'k' END AS keys,
             event_type = 'signup' AND event_id % 3 = 0 AS unreadable FROM events),
drift AS (
  SELECT name, keys, unreadable, count(*) AS documents,
         CASE WHEN name <> 'purchase' AND keys IS NOT NULL THEN CASE WHEN keys = 'a,j' THEN 'k' ELSE '' END END AS missing,
         CASE WHEN name <> 'purchase' AND keys IS NOT NULL THEN CASE keys WHEN 'a,j' THEN 'a,j' WHEN 'k,new' THEN 'new' ELSE '' END END AS added,
         CASE WHEN unreadable THEN 'warning' WHEN name = 'purchase' THEN 'info' WHEN keys = 'a,j' THEN 'warning' WHEN keys = 'k,new' THEN 'info' END AS severity
  FROM d WHERE keys IS NOT NULL OR unreadable GROUP BY ALL)
"""
DRIFT_SQL = f"WITH {DRIFT_CTE} SELECT * FROM drift"


def drift_bootstrap(spark, sf):
    """Keys of the newest readable document of every kind without a reference."""
    reference = drift_reference(spark, sf).where("name IN ('view', 'click')")
    learned = audit.bootstrap_reference(drift_documents(spark, sf), reference)
    return learned.select("name", F.array_join("keys", ",").alias("keys"))


BOOTSTRAP_SQL = """
WITH d AS (SELECT event_type AS name, ts, CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'k' ELSE 'a,j' END
             WHEN event_type = 'signup' THEN CASE WHEN event_id % 3 <> 0 THEN 'k,new' END WHEN event_id % 2 <> 0 THEN 'k' END AS keys
           FROM events WHERE event_type NOT IN ('view', 'click'))
SELECT name, arg_max(keys, ts) AS keys FROM d WHERE keys IS NOT NULL GROUP BY 1
"""

# --- findings ------------------------------------------------------------------------------------------


def all_findings(spark, sf) -> DataFrame:
    """Findings of four checks over the whole tables, as one table."""
    detected = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    missing = audit.findings(
        fk_violations(spark, sf), "xtable_customer", "warning", "orders",
        F.format_string("order %s names customer %s, who is unknown.", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")), detected, "run-1",
    )
    repeated = audit.findings(
        unique_violations(spark, sf), "duplicate_line", "info", "lineitem",
        F.format_string("line %s of order %s occurs %s times.", F.col("l_linenumber").cast("string"), F.col("l_orderkey").cast("string"), F.col("rows").cast("string")), detected, "run-1",
    )
    slow = audit.findings(
        rate_below_threshold(spark, sf), "trend_success_rate", "critical", "calls", F.format_string("Source %s is below 0.80.", "source_name"), detected, "run-1",
    )
    drift = audit.drift_findings(_drift(spark, sf), detected, "run-1")
    return audit.union_findings([missing, repeated, slow, drift])


FINDINGS_CTE = f"""
{CALLS_CTE}, {DRIFT_CTE},
findings AS (
  SELECT 'xtable_customer' AS check_name, 'warning' AS severity, 'orders' AS related_table, 'order ' || o_orderkey || ' names customer ' || o_custkey || ', who is unknown.' AS description
  FROM ({FK_SQL})
  UNION ALL
  SELECT 'duplicate_line', 'info', 'lineitem', 'line ' || l_linenumber || ' of order ' || l_orderkey || ' occurs ' || rows || ' times.' FROM ({UNIQUE_SQL})
  UNION ALL
  SELECT 'trend_success_rate', 'critical', 'calls', 'Source ' || source_name || ' is below 0.80.' FROM ({BELOW_SQL})
  UNION ALL
  SELECT 'schema_drift_' || name, severity, NULL,
         CASE WHEN unreadable THEN 'Unreadable document of ' || name || '.' WHEN missing IS NULL THEN 'First keys seen for ' || name || ': [' || replace(keys, ',', ', ') || '].'
              ELSE 'Keys changed for ' || name || ': missing=[' || replace(missing, ',', ', ') || '], added=[' || replace(added, ',', ', ') || '].' END
  FROM drift WHERE severity IS NOT NULL)
"""


def findings_union(spark, sf):
    return shown(all_findings(spark, sf))


FINDINGS_SQL = f"WITH {FINDINGS_CTE} SELECT *, '2024-01-31 00:00:00' AS detected_at, 'run-1' AS pipeline_run_id FROM findings"


def findings_by_check(spark, sf):
    return dashboards.findings_by_check(all_findings(spark, sf))


BY_CHECK_SQL = f"WITH {FINDINGS_CTE} SELECT check_name, count(*) AS findings FROM findings GROUP BY 1"


def drift_by_source(spark, sf):
    return dashboards.findings_by_check(all_findings(spark, sf), "schema_drift_")


DRIFT_BY_SQL = f"WITH {FINDINGS_CTE} SELECT check_name, count(*) AS findings FROM findings WHERE check_name LIKE 'schema_drift_%' GROUP BY 1"


def recent_findings(spark, sf):
    return shown(dashboards.recent_findings(all_findings(spark, sf)))


RECENT_FINDINGS_SQL = f"""
WITH {FINDINGS_CTE}
SELECT '2024-01-31 00:00:00' AS detected_at, severity, check_name, related_table, description FROM findings
ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END, check_name, description LIMIT 100
"""

QUERIES = {
    "constraint_violations": Query(constraint_violations, VIOLATIONS_SQL),
    "violating_rows": Query(violating_rows, VIOLATING_SQL),
    "unique_violations": Query(unique_violations, UNIQUE_SQL),
    "current_unique_violations": Query(current_unique_violations, CURRENT_UNIQUE_SQL),
    "fk_violations": Query(fk_violations, FK_SQL),
    "missing_rows": Query(missing_rows, MISSING_SQL),
    "defaults": Query(defaults, DEFAULTS_SQL),
    "window_coverage": Query(window_coverage, WINDOW_SQL),
    "backfill_windows": Query(backfill_windows, BACKFILL_SQL),
    "rolling_window": Query(rolling_window, ROLLING_SQL),
    "coverage_gaps": Query(coverage_gaps, GAPS_SQL),
    "gap_runs": Query(gap_runs, RUNS_SQL),
    "absence": Query(absence, ABSENCE_SQL),
    "expected_rows": Query(expected_rows, EXPECTED_SQL),
    "trailing_anomaly": Query(trailing_anomaly, ANOMALY_SQL),
    "trailing_anomaly_rows": Query(trailing_anomaly_rows, ANOMALY_ROWS_SQL),
    "xtable_missing": Query(xtable_missing, XTABLE_SQL),
    "rate_below_threshold": Query(rate_below_threshold, BELOW_SQL),
    "key_drift": Query(key_drift, DRIFT_SQL),
    "drift_bootstrap": Query(drift_bootstrap, BOOTSTRAP_SQL),
    "findings_union": Query(findings_union, FINDINGS_SQL),
    "findings_by_check": Query(findings_by_check, BY_CHECK_SQL),
    "drift_by_source": Query(drift_by_source, DRIFT_BY_SQL),
    "recent_findings": Query(recent_findings, RECENT_FINDINGS_SQL),
}
