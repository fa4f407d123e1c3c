"""Merges, versions and joins of versioned tables, on customers, suppliers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalogue.base import Query, moment, shown, table
from tidemark.operators import joins, merge
from tidemark.operators.dedupe import distinct_projection
from tidemark.plans import dashboards
from tidemark.sources.seed import seed_rows

T0, T1, T2, T3 = "2023-01-01 00:00:00", "2024-01-01 00:00:00", "2024-06-01 00:00:00", "2024-07-01 00:00:00"
KEYS, TRACKED = ["c_custkey"], ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


def with_versions(df: DataFrame, opened, closed=None) -> DataFrame:
    end = closed if closed is not None else F.lit(None)
    return df.withColumn("open_date", opened).withColumn("close_date", end.cast("timestamp_ntz"))


def customer_history(spark, sf) -> DataFrame:
    """Current versions of all customers, and an older closed one of every fifth."""
    customers = table(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,2)"))
    older = customers.where("c_custkey % 5 = 0").withColumn("c_mktsegment", F.lit("OLD"))
    return with_versions(customers, moment(T1)).unionByName(with_versions(older, moment(T0), moment(T1)))


def customer_batch(spark, sf) -> DataFrame:
    """Some balances and segments changed, some customers left out, some new."""
    changed = table(spark, sf, "customer").where("c_custkey % 11 <> 0").withColumns(
        {
            "c_acctbal": F.expr("cast(c_acctbal AS DECIMAL(15,2)) + if(c_custkey % 7 = 0, 1, 0)").cast("decimal(15,2)"),
            "c_mktsegment": F.expr("if(c_custkey % 17 = 0, NULL, c_mktsegment)"),
        }
    )
    new = changed.where("c_custkey % 13 = 0").withColumn("c_custkey", F.expr("-c_custkey - 1"))
    return changed.unionByName(new)


BATCH_CTE = f"""
old AS (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal, c_mktsegment FROM customer),
chg AS (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(15,2)) AS c_acctbal,
               CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END AS c_mktsegment FROM old WHERE c_custkey % 11 <> 0),
batch AS (SELECT * FROM chg UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM chg WHERE c_custkey % 13 = 0)
"""


def merged_sql(order: str = "") -> str:
    return f"""
WITH {BATCH_CTE},
changed AS (SELECT o.c_custkey FROM old o JOIN batch b USING (c_custkey)
            WHERE o.c_acctbal IS DISTINCT FROM b.c_acctbal OR o.c_mktsegment IS DISTINCT FROM b.c_mktsegment),
merged AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'OLD' AS c_mktsegment, '{T0}' AS open_date, '{T1}' AS close_date FROM old WHERE c_custkey % 5 = 0
  UNION ALL
  SELECT {COLUMNS}, '{T1}', CASE WHEN c_custkey IN (SELECT c_custkey FROM changed) THEN '{T2}' END FROM old
  UNION ALL
  SELECT {COLUMNS}, '{T2}', NULL FROM batch WHERE c_custkey IN (SELECT c_custkey FROM changed) OR c_custkey NOT IN (SELECT c_custkey FROM old))
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment, open_date, close_date FROM merged {order}
"""


def merged(spark, sf, **options) -> DataFrame:
    return merge.scd2_merge(customer_history(spark, sf), customer_batch(spark, sf), KEYS, TRACKED, moment(T2), **options)


def scd1_upsert(spark, sf):
    existing = customer_history(spark, sf).where("close_date IS NULL").drop("open_date", "close_date")
    return shown(merge.scd1_upsert(existing, customer_batch(spark, sf), KEYS))


SCD1_SQL = f"""
WITH {BATCH_CTE}
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment FROM batch
UNION ALL
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE), c_mktsegment FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
"""


def scd2_merge(spark, sf):
    """One full outer join of current and incoming rows."""
    return shown(merged(spark, sf))


def scd2_merge_small(spark, sf):
    """A batch whose keys are known to be unique: no window before the join."""
    return shown(merged(spark, sf, check_unique=False))


def scd2_first_load(spark, sf):
    return shown(merge.scd2_merge(None, customer_batch(spark, sf), KEYS, TRACKED, moment(T2)))


FIRST_SQL = f"""
WITH {BATCH_CTE}
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment, '{T2}' AS open_date, CAST(NULL AS VARCHAR) AS close_date FROM batch
"""


def scd2_rerun(spark, sf):
    """The same batch again, later: nothing changes."""
    again = merge.scd2_merge(merged(spark, sf), customer_batch(spark, sf), KEYS, TRACKED, moment(T3))
    return shown(again)


def scd2_surrogates(spark, sf):
    """Opened versions are numbered on from the largest key ever used, without gaps."""
    numbered = merge.dense_numbers(customer_history(spark, sf), ["c_custkey", "open_date"], "customer_key")
    out = merge.scd2_merge(numbered, customer_batch(spark, sf), KEYS, TRACKED, moment(T2), surrogate="customer_key")
    return out.groupBy((F.col("open_date") == moment(T2)).alias("opened_now")).agg(
        F.min("customer_key").alias("first_key"), F.max("customer_key").alias("last_key"),
        F.count_distinct("customer_key").alias("keys"), F.count(F.lit(1)).alias("versions"),
    )


SURROGATES_SQL = f"""
WITH m AS ({merged_sql()}),
n AS (SELECT open_date = '{T2}' AS opened_now, count(*) AS versions FROM m GROUP BY 1)
SELECT opened_now, CAST(CASE WHEN opened_now THEN (SELECT versions FROM n WHERE NOT opened_now) ELSE 0 END AS BIGINT) + 1 AS first_key,
       CAST(CASE WHEN opened_now THEN (SELECT sum(versions) FROM n) ELSE versions END AS BIGINT) AS last_key, versions AS keys, versions
FROM n
"""


def surrogate_keys(spark, sf):
    """Dense numbers over buckets of the key."""
    df = table(spark, sf, "customer").select("c_custkey", "c_name")
    return merge.dense_numbers(df, ["c_custkey"], "customer_key", F.lit(1000), bucket=F.pmod("c_custkey", F.lit(64)))


SURROGATE_SQL = """
SELECT c_custkey, c_name, 1000 + row_number() OVER (ORDER BY c_custkey % 64, c_custkey) AS customer_key FROM customer
"""


def as_of_view(spark, sf):
    return shown(joins.as_of_view(merged(spark, sf), moment("2024-03-01 12:00:00")))


AS_OF_SQL = f"SELECT * FROM ({merged_sql()}) WHERE open_date <= '2024-03-01 12:00:00' AND (close_date IS NULL OR close_date > '2024-03-01 12:00:00')"


def current_versions(spark, sf):
    return shown(joins.current(merged(spark, sf)).drop("close_date"))


CURRENT_SQL = f"SELECT * EXCLUDE (close_date) FROM ({merged_sql()}) WHERE close_date IS NULL"


# --- derived dimension ----------------------------------------------------------------

ATTRIBUTES = ["l_returnflag", "l_linestatus", "l_quantity"]


def derive_dimension(spark, sf):
    """Attributes of each supplier's last line, versioned over an earlier state."""
    feed = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("decimal(15,2)"))
    last = merge.latest_attributes(feed, ["l_suppkey"], ATTRIBUTES, ["l_shipdate", "l_orderkey", "l_linenumber"])
    earlier = table(spark, sf, "supplier").where("s_suppkey % 4 <> 0").select(
        F.col("s_suppkey").alias("l_suppkey"), F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.expr("cast(s_suppkey % 50 + 1 AS DECIMAL(15,2))").alias("l_quantity"),
    )
    return shown(merge.scd2_merge(with_versions(earlier, moment(T1)), last, ["l_suppkey"], ATTRIBUTES, moment(T2)))


DERIVE_SQL = f"""
WITH last AS (
  SELECT l_suppkey, l_returnflag, l_linestatus, l_quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_returnflag DESC, l_linestatus DESC, l_quantity DESC) AS r
    FROM lineitem) WHERE r = 1),
old AS (SELECT s_suppkey AS l_suppkey, 'A' AS l_returnflag, 'F' AS l_linestatus, CAST(s_suppkey % 50 + 1 AS DOUBLE) AS l_quantity FROM supplier WHERE s_suppkey % 4 <> 0),
same AS (SELECT l_suppkey FROM old JOIN last USING (l_suppkey, l_returnflag, l_linestatus, l_quantity))
SELECT l_suppkey, l_returnflag, l_linestatus, l_quantity, '{T1}' AS open_date,
       CASE WHEN l_suppkey IN (SELECT l_suppkey FROM last) AND l_suppkey NOT IN (SELECT l_suppkey FROM same) THEN '{T2}' END AS close_date
FROM old
UNION ALL
SELECT l_suppkey, l_returnflag, l_linestatus, l_quantity, '{T2}', NULL FROM last WHERE l_suppkey NOT IN (SELECT l_suppkey FROM same)
"""


def latest_attributes(spark, sf):
    """Rows at the global latest date, distinct."""
    df = table(spark, sf, "orders")
    newest = df.agg(F.max("o_orderdate")).scalar()
    return distinct_projection(df.where(F.col("o_orderdate") == newest), ["o_custkey", "o_orderstatus", "o_orderpriority"])


LATEST_SQL = """
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
"""


def seed_dimension(spark, sf):
    """Hand-kept names put over the region table, carried to every customer."""
    schema = table(spark, sf, "region").schema
    seeds = seed_rows(spark, [(0, "Africa"), (3, "Europe"), (9, "Antarctica")], schema)
    regions = merge.scd1_upsert(table(spark, sf, "region"), seeds, ["r_regionkey"])
    nations = table(spark, sf, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "right")
    per_nation = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_n"))
    counted = nations.join(per_nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return counted.groupBy("r_regionkey", "r_name").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("customers"))


SEED_SQL = """
WITH seed AS (SELECT * FROM (VALUES (0, 'Africa'), (3, 'Europe'), (9, 'Antarctica')) AS t(r_regionkey, r_name)),
r AS (SELECT * FROM seed UNION ALL SELECT * FROM region WHERE r_regionkey NOT IN (SELECT r_regionkey FROM seed))
SELECT r_regionkey, r_name, count(c_custkey) AS customers
FROM r LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL
"""

# --- joins -------------------------------------------------------------------------------


def versioned_customers(spark, sf) -> DataFrame:
    """Two versions per customer inside the years of the orders; every fifth one ends early."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    turn = F.expr("TIMESTAMP_NTZ'1997-01-01 00:00:00' + make_dt_interval(int(c_custkey % 700))")
    first = with_versions(c.withColumn("c_mktsegment", F.lit("FIRST")), moment("1995-03-01 00:00:00"), turn)
    second = with_versions(c, turn, F.expr("if(c_custkey % 5 = 0, TIMESTAMP_NTZ'2000-01-01 00:00:00', NULL)"))
    return first.unionByName(second)


VERSIONS_CTE = """
v AS (
  SELECT c_custkey, c_name, 'FIRST' AS c_mktsegment, TIMESTAMP '1995-03-01' AS open_date, TIMESTAMP '1997-01-01' + (c_custkey % 700) * INTERVAL 1 DAY AS close_date FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '1997-01-01' + (c_custkey % 700) * INTERVAL 1 DAY, CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2000-01-01' END FROM customer)
"""


def effective(spark, sf, **options) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    return joins.effective_join(orders, versioned_customers(spark, sf), "c_custkey", "o_orderdate", ["c_name", "c_mktsegment"], **options)


def effective_join(spark, sf):
    return shown(effective(spark, sf))


def effective_join_sliced(spark, sf):
    """The same, joined on month slices too, for keys with very many versions."""
    return shown(effective(spark, sf, slice_unit="MONTH"))


EFFECTIVE_SQL = f"""
WITH {VERSIONS_CTE}
SELECT o_orderkey, o_custkey AS c_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, c_name, c_mktsegment
FROM orders JOIN v ON c_custkey = o_custkey AND o_orderdate >= open_date AND (o_orderdate < close_date OR close_date IS NULL)
"""


def approaches_by_distance(spark, sf):
    """The approach report over orders as facts and customers as versioned objects."""
    facts = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("asteroid_id"), F.col("o_orderdate").cast("date").alias("close_approach_date"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("miss_distance_km"), F.col("o_orderkey").alias("relative_velocity_kph"),
        F.col("o_orderdate").alias("open_date"), F.expr("if(o_orderstatus = 'F', o_orderdate, NULL)").alias("close_date"),
    )
    return shown(dashboards.approaches_by_distance(facts, asteroids(spark, sf)))


def asteroids(spark, sf) -> DataFrame:
    return versioned_customers(spark, sf).select(
        F.col("c_custkey").cast("string").alias("asteroid_id"), F.col("c_name").alias("name"),
        F.col("c_custkey").alias("estimated_diameter_m_max"), (F.col("c_mktsegment") == "FIRST").alias("is_potentially_hazardous"),
        "open_date", "close_date",
    )


DISTANCE_SQL = f"""
WITH {VERSIONS_CTE}
SELECT CAST(o_custkey AS VARCHAR) AS asteroid_id, c_name AS name, strftime(o_orderdate, '%Y-%m-%d') AS close_approach_date,
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS miss_distance_km, o_orderkey AS relative_velocity_kph, c_custkey AS estimated_diameter_m_max,
       c_mktsegment = 'FIRST' AS is_potentially_hazardous
FROM orders JOIN v ON c_custkey = o_custkey AND o_orderdate >= open_date AND (o_orderdate < close_date OR close_date IS NULL)
WHERE o_orderstatus <> 'F'
"""


def distance_scatter(spark, sf):
    facts = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("asteroid_id"), F.col("o_totalprice").alias("miss_distance_km"),
        F.col("o_orderkey").alias("relative_velocity_kph"), F.col("o_orderdate").alias("open_date"),
        F.expr("if(o_orderstatus = 'F', o_orderdate, NULL)").alias("close_date"),
    )
    return dashboards.distance_velocity_scatter(facts, asteroids(spark, sf))


SCATTER_SQL = f"""
WITH {VERSIONS_CTE}
SELECT o_totalprice AS miss_distance_km, o_orderkey AS relative_velocity_kph, c_custkey AS estimated_diameter_m_max
FROM orders JOIN v ON c_custkey = o_custkey AND o_orderdate >= open_date AND (o_orderdate < close_date OR close_date IS NULL)
WHERE o_orderstatus <> 'F'
"""


def current_dim_join(spark, sf):
    """Facts with the current dimension row; facts whose customer has none drop out."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return joins.resolve_current(orders, versioned_customers(spark, sf), "c_custkey", ["c_name", "c_mktsegment"])


CURRENT_DIM_SQL = f"""
WITH {VERSIONS_CTE}
SELECT o_orderkey, o_custkey AS c_custkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN v ON c_custkey = o_custkey WHERE close_date IS NULL
"""


def current_dim_join_spread(spark, sf):
    """The same join with hot fact keys shared out over several tasks."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    dim = joins.current(versioned_customers(spark, sf)).select("c_custkey", "c_name", "c_mktsegment")
    return joins.spread_join(orders, dim, ["c_custkey"], "inner", spread=8)


def linked_lookup(spark, sf):
    """Events with the event their property points to; half of them point nowhere."""
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), "event_type", F.expr("if(event_type IN ('view', 'click'), cast(get_json_object(props, '$.k') AS BIGINT), NULL)").alias("link"),
        F.col("value"),
    )
    return joins.linked(events, "link", "id", {"event_type": "linked_type", "value": "linked_value"}, spread=8)


LINKED_SQL = """
WITH e AS (SELECT event_id AS id, event_type, CASE WHEN event_type IN ('view', 'click') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS link, value FROM events)
SELECT a.id, a.event_type, a.link, a.value, b.event_type AS linked_type, b.value AS linked_value FROM e a LEFT JOIN e b ON a.link = b.id
"""

QUERIES = {
    "scd1_upsert": Query(scd1_upsert, SCD1_SQL),
    "scd2_merge": Query(scd2_merge, merged_sql()),
    "scd2_merge_small": Query(scd2_merge_small, merged_sql()),
    "scd2_first_load": Query(scd2_first_load, FIRST_SQL),
    "scd2_rerun": Query(scd2_rerun, merged_sql()),
    "scd2_surrogates": Query(scd2_surrogates, SURROGATES_SQL),
    "surrogate_keys": Query(surrogate_keys, SURROGATE_SQL),
    "as_of_view": Query(as_of_view, AS_OF_SQL),
    "current_versions": Query(current_versions, CURRENT_SQL),
    "derive_dimension": Query(derive_dimension, DERIVE_SQL),
    "latest_attributes": Query(latest_attributes, LATEST_SQL),
    "seed_dimension": Query(seed_dimension, SEED_SQL),
    "effective_join": Query(effective_join, EFFECTIVE_SQL),
    "effective_join_sliced": Query(effective_join_sliced, EFFECTIVE_SQL),
    "approaches_by_distance": Query(approaches_by_distance, DISTANCE_SQL),
    "distance_scatter": Query(distance_scatter, SCATTER_SQL),
    "current_dim_join": Query(current_dim_join, CURRENT_DIM_SQL),
    "current_dim_join_spread": Query(current_dim_join_spread, CURRENT_DIM_SQL),
    "linked_lookup": Query(linked_lookup, LINKED_SQL),
}
