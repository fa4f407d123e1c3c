"""Audits: each check returns findings as a DataFrame and never fails the run."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions.scalars import at
from tidemark.operators import joins

log = logging.getLogger("tidemark.audit")


def findings(
    rows: DataFrame, check_name: str | Column, severity: str | Column, related_table: str | None, description: Column, detected_at, run_id: str | None = None
) -> DataFrame:
    """Shape check results as finding rows."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return rows.select(
        as_col(check_name).alias("check_name"),
        as_col(severity).alias("severity"),
        F.lit(related_table).cast("string").alias("related_table"),
        description.alias("description"),
        at(detected_at).alias("detected_at"),
        F.lit(run_id).cast("string").alias("pipeline_run_id"),
    )


def union_findings(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_checks(checks: Mapping[str, Callable[[], DataFrame]], sink: Callable[[DataFrame], None]) -> list[str]:
    """Run every check into ``sink``; one that fails is logged and skipped.

    Returns the names that failed.  Findings go from executors to the sink and are
    never gathered on the driver.
    """
    failed = []
    for name, check in checks.items():
        try:
            sink(check())
        except Exception:  # a broken check must not hide the others
            log.exception("audit check %s failed", name)
            failed.append(name)
    return failed


# --- absence ----------------------------------------------------------------


def absent(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected rows without an actual one; filter ``actual`` before."""
    return expected.join(actual.select(*keys), list(keys), "left_anti")


def absent_on(dim: DataFrame, fact: DataFrame, key: str, date_col: str, day) -> DataFrame:
    """Current dimension rows without a current fact on one day."""
    present = joins.current(fact).where(F.col(date_col) == F.to_date(at(day))).select(key)
    return joins.current(dim).join(present, key, "left_anti")


# --- anomaly ----------------------------------------------------------------


def trailing_anomaly(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    value_col: str,
    days: int = fixed.ANOMALY_DAYS,
    sigmas: int | float = fixed.ANOMALY_SIGMAS,
    slice_days: int = 365,
    repeated_days: bool = False,
) -> DataFrame:
    """Rows more than ``sigmas`` sample deviations from the mean of the ``days`` days before.

    Days, not rows: gaps count as gaps, and the row's own day is left out.  Fewer
    than two earlier rows give no verdict; with a deviation of zero any change is
    flagged.

    A key's history is cut into slices of ``slice_days``, each with the last
    ``days`` days before it as context, so a key that holds a third of all rows is
    spread over its years.  Where a key may have many rows on one day, say
    ``repeated_days``: days are then summed up before they meet in a window, which
    holds at most one row per day, and only days with a flagged extreme are looked
    at row by row.

    All numeric types are compared in double precision.  Days carry their count,
    mean and sum of squared deviations; in a slice they are pooled around the
    slice's own mean, so large values and long histories neither overflow nor
    cancel.  A difference of less than one part in 10^12 of the values counts as none.
    """
    rows = df.withColumn("_day", F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date"))).withColumn("_value", F.col(value_col).cast("double"))
    if not repeated_days:
        x = F.col("_value")
        daily = rows.withColumns({"_n": F.when(x.isNotNull(), 1).otherwise(0), "_mean": x, "_m2": F.when(x.isNotNull(), F.lit(0.0))})
        scored = _pooled(daily, keys, days, slice_days)
        return scored.where(_outlier(x, sigmas)).select(*df.columns)
    per_day = rows.groupBy(*keys, "_day").agg(
        F.count("_value").alias("_n"),
        F.avg("_value").alias("_mean"),
        (F.var_pop("_value") * F.count("_value")).alias("_m2"),
        F.min("_value").alias("_low"),
        F.max("_value").alias("_high"),
    )
    scored = _pooled(per_day, keys, days, slice_days)
    suspect = scored.where(_outlier(F.col("_low"), sigmas) | _outlier(F.col("_high"), sigmas))
    met = rows.join(suspect.select(*keys, "_day", "_n", "_mean", "_m2"), [*keys, "_day"])
    return met.where(_outlier(F.col("_value"), sigmas)).select(*df.columns)


def _pooled(daily: DataFrame, keys: Sequence[str], days: int, slice_days: int) -> DataFrame:
    """Replace count, mean and squared deviations by those of the ``days`` days before."""
    near_end = F.pmod(F.col("_day"), F.lit(slice_days)) >= slice_days - days
    sliced = daily.withColumn("_own", F.floor(F.col("_day") / F.lit(slice_days)).cast("int")).withColumn(
        "_slice", F.explode(F.when(near_end, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))
    )
    whole = Window.partitionBy(*keys, "_slice")
    sliced = sliced.withColumn("_centre", F.coalesce(F.avg("_mean").over(whole), F.lit(0.0)))
    frame = Window.partitionBy(*keys, "_slice").orderBy("_day").rangeBetween(-days, -1)
    off = F.col("_mean") - F.col("_centre")
    sliced = sliced.withColumns({"_off": F.col("_n") * off, "_square": F.col("_m2") + F.col("_n") * off * off})
    n, total, squares = (F.sum(c).over(frame) for c in ("_n", "_off", "_square"))
    pooled = sliced.withColumns({"_count": n, "_total": total, "_squares": squares}).where(F.col("_slice") == F.col("_own"))
    m2 = F.greatest(F.col("_squares") - F.col("_total") * F.col("_total") / F.col("_count"), F.lit(0.0))
    mean = F.col("_centre") + F.col("_total") / F.col("_count")
    return pooled.where(F.col("_count") > 1).withColumns({"_n": F.col("_count"), "_mean": mean, "_m2": m2})


def _outlier(x: Column, sigmas: int | float) -> Column:
    """NULL (not flagged) where ``x`` is."""
    least = F.lit(1e-12) * (F.abs(x) + F.abs(F.col("_mean")))
    spread = F.sqrt(F.col("_m2") / (F.col("_n") - 1))
    return F.abs(x - F.col("_mean")) > F.lit(float(sigmas)) * spread + least


# --- cross-table ------------------------------------------------------------


def unmatched_keys(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Distinct non-NULL keys of ``left`` that ``right`` does not have.

    Keys are made distinct before the join, so a hot key is one row by then.
    """
    probe = left.select(*keys).distinct()
    return joins.missing_in(probe, right, keys, null_keys=False)


# --- success rate -----------------------------------------------------------


def success_rate(calls: DataFrame, as_of, days: int = 7, group: str = "source_name") -> DataFrame:
    """Share of successful calls per source in the trailing days, as calls, successes and rate."""
    recent = calls.where(F.col("called_at") > at(as_of, calls.schema["called_at"].dataType) - F.expr(f"INTERVAL {int(days)} DAYS"))
    counted = recent.groupBy(group).agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.coalesce(F.col("success"), F.lit(False))).alias("successes")
    )
    return counted.withColumn("rate", F.col("successes") / F.col("calls"))


def low_success_rate(calls: DataFrame, as_of, floor: float = fixed.SUCCESS_RATE_FLOOR, days: int = 7, group: str = "source_name") -> DataFrame:
    """Sources below ``floor``; the rate compared is the unrounded one."""
    low = success_rate(calls, as_of, days, group).where(F.col("rate") < floor)
    return low.select(group, F.round("rate", 3).alias("success_rate_7d"))


# --- key drift --------------------------------------------------------------


def top_level_keys(value: Column) -> Column:
    """Sorted top-level keys; of the first element for a list.  NULL where there are none to see."""
    first = F.when(F.json_array_length(value).isNotNull(), F.get_json_object(value, "$[0]")).otherwise(value)
    return F.array_sort(F.json_object_keys(first))


def unreadable(value: Column) -> Column:
    return F.json_object_keys(value).isNull() & F.json_array_length(value).isNull()


def key_drift(docs: DataFrame, reference: DataFrame, name: str = "name", value: str = "value") -> DataFrame:
    """Compare the keys of every document with its reference.

    ``docs``: (name, value); ``reference``: (name, keys ARRAY<STRING>), unique on
    name.  Result: one row per name and distinct shape, with ``missing`` and
    ``added`` keys and a severity (NULL where nothing drifted); names without a
    reference are ``info``, unreadable documents ``warning``.  Lists without
    elements have no keys to compare and get no verdict.

    Documents are reduced to distinct shapes before the join, so the work after the
    scan grows with the number of shapes, not of documents.
    """
    shapes = (
        docs.select(
            F.col(name).alias("name"), top_level_keys(F.col(value)).alias("keys"), unreadable(F.col(value)).alias("unreadable")
        )
        .where(F.col("keys").isNotNull() | F.col("unreadable"))
        .groupBy("name", "keys", "unreadable")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    ref = reference.select(F.col("name"), F.col("keys").alias("_reference"), F.lit(True).alias("_known"))
    joined = shapes.join(ref, "name", "left").withColumns(
        {
            "missing": F.array_sort(F.array_except("_reference", "keys")),
            "added": F.array_sort(F.array_except("keys", "_reference")),
        }
    )
    severity = (
        F.when(F.col("unreadable"), "warning")
        .when(F.col("_known").isNull(), "info")
        .when(F.size("missing") > 0, "warning")
        .when(F.size("added") > 0, "info")
    )
    return joined.select("name", "keys", "unreadable", "documents", "missing", "added", severity.alias("severity"))


def drift_findings(drift: DataFrame, detected_at, run_id: str | None = None) -> DataFrame:
    listed = lambda c: F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))
    text = (
        F.when(F.col("unreadable"), F.concat(F.lit("Unreadable document of "), "name", F.lit(".")))
        .when(F.col("missing").isNull(), F.concat(F.lit("First keys seen for "), "name", F.lit(": "), listed("keys"), F.lit(".")))
        .otherwise(F.concat(F.lit("Keys changed for "), "name", F.lit(": missing="), listed("missing"), F.lit(", added="), listed("added"), F.lit(".")))
    )
    return findings(
        drift.where("severity IS NOT NULL"), F.concat(F.lit("schema_drift_"), "name"), F.col("severity"), None, text, detected_at, run_id
    )


def bootstrap_reference(docs: DataFrame, reference: DataFrame | None, name: str = "name", value: str = "value") -> DataFrame:
    """Reference rows for names not seen before: the keys of their latest readable document."""
    seen = docs.select(
        F.col(name).alias("name"), top_level_keys(F.col(value)).alias("keys"), "fetched_at", "file_name"
    ).where(F.col("keys").isNotNull())
    if reference is not None:
        seen = seen.join(reference.select("name"), "name", "left_anti")
    return seen.groupBy("name").agg(F.max_by("keys", F.struct("fetched_at", "file_name")).alias("keys"))
