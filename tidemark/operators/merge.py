"""Overwrite-in-place and close-and-insert merges."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import at
from tidemark.operators.dedupe import keep_first
from tidemark.operators.joins import current
from tidemark.session import written

STATE = "_state"
KEPT, CLOSED, OPENED = "kept", "closed", "opened"


def scd1_upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows replace existing ones on the key, whatever their age; others stay."""
    if existing is None:
        return incoming
    stay = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return stay.select(*incoming.columns).unionByName(incoming)


def differs(old: Sequence[Column], new: Sequence[Column]) -> Column:
    """NULL-safe: any pair is distinct."""
    return ~F.struct(*old).eqNullSafe(F.struct(*new))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail on the second row of a key.

    The window needs the partitioning and order of a merge join on the same keys, so
    before one it costs no shuffle of its own.  Rows of a repeated key meet in one
    task before it fails.
    """
    order = Window.partitionBy(*keys).orderBy(*keys)
    message = F.concat(F.lit("duplicate key in batch: "), F.to_json(F.struct(*keys)))
    checked = F.when(F.col("_nth") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_nth", F.row_number().over(order)).where(checked).drop("_nth")


def scd2_step(
    current_rows: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of,
    *,
    surrogate: str | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """One merge over the current versions: every row that is current or just closed.

    ``_state`` says what happened: ``kept`` (unchanged, or absent from the batch),
    ``closed`` at ``as_of``, or ``opened`` at ``as_of``.  Closed history is not an
    input: it never changes and never shuffles.  Current and incoming rows meet in
    one full outer join on the key.  ``check_unique=False`` is for a batch whose
    keys are known to be unique, such as a staged snapshot.
    """
    if check_unique:
        incoming = assert_unique(incoming, keys)
    if current_rows is None:
        return open_rows(incoming, at(as_of), surrogate).withColumn(STATE, F.lit(OPENED))
    columns = current_rows.columns
    kind = current_rows.schema["open_date"].dataType
    cast = [
        F.col(f.name).cast(f.dataType)
        for f in current_rows.schema.fields
        if f.name not in (surrogate, "open_date", "close_date")
    ]
    incoming = incoming.select(*cast)
    t = at(as_of, kind)
    return _merge_outer(current_rows, incoming, list(keys), list(tracked), t, surrogate).select(*columns, STATE)


def open_rows(incoming: DataFrame, t: Column, surrogate: str | None) -> DataFrame:
    never = F.when(F.lit(False), t)  # NULL of the same type
    out = incoming.withColumn("open_date", t).withColumn("close_date", never)
    if surrogate:
        out = out.select(F.lit(None).cast("bigint").alias(surrogate), *out.columns)
    return out


def _closing_time(open_date: Column, t: Column, kind: T.DataType) -> Column:
    late = F.raise_error(F.lit("as_of must be later than the open_date of the versions it closes"))
    return F.when(open_date < t, t).otherwise(late.cast(kind))


def _merge_outer(current_rows, incoming, keys, tracked, t, surrogate) -> DataFrame:
    columns = current_rows.columns

    def side(df: DataFrame, mark: str, name: str) -> DataFrame:
        """Keys and, beside them, a struct of all else: every row moves, so no value moves twice."""
        return df.select(*[F.col(k).alias(f"{mark}{k}") for k in keys], F.struct(*[c for c in df.columns if c not in keys]).alias(name))

    old, new = side(current_rows, "_o_", "_old"), side(incoming, "_n_", "_new")
    on = [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys]
    both = old.join(new, on, "full_outer")

    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value_of(mark: str, name: str, column: str) -> Column:
        return F.col(f"{mark}{column}") if column in keys else F.col(f"{name}.{column}")

    changed = is_old & is_new & differs(
        [value_of("_o_", "_old", c) for c in tracked], [value_of("_n_", "_new", c) for c in tracked]
    )
    schema = {f.name: f.dataType for f in current_rows.schema.fields}

    def row(state: str) -> Column:
        fields = []
        for name in columns:
            if state == OPENED:
                if name == "open_date":
                    value = t
                elif name in ("close_date", surrogate):
                    value = F.lit(None)
                else:
                    value = value_of("_n_", "_new", name)
            elif state == CLOSED and name == "close_date":
                value = _closing_time(F.col("_old.open_date"), t, schema["open_date"])
            else:
                value = value_of("_o_", "_old", name)
            fields.append(value.cast(schema[name]).alias(name))
        return F.struct(*fields, F.lit(state).alias(STATE))

    rows = (
        F.when(changed, F.array(row(CLOSED), row(OPENED)))
        .when(is_old, F.array(row(KEPT)))
        .otherwise(F.array(row(OPENED)))
    )
    return both.select(F.inline(rows))


def scd2_merge(
    history: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of,
    *,
    surrogate: str | None = None,
    surrogate_order: Sequence[str] | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """Whole history after the merge: closed rows as they were, plus :func:`scd2_step`."""
    now = None if history is None else current(history)
    step = scd2_step(now, incoming, keys, tracked, as_of, surrogate=surrogate, check_unique=check_unique)
    if surrogate:
        start = F.lit(0)
        if history is not None:
            start = F.coalesce(history.agg(F.max(surrogate)).scalar(), start)
        step = assign_surrogates(step, surrogate, surrogate_order or keys, start)
    step = step.drop(STATE)
    if history is None:
        return step
    return history.where(F.col("close_date").isNotNull()).unionByName(step)


def assign_surrogates(step: DataFrame, surrogate: str, order_by: Sequence[str], start: Column) -> DataFrame:
    """Number the opened rows from ``start`` + 1 (the largest key ever used); other rows keep theirs.

    The merge is written once to the shared folder and numbered from there.
    """
    step = written(step, "surrogates")
    opened = step.where(F.col(STATE) == OPENED)
    others = step.where(F.col(STATE) != OPENED)
    numbered = dense_numbers(opened.drop(surrogate), order_by, surrogate, start.cast("bigint"))
    return others.unionByName(numbered.select(*step.columns))


def dense_numbers(
    df: DataFrame, order_by: Sequence[str], out: str, start: Column | None = None, buckets: int | None = None, bucket: Column | None = None
) -> DataFrame:
    """Consecutive numbers start+1, start+2, ... without sorting everything in one task.

    Rows are numbered inside hash buckets of the (unique) order columns; the sizes of
    the buckets before it, one row per bucket, are added as an offset.  There are
    about as many buckets as rows in each, so neither grows faster than the root of
    the rows.  The result depends on the rows only, not on how they are partitioned,
    so a retried task gives the same numbers.
    """
    if buckets is None and bucket is None:
        buckets = 1 << math.ceil(math.log2(max(1, df.count())) / 2)
    start = F.lit(0).cast("bigint") if start is None else start
    slot = F.pmod(F.xxhash64(*order_by), F.lit(buckets)) if bucket is None else bucket
    slotted = df.withColumn("_bucket", slot.cast("bigint"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slotted.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*order_by)
    return (
        slotted.withColumn("_nth", F.row_number().over(inside))
        .join(offsets, "_bucket")
        .withColumn(out, (start + F.col("_offset") + F.col("_nth")).cast("bigint"))
        .drop("_bucket", "_offset", "_nth")
    )


def latest_attributes(feed: DataFrame, key: Sequence[str], attributes: Sequence[str], order_by: Sequence[str], conflict: str = "latest") -> DataFrame:
    """Attributes of the last feed row per entity, for a derived dimension.

    ``conflict="fail"`` raises where the rows of an entity's last moment disagree.
    """
    if conflict == "latest":
        tie_break = [F.col(c).desc_nulls_last() for c in (*order_by, *attributes)]
        return keep_first(feed.select(*key, *attributes, *order_by), key, tie_break).select(*key, *attributes)
    if conflict != "fail":
        raise ValueError("conflict is 'latest' or 'fail'")
    last = feed.groupBy(*key).agg(F.max(F.struct(*order_by)).alias("_last"))
    tied = feed.join(last, list(key)).where(F.struct(*order_by).eqNullSafe(F.col("_last")))
    return assert_unique(tied.select(*key, *attributes).distinct(), key)
