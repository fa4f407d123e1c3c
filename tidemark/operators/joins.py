"""Joins of versioned tables.

No broadcast hints: a dimension may grow, so Spark's own size check (static and
adaptive) decides, and large sides fall back to a shuffle join that adaptive
execution splits where a key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import at


def current(history: DataFrame) -> DataFrame:
    return history.where(F.col("close_date").isNull())


def as_of_view(history: DataFrame, as_of, open_col: str = "open_date", close_col: str = "close_date") -> DataFrame:
    """Versions in force at one instant: open <= t < close."""
    t = at(as_of, history.schema[open_col].dataType)
    return history.where((F.col(open_col) <= t) & (F.col(close_col).isNull() | (F.col(close_col) > t)))


def date_and_key_filter(
    df: DataFrame, date_col: str | None = None, start=None, end=None, key_col: str | None = None, keys: Sequence | None = None
) -> DataFrame:
    """Shared panel filter; every argument is optional and pushed down by Catalyst."""
    if start is not None:
        df = df.where(F.col(date_col) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(date_col) <= F.lit(end))
    if keys is not None:
        df = df.where(F.col(key_col).isin(list(keys)))
    return df


def resolve_current(fact: DataFrame, dim: DataFrame, key: str, take: Sequence[str]) -> DataFrame:
    """Add columns of the current dimension row; facts without one drop out (see missing_in)."""
    return fact.join(current(dim).select(key, *take), key, "inner")


def missing_in(left: DataFrame, right: DataFrame, keys: dict[str, str] | Sequence[str], null_keys: bool = True) -> DataFrame:
    """Anti join; with ``null_keys=False`` rows whose key is NULL are not reported."""
    pairs = keys if isinstance(keys, dict) else {k: k for k in keys}
    if not null_keys:
        for name in pairs:
            left = left.where(F.col(name).isNotNull())
    # distinct on the keys of the join: a hot key of the right side is one row
    probe = right.select(*[F.col(r).alias(f"_probe_{l}") for l, r in pairs.items()]).distinct()
    condition = [F.col(l) == F.col(f"_probe_{l}") for l in pairs]
    return left.join(probe, condition, "left_anti")


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", spread: int = 16) -> DataFrame:
    """Equi join whose left side may hold most rows on one key (or on NULL).

    Left rows get a salt in [0, spread); right rows are repeated once per salt, so
    a hot left key is shared by ``spread`` tasks.  Every pair is kept exactly once.
    Meant for inner, left, left_semi and left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot salt a {how} join")
    if spread <= 1:
        return left.join(right, list(keys), how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*hashable(left)), F.lit(spread)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]


def effective_join(
    fact: DataFrame, dim: DataFrame, key: str, fact_time: str = "open_date", take: Sequence[str] | None = None, slice_unit: str | None = None
) -> DataFrame:
    """Fact rows with the dimension version in force at ``fact_time``.

    The plain form is an equi join on ``key`` with the interval as a residual;
    adaptive execution splits a hot key.  Where single keys have very many
    versions, give ``slice_unit`` ("MONTH", "YEAR"): closed versions, repeated once
    per slice they cover, are then joined on the time slice too, so a fact meets
    only those of its own slice.  Open versions, at most one per key in a history,
    are joined on the key alone.
    """
    take = list(take) if take is not None else [c for c in dim.columns if c not in fact.columns]
    sided = dim.select(
        F.col(key),
        F.col("open_date").alias("_dim_open"),
        F.col("close_date").alias("_dim_close"),
        *[F.col(c).alias(f"_dim_{c}") for c in take],
    )
    if not slice_unit:
        return _in_force(fact, sided, [key], fact_time, take, fact.columns)
    first, last = (slice_number(F.col(c), slice_unit) for c in ("_dim_open", "_dim_close"))
    closed = sided.where(F.col("_dim_close") > F.col("_dim_open")).withColumn("_slice", F.explode(F.sequence(first, last)))
    sliced = fact.withColumn("_slice", slice_number(F.col(fact_time), slice_unit))
    past = _in_force(sliced, closed, [key, "_slice"], fact_time, take, fact.columns)
    return past.unionByName(_in_force(fact, sided.where(F.col("_dim_close").isNull()), [key], fact_time, take, fact.columns))


def _in_force(fact: DataFrame, sided: DataFrame, keys: Sequence[str], fact_time: str, take: Sequence[str], kept: Sequence[str]) -> DataFrame:
    t = F.col("_fact." + fact_time)
    on = [F.col(f"_fact.{k}") == F.col(f"_dim.{k}") for k in keys]
    on += [t >= F.col("_dim_open"), (t < F.col("_dim_close")) | F.col("_dim_close").isNull()]
    joined = fact.alias("_fact").join(sided.alias("_dim"), on, "inner")
    return joined.select(*[F.col(f"_fact.{c}") for c in kept], *[F.col(f"_dim._dim_{c}").alias(c) for c in take])


def slice_number(value: Column, unit: str) -> Column:
    """Whole months or years since year 0, as an integer slice key."""
    months = F.year(value) * 12 + F.month(value)
    return months if unit.upper() == "MONTH" else F.year(value)


def linked(df: DataFrame, link: str, target: str, take: dict[str, str], targets: DataFrame | None = None, spread: int = 1) -> DataFrame:
    """Left lookup of the linked row (``link`` -> ``target``); unlinked rows keep NULLs.

    Rows without a link are most of the data.  The salt is a key of the join, and
    theirs is a hash of the row, so they do not meet in the one task that a NULL key
    alone would send them to; ``spread`` shares out the rows of one hot link too.
    """
    right = (targets if targets is not None else df).select(
        F.col(target).alias("_target"), *[F.col(c).alias(a) for c, a in take.items()]
    )
    row_hash = F.xxhash64(*hashable(df))
    left = df.withColumn("_salt", F.when(F.col(link).isNull(), row_hash).otherwise(F.pmod(row_hash, F.lit(spread))))
    # a column, not a literal, also for one copy: a literal would be folded out of the keys
    last = F.when(F.col("_target").isNotNull(), spread - 1).cast("bigint")
    right = right.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    joined = left.join(right, (F.col(link) == F.col("_target")) & (F.col("_salt") == F.col("_copy")), "left")
    return joined.drop("_salt", "_target", "_copy")
