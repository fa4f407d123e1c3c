"""Declared constraints: one aggregate pass per batch, raised before anything is written.

A rule that evaluates to NULL passes, as a table CHECK does.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators import joins


class ConstraintError(ValueError):
    """A batch broke a rule; ``counts`` holds the violations per rule."""

    def __init__(self, table: str, counts: dict[str, int]):
        super().__init__(f"{table}: " + ", ".join(f"{k} x{v}" for k, v in sorted(counts.items())))
        self.counts = counts


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str  # Spark SQL, true or NULL = fine

    @property
    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(True))


def not_null(*names: str) -> tuple[Rule, ...]:
    return tuple(Rule(f"{n}_not_null", f"{n} IS NOT NULL") for n in names)


def between(name: str, low, high) -> Rule:
    return Rule(f"{name}_range", f"{name} BETWEEN {low} AND {high}")


def non_negative(name: str) -> Rule:
    return Rule(f"{name}_non_negative", f"{name} >= 0")


def one_of(name: str, values: Sequence[str]) -> Rule:
    listed = ", ".join(f"'{v}'" for v in values)
    return Rule(f"{name}_known", f"{name} IN ({listed})")


def counters(rules: Iterable[Rule], where: Column | None = None) -> list[Column]:
    """One ``count_if`` column per rule, for an aggregate or an ``observe``."""
    keep = F.lit(True) if where is None else where
    return [F.count_if(keep & r.broken).alias(r.name) for r in rules]


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule_name, violations), one row per rule, from a single aggregate."""
    totals = df.agg(*counters(rules))
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule_name"), F.col(r.name).alias("violations")) for r in rules])
    return totals.select(F.inline(pairs))


def violating_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with the names of the rules they break."""
    names = F.array_compact(F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules]))
    return df.withColumn("broken_rules", names).where(F.size("broken_rules") > 0)


def enforce(df: DataFrame, rules: Sequence[Rule], table: str = "batch") -> DataFrame:
    """Raise :class:`ConstraintError` unless every rule holds; returns ``df``."""
    if rules:
        raise_if_broken(df.agg(*counters(rules)).first().asDict(), rules, table)
    return df


def observed(df: DataFrame, rules: Sequence[Rule], extra: Sequence[Column] = (), where: Column | None = None):
    """``df`` that counts violations (and ``extra`` aggregates) while it is written.

    Validation then costs no pass of its own: write a new version, look at the
    counts, publish it only if they are zero.
    """
    observation = Observation()
    columns = [F.count(F.lit(1)).alias("rows"), *extra, *counters(rules, where)]
    return df.observe(observation, *columns), observation


class StageCounts:
    """Rows that pass named points of a run, counted by the jobs of the run itself.

    ``at`` marks a point; ``add`` takes what a merge or a write has counted.  ``rows`` waits for
    the jobs that pass the points.
    """

    def __init__(self):
        self._points: dict[str, Observation | int] = {}

    def at(self, stage: str, df: DataFrame) -> DataFrame:
        self._points[stage] = observation = Observation()
        return df.observe(observation, F.count(F.lit(1)).alias("rows"))

    def add(self, counts: dict[str, int]) -> None:
        self._points |= counts

    def rows(self, spark) -> DataFrame:
        """(step, stage, rows), one row per point in the order of the run."""
        found = [(k, s, p if isinstance(p, int) else p.get["rows"]) for k, (s, p) in enumerate(self._points.items(), 1)]
        return spark.createDataFrame(found, "step int, stage string, rows long")


def broken(counts: dict, rules: Sequence[Rule]) -> dict:
    return {r.name: counts[r.name] for r in rules if counts.get(r.name)}


def raise_if_broken(counts: dict, rules: Sequence[Rule], table: str) -> None:
    if found := broken(counts, rules):
        raise ConstraintError(table, found)


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def current_unique_violations(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one current version."""
    return unique_violations(joins.current(history), keys)


def foreign_key_violations(df: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows whose (non-NULL) key is missing in ``parent``; ``keys`` maps child to parent columns."""
    return joins.missing_in(df, parent, keys, null_keys=False)


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill declared defaults before NOT NULL is checked."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}) if defaults else df
