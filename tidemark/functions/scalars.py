"""Column expressions used by the feeds.  All are built-in, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import fixed_values as fixed

ColumnOrName = Column | str


def column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def at(as_of: Column | datetime | date | str, like: T.DataType | None = None) -> Column:
    """``as_of`` as a column: a literal instant, or a column passed through."""
    col = as_of if isinstance(as_of, Column) else F.lit(as_of)
    if like is not None:
        return col.cast(like)
    return col.cast("timestamp") if isinstance(as_of, str) else col


def number(value: ColumnOrName) -> Column:
    """Text to DOUBLE; NULL, blank and anything that is no number give NULL.

    A type suffix (``1d``, ``2.5f``), which a plain cast takes, is no number here.
    Digit separators (``1_0``) are not read.  Only a text with one of these letters meets the
    pattern for them.  A text that starts as no number does is not cast, as each failed cast
    throws an exception, which costs more than reading the rest of a row.
    """
    text = column(value).cast("string")
    starts = (text < ":") | text.rlike(r"^(?i:nan|inf(inity)?)[\x00-\x20]*$")  # sign, point, digits and white space come before ":"
    lettered = F.contains(text, F.lit("d")) | F.contains(text, F.lit("f")) | F.contains(text, F.lit("D")) | F.contains(text, F.lit("F"))
    return F.when(starts, F.when(~(lettered & text.rlike(r"[0-9.][dDfF]\s*$")), text.try_cast("double")))


def blank_to_null(value: ColumnOrName) -> Column:
    return F.nullif(column(value), F.lit(""))


def truthy(value: ColumnOrName) -> Column:
    """JSON value read as text -> BOOLEAN; missing, false, zero and empty are false."""
    text = column(value).cast("string")
    return F.coalesce(~text.isin("false", "0", "0.0", "", "[]", "{}"), F.lit(False))


def instant(value: ColumnOrName, strict: bool = True) -> Column:
    """ISO text with minute or second precision -> TIMESTAMP.

    ``strict`` raises on malformed text (whole batch fails); otherwise it is NULL.
    """
    text = blank_to_null(value)
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(text, fixed.INSTANT_FORMAT if strict else F.lit(fixed.INSTANT_FORMAT))


def class_score(value: ColumnOrName) -> Column:
    """Flare class text -> sortable score: rank of the letter plus magnitude / 10.

    Unknown letters give NULL and an unreadable magnitude counts as 0.  Ties of
    two-decimal magnitudes round half-even on the decimal value.
    """
    text = blank_to_null(value)
    rank = F.nullif(F.instr(F.lit(fixed.FLARE_CLASSES), F.upper(F.left(text, F.lit(1)))), F.lit(0))
    magnitude = F.coalesce(number(F.substr(text, F.lit(2))), F.lit(0.0))
    return F.bround(rank + magnitude / 10, 2)


def label(value: ColumnOrName, labels: Mapping[int, str], default: str) -> Column:
    """Lookup in a small literal map (no join); NULL and unknown codes give ``default``."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column(value)), F.lit(default))


def code_lookup(df: DataFrame, code: str, lookup: DataFrame, out: str, default: str) -> DataFrame:
    """n-1 lookup in a table of (code, label) rows, unique on code.

    No broadcast hint: the lookup is user data, so Spark's own size check decides.
    """
    named = lookup.toDF("_code", "_label")
    return (
        df.join(named, F.col(code) == F.col("_code"), "left")
        .withColumn(out, F.coalesce("_label", F.lit(default)))
        .drop("_code", "_label")
    )


def value_range(low: ColumnOrName, high: ColumnOrName) -> Column:
    return column(high) - column(low)


def is_positive(value: ColumnOrName) -> Column:
    return F.coalesce(column(value), F.lit(0)) > 0


def bucket(value: ColumnOrName, low: float, high: float, count: int) -> Column:
    """Equal-width bucket number; below ``low`` is 0, ``high`` and above is count + 1."""
    return F.width_bucket(
        column(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(count)
    )


def period_start(unit: str, value: ColumnOrName) -> Column:
    """First day of the week (Monday), month, ... as DATE."""
    return F.date_trunc(unit, column(value)).cast("date")


def severity_rank(value: ColumnOrName) -> Column:
    """Sort key: critical 0, warning 1, everything else 2."""
    col = column(value)
    return F.when(col == "critical", 0).when(col == "warning", 1).otherwise(2)


def strict_cast(name: str, kind: T.DataType, ansi: bool = True) -> Column:
    """Cast a column, raising where a value does not fit.

    An ANSI cast does that by itself, in little generated code (methods too large
    for the JIT are an order of magnitude slower); the check is spelled out only
    for sessions with ANSI mode off.
    """
    source = F.col(name)
    if ansi:
        return source.cast(kind)
    cast = source.try_cast(kind)
    message = F.format_string(f"{name}: %s does not fit {kind.simpleString()}", source.cast("string"))
    failed = source.isNotNull() & cast.isNull()
    return F.when(failed, F.raise_error(message).cast(kind)).otherwise(cast)


def conform(df: DataFrame, schema: T.StructType, only: Iterable[str] | None = None) -> DataFrame:
    """Select and cast to ``schema``; a value that does not fit fails the batch.

    With ``only``, just these columns are cast and all others stay as they are.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    ansi = df.sparkSession.conf.get("spark.sql.ansi.enabled", "true").lower() == "true"
    out = {n: strict_cast(n, k, ansi) for n, k in want.items() if have[n] != k and (only is None or n in only)}
    if only is not None:
        return df.withColumns(out)
    return df.select(*[out.get(n, F.col(n)).alias(n) for n in want])


def with_lineage(df: DataFrame, run_id: str | None, fetched: str = "fetched_at") -> DataFrame:
    """Rename the fetch time to its lineage name and stamp the run id."""
    return df.withColumnRenamed(fetched, "source_fetched_at").withColumn(
        "pipeline_run_id", F.lit(run_id).cast("string")
    )
