"""Headerless pipe-delimited files, quoted where needed, empty = NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMAT = {"sep": "|", "escape": '"', "header": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}


#: Rows of one file; a file with newlines in its text is read by one task.
FILE_ROWS = 1_000_000


def write_flat(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists", file_rows: int = FILE_ROWS) -> None:
    """Write ``columns`` in this order, in files of bounded size; text keeps its outer blanks."""
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": "", "maxRecordsPerFile": str(file_rows)}
    df.select(*columns).write.mode(mode).options(**FORMAT, **keep).csv(path)


def read_flat(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Typed scan that fails on the first value that does not fit.

    ``multiline=False`` lets Spark split big files, for text known to hold no
    newlines.  A DATE, DECIMAL or INT that does not parse raises.
    """
    options = {"mode": "FAILFAST", "multiLine": str(multiline).lower()}
    return spark.read.schema(schema).options(**FORMAT, **options).csv(path)
