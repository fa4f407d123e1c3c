"""Run catalogue queries on Spark and their SQL on DuckDB, and compare the rows."""

import datetime
import math
from decimal import Decimal
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (float, Decimal)):
        value = float(value)
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    if isinstance(value, int):
        return repr(float(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return str(value)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(query, spark, con, sf_dir):
    """None if equal, else a message."""
    df = query.run(spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(query.sql)
    names = [d[0] for d in cursor.description]
    want = normal(cursor.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:2]
        lacking = [r for r in want if r not in set(got)][:2]
        return f"rows {len(got)} != {len(want)}; extra {extra}; lacking {lacking}"
    for a, b in zip(got, want):
        if a != b:
            return f"{sorted(df.columns)}: {a} != {b}"
    return None if got else "no rows"
