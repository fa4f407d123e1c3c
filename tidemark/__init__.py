"""Versioned feed analytics on Spark.

Landed JSON documents and delimited files become typed rows, staging snapshots,
close-and-insert history tables, audits and reports.  Every operator takes and
returns DataFrames, and time is always an argument (``as_of``), never ``now()``.
"""
