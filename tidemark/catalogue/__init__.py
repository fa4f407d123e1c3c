"""Every operator as a query over the star-schema tables, with the SQL it must equal."""

from tidemark.catalogue import feeds, history, landed, quality, reports, runs

ALL = {**feeds.QUERIES, **history.QUERIES, **quality.QUERIES, **reports.QUERIES, **runs.QUERIES, **landed.QUERIES}
