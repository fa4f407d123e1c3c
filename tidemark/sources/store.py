"""Parquet tables published by a small manifest, so a reader never sees half a batch.

A write goes to a new ``v=<n>`` folder in one Spark job.  Only when the job and the
rules have passed is ``_commits/<n>.json`` put in place; it names the folders that
make up the table.  Old folders stay, so a lost executor or a failed batch leaves
the last version as it was.

Rows lie in slices, a SQL expression over the key.  A write reads and rewrites only
the slices its batch touches.  History tables keep current and closed rows apart;
closed rows are only ever appended.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import at
from tidemark.operators import constraints, merge
from tidemark.operators.merge import CLOSED, KEPT, OPENED, STATE
from tidemark.schemas import History, Staging

PART, SLICE = "_part", "_slice"


class Folder:
    """Files below one path, through the Hadoop file system the session uses."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        path = self._path(name)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Create a file whole: written aside, then renamed; an existing name is a lost race.

        The check and the rename are two steps: safe with one writer per table, or on a file
        system whose rename fails on an existing name (HDFS), not on an object store.
        """
        target, aside = self._path(name), self._path(f"{name}.tmp")
        stream = self._fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            raise RuntimeError(f"another writer published {name} in {self.path}")


    def settle(self, aside: str, name: str | None) -> None:
        """Rename a folder written aside into place, or remove it.

        A rename is whole on a file system such as HDFS; on an object store it is a copy
        of each file, during which readers may see part of the batch.
        """
        if name is None:
            self._fs.delete(self._path(aside), True)
        elif not self._fs.rename(self._path(aside), self._path(name)):
            raise RuntimeError(f"could not publish {name} in {self.path}")


class VersionedTable:
    """A table whose content is the newest manifest.

    Manifest: ``version``; ``current`` and ``closed`` folders; ``marks``, numbers
    kept with the data (stream batches applied, source versions merged, ...).
    """

    def __init__(self, spark: SparkSession, path: str, table: Staging | History):
        self.spark, self.path, self.table = spark, path.rstrip("/"), table
        self.schema = table.schema
        self.slice_of = F.expr(table.slice_by)
        self.folder = Folder(spark, path)

    # --- manifests ---------------------------------------------------------

    @property
    def version(self) -> int:
        names = self.folder.names("_commits")
        return max((int(n[:12]) for n in names if n.endswith(".json")), default=0)

    def manifest(self) -> dict:
        newest = self.version
        if not newest:
            return {"version": 0, "current": {}, "closed": [], "marks": {}}
        return json.loads(self.folder.read(f"_commits/{newest:012d}.json"))

    def publish(self, old: dict, current: dict, closed: Sequence[str] = (), marks: dict | None = None) -> None:
        new = {
            "version": old["version"] + 1,
            "current": {**old["current"], **current},
            "closed": [*old["closed"], *closed],
            "marks": {**old["marks"], **(marks or {})},
        }
        self.folder.publish(f"_commits/{new['version']:012d}.json", json.dumps(new))

    def fresh_folder(self, kind: str, version: int) -> str:
        """A folder no earlier attempt has written to."""
        stem = f"{kind}={version:012d}"
        return f"{stem}-{sum(n.startswith(stem) for n in self.folder.names(''))}"

    def slices(self, folder: str) -> dict[str, str]:
        names = [n for n in self.folder.names(folder) if n.startswith(f"{SLICE}=")]
        return {n.removeprefix(f"{SLICE}="): f"{folder}/{n}" for n in names}

    # --- reads -------------------------------------------------------------

    def load(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        # Folder names are not columns, and a closed folder is read with its slices.
        reader = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true")
        return reader.parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, since: int = 0) -> DataFrame:
        """Every row; ``since`` leaves out slices not written after that version."""
        m = self.manifest()
        fresh = [f for f in m["current"].values() if int(f[2:14]) > since]
        return self.load([*fresh, *(m["closed"] if not since else [])])

    def current(self, slices: Sequence[str] | None = None) -> DataFrame:
        """Current rows only; closed files are not listed, let alone read."""
        found = self.manifest()["current"]
        return self.load([f for s, f in found.items() if slices is None or s in slices])

    def write_sliced(self, df: DataFrame, folder: str, by: Sequence[str] = (SLICE,)) -> None:
        """Rebalancing gives whole files per slice and splits a slice that is hot."""
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{self.path}/{folder}")


class Snapshot(VersionedTable):
    """Staging table: incoming rows replace those of the same key."""

    def upsert(self, incoming: DataFrame, batch: tuple[str, int] | None = None) -> dict:
        """Rules, then replace-or-insert; all or nothing.  Returns what was counted.

        The batch is landed first, so its documents are parsed once and the slices
        it touches are known from its folders.
        """
        m, keys = self.manifest(), self.table.keys
        if already_applied(m, batch):
            return {"rows": 0}
        rows = merge.assert_unique(incoming.select(*self.schema.fieldNames()), keys)
        watched, seen = constraints.observed(rows, self.table.rules)
        landed = self.fresh_folder("v", m["version"] + 1)
        self.write_sliced(watched.withColumn(SLICE, self.slice_of), landed)
        counts = seen.get
        constraints.raise_if_broken(counts, self.table.rules, self.table.name)
        slices = self.slices(landed)
        standing = [m["current"][s] for s in slices if s in m["current"]]
        if standing:  # slices seen for the first time stay as they landed
            arrived = self.load([f for s, f in slices.items() if s in m["current"]])
            merged = merge.scd1_upsert(self.load(standing), arrived, keys)
            folder = self.fresh_folder("v", m["version"] + 1)
            self.write_sliced(merged.withColumn(SLICE, self.slice_of), folder)
            slices |= self.slices(folder)
        if slices:
            self.publish(m, slices, marks=batch_mark(batch))
        return counts


class HistoryTable(VersionedTable):
    """Close-and-insert table."""

    def merge(self, incoming: DataFrame, as_of, batch: tuple[str, int] | None = None, marks: dict | None = None, check_unique: bool = False) -> dict:
        """Close-and-insert ``incoming`` at ``as_of``; all or nothing.  Returns rows per state.

        A staged snapshot is unique on its key; for other input say ``check_unique``.

        ``incoming`` must be cheap to read again (a staged snapshot): its slices are
        listed first, at most one name per slice of the calendar or hash.
        """
        table, m = self.table, self.manifest()
        nothing = dict.fromkeys((KEPT, CLOSED, OPENED), 0)
        if already_applied(m, batch):
            return nothing
        touched = [r[0] for r in incoming.select(self.slice_of.alias(SLICE)).distinct().collect()]
        if not touched:
            return nothing
        standing = [m["current"][s] for s in touched if s in m["current"]]
        incoming = constraints.with_defaults(incoming, table.defaults)
        step = merge.scd2_step(
            self.load(standing) if standing else None,
            incoming,
            table.keys,
            table.tracked,
            at(as_of, T.TimestampType()),
            surrogate=table.surrogate,
            check_unique=check_unique,
        )
        if table.surrogate:
            step = merge.assign_surrogates(step, table.surrogate, table.keys, F.lit(m["marks"].get("max_key", 0)))
        step = step.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields], STATE)

        extra = [F.count_if(F.col(STATE) == s).alias(s) for s in (KEPT, CLOSED, OPENED)]
        extra.append(F.max(F.unix_micros("open_date")).alias("latest"))
        if table.surrogate:
            extra.append(F.max(table.surrogate).alias("max_key"))
        watched, seen = constraints.observed(step, table.rules, extra, where=F.col(STATE) == OPENED)
        part = F.when(F.col(STATE) == CLOSED, "closed").otherwise("current")
        folder = self.fresh_folder("v", m["version"] + 1)
        self.write_sliced(watched.withColumns({PART: part, SLICE: self.slice_of}).drop(STATE), folder, (PART, SLICE))
        counts = seen.get
        constraints.raise_if_broken(counts, table.rules, table.name)

        notes = {**(marks or {}), **batch_mark(batch), "latest": max(counts["latest"] or 0, m["marks"].get("latest", 0))}
        if table.surrogate:
            notes["max_key"] = max(counts["max_key"] or 0, m["marks"].get("max_key", 0))
        closed = [f"{folder}/{PART}=closed"] if counts[CLOSED] else []
        self.publish(m, self.slices(f"{folder}/{PART}=current"), closed, notes)
        return {state: counts[state] for state in (KEPT, CLOSED, OPENED)}


class Log:
    """Append-only rows, one folder per batch and day."""

    def __init__(self, spark: SparkSession, path: str, table: Staging, day: str):
        self.spark, self.path, self.table, self.day = spark, path.rstrip("/"), table, day
        self.folder = Folder(spark, path)

    def append(self, rows: DataFrame) -> None:
        """Append with a generated id, in one pass: rules are counted on the write.

        The batch is written aside, where readers do not look, and renamed into place
        only if the rules hold; an empty or failed batch is removed.
        """
        rows = constraints.with_defaults(rows, self.table.defaults)
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.table.schema.fields])
        watched, seen = constraints.observed(typed, self.table.rules)
        keyed = watched.select(F.expr("uuid()").alias("id"), "*", F.to_date(self.day).alias("day"))
        batch = uuid.uuid4().hex
        keyed.write.partitionBy("day").parquet(f"{self.path}/_pending-{batch}")
        counts = seen.get
        kept = counts["rows"] > 0 and not constraints.broken(counts, self.table.rules)
        self.folder.settle(f"_pending-{batch}", f"batch={batch}" if kept else None)
        constraints.raise_if_broken(counts, self.table.rules, self.table.name)

    def read(self) -> DataFrame:
        schema = T.StructType([T.StructField("id", T.StringType()), *self.table.schema.fields, T.StructField("day", T.DateType())])
        if not any(n.startswith("batch=") for n in self.folder.names("")):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path).select(*schema.fieldNames())


def already_applied(manifest: dict, batch: tuple[str, int] | None) -> bool:
    return batch is not None and manifest["marks"].get(f"batch:{batch[0]}", -1) >= batch[1]


def batch_mark(batch: tuple[str, int] | None) -> dict:
    return {f"batch:{batch[0]}": batch[1]} if batch else {}
