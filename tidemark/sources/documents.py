"""Landed JSON documents: whole files, with the context their names carry."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import fixed_values as fixed
from tidemark.functions.scalars import ColumnOrName, column
from tidemark.schemas import CALL_LOG


def stem(file_name: ColumnOrName) -> Column:
    """Name without its last extension."""
    name = column(file_name)
    extension = F.length(F.substring_index(name, ".", -1)) + 1
    return F.when(F.contains(name, F.lit(".")), F.left(name, F.length(name) - extension)).otherwise(name)


def first_token(file_name: ColumnOrName) -> Column:
    """Location id or event type: what stands before the first underscore."""
    return F.substring_index(stem(file_name), "_", 1)


def fetched_at(file_name: ColumnOrName) -> Column:
    """Fetch instant: the last token of the name."""
    return F.to_timestamp(F.substring_index(stem(file_name), "_", -1), fixed.STAMP_FORMAT)


def window_start(file_name: ColumnOrName) -> Column:
    """Start of the requested window, where the name has a middle token."""
    tokens = F.split(stem(file_name), "_")
    return F.when(F.size(tokens) > 2, F.get(tokens, F.lit(1)).try_cast("date"))


def name_context(df: DataFrame, file_name: str = "file_name") -> DataFrame:
    return df.withColumns(
        {
            "first_token": first_token(file_name),
            "window_start": window_start(file_name),
            "fetched_at": fetched_at(file_name),
        }
    )


#: Folder of a document that Spark itself landed; a folder can carry its name, a part file cannot.
LANDED = "document"


def land_documents(docs: DataFrame, folder: str) -> None:
    """Write (value, file_name) rows into a landing folder, each as a file of its own.

    Names must be unique.  A document lies in ``document=<file_name>/``, from where all readers
    of this module take its name.  Tasks write the files; nothing is gathered.  On a local or
    mounted file system they write them without Hadoop, which starts a ``chmod`` process for each
    new file, checksum and folder.  There a file is put in place whole under a name that its text
    gives, so a repeated task, or a landing repeated after a failure, leaves each document once.
    """
    named = docs.select("value", F.col("file_name").alias(LANDED))
    path = _mounted(docs.sparkSession, folder)
    if path is None:
        named.write.mode("append").partitionBy(LANDED).text(folder)
    else:
        os.makedirs(path, exist_ok=True)
        named.foreachPartition(_lander(path))


def _mounted(spark: SparkSession, folder: str) -> str | None:
    """The path of a folder on a local or mounted file system, else None."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _lander(path: str) -> Callable[[Iterable[Row]], None]:
    """Writes the documents of a partition as ``partitionBy(LANDED).text`` does; a closure, so workers need not import this module."""
    landed, special = LANDED, r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]"

    def land(rows):
        import hashlib
        import os
        import re
        import uuid

        for value, name in rows:
            name = re.sub(special, lambda m: f"%{ord(m[0]):02X}", name) if name else "__HIVE_DEFAULT_PARTITION__"
            text = ("" if value is None else value).encode() + b"\n"
            target = f"{path}/{landed}={name}"
            os.makedirs(target, exist_ok=True)
            aside = f"{target}/.{uuid.uuid4().hex}"
            with open(aside, "wb") as file:
                file.write(text)
            os.replace(aside, f"{target}/part-{hashlib.sha256(text).hexdigest()}.txt")

    return land


def _file_name() -> Column:
    folder = F.regexp_extract("_metadata.file_path", f"/{LANDED}=([^/]+)/[^/]+$", 1)
    return F.when(folder != "", folder).otherwise(F.col("_metadata.file_name"))


@contextmanager
def _listing_tasks() -> Iterator[None]:
    """A few listing tasks per core inside; by default Spark starts one per folder, up to 10,000, and a landed document has a folder."""
    spark, key = SparkSession.active(), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _files(reader, folder: str | Sequence[str]) -> DataFrame:
    """(value, file_name, path) of the documents below ``folder``; one scan, small files packed together."""
    # wholetext as an argument: as an option it is set back by the method's own default
    with _listing_tasks():
        raw = reader.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="{*.json,part-*.txt}")
    return raw.select("value", _file_name().alias("file_name"), F.col("_metadata.file_path").alias("path"))


def _scan(reader, folder: str | Sequence[str]) -> DataFrame:
    docs = _files(reader, folder)
    return name_context(docs.select("value", "file_name", F.contains("path", F.lit("/historical/")).alias("historical")))


def read_documents(
    spark: SparkSession, folder: str | Sequence[str], fetched_from: Column | None = None, fetched_to: Column | None = None, historical: bool | None = None
) -> DataFrame:
    """One row per document below ``folder``, daily and historical pulls alike.

    The bounds select pulls by their fetch instant (a replay).  They only use file
    metadata, so files outside are not opened.  Spark packs at most 32 small files into a task;
    a folder of many is read by 8 tasks per core, as each task costs more than its files.
    """
    docs = _scan(spark.read, folder).coalesce(8 * spark.sparkContext.defaultParallelism)
    if fetched_from is not None:
        docs = docs.where(F.col("fetched_at") >= fetched_from)
    if fetched_to is not None:
        docs = docs.where(F.col("fetched_at") <= fetched_to)
    if historical is not None:
        docs = docs.where(F.col("historical") == historical)
    return docs


def stream_documents(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same rows as a stream of newly landed files."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _scan(reader, folder)


def named_documents(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """(name, value, fetched_at, file_name) of the documents of several feeds, for the key audit.

    ``folders`` maps feed names to landing folders, none inside another.  All are one scan; a file's
    path tells its feed.  A feed whose file names start with an event type has a name per type, such
    as ``space_weather_CME``; dates and ids are no types.
    """
    docs = name_context(_files(spark.read, list(folders.values())))
    feed = F.coalesce(*[F.when(F.contains("path", F.lit(f"{_bare(folder)}/")), F.lit(name)) for name, folder in folders.items()])
    kind = F.upper("first_token")
    typed = F.when(kind.isin(*fixed.EVENT_TYPES), F.concat(feed, F.lit("_"), kind)).otherwise(feed)
    return docs.select(typed.alias("name"), "value", "fetched_at", "file_name")


def _bare(folder: str) -> str:
    """A folder without scheme and host, as it stands in file paths."""
    return "/" + folder.rstrip("/").split("://", 1)[-1].partition("/")[2] if "://" in folder else folder.rstrip("/").removeprefix("file:")


def read_call_records(spark: SparkSession, folder: str) -> DataFrame:
    """Landed call records, one JSON object per line, of calls that succeeded and of those that failed.

    The rows have the columns of the call log; a line that is no object fails the batch, unknown
    fields are left out, and missing ones are null (the log fills its defaults).
    """
    schema = T.StructType([*CALL_LOG.schema.fields])
    return spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(folder)
