"""Commit log of a file sink: a micro-batch writes to a fresh folder and is published by one small file.

A reader takes the published folders only. So it sees each batch whole or not at all, a crash between writing and
publishing leaves nothing behind that is read, and a replay takes the place of what it replays in one
step. Each entry keeps the range of event times of its batch, by which readers leave batches out.
"""

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The leading underscore hides the folder from plain scans of the sink.
COMMITS = "_commits"
ENTRY = "batch_id long, folder string, first long, last long"
EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Commit:
    """A published batch; ``first`` and ``last`` are event times in microseconds, null if it has none."""

    batch_id: int
    folder: str
    first: int | None = None
    last: int | None = None


def micros(time: datetime) -> int:
    """Microseconds since the epoch; a time without a zone is in UTC."""
    naive = time.astimezone(timezone.utc).replace(tzinfo=None) if time.tzinfo else time
    return (naive - EPOCH) // timedelta(microseconds=1)


def fresh_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}/attempt={uuid.uuid4().hex}"


def _file(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file(spark, path)
    return fs.exists(hadoop_path)


def publish(spark: SparkSession, path: str, commit: Commit) -> None:
    """Make a written folder the content of its batch, in place of an earlier one.

    The entry is written aside and renamed over the one of an earlier attempt, which file systems do in one
    step.
    """
    name = f"{path}/{COMMITS}/{commit.batch_id}.json"
    aside, fs = _file(spark, f"{path}/{COMMITS}/.{commit.batch_id}-{uuid.uuid4().hex}")
    entry = commit.__dict__ | {"folder": commit.folder.removeprefix(f"{path}/")}
    out = fs.create(aside)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, jvm.org.apache.hadoop.fs.Path(name), options)


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """All published batches in order; there are as many entries as batches, each of one line."""
    if not exists(spark, f"{path}/{COMMITS}"):
        return []
    entries = spark.read.schema(ENTRY).json(f"{path}/{COMMITS}").orderBy("batch_id")
    return [Commit(*row) for row in entries.collect()]


def read_committed(
    spark: SparkSession,
    path: str,
    fmt: str,
    declared: T.StructType,
    until: datetime | None = None,
) -> DataFrame:
    """Rows of the published batches; with ``until`` only of those that begin no later.

    The cut is by batch: rows of a batch that goes on after ``until`` are all returned.
    """
    found = commits(spark, path)
    if until is not None:
        found = [c for c in found if c.first is not None and c.first <= micros(until)]
    if not found:
        return spark.createDataFrame([], declared)
    folders = [f"{path}/{c.folder}" for c in found]
    rows = spark.read.schema(declared).option("basePath", path).format(fmt).load(folders)
    return rows.select(declared.names)
