"""Dated, committed snapshots of pulled inputs.

The reference pickles each pulled dataset under a date-stamped name and
reuses it on a second run the same day. Here a snapshot is a folder
``<root>/<name>/run_date=YYYY-MM-DD`` with the data in a folder of its own
(``data-<id>``) and a ``manifest.json`` that names it, with its row count, schema
and, if the caller gives one, a fingerprint of what it was made from.

The manifest is written last, by a rename: without it there is no snapshot, so a
run that died while it wrote leaves nothing that a reader takes for whole. A
snapshot whose files hold another number of rows, whose schema differs from the
one asked for, or that was made from other inputs is refused, and built anew
beside the old data. Several writers don't disturb each other: each writes its
own folder, and the last manifest counts.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "manifest.json"


@dataclass(frozen=True)
class Manifest:
    """What a snapshot must hold."""

    data: str
    rows: int
    schema: str
    inputs: str | None = None


class _Folder:
    """A folder in whatever store its path names (Hadoop's file systems)."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.path = path.rstrip("/")
        self.fs = self.hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}")

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.at(name)):
            return None
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write under another name, then take the place of ``name``."""
        staged = self.at(f".{name}-{uuid.uuid4().hex}")
        stream = self.fs.create(staged, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(staged, self.at(name)):
            self.fs.delete(self.at(name), False)
            if not self.fs.rename(staged, self.at(name)):
                raise OSError(f"{self.path}/{name} could not be written")


def snapshot_path(root: str, name: str, run_date: dt.date) -> str:
    return f"{root.rstrip('/')}/{name}/run_date={run_date.isoformat()}"


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    """Equal names and types in order; what may be NULL isn't compared, as every
    stored column may be."""
    return [(f.name, f.dataType.simpleString()) for f in a] == [(f.name, f.dataType.simpleString()) for f in b]


def write_snapshot(df: DataFrame, path: str, inputs: str | None = None) -> Manifest:
    """Write the data, then the manifest. The rows are counted in the same pass."""
    from sitegauge.operators.quality import observe_rows

    data = f"data-{uuid.uuid4().hex}"
    counted, seen = observe_rows(df, f"snapshot-{data}")
    counted.write.mode("error").parquet(f"{path}/{data}")
    manifest = Manifest(data, seen.get["rows"], df.schema.json(), inputs)
    _Folder(df.sparkSession, path).put(MANIFEST, json.dumps(asdict(manifest)))
    return manifest


def why_not(spark: SparkSession, path: str, schema: T.StructType | None = None, inputs: str | None = None) -> str | None:
    """Why the folder holds no snapshot that may be read; None if it does."""
    text = _Folder(spark, path).read(MANIFEST)
    if text is None:
        return "no manifest"
    manifest = Manifest(**json.loads(text))
    stored = T.StructType.fromJson(json.loads(manifest.schema))
    if schema is not None and not _same_columns(stored, schema):
        return "another schema"
    if inputs is not None and manifest.inputs != inputs:
        return "other inputs"
    if not _Folder(spark, path).fs.exists(_Folder(spark, path).at(manifest.data)):
        return "data missing"
    # counted from file footers: no column is read
    rows = spark.read.schema(stored).parquet(f"{path}/{manifest.data}").agg(F.count(F.lit(1))).first()[0]
    return None if rows == manifest.rows else f"{rows} rows instead of {manifest.rows}"


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None, inputs: str | None = None) -> DataFrame:
    """A committed snapshot; ``ValueError`` says why there is none."""
    reason = why_not(spark, path, schema, inputs)
    if reason is not None:
        raise ValueError(f"{path}: {reason}")
    manifest = Manifest(**json.loads(_Folder(spark, path).read(MANIFEST)))
    return spark.read.schema(T.StructType.fromJson(json.loads(manifest.schema))).parquet(f"{path}/{manifest.data}")


def read_or_build_snapshot(spark: SparkSession, root: str, name: str, run_date: dt.date, build: Callable[[], DataFrame],
                           schema: T.StructType | None = None, inputs: str | None = None) -> DataFrame:
    """The day's snapshot if there is a fitting one, else ``build``'s result written as
    one. With a snapshot there, ``build`` isn't called: its sources may be gone."""
    path = snapshot_path(root, name, run_date)
    if why_not(spark, path, schema, inputs) is not None:
        write_snapshot(build(), path, inputs)
    return read_snapshot(spark, path, schema, inputs)
