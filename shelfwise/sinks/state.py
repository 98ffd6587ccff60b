"""State that must outlive every failure: versions of several tables under one pointer file.

A version is a folder of tables that is never changed once written. The pointer names the version
in force; it is replaced by one rename over the old pointer after everything else, so a stop at
any point leaves either the old version or the new one. A state folder that has versions but no
readable pointer is an error, as taking it for empty would hand out numbers twice.

A state that only grows is kept in parts: the pointer names a first version and the versions of rows
added since, one a line. A run writes its new rows only; many parts are put together now and then.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfwise.sources.files import path_exists

POINTER = "CURRENT"
_VERSION = "version-"
#: Parts of a growing state before they are put together.
MOST_PARTS = 16


def _hadoop(spark: SparkSession, path: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = fs.Path(path)
    return fs, conf, target, target.getFileSystem(conf)


def _pointed(spark: SparkSession, state: str) -> list[str] | None:
    """The folders of the versions in force, oldest first; None for a state that never was published."""
    if path_exists(spark, f"{state}/{POINTER}"):
        text = spark.read.text(f"{state}/{POINTER}", wholetext=True).first()
        names = text[0].split() if text else []
        folders = [f"{state}/{name}" for name in names]
        if not names or not all(n.startswith(_VERSION) and path_exists(spark, f) for n, f in zip(names, folders)):
            raise RuntimeError(f"{state}/{POINTER} names no version")
        return folders
    if path_exists(spark, state):
        _, _, target, system = _hadoop(spark, state)
        if any(s.getPath().getName().startswith(_VERSION) for s in system.listStatus(target)):
            raise RuntimeError(f"{state} has versions but no {POINTER}; a first publish was stopped: move them away to start anew")
    return None


def read_state(spark: SparkSession, state: str, name: str, schema: T.StructType | str, optional: bool = False) -> DataFrame:
    """One table of the versions in force, or an empty one before the first publish.

    A table written there directly, before there were versions, is read as it is. A published state
    without the table is an error unless the table is ``optional``.
    """
    folders = _pointed(spark, state)
    paths = [f"{folder}/{name}" for folder in folders or [state] if path_exists(spark, f"{folder}/{name}")]
    if paths:
        return spark.read.schema(schema).parquet(*paths)
    if folders and not optional:
        raise RuntimeError(f"{state} has no table {name}")
    return spark.createDataFrame([], schema)


def write_version(tables: dict[str, DataFrame], state: str) -> str:
    """Write a version that nobody sees yet; returns its name."""
    version = f"{_VERSION}{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{state}/{version}/{name}")
    return version


def point_to(spark: SparkSession, state: str, version: str) -> None:
    """Put a version, or several as parts of one state, in force."""
    fs, conf, target, system = _hadoop(spark, f"{state}/{POINTER}")
    staged = fs.Path(f"{state}/.{POINTER}-{uuid.uuid4().hex}")
    out = system.create(staged, True)
    out.write(bytearray(version.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(system.getUri(), conf)
    context.rename(system.makeQualified(staged), system.makeQualified(target), options)


def publish_state(tables: dict[str, DataFrame], state: str) -> None:
    """Replace the version in force by one with these tables, all or none."""
    spark = next(iter(tables.values())).sparkSession
    point_to(spark, state, write_version(tables, state))


def append_state(added: dict[str, DataFrame], state: str, most_parts: int = MOST_PARTS) -> None:
    """Add rows to the tables of a state, all tables or none; only these rows are written.

    Rows need not be new tables: each table is the union of its parts. With ``most_parts`` parts, and
    over tables from before there were versions, everything is written as one part again.
    """
    spark = next(iter(added.values())).sparkSession
    parts = _pointed(spark, state)
    if parts is None or len(parts) >= most_parts:
        added = {n: read_state(spark, state, n, df.schema, optional=True).unionByName(df) for n, df in added.items()}
        parts = []
    version = write_version(added, state)
    point_to(spark, state, "\n".join([*(p.rsplit("/", 1)[1] for p in parts), version]))
