"""Session settings and the shared scratch folder for cut lineages."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. A value the cluster set is left alone.
_RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep splitting a skewed join side even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    explicit = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in _RUNTIME.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "shelfwise", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster pass your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "8g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, one subfolder per application.

    Only a local session without that setting gets a folder of its own; on a cluster an
    unset folder is an error, because a machine-local one would not survive an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = "file:" + tempfile.mkdtemp(prefix="shelfwise-scratch-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return f"{configured.rstrip('/')}/shelfwise-{spark.sparkContext.applicationId}"


_scopes: list[str] = []


@contextmanager
def scratch_scope(name: str) -> Iterator[None]:
    """Scratch tables made inside go to a folder of their own, which ``drop_scratch`` can delete alone."""
    _scopes.append(name)
    try:
        yield
    finally:
        _scopes.pop()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared scratch folder, below the scope in force."""
    return "/".join([scratch_root(spark), *_scopes, f"{name}-{uuid.uuid4().hex}"])


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared scratch folder and read it back.

    A columnar table (not an RDD checkpoint) keeps column pruning and statistics for the
    readers, and its rows are fixed however often a later stage is retried.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, scope: str | None = None) -> None:
    """Delete this application's scratch tables, or those of one scope, once their readers are done."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark) + (f"/{scope}" if scope else ""))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
