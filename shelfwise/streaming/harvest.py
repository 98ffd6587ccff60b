"""Incremental runs: landed pages into a cache, analysis rebuilds, progress follow-up."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwise.operators.indexing import first_wins
from shelfwise.sources.files import path_exists
from shelfwise.sources.harvest import parse_pages

LANDING_SCHEMA = "unit string, page_offset bigint, body string"
ROWS_SCHEMA = (
    "unit string, page_offset bigint, pos int, track_id string, artist string, track string, "
    "album string, first_artist string"
)


def ingest_pages(
    spark: SparkSession, landing: str, cache: str, checkpoint: str, files_per_batch: int = 100,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Consume each landed page file once, parse it and add it to the cache.

    A micro-batch overwrites its own partition of the cache, so a batch repeated after a
    crash replaces itself; the stream checkpoint is the resume point. Refused pages go to a
    folder of their own and never count as consumed. One run takes all pages there are.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        rows, facts, refused = parse_pages(batch)
        for name, part in (("rows", rows), ("pages", facts), ("refused", refused)):
            part.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch").parquet(f"{cache}/{name}")
        batch.unpersist()

    return (
        spark.readStream.schema(LANDING_SCHEMA).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(landing)
        .writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def cached_rows(spark: SparkSession, cache: str) -> DataFrame:
    """Track rows of the cache; a page landed twice counts once (first batch wins)."""
    if not path_exists(spark, f"{cache}/rows"):
        return spark.createDataFrame([], ROWS_SCHEMA)
    stored = spark.read.schema(ROWS_SCHEMA + ", batch bigint").parquet(f"{cache}/rows")
    return first_wins(stored, ["unit", "page_offset", "pos"], "batch").drop("batch")


def cached_pages(spark: SparkSession, cache: str) -> DataFrame:
    """Page facts of the cache, once per page."""
    stored = spark.read.parquet(f"{cache}/pages")
    return first_wins(stored, ["unit", "page_offset"], "batch").drop("batch")


def watch(
    spark: SparkSession, landing: str, schema: str, rebuild: Callable[[], None], checkpoint: str,
    interval: str | None = None, fmt: str = "parquet",
) -> StreamingQuery:
    """Rebuild whenever new cache files land: one pass, or every ``interval`` until stopped."""
    stream = spark.readStream.schema(schema).format(fmt).load(landing)

    def refresh(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            rebuild()

    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def _emit_gains(
    key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    (shown,) = state.get if state.exists else (None,)
    # One small row per run of the stream, so a micro-batch holds few of them.
    snapshots = pd.concat(list(batches)).sort_values("run")
    out = []
    for run, pct in zip(snapshots["run"], snapshots["pct"]):
        if shown is not None and pct > shown:
            out.append((key[0], run, pct, pct - shown))
        shown = pct if shown is None else max(shown, pct)
    state.update((int(shown),))
    yield pd.DataFrame(out, columns=["stream", "run", "pct", "gain"])


def follow_gains(snapshots: DataFrame) -> DataFrame:
    """Streaming form of the progress follow-up: one row per gained point or more.

    ``snapshots`` is a stream of ``stream, run, pct``; the state is one number per stream.
    """
    return snapshots.groupBy("stream").applyInPandasWithState(
        _emit_gains, "stream string, run bigint, pct bigint, gain bigint", "shown bigint", "append",
        GroupStateTimeout.NoTimeout,
    )
